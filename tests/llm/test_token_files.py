"""Bit-packed files against the library's own ids."""

import io
import random
import string
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from conftest import SMALL
from tokenizers import Tokenizer

from tripweave.llm import token_files as tf
from tripweave.llm.chunks import chunks_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(0).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = tf.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8) and (tf.unpack(packed, bits, 1001) == ids).all()
    assert tf.pack(ids[:0], bits) == b"" and tf.bits_for(1 << bits) == bits


def test_random_access():
    docs = [np.arange(n, dtype=np.uint32) * 7 % 1000 for n in (0, 5, 40, 0, 100, 1)]
    out = io.BytesIO()
    writer = tf.Writer(out, 10, block_ids=16)
    for k, ids in enumerate(docs):
        writer.add(None if k == 1 else k, ids)
    writer.close()
    reader = tf.Reader(pa.BufferReader(out.getvalue()))
    assert reader.doc_ids == [0, None, 2, 3, 4, 5]
    for k in (4, 1, 0, 5):
        assert (reader.document(k) == docs[k]).all()
    assert all((ids == docs[k]).all() for k, ids in reader.documents(blocks_at_once=1))


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_the_library_as_it_is():
    """Names of special tokens become these tokens; chunks give what whole texts give."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "x  <|endoftext|>", "<|endoftext|><|endoftext|>", None, "", "a  b\n c \u2003 d", "caf\u00e9  \u0436\u0436 \u6f22 1 \u00a0 2", " " * 50, "x" * 5000]
    draw = random.Random(4)
    texts += ["".join(draw.choice("  \u00a0\u2003\u3000\u0085\x1c\x7f\n\ta漢ж1.é'sʼª²") for _ in range(draw.randrange(60))) for _ in range(2000)]
    texts += ["".join(draw.choice("  abé'1.!sx") for _ in range(draw.randrange(60))) for _ in range(2000)]
    got = tf.Encoder(PATH)(pa.array(texts, pa.string()))
    assert [ids.tolist() for ids in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got[0].tolist() == [64, 220, 50256, 275]


def test_signs_are_cut_off_words():
    """So a word is the same chunk whatever follows it, and is encoded once."""
    assert chunks_of(" word, word. (x-ray2) it's") == [" word", ",", " word", ".", " (", "x", "-", "ray2", ")", " it", "'s"]
    split = regex.compile(public_tokenizers.PATTERN).findall
    draw = random.Random(9)
    for alphabet in ("ab1 '.,-\n", string.printable, "as tdlmrev'\u2019\u00e9.1"):
        for _ in range(3000):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(40)))
            assert [m for c in chunks_of(text) for m in split(c)] == split(text)


def test_a_remembered_word_is_not_split_again():
    encode, asked = tf.Encoder(PATH), []
    split = encode.split
    encode.split = lambda chunk: asked.append(chunk) or split(chunk)
    encode(pa.array([f"word{sign} alone{sign}" for sign in ".,;:!?)"]))
    assert set(asked) <= set(".,;:!?)")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tokens = tf.write_tokens(docs, PATH)
    assert tokens.bits == 16
    got = sorted(map(tuple, tf.read_tokens(spark, tokens).collect()))
    assert got == expected(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_nulls_and_repeats(spark):
    rows = [(3, "b"), (1, None), (2, ""), (3, "b"), (None, "x  \n y"), (5, "naïve <|endoftext|> 漢字 ñu 😀 it's \u1c80x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as tie", "2 as ROW")
    got = sorted(map(tuple, tf.read_tokens(spark, tf.write_tokens(docs, PATH)).collect()), key=lambda r: r[1])
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    empty = tf.write_tokens(docs.limit(0), PATH)
    assert empty.files == [] and tf.read_tokens(spark, empty).count() == 0
