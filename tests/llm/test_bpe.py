"""Encoding against the public library on the same rank file."""

import hashlib
import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL

from tripweave.llm import bpe
from tripweave.llm.chunks import Memory, chunks_of
from tripweave.llm.chunks import encoded as chunk_values

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def encoded(texts):
    return bpe.TextEncoder(PATH, public_tokenizers.PATTERN)(pa.array(texts, pa.string()))


def test_odd_texts(library):
    draw = random.Random(1)
    texts = ["", " ", "a  b   c", "x \n \n y", "\t \t", " " * 90, "é" * 300, "ab" * 900, "aaaa" * 400, "it's we'll 12 ½²", "😀‍😀　x"]
    texts += ["".join(draw.choice("abcdethinor") for _ in range(1500))]
    texts += ["".join(draw.choice(" \n\tabé'1.!sx") for _ in range(draw.randrange(60))) for _ in range(800)]
    texts += ["".join(draw.choice("  \u00a0\u2003\u3000\u0085\u1680\u2028\x1c\x7fa漢ж1.é") for _ in range(draw.randrange(40))) for _ in range(1500)]
    ids, decoded = encoded(texts)
    for text, some, back in zip(texts, ids.parts(), decoded.parts(), strict=True):
        assert some.tolist() == library.encode_ordinary(text), text
        assert back.tobytes() == text.encode()
        assert "".join(chunks_of(text)) == text


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    coded = bpe.encode_texts(docs, PATH, public_tokenizers.PATTERN)
    back = bpe.decode_ids(coded, PATH).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(back) == len(texts)
    for r in back:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode() and len(r.ids) == r.n_tokens


def test_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, None), (1, None), (None, "ab c"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("'x' as TEXT", "1 as ids", "doc_id", "text")
    got = bpe.encode_texts(docs, PATH, public_tokenizers.PATTERN, with_ids=False).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *digests(library, t)) for i, t in rows], key=str)
    assert bpe.encode_texts(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_memory_forgets_and_keeps():
    memory, asked = Memory(6 * Memory.ENTRY, longest=3), []
    double = lambda new: asked.extend(new) or [w * 2 for w in new]
    for keys in ("ab", "bc", "de", "bf", "a", [*"abcdefghij", "long" * 9], ["long" * 9, "1,2"]):
        got = chunk_values([*keys], lambda c: c.split(","), double, "-".join, memory)
        assert got == ["11-22" if k == "1,2" else k * 2 for k in keys]
        assert "long" * 9 not in memory.young
    assert asked.count("b") < 3 and asked.count("long" * 9) == 2


def test_memory_is_bounded_in_bytes():
    memory = Memory(200_000)
    for i in range(200):
        for key in [f"{i}-{j}" for j in range(50)] + ["x" * 50_000 + str(i)]:
            memory.lookup([key])
            memory.put(key, key)
    assert len(memory.young) + len(memory.old) < 2000 and all(len(k) <= 64 for k in [*memory.young, *memory.old])


def test_long_words(library):
    """In seconds, whatever is in them."""
    draw = random.Random(2)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFabcdefghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/", "a", "ab", "é", "漢字仮名", "01", "=-", " ", "\n "]
    texts = ["".join(draw.choice(kind) for _ in range(n)) for kind in kinds for n in (65, 1023, 20_000)]
    texts += ["".join(draw.choice(kinds[0]) for _ in range(100_000)), "x" * 30 + "y" * 70 + "ing" * 400]
    ids, decoded = encoded(texts)
    for text, some, back in zip(texts, ids.parts(), decoded.parts(), strict=True):
        assert some.tolist() == library.encode_ordinary(text) and back.tobytes() == text.encode()


def test_indented_texts_leave_little_behind():
    encoder = bpe.TextEncoder(PATH, public_tokenizers.PATTERN)
    for i in range(20):
        lines = [f"\t  if x{i * 50 + j}:\n      y  \n" for j in range(2500)]
        encoder(pa.array(["".join(lines)]))
    assert encoder.memory.size < 5_000_000
