"""Token ids in fixed-width bit packing, written and read as files in the shared folder.

A file holds the documents of one task in order.  Each id takes the fewest bits that hold
every id of the vocabulary, least bit first.  Ids are cut into blocks of equal count, and a
block starts on a byte, so that any block can be read alone and unpacked by numpy:

    magic "TIDS" | blocks | uint64 offsets of the blocks and of their end |
    uint64 first id of each document, and the number of ids | int64 doc ids | uint8 whether each is known |
    footer: uint32 bits, uint32 ids in a block, uint64 blocks, uint64 documents
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tripweave.llm.chunks import Memory, encode_by_chunks, encoded
from tripweave.llm.columns import pick, slices
from tripweave.session import cut_lineage, fresh_folder

MAGIC = b"TIDS"
BLOCK_IDS = 1 << 16
END_ID = 2
SLICE = 8 << 20  # bytes of text that a task encodes at once
LIBRARY_BATCH = 1000  # texts in one call of the library
REMEMBERED_BYTES = 320 << 20  # words, chunks and their ids that a worker remembers

_FOOTER = struct.Struct("<IIQQ")


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (each.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(1).astype(np.uint32)


class Writer:
    """Writes one file; holds one block of ids and the index."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.blocks, self.starts, self.doc_ids = [len(MAGIC)], [0], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            self._flush(self.n_waiting - self.n_waiting % self.block_ids)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, count, self.block_ids):
            packed = pack(ids[at : min(at + self.block_ids, count)], self.bits)
            self.out.write(packed)
            self.blocks.append(self.blocks[-1] + len(packed))
        self.waiting, self.n_waiting = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.n_waiting)
        self.out.write(np.array(self.blocks, "<u8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([i is not None for i in self.doc_ids], np.uint8).tobytes())
        self.out.write(_FOOTER.pack(self.bits, self.block_ids, len(self.blocks) - 1, len(self.doc_ids)))


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - _FOOTER.size)
        self.bits, self.block_ids, n_blocks, n_docs = _FOOTER.unpack(source.read(_FOOTER.size))
        index = 8 * (n_blocks + 1) + 8 * (n_docs + 1) + 9 * n_docs
        source.seek(size - _FOOTER.size - index)
        data = source.read(index)
        self.blocks = np.frombuffer(data, "<u8", n_blocks + 1).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, 8 * (n_blocks + 1)).astype(np.int64)
        keys = np.frombuffer(data, "<i8", n_docs, 8 * (n_blocks + n_docs + 2))
        known = np.frombuffer(data, np.uint8, n_docs, len(data) - n_docs)
        self.doc_ids = [int(k) if ok else None for k, ok in zip(keys, known, strict=True)]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, -(-end // self.block_ids)
        self.source.seek(int(self.blocks[first]))
        data = self.source.read(int(self.blocks[last] - self.blocks[first]))
        out = []
        for b in range(first, last):
            count = min(self.block_ids, int(self.starts[-1]) - b * self.block_ids)
            out.append(unpack(data[self.blocks[b] - self.blocks[first] : self.blocks[b + 1] - self.blocks[first]], self.bits, count))
        return np.concatenate(out)[start - first * self.block_ids : end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self, blocks_at_once: int = 16) -> Iterator[tuple[int, np.ndarray]]:
        """(number in the file, ids) of every document, reading some blocks at a time."""
        at, held, base = 0, np.zeros(0, np.uint32), 0
        while at < len(self.doc_ids):
            if self.starts[at + 1] > base + len(held):
                base = int(self.starts[at])
                end = max(int(self.starts[at + 1]), base + blocks_at_once * self.block_ids)
                held = self.ids(base, min(end, int(self.starts[-1])))
            yield at, held[self.starts[at] - base : self.starts[at + 1] - base]
            at += 1


def _splits_like_the_pattern(spec: dict) -> bool:
    """Whether a tokenizer cuts texts by the public pattern and merges each match alone."""
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    own = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    return own and plain and model.get("type") == "BPE" and spec.get("normalizer") is None


# The library's names of bytes: printable ones are themselves, the others follow from 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_NAMES = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder:
    """Arrow texts -> ids by the tokenizers library, as it is: names of special tokens in a text become these tokens.

    Where the tokenizer merges each match of the public pattern alone, each different match goes through the
    library's model once as long as it is remembered.  Chunks with characters beyond the Latin letters, on which two
    libraries might differ in what a letter is, texts that hold the name of a special token, and texts for other
    tokenizers go through the whole library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, regex.compile(public_tokenizers.PATTERN).findall
        self.in_chunks = _splits_like_the_pattern(spec)
        self.names = [t["content"] for t in spec.get("added_tokens") or []]
        self.memory = Memory(REMEMBERED_BYTES)

    def whole(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), LIBRARY_BATCH):
            for coded in self.tokenizer.encode_batch_fast(texts[at : at + LIBRARY_BATCH], add_special_tokens=False):
                yield np.array(coded.ids, "<u4").tobytes()

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        texts = texts.fill_null("")
        apart = np.full(len(texts), not self.in_chunks)
        for name in self.names:
            apart |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        pieces = encode_by_chunks(texts.filter(pa.array(~apart)), self._chunks, ("<u4",))[0]
        parts, named = iter(pieces.parts()), self.whole(texts.filter(pa.array(apart)).to_pylist())
        return [np.frombuffer(next(named), "<u4") if a else next(parts) for a in apart.tolist()]

    def _chunks(self, chunks: list[str]) -> list[list[bytes]]:
        return [encoded(chunks, self._matches, self._words, b"".join, self.memory)]

    def _matches(self, chunk: str) -> list[str]:
        return self.split(chunk) if _latin(chunk) else [chunk]

    def _words(self, new: list[str]) -> Iterator[bytes]:
        rest = self.whole([w for w in new if not _latin(w)])
        for word in new:
            if word.isascii():
                # Of what is printable, the space alone has another name.
                name = word.replace(" ", _NAMES[32]) if word.isprintable() else word.translate(_NAMES)
            elif _latin(word):
                name = word.encode().decode("latin-1").translate(_NAMES)
            else:
                yield next(rest)
                continue
            yield array("I", [t.id for t in self.model.tokenize(name)]).tobytes()


def _latin(text: str) -> bool:
    return text.isascii() or max(text) < "\u0250"


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one for each worker process; what it remembers is bounded in bytes."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class File(NamedTuple):
    path: str
    n_docs: int
    n_ids: int
    start: int  # ids of all files before it


@dataclass
class TokenFiles:
    """What was written: files in ascending order of documents."""

    folder: str
    bits: int
    files: list[File]



def open_tokens(file: File) -> Reader:
    system, path = fs.FileSystem.from_uri(file.path)
    return Reader(system.open_input_file(path))


_WRITTEN = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, folder: str | None = None) -> TokenFiles:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order.

    Rows are ordered by doc_id (nulls first), then by a hash of the text; rows equal in both are
    equal.  A null or empty text has the end id alone.  Other columns of ``docs`` are not read.

    Texts are range-partitioned before they are encoded, so sampling the ranges costs a scan and no
    encoding; a row number breaks ties, so that many equal rows do not share a task.  A task
    that runs twice writes two files, and only the one whose row came back counts.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    bits = bits_for(Tokenizer.from_file(path).get_vocab_size())
    keys = ["doc_id", "tie", "row"]
    sorted_docs = (
        pick(docs, "doc_id", "text")
        .select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tids"
        writer = out = None
        encode = encoder(path)
        for batch in slices(batches, most=SLICE):
            if writer is None:
                system, place = fs.FileSystem.from_uri(name)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(place)
                writer = Writer(out, bits)
            end = np.array([end_id], np.uint32)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            out.close()
            row = [[part], [name], [len(writer.doc_ids)], [writer.starts[-1]]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=_WRITTEN.names)

    # One row for each file reaches the driver.
    written = cut_lineage(sorted_docs.mapInArrow(write, _WRITTEN)).orderBy("part").collect()
    files, start = [], 0
    for r in written:
        files.append(File(r.path, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return TokenFiles(folder, bits, files)


def read_tokens(spark, tokens: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; one task reads a file."""
    files = spark.sparkContext.broadcast(tokens.files)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                file = files.value[k]
                reader = open_tokens(file)
                sums = [(n, zlib.crc32(ids.astype("<u4").tobytes())) for n, ids in reader.documents()]
                columns = [
                    pa.array(reader.doc_ids, pa.int64()),
                    pa.array(file.start + reader.starts[:-1], pa.int64()),
                    pa.array(np.diff(reader.starts), pa.int64()),
                    pa.array([s for _, s in sums], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = len(tokens.files)
    return spark.range(0, n, 1, max(n, 1)).mapInArrow(read, schema)
