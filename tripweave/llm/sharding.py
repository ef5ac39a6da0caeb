"""A reproducible shuffle: a Feistel permutation of global row numbers.

The place of a row in the shuffle is computed from its number, the number of rows and a
seed alone, and back; nothing has to be sorted by a random key.  Place p is slot p // shards
of shard p % shards, so the shards differ by one row at most and their slots have no gaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import pick
from tripweave.llm.words import mix
from tripweave.session import cut_lineage

ROUNDS = 6
SEED = 20_240


def _keys(seed: int) -> list[np.uint64]:
    return [mix(np.array([seed * 1_000_003 + r], np.uint64))[0] for r in range(ROUNDS)]


def _round(half: np.ndarray, key: np.uint64, mask: np.uint64) -> np.ndarray:
    return mix(half * np.uint64(0x9E3779B97F4A7C15) + key) & mask


def _once(x: np.ndarray, bits: int, keys: list[np.uint64], back: bool) -> np.ndarray:
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> shift, x & mask
    for key in reversed(keys) if back else keys:
        if back:
            left, right = right ^ _round(left, key, mask), left
        else:
            left, right = right, left ^ _round(right, key, mask)
    return (left << shift) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The place of each number 0 to n - 1 in the shuffle; with ``back``, the number at each place.

    The network permutes the next power of four; places beyond the end walk on along their
    cycle until they are within it, which takes fewer than four steps on average.
    """
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _keys(seed)
    out = _once(np.asarray(numbers).astype(np.uint64), bits, keys, back)
    while len(far := np.flatnonzero(out >= np.uint64(n))):
        out[far] = _once(out[far], bits, keys, back)
    return out.astype(np.int64)


def locate(numbers: np.ndarray, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of global row numbers."""
    place = permute(numbers, n, seed)
    return place % shards, place // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """The global row number at a slot of a shard."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def number_rows(rows: DataFrame, *keys: str) -> tuple[DataFrame, dict[int, int]]:
    """(rows with ``part`` and ``place`` in it, number of rows before each part), in the order of ``keys``.

    Ranges are cut by the keys and then by a row number, so that many rows with equal keys spread.
    The order is stored before it is counted, and one count for each part reaches the driver.
    """
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])

    names = rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            columns = {name: batch.column(name) for name in names}
            columns["part"] = pa.array(np.full(batch.num_rows, part), pa.int32())
            columns["place"] = pa.array(np.arange(at, at + batch.num_rows), pa.int64())
            at += batch.num_rows
            yield pa.RecordBatch.from_pydict(columns)

    numbered = cut_lineage(ordered.mapInArrow(number, schema))
    counts = {r.part: r.n for r in numbered.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    return numbered, before | {-1: total}


def shard_documents(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 8.  The law is ``rows``: counts of the
    shards differ by one at most, so ``grown_shard`` is null.  Rows are numbered by doc_id (nulls
    first), size and checksum; repeated rows each have a place of their own.  Other columns are not
    read, and texts are not shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    numbered, before = number_rows(rows, "doc_id", "size", "text_crc32")
    n = before[-1]
    starts = docs.sparkSession.sparkContext.broadcast(before)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, at = batch.column("part").to_numpy(), batch.column("place").to_numpy()
            known = np.array([starts.value[p] for p in np.unique(parts).tolist()], np.int64)
            shard, slot = locate(known[np.unique(parts, return_inverse=True)[1]] + at, n, shards, seed)
            columns = [batch.column(c) for c in ("doc_id", "size", "text_crc32")]
            columns += [pa.array(["rows"] * batch.num_rows), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())]
            columns.append(pa.nulls(batch.num_rows, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("law", T.StringType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("slot", T.LongType()),
            T.StructField("grown_shard", T.IntegerType()),
        ]
    )
    return numbered.mapInArrow(place, schema)
