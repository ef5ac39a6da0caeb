"""Stored Bloom filters of the keys of a table, one for each of its buckets, in Spark's own functions.

A filter is a list of cells of 32,768 bits each.  A key sets a few bits, chosen by hashes of it; a key whose
bits are not all set is not in the bucket.  Filters of more rows are added as further rows, and combined by OR
when they are read.  A filter never forgets, so after a delete it may say "maybe" for keys that are gone; what
it says is therefore always followed by an exact look at the buckets it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_BITS = 32_768
HASHES = 4


def _positions(key: Column, cells: int) -> Column:
    """The bits of a key in a filter of so many cells."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(cells * CELL_BITS)) for i in range(HASHES)])


def _cell(position: Column) -> Column:
    return F.floor(position / CELL_BITS).cast("int")


def filter_rows(rows: DataFrame, bucket: str, key: str, cells: int) -> DataFrame:
    """(of, cell, bits): the filters of the keys in ``rows``, one list of cells for each ``bucket``."""
    known = rows.where(F.col(key).isNotNull())
    set_bits = known.select(F.col(bucket).alias("of"), F.explode(_positions(F.col(key), cells)).alias("position"))
    placed = set_bits.select("of", _cell(F.col("position")).alias("cell"), F.expr(f"position % {CELL_BITS}").alias("bit"))
    return placed.groupBy("of", "cell").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def may_hold(filters: DataFrame, keys: DataFrame, key: str, cells: int) -> DataFrame:
    """(key, of): the buckets that may hold each key; a pair that is missing is certain.

    Each bit of a key meets the cells it lies in, of all buckets, in an equality join.
    """
    merged = filters.groupBy("of", "cell").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = keys.select(F.col(key), F.posexplode(_positions(F.col(key), cells)).alias("i", "position"))
    asked = asked.select(key, "i", _cell(F.col("position")).alias("cell"), F.expr(f"position % {CELL_BITS}").alias("bit"))
    told = asked.join(merged, "cell").where(_is_set(F.col("bits"), F.col("bit"))).select(key, "of")
    return told.groupBy(key, "of").agg(F.count("*").alias("n")).where(F.col("n") == HASHES).select(key, "of")
