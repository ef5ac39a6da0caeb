"""Picking columns, and moving rows between Spark and numpy as Arrow buffers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that a task works on at once.  A longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns, even if others differ from them only in case or repeat a name."""
    columns = df.columns
    numbered = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return numbered.select(*[F.col(f"c{columns.index(name)}").alias(name) for name in names])


def in_plain_names(docs: DataFrame, used: tuple[str, ...], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``change`` of ``docs``, with the columns and names of ``docs``, while all columns but the used
    ones have names that clash with nothing."""
    names = docs.columns
    plain = [n if n in used else f"_column{i}" for i, n in enumerate(names)]
    return change(docs.toDF(*plain)).select(*plain).toDF(*names)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or of one row."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def ragged(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list column of slices of ``values``."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a folder; Python workers of the session will look for this package where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
