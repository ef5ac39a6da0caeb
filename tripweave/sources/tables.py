"""Table scans and sinks.

Reads always carry an explicit schema: no inference pass over the data, and an
empty file keeps its columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.model import SCHEMAS

_RAW = "_damaged_line"


class Checked(NamedTuple):
    """What a checked scan of text files gave."""

    rows: DataFrame
    damaged: DataFrame  # file, line
    n_rows: int
    n_damaged: int


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Scan one table; ``fmt`` is parquet, json (one object per line) or csv (with header)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def scan_checked(spark: SparkSession, path: str, schema: T.StructType, staging: str, fmt: str = "json", header: bool = True) -> Checked:
    """Scan JSON lines or CSV whose lines may be damaged: cut off, of another shape, or with a value that does not
    fit its column.  Such lines go to quarantine as they stand, with the name of their file, instead of
    becoming rows of nulls.

    The text is read once, into a new folder ``staging`` that holds the rows and the quarantine; both counts come
    from that write.  A CSV line is damaged too if it has not as many fields as the schema.  That a value
    is there at all is the business of the row rules.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"only text has damaged lines, not {fmt}")
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [T.StructField(_RAW, T.StringType())])
    reader = spark.read.schema(loose).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    if fmt == "csv":
        reader = reader.option("header", header)
    damaged = F.col(_RAW).isNotNull()
    kept = [F.when(~damaged, F.col(f.name)).alias(f.name) for f in schema.fields]
    read = reader.format(fmt).load(path).select(*kept, F.when(damaged, F.col("_metadata.file_path")).alias("_file"), _RAW, damaged.alias("_damaged"))
    seen = Observation()
    counts = F.count_if(~F.col("_damaged")).alias("rows"), F.count_if(F.col("_damaged")).alias("damaged")
    read.observe(seen, *counts).write.partitionBy("_damaged").parquet(staging)
    stored = T.StructType([*loose.fields[:-1], T.StructField("_file", T.StringType()), loose.fields[-1], T.StructField("_damaged", T.BooleanType())])
    staged = spark.read.schema(stored).parquet(staging)
    rows = staged.where(~F.col("_damaged")).select(schema.names)
    quarantine = staged.where("_damaged").select(F.col("_file").alias("file"), F.col(_RAW).alias("line"))
    return Checked(rows, quarantine, seen.get["rows"], seen.get["damaged"])


VERSION = "version"


def write_version(df: DataFrame, path: str, version: int, mode: str = "append") -> None:
    """Write documents of one schema version into a folder that may hold others."""
    write_table(df.withColumn(VERSION, F.lit(version)), path, mode=mode, partition_by=[VERSION])


def read_versions(spark: SparkSession, path: str, schemas: dict[int, T.StructType]) -> DataFrame:
    """The documents of all versions in a folder, with the schema of the newest and their ``version``.

    Fields that came later are null in older documents, so newer schemas may only add optional fields.  A
    condition on the version prunes to its files.
    """
    newest = schemas[max(schemas)]
    return read_table(spark, path, T.StructType([*newest.fields, T.StructField(VERSION, T.IntegerType())]))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Write one table from all tasks in parallel.

    ``mode="append"`` is the bulk insert, ``mode="overwrite"`` the clear and
    reload.  ``sort_by`` range-partitions and sorts the rows first, which gives
    every Parquet row group a narrow value range to prune by.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def load_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The four tables of the model from ``folder/<table>``."""
    return {name: read_table(spark, f"{folder}/{name}", schema, fmt) for name, schema in SCHEMAS.items()}


def save_tables(
    tables: dict[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    sort_by: dict[str, list[str]] | None = None,
) -> None:
    """Write tables to ``folder/<name>`` for :func:`load_tables`."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", fmt, mode, sort_by=(sort_by or {}).get(name))
