"""Stored tables that are changed in place: files are only ever added, and a log says which ones count.

A table is a folder of Parquet files, dealt into buckets by a hash of the columns that its questions
and changes look up; the bucket is a partition column, so a lookup prunes to the files of its buckets.
A change writes the files it needs under a name of its own and then adds the lines of one commit to the
log: files that came, files that went.  All tables of a store share one log, so a commit changes
several tables or none; a run that breaks before its commit leaves everything as it was, and what
it wrote is never read.  Files that a change does not touch keep their names.

Columns that a table is not dealt by may have stored filters, which tell the buckets that can hold a key
(:mod:`tripweave.sources.filters`).  They are a table of the store too, and grow with it.

The log is written and read by Spark.  What the driver holds is one entry per live file, as it does for
any table it scans.  One writer at a time; readers see the last commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.session import cut_lineage, small_side
from tripweave.sources.filters import filter_rows, may_hold

BUCKET = "bucket"
_LOG = "seq bigint, batch string, table string, file string, bucket int, n_rows bigint, live boolean"
_IN_TABLE = r"(run=[^/]+/bucket=[^/]+/[^/]+)$"


@dataclass(frozen=True)
class Layout:
    """How a table is stored: its columns, its key, the columns it is dealt by, the order in files, and
    the columns with filters of so many cells a bucket."""

    schema: T.StructType
    key: tuple[str, ...]
    bucket_by: tuple[str, ...]
    buckets: int = 64
    sort_by: tuple[str, ...] = ()
    filters: tuple[str, ...] = ()
    filter_cells: int = 8

    def bucket(self, *values: Column) -> Column:
        """The bucket of a row, or of given values of ``bucket_by``."""
        typed = [(v if values else F.col(c)).cast(self.schema[c].dataType) for c, v in zip(self.bucket_by, values or self.bucket_by, strict=True)]
        return F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int")


FILTERS = "key_filters"
_FILTERS = Layout(
    T.StructType().add("table", "string").add("column", "string").add("of", "integer").add("cell", "integer").add("bits", "binary"),
    ("table", "column", "of", "cell"), ("table", "column", "cell"), 16, ("table", "column"),
)
Written = dict[str, "list[File]"]  # files of each table


def joined(*written: Written) -> Written:
    out: Written = {}
    for some in written:
        for table, files in some.items():
            out[table] = out.get(table, []) + files
    return out


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as files may hold them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return kind


@dataclass(frozen=True)
class File:
    path: str  # below the folder of the table
    bucket: int
    n_rows: int


class Store:
    """The stored tables of one folder."""

    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout]):
        self.spark, self.root, self.layouts = spark, root.rstrip("/"), layouts | {FILTERS: _FILTERS}

    # ---- Reading ----

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).json(f"{self.root}/log")

    def create(self, tables: dict[str, DataFrame]) -> None:
        """Start a new store with these tables; others of its layouts are empty."""
        self.commit(joined(*[self.write(name, df) for name, df in tables.items()]), first=True)

    def snapshot(self) -> Snapshot:
        """The tables as of the last commit."""
        log = self._log().where(F.col("table").isNotNull())
        latest = log.groupBy("table", "file").agg(F.max_by(F.struct("bucket", "n_rows", "live"), "seq").alias("last"))
        live = latest.where("last.live").select("table", "file", "last.bucket", "last.n_rows").collect()
        files: dict[str, list[File]] = {name: [] for name in self.layouts}
        for row in live:
            files[row.table].append(File(row.file, row.bucket, row.n_rows))
        return Snapshot(self, files)

    def read(self, table: str) -> DataFrame:
        """One whole table."""
        return self.snapshot().read(table)

    def has_batch(self, batch: str) -> bool:
        """Whether a commit of this name was made."""
        return not self._log().where(F.col("batch") == batch).isEmpty()

    # ---- Writing ----

    def write(self, table: str, df: DataFrame, in_place: bool = False) -> Written:
        """New files with the rows of ``df``, and with the filters of their keys; they count only after a commit.

        Rows are dealt by bucket; one with very many rows is split over several tasks.  ``in_place`` says that the
        rows come from files of this table one by one, without a shuffle: those lie by bucket already and stay
        in their tasks.
        """
        layout, run = self.layouts[table], f"{self.root}/{table}/run={uuid.uuid4().hex}"
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _nullable(layout.schema).fields])
        dealt = typed.withColumn(BUCKET, layout.bucket())
        if not in_place:
            dealt = dealt.hint("rebalance", F.col(BUCKET))
        if layout.sort_by:
            dealt = dealt.sortWithinPartitions(BUCKET, *layout.sort_by)
        dealt.write.partitionBy(BUCKET).parquet(run)
        written = self._scan(table, [run])
        counts = written.groupBy(_file_of(), BUCKET).agg(F.count("*").alias("n"))
        files = [File(*row) for row in counts.collect()]
        if not files:
            return {table: []}
        parts = [{table: files}]
        for column in layout.filters:
            rows = filter_rows(written, BUCKET, column, layout.filter_cells)
            parts.append(self.write(FILTERS, rows.withColumns({"table": F.lit(table), "column": F.lit(column)})))
        return joined(*parts)

    def commit(self, added: Written, removed: Written | None = None, batch: str | None = None, first: bool = False) -> None:
        """Make the added files count and the removed ones not, all at once."""
        seq = 0 if first else 1 + self._log().agg(F.max("seq")).first()[0]
        lines = [(seq, batch, None, None, None, None, True)]
        for live, files in ((False, removed or {}), (True, added)):
            lines += [(seq, batch, table, f.path, f.bucket, f.n_rows, live) for table, some in files.items() for f in some]
        # One file, which its rename makes visible as a whole.
        commit = self.spark.createDataFrame(lines, _LOG).coalesce(1)
        commit.write.mode("errorifexists" if first else "append").json(f"{self.root}/log")

    def _scan(self, table: str, paths: list[str]) -> DataFrame:
        schema = _nullable(self.layouts[table].schema).add(BUCKET, T.IntegerType())
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)


class Snapshot:
    """The live files of all tables at one commit."""

    def __init__(self, store: Store, files: dict[str, list[File]]):
        self.store, self.files = store, files

    def of_buckets(self, table: str, buckets: Iterable[int]) -> list[File]:
        wanted = set(buckets)
        return [f for f in self.files[table] if f.bucket in wanted]

    def read(self, table: str, files: list[File] | None = None, with_file: bool = False) -> DataFrame:
        """The rows of a table, or of some of its files; ``with_file`` adds the column ``file``."""
        layout = self.store.layouts[table]
        files = self.files[table] if files is None else files
        extra = [_file_of()] if with_file else []
        if not files:
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in _nullable(layout.schema).fields]
            extra = [F.lit(None).cast("string").alias("file")] if with_file else []
            return self.store.spark.range(0).select(*empty, *extra)
        found = self.store._scan(table, [f"{self.store.root}/{table}/{f.path}" for f in files])
        return found.select(*layout.schema.names, *extra)

    def lookup(self, table: str, **values: object) -> DataFrame:
        """The rows with given values of the columns that the table is dealt by: reads one bucket, and in
        sorted files only the row groups that may hold them."""
        layout = self.store.layouts[table]
        literals = [F.lit(values[c]) for c in layout.bucket_by]
        # One row without a table: the optimizer computes the bucket.
        bucket = self.store.spark.sql("SELECT 1").select(layout.bucket(*literals)).first()[0]
        rows = self.read(table, self.of_buckets(table, [bucket]))
        for c, v in values.items():
            rows = rows.where(F.col(c) == F.lit(v))
        return rows

    def near(self, table: str, keys: DataFrame) -> list[File]:
        """The files of the buckets that ``keys`` (columns ``bucket_by``) fall in."""
        found = keys.select(self.store.layouts[table].bucket().alias(BUCKET)).distinct().collect()
        return self.of_buckets(table, [row[0] for row in found])

    def holding(self, table: str, rows: DataFrame) -> list[File]:
        """The files that ``rows`` (with a column ``file``) come from."""
        paths = {row[0] for row in rows.select("file").distinct().collect()}
        return [f for f in self.files[table] if f.path in paths]

    def may_hold(self, table: str, column: str, keys: DataFrame) -> list[File]:
        """The files of the buckets that may hold one of ``keys`` (``column``), as far as can be told
        without looking: by the hash that deals the table, or by its filters."""
        layout = self.store.layouts[table]
        if layout.bucket_by == (column,):
            return self.near(table, keys)
        if column not in layout.filters:
            return self.files[table]
        stored = self.read(FILTERS).where((F.col("table") == table) & (F.col("column") == column)).select("of", "cell", "bits")
        found = may_hold(stored, keys.where(F.col(column).isNotNull()).distinct(), column, layout.filter_cells)
        return self.of_buckets(table, [row[0] for row in found.select("of").distinct().collect()])

    def known(self, table: str, column: str, keys: DataFrame) -> DataFrame:
        """(column): those of ``keys`` that the table holds, each once.  Only the key column of buckets
        that may hold one is read."""
        keys = cut_lineage(keys.select(F.col(column).cast(self.store.layouts[table].schema[column].dataType)).distinct())
        rows = self.read(table, self.may_hold(table, column, keys)).select(column)
        return rows.join(keys, column, "left_semi").distinct()

    def with_keys(self, table: str, keys: DataFrame) -> list[File]:
        """The files that hold a row whose values are among ``keys``, columns of the table.

        If the keys have all columns that the table is dealt by, only the buckets they fall in are looked
        at, and of those only the key columns.  A file goes through the join as a hash of its name; should
        two names share one, both files are taken.
        """
        layout, columns = self.store.layouts[table], keys.columns
        keys, n = small_side(keys.distinct())
        if not n:
            return []
        some = self.near(table, keys) if set(layout.bucket_by) <= set(columns) else self.files[table]
        if not some:
            return []
        rows = self.read(table, some, with_file=True).select(*columns, F.xxhash64("file").alias("file"))
        hashes = {row[0] for row in rows.join(keys, columns, "left_semi").select("file").distinct().collect()}
        named = self.store.spark.createDataFrame([(f.path,) for f in some], "path string").select("path", F.xxhash64("path"))
        paths = {path for path, its_hash in named.collect() if its_hash in hashes}
        return [f for f in some if f.path in paths]


def _file_of() -> Column:
    return F.regexp_extract("_metadata.file_path", _IN_TABLE, 1).alias("file")
