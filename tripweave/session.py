"""Session settings, and the two places where work touches shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Rows of texts that go to Python at once, where stages follow each other in one session.
BATCH_ROWS = 500

# Key sets up to this many rows and bytes may be broadcast.
SMALL_KEY_SET = 1_000_000
SMALL_KEY_BYTES = 32 << 20

# What the operators rely on.  All of these may be overridden by the caller.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares, as named in ``spark.checkpoint.dir``, or else
    the checkpoint folder that was given to the context.

    Only a local session may go without the setting; it then gets a folder of
    its own.  On a cluster a machine-local folder would lose data together with
    the machine, so there a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tripweave-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from reliable checkpoint files."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def fixed_plan(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Plan shuffles with so many partitions inside the block, once and for all.

    For loops whose data is far smaller than what the session is set up for, and
    whose partitions have to match.  Without adaptive execution several rounds are one
    job, instead of one for each shuffle.
    """
    with _set_inside(spark, {SHUFFLE_PARTITIONS: str(partitions), "spark.sql.adaptive.enabled": "false"}):
        yield


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Run what is inside the block with at most so many rows in a batch for Python.

    A batch of long texts is held several times at once, by the task and by its worker; Spark's 10,000 rows may be all
    rows of a task.
    """
    with _set_inside(spark, {ARROW_ROWS: str(min(rows, int(spark.conf.get(ARROW_ROWS))))}):
        yield


@contextmanager
def _set_inside(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def small_side(keys: DataFrame, max_rows: int = SMALL_KEY_SET, max_bytes: int = SMALL_KEY_BYTES) -> tuple[DataFrame, int]:
    """Compute a key set that is expected to be small, and say how many rows it has.

    The set gets a broadcast hint only if its rows, and the bytes of its texts, have been
    counted and are within the bounds; a larger one is returned without a hint and is joined
    by shuffle.  Knowing the size up front spares the large side the shuffle that
    adaptive execution would already have written before it could change its
    mind.
    """
    stored = cut_lineage(keys)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in stored.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(8 * len(stored.columns)) + sum(texts, F.lit(0))
    size = stored.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return (F.broadcast(stored) if size.rows <= max_rows and size.bytes <= max_bytes else stored), size.rows
