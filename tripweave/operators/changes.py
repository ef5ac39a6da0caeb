"""Changes to tables: upserts, deletes with their rules, and schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import model
from tripweave.operators.documents import once_per_trip


def upsert(
    base: DataFrame, batch: DataFrame, key: str, properties: list[str] | None = None, sequence: str | None = None
) -> DataFrame:
    """Insert the rows of ``batch`` whose key is new, and overwrite the listed
    properties of the others.  A null property of the batch removes the value.

    A key that the batch repeats takes its last row by ``sequence``, a null sequence
    being before all others; the repeats are reduced per task before they are shuffled.
    Without ``sequence`` a repeated key fails the job, since rows of a DataFrame have no
    order.  Columns of ``base`` that are not listed keep their value, and are null in
    inserted rows.
    """
    if properties is None:
        properties = [c for c in batch.columns if c in base.columns and c != key]
    rows = batch.where(F.col(key).isNotNull())
    if sequence:
        order = F.struct(F.col(sequence).isNotNull(), F.col(sequence))
        rows = rows.groupBy(key).agg(F.max_by(F.struct(*properties), order).alias("new"))
    else:
        complaint = F.raise_error(F.concat(F.lit("the batch repeats the key "), F.col(key).cast("string")))
        rows = rows.groupBy(key).agg(F.first(F.struct(*properties)).alias("new"), F.count("*").alias("n"))
        rows = rows.where(F.when(F.col("n") > 1, complaint.cast("boolean")).otherwise(F.lit(True))).drop("n")
    rows = rows.withColumnRenamed(key, "_key")

    joined = base.join(rows, F.col(key) == F.col("_key"), "full_outer")
    in_batch = F.col("_key").isNotNull()

    def merged(column: str) -> Column:
        if column == key:
            return F.coalesce(key, "_key")
        if column in properties:
            return F.when(in_batch, F.col("new")[column]).otherwise(F.col(column))
        return F.col(column)

    return joined.select(*[merged(c).alias(c) for c in base.columns])


def delete_cascade(
    users: DataFrame, trips: DataFrame, events: DataFrame, doomed: DataFrame
) -> dict[str, DataFrame]:
    """What is left after deleting the riders in ``doomed`` (a column of
    ``user_id``), their trips, and the events of those trips."""
    # No DISTINCT on the key sides: semi and anti joins do not need it, and only a
    # side that comes straight from its shuffle lets heavy keys be split.
    keys = doomed.select("user_id")
    doomed_trips = trips.join(keys, "user_id", "left_semi").select("trip_id")
    return {
        "users": users.join(keys, "user_id", "left_anti").select(users.columns),
        "trips": trips.join(keys, "user_id", "left_anti").select(trips.columns),
        "events": events.join(doomed_trips, "trip_id", "left_anti").select(events.columns),
    }


def delete_blocked(doomed: DataFrame, trips: DataFrame) -> DataFrame:
    """The stations in ``doomed`` that may not be deleted because a trip starts
    or ends there."""
    used = trips.select(F.explode(F.array("start_station", "end_station")).alias("station_id")).distinct()
    return doomed.select("station_id").distinct().join(used, "station_id", "left_semi")


def add_column(df: DataFrame, name: str, kind: T.DataType) -> DataFrame:
    """Add a nullable column; a column that is already there stays as it is."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(kind))


def _level(value: Column, strict: bool) -> Column:
    number = value.try_cast("int")
    if not strict:
        return number
    complaint = F.raise_error(F.concat(F.lit("not a battery level: "), value)).cast("int")
    return F.when(value.isNull() | number.isNotNull(), number).otherwise(complaint)


def backfill_battery(events: DataFrame, overwrite: bool = False, strict: bool = True) -> DataFrame:
    """Fill the battery level of BATTERY rows from the event value.

    Levels that are set already stay, unless ``overwrite``.  Text that is no
    number fails the job if ``strict``, and gives null otherwise.  Only the
    values of BATTERY rows are ever cast.
    """
    events = add_column(events, "battery_level", T.IntegerType())
    old, value = F.col("battery_level"), F.col("value")
    needed = F.col("event_type") == "BATTERY"
    if not overwrite:
        needed = needed & old.isNull()
    return events.withColumn("battery_level", F.when(needed, _level(value, strict)).otherwise(old))


def backfill_battery_nested(docs: DataFrame, strict: bool = True) -> DataFrame:
    """The same inside documents: every embedded BATTERY event gets its level
    from its value, also where it had one; other events stay as they are."""
    item = docs.schema["events"].dataType.elementType
    has_level = "battery_level" in item.names

    def filled(e: Column) -> Column:
        old = e["battery_level"] if has_level else F.lit(None).cast("int")
        level = F.when(e["event_type"] == "BATTERY", _level(e["value"], strict)).otherwise(old)
        return e.withField("battery_level", level)

    return docs.withColumn("events", F.transform("events", filled))


def modified_count(docs: DataFrame) -> DataFrame:
    """(n_trips): how many trips :func:`backfill_battery_nested` would change."""
    has_level = "battery_level" in docs.schema["events"].dataType.elementType.names
    # Only the fields that matter, so that a scan reads no others.
    needed = ["event_type", "value"] + (["battery_level"] if has_level else [])
    events = F.arrays_zip(*[F.col(f"events.{name}") for name in needed])

    def changes(e: Column) -> Column:
        old = e["battery_level"] if has_level else F.lit(None).cast("int")
        return (e["event_type"] == "BATTERY") & ~e["value"].try_cast("int").eqNullSafe(old)

    changed = docs.where(F.exists(events, changes)).select("trip_id", "part", "parts")
    return once_per_trip(changed).agg(F.count("*").alias("n_trips"))


def sample_event(events: DataFrame, event_type: str = "BATTERY") -> DataFrame:
    """One event of the given type: the one with the smallest key."""
    found = events.where(F.col("event_type") == event_type)
    return found.select("event_id", "value", "battery_level").orderBy("event_id").limit(1)


def validate_battery(events: DataFrame) -> DataFrame:
    """The evolved events that break a battery rule."""
    holds = F.expr(f"({model.BATTERY_RANGE}) AND ({model.BATTERY_ONLY})")
    return events.where(~F.coalesce(holds, F.lit(True)))
