"""Changes to stored tables: merge, deletes with their rules, backfill, and inserts that check.

Each function changes a :class:`tripweave.sources.store.Store` by one commit.  Only files that
hold a row to be changed are read whole and written anew; which ones these are is found on key columns
of the buckets that the change falls in.  All of them run their jobs when called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import model
from tripweave.operators import changes, quality
from tripweave.session import SMALL_KEY_SET, cut_lineage, fresh_folder, small_side
from tripweave.sources.store import File, Layout, Snapshot, Store, Written, joined
from tripweave.sources.tables import read_table, write_table


class Blocked(ValueError):
    """A delete that other rows forbid; ``keys`` are the ones that they refer to."""

    def __init__(self, table: str, keys: DataFrame):
        super().__init__(f"rows of {table} are still referred to")
        self.keys = keys


REJECTED = "_rejected"

EVENTS_V2 = T.StructType([*model.EVENTS.fields, T.StructField("battery_level", T.IntegerType())])
EDGES = T.StructType([T.StructField(c, T.StringType()) for c in ("src", "dst", "type")])


def layouts(buckets: int = 64) -> dict[str, Layout]:
    """The tables of the model.  Trips lie by rider and events by trip, as they are asked for and deleted;
    events have their battery level from the first, null until it is filled.  Trips have filters of their own
    keys, by which events and further trips are checked."""
    rejected = T.StructType([*model.TRIPS.fields, T.StructField("broken_rules", T.ArrayType(T.StringType()))])
    return {
        "users": Layout(model.USERS, ("user_id",), ("user_id",), buckets, ("user_id",)),
        "stations": Layout(model.STATIONS, ("station_id",), ("station_id",), buckets, ("station_id",)),
        "trips": Layout(model.TRIPS, ("trip_id",), ("user_id",), buckets, ("user_id", "trip_id"), ("trip_id",)),
        "events": Layout(EVENTS_V2, ("event_id",), ("trip_id",), buckets, ("trip_id", "event_id"), ("event_id",)),
        "trips_rejected": Layout(rejected, ("trip_id",), ("user_id",), buckets),
        "edges": Layout(EDGES, ("src", "dst", "type"), ("src",), buckets, ("src",)),
        "trip_documents": Layout(model.TRIP_DOCUMENT_V2, ("trip_id", "part"), ("trip_id",), buckets, ("trip_id",)),
    }


# ---- Merge --------------------------------------------------------------------


def merge(store: Store, table: str, batch: DataFrame, properties: list[str] | None = None, sequence: str | None = None) -> None:
    """Insert the rows of ``batch`` with new keys and overwrite the listed properties of the others, as
    :func:`tripweave.operators.changes.upsert` does; the columns that the table is dealt by must be part of its key.

    Files without a key of the batch stay; inserted rows go to new files.  A batch that brings nothing new
    besides keys (``properties=[]``) rewrites no file.
    """
    layout, now = store.layouts[table], store.snapshot()
    if not set(layout.bucket_by) <= set(layout.key):
        raise ValueError(f"{table} is not dealt by its key")
    key = list(layout.key)
    if properties is None:
        properties = [c for c in batch.columns if c in layout.schema.names and c not in key]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    batch = batch.where(known).select(*key, *properties, *([sequence] if sequence and sequence not in [*key, *properties] else []))
    if not properties:
        # No file is rewritten, so it need not be told which ones hold a key: one join with the buckets' keys.
        batch = cut_lineage(batch.select(*key).distinct())
        new = batch.join(now.read(table, now.near(table, batch)).select(*key), key, "left_anti")
        rest = [c for c in layout.schema.names if c not in key]
        store.commit(store.write(table, new.withColumns({c: F.lit(None) for c in rest})))
        return
    batch = cut_lineage(batch)
    hit = now.with_keys(table, batch.select(*key))
    base = now.read(table, hit)
    one = F.struct(*key)
    merged = changes.upsert(base.withColumn("_id", one), batch.withColumn("_id", one), "_id", properties, sequence)
    merged = merged.select(*[F.col("_id")[c].alias(c) if c in key else F.col(c) for c in layout.schema.names])
    store.commit(store.write(table, merged), {table: hit})


# ---- Deletes ------------------------------------------------------------------


def _without(now: Snapshot, table: str, keys: DataFrame) -> tuple[Written, list[File]]:
    """(new files, files that go) for a table without the rows whose values are among ``keys``."""
    hit = now.with_keys(table, keys)
    if not hit:
        return {}, hit
    gone, n = small_side(keys.distinct())
    left = now.read(table, hit).join(gone, keys.columns, "left_anti")
    # Keys that are broadcast leave the rows in the tasks that read them.
    return now.store.write(table, left, in_place=n <= SMALL_KEY_SET), hit


def delete_users(store: Store, doomed: DataFrame) -> None:
    """Delete riders (``user_id``), their trips, and the events of those trips: one commit for all three."""
    now = store.snapshot()
    riders = cut_lineage(doomed.select("user_id").where("user_id IS NOT NULL").distinct())
    trips = now.read("trips", now.near("trips", riders)).join(riders, "user_id", "left_semi")
    trips = cut_lineage(trips.select("trip_id").where("trip_id IS NOT NULL"))
    parts = {"users": _without(now, "users", riders), "trips": _without(now, "trips", riders), "events": _without(now, "events", trips)}
    store.commit(joined(*[new for new, _ in parts.values()]), {t: old for t, (_, old) in parts.items()})


def delete_stations(store: Store, doomed: DataFrame) -> None:
    """Delete stations (``station_id``), or raise :class:`Blocked` and change nothing if a trip starts or
    ends at one of them."""
    now = store.snapshot()
    doomed = cut_lineage(doomed.select("station_id").where("station_id IS NOT NULL").distinct())
    used = changes.delete_blocked(doomed, now.read("trips"))
    blocked, n = small_side(used)
    if n:
        raise Blocked("stations", blocked)
    new, old = _without(now, "stations", doomed)
    store.commit(new, {"stations": old})


# ---- Backfill -----------------------------------------------------------------


def _rewritten(now: Snapshot, table: str, needs: Column, columns: list[str], change, **counts: Column) -> dict[str, int]:
    """Rewrite the files with a row that ``needs`` a change, and count while writing.

    The files are found on ``columns`` alone.  The change is one of single rows, so these are not dealt again.
    """
    rows = now.read(table, with_file=True).select(*columns, "file")
    hit = now.holding(table, rows.where(needs))
    if not hit:
        return dict.fromkeys(counts, 0)
    seen = Observation()
    before = now.read(table, hit).observe(seen, *[F.count_if(c).alias(n) for n, c in counts.items()])
    new = now.store.write(table, change(before), in_place=True)
    now.store.commit(new, {table: hit})
    return seen.get


def backfill_events(store: Store, strict: bool = True) -> int:
    """Fill the battery level of stored BATTERY events that have none; says how many rows changed.

    Files without such an event stay as they are.
    """
    needs = (F.col("event_type") == "BATTERY") & F.col("battery_level").isNull()
    fills = needs & F.col("value").try_cast("int").isNotNull()
    columns = ["event_type", "battery_level", "value"]
    told = _rewritten(store.snapshot(), "events", fills if not strict else needs & F.col("value").isNotNull(), columns,
                      lambda df: changes.backfill_battery(df, strict=strict), filled=fills)
    return told["filled"]


def _changes_document() -> Column:
    """Whether the backfill would change a level of the document; null levels of text that is no number do not."""
    events = F.arrays_zip(F.col("events.event_type"), F.col("events.value"), F.col("events.battery_level"))
    return F.exists(events, lambda e: (e["event_type"] == "BATTERY") & ~e["value"].try_cast("int").eqNullSafe(e["battery_level"]))


def backfill_documents(store: Store, strict: bool = True) -> int:
    """Fill the battery levels inside stored trip documents; says how many trips changed.

    The count of whole documents comes from the write itself.  Only if documents in parts changed, their
    trips are counted apart, on those parts.
    """
    now, changed = store.snapshot(), _changes_document()
    in_parts = F.col("parts") > 1
    bad = F.exists("events", lambda e: (e["event_type"] == "BATTERY") & e["value"].isNotNull() & e["value"].try_cast("int").isNull())
    told = _rewritten(now, "trip_documents", changed | bad if strict else changed, ["events"],
                      lambda df: changes.backfill_battery_nested(df, strict=strict),
                      whole=changed & ~in_parts, cut=changed & in_parts)
    if not told["cut"]:
        return told["whole"]
    cut = now.read("trip_documents").where(in_parts & changed).agg(F.count_distinct("trip_id").alias("n"))
    return told["whole"] + cut.first().n


# ---- Inserts --------------------------------------------------------------------


def _parents(now: Snapshot, table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """For each table that the rows refer to, those of the keys they use that are stored."""
    wanted: dict[str, list[str]] = {}
    for fk in model.FOREIGN_KEYS:
        if fk.child == table:
            wanted.setdefault(fk.parent, []).append(fk.column)
    out = {}
    for parent, columns in wanted.items():
        key = model.KEYS[parent]
        out[parent] = now.known(parent, key, rows.select(F.explode(F.array(*columns)).alias(key)))
    return out


def insert(store: Store, table: str, batch: str, rows: DataFrame) -> bool:
    """Append the rows that keep all rules of their table, and put the others with their broken rules
    into ``<table>_rejected``: one commit under the name ``batch``.

    A batch that was committed before adds nothing (the result is false), so a run that broke may simply be
    repeated.  A key that is stored already, or repeated in the batch, breaks the unique rule.
    """
    if store.has_batch(batch):
        return False
    now, key, layout = store.snapshot(), model.KEYS[table], store.layouts[table]
    names = layout.schema.names
    rows = cut_lineage(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.schema.fields]))
    marked = quality.broken_rules(rows, table, _parents(now, table, rows))
    stored = _stored_keys(now, table, rows)
    again = F.lit(f"{table}.{key}.unique")
    marked = marked.join(stored, F.col(key) == F.col("_stored"), "left")
    marked = marked.withColumn(
        "broken_rules", F.when(F.col("_stored").isNotNull(), F.array_union("broken_rules", F.array(again))).otherwise(F.col("broken_rules"))
    ).select(*names, "broken_rules")
    # Judged once: both sinks read the staged rows.
    staged, schema = fresh_folder(store.spark, "staged"), marked.schema
    write_table(marked, staged)
    marked = read_table(store.spark, staged, schema)
    good = F.size("broken_rules") == 0
    store.commit(joined(store.write(table, marked.where(good)), store.write(table + REJECTED, marked.where(~good))), batch=batch)
    return True


def _stored_keys(now: Snapshot, table: str, rows: DataFrame) -> DataFrame:
    """(_stored): the keys of ``rows`` that the table holds, each once."""
    key = model.KEYS[table]
    return small_side(now.known(table, key, rows.select(key)).select(F.col(key).alias("_stored")))[0]


# ---- Checks against what is stored -------------------------------------------------


def check_unique(store: Store, table: str, batch: DataFrame) -> DataFrame:
    """(rule, n_violations): rows of ``batch`` whose key is stored or stands in the batch before."""
    key, now = model.KEYS[table], store.snapshot()
    per_key = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    taken = now.known(table, key, per_key.select(key)).withColumn("taken", F.lit(1))
    extra = F.col("n") - 1 + F.coalesce("taken", F.lit(0))
    rule = F.lit(f"{table}.{key}.unique").alias("rule")
    return per_key.join(taken, key, "left").agg(F.coalesce(F.sum(extra), F.lit(0)).alias("n_violations")).select(rule, "n_violations")


def check_foreign_keys(store: Store, table: str, batch: DataFrame) -> DataFrame:
    """(rule, n_violations): rows of ``batch`` whose parent is not stored, for each foreign key."""
    fks = [fk for fk in model.FOREIGN_KEYS if fk.child == table]
    return quality.count_orphans(batch, fks, _parents(store.snapshot(), table, batch))
