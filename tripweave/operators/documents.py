"""The document shape: nesting, unnesting, and the questions asked on documents.

A nested array is one value in one row, so an unbounded group must never become
one array.  Nesting therefore cuts the matches of a key into parts of at most
``part_rows`` elements: the usual key has one part, a key with very many matches
has several rows, numbered by ``part`` of ``parts``, which hold its matches in
order one after the other.  Both columns are fixed fields of every document, in
memory, stored or as text, and everything that reads documents needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tripweave.functions.expressions import mean_minutes, minutes_and_micros, null_as
from tripweave.session import cut_lineage, small_side

PART_ROWS = 10_000
# Matches of a key that may be one array inside a task, however small the parts it is then cut into.
_WHOLE_ROWS = 10_000
_PARTS_PER_BLOCK = 10_000


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    into: str,
    order_by: str,
    fields: list[str] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Left nest-join: ``left`` with the matching ``right`` rows as an array.

    Meant for one left row with many matches.  To fetch the one parent of many
    rows, join instead: there a heavy key can be split at run time.

    A left row without matches gets an empty array.  Array elements carry
    ``fields`` (all columns of ``right`` if not given) and are ordered by
    ``order_by``, which must be unique among the matches of a key; the parts of
    a key are in that order too.  A key of up to ``_WHOLE_ROWS`` matches is put
    together in one task and cut there; only the matches of larger ones are
    ranged and numbered over tasks.  The result has the columns of ``left``, then
    ``part``, ``parts`` and ``into``.
    """
    matches = right.where(F.col(right_key).isNotNull())
    limit = max(part_rows, _WHOLE_ROWS)
    counts = matches.groupBy(right_key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    large, n_large = small_side(
        counts.select(F.col(right_key).alias("_key"), F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts"))
    )

    item = F.struct(order_by, *[c for c in fields or right.columns if c != order_by]).alias("_item")
    keyed = matches.select(F.col(right_key).alias("_key"), item)
    if not n_large:
        # The usual case: one shuffle of the matches, which the join uses as well.
        arrays = keyed.repartition("_key").groupBy("_key")
        joined = left.join(_sorted_items(arrays, into), F.col(left_key) == F.col("_key"), "left")
        joined = joined.withColumn("part", F.lit(0)).withColumn("parts", F.lit(None).cast("int"))
    else:
        heavy = _in_parts(keyed.join(large.select("_key"), "_key", "left_semi"), f"_item.{order_by}", part_rows)
        usual = keyed.join(large.select("_key"), "_key", "left_anti").withColumn("_part", F.lit(0))
        arrays = usual.unionByName(heavy).repartition("_key", "_part").groupBy("_key", "_part")
        base = left.join(large, F.col(left_key) == F.col("_key"), "left").withColumn("parts", null_as("_parts", 1))
        base = _numbered_parts(base).withColumn("parts", F.col("_parts")).drop("_key", "_parts")
        same = (F.col(left_key) == F.col("_key")) & (F.col("part") == F.col("_part"))
        joined = base.join(_sorted_items(arrays, into), same, "left")
    items = joined.select(*left.columns, "part", "parts", F.coalesce(F.col(into), F.array()).alias(into))
    if part_rows >= limit:
        return items.withColumn("parts", null_as("parts", 1))
    return _cut(items, into, part_rows).select(*left.columns, "part", "parts", into)


def _cut(items: DataFrame, into: str, part_rows: int) -> DataFrame:
    """The rows with ``parts`` null, which hold all matches of their key, cut into rows of ``part_rows`` each."""
    whole, array = F.col("parts").isNull(), F.col(into)
    n = F.greatest(F.lit(1), F.ceil(F.size(array) / part_rows).cast("int"))
    slices = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(array, i * part_rows + 1, part_rows))
    others = [c for c in items.columns if c not in ("part", "parts", into)]
    pieces = F.posexplode(F.when(whole, slices).otherwise(F.array(array))).alias("_at", into)
    cut = items.select(*others, F.col("part").alias("_first"), F.coalesce("parts", n).alias("parts"), pieces)
    return cut.withColumn("part", F.col("_first") + F.col("_at")).drop("_first", "_at")


def _in_parts(matches: DataFrame, order_by: str, part_rows: int) -> DataFrame:
    """(_key, _item, _part): consecutive ranges of at most ``part_rows`` matches of each key.

    The matches are range-partitioned by key and order, so a key spreads over tasks.  Numbered
    within their partition, and by the counts of the partitions before it, no task sees a whole key.
    """
    ranged = matches.withColumn("_order", F.col(order_by)).repartitionByRange("_key", "_order")
    placed = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))
    slices = placed.groupBy("_key", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("_key", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = Window.partitionBy("_key", "_slice").orderBy("_order")
    number = F.row_number().over(here) - 1 + F.col("_before")
    return placed.join(starts, ["_key", "_slice"]).select("_key", "_item", F.floor(number / part_rows).cast("int").alias("_part"))


def _numbered_parts(df: DataFrame) -> DataFrame:
    """One row per ``part`` from 0 to ``parts`` - 1.  Counted out in two steps, so
    that the numbers of a very large key are never one array."""
    block = F.floor((F.col("parts") - 1) / _PARTS_PER_BLOCK).cast("int")
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0), block)))
    first = F.col("_block") * _PARTS_PER_BLOCK
    last = F.least(first + _PARTS_PER_BLOCK, F.col("parts")) - 1
    return blocks.withColumn("part", F.explode(F.sequence(first, last))).drop("_block")


def _sorted_items(grouped: GroupedData, into: str) -> DataFrame:
    return grouped.agg(F.sort_array(F.collect_list("_item")).alias(into))


def embed_events(trips: DataFrame, events: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Trip documents: every trip with its events, ordered by event key."""
    fields = [c for c in events.columns if c != "trip_id"]
    nested = lookup(trips, events, "trip_id", "trip_id", "events", "event_id", fields, part_rows)
    return nested.select(
        "trip_id",
        "user_id",
        F.col("start_station").alias("start_station_id"),
        F.col("end_station").alias("end_station_id"),
        "start_time",
        "end_time",
        "total_cost",
        "part",
        "parts",
        "events",
    )


def unwind(df: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """One row per array element; rows with an empty or missing array vanish."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(into or column))


def unwind_events(docs: DataFrame) -> DataFrame:
    """The events of trip documents as a table again."""
    return unwind(docs.select("trip_id", "events"), "events", "e").select("trip_id", "e.*")


def has_event(event_type: str, column: str = "events") -> Column:
    """True if any element of the array has the given type.  Written on the one
    field it needs, so that a scan reads no other field of the elements."""
    return F.array_contains(F.col(f"{column}.event_type"), event_type)


def with_parts(docs: DataFrame) -> DataFrame:
    """``docs``, if they say which part of which document they are; an error otherwise.  Documents
    without these fields cannot be told from parts, and counting parts as documents would be wrong."""
    missing = [c for c in ("part", "parts") if c not in docs.columns]
    if missing:
        raise ValueError(f"documents need the fields part and parts; missing: {', '.join(missing)}")
    return docs


def _first_parts(docs: DataFrame) -> DataFrame:
    """One row per document, for questions that do not look into the array."""
    return with_parts(docs).where(F.col("part") == 0)


def once_per_trip(docs: DataFrame) -> DataFrame:
    """Document rows that passed a test, reduced to one row per trip.

    Only a trip in several parts can pass more than once.  Whole documents need
    no shuffle; where no document is in parts, the second branch is empty by
    file statistics, or even at planning.
    """
    whole = with_parts(docs).where(F.col("parts") == 1).drop("part", "parts")
    cut = docs.where(F.col("parts") > 1).drop("part", "parts").dropDuplicates(["trip_id"])
    return whole.unionByName(cut)


def trips_with_embedded_event(docs: DataFrame, event_type: str = "ERROR") -> DataFrame:
    """Trips with at least one embedded event of the given type, each once."""
    fields = ["trip_id", "user_id", "start_time", "end_time", "total_cost", "part", "parts"]
    return once_per_trip(with_parts(docs).where(has_event(event_type)).select(*fields))


def trip_documents_report(docs: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Trip details in the document naming, with the document key as ``_id``."""
    riders = users.select(
        F.col("user_id").alias("rider"),
        F.col("name").alias("user_name"),
        F.col("surname").alias("user_surname"),
        F.col("birthdate").alias("user_birthdate"),
        F.col("country").alias("user_country"),
    )

    def names(role: str) -> DataFrame:
        return stations.select(F.col("station_id").alias(f"{role}_id"), F.col("name").alias(f"{role}_station_name"))

    return (
        _first_parts(docs)
        .join(names("start"), F.col("start_station_id") == F.col("start_id"))
        .join(names("end"), F.col("end_station_id") == F.col("end_id"))
        .join(riders, F.col("user_id") == F.col("rider"))
        .select(
            F.col("trip_id").alias("_id"),
            "trip_id",
            "user_id",
            "user_name",
            "user_surname",
            "user_birthdate",
            "user_country",
            "start_station_name",
            "end_station_name",
            "start_time",
            "end_time",
            "total_cost",
        )
    )


def user_stats_nested(users: DataFrame, trips: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Trip count and mean duration per rider, computed inside the array of the
    rider's trips; zero for riders without trips."""
    nested = lookup(
        users.select("user_id", "name", "surname"),
        trips.select("trip_id", F.col("user_id").alias("rider"), "start_time", "end_time"),
        "user_id",
        "rider",
        "trips",
        "trip_id",
        ["start_time", "end_time"],
        part_rows,
    )
    def total(part: int) -> Column:
        values = F.transform("trips", lambda t: minutes_and_micros(t["start_time"], t["end_time"])[part])
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda so_far, v: so_far + v)

    sums = {"minutes": total(0), "micros": total(1), "n": F.size("trips")}
    per_part = nested.select("user_id", "name", "surname", *[c.alias(name) for name, c in sums.items()])
    per_user = per_part.groupBy("user_id", "name", "surname").agg(
        F.sum("n").alias("num_trips"), F.sum("minutes").alias("minutes"), F.sum("micros").alias("micros")
    )
    mean = F.when(F.col("num_trips") > 0, mean_minutes("minutes", "micros", "num_trips")).otherwise(0.0)
    return per_user.select("user_id", "name", "surname", "num_trips", mean.alias("avg_duration_minutes"))


def facet_counts(df: DataFrame, facets: dict[str, str], into: str) -> DataFrame:
    """Several groupings of one input in one result: (``into``, role, n).

    ``facets`` maps a role to the column it groups by.  The input is read once:
    every row is turned into one (role, value) pair per facet.
    """
    pairs = F.array(*[F.struct(F.lit(role).alias("role"), F.col(c).alias(into)) for role, c in facets.items()])
    return df.select(F.inline(pairs)).groupBy(into, "role").agg(F.count("*").alias("n"))


def facet_station_roles(docs: DataFrame) -> DataFrame:
    """Departures and arrivals per station as tagged facets."""
    return facet_counts(_first_parts(docs), {"start": "start_station_id", "end": "end_station_id"}, "station_id")


def active_station_counts(docs: DataFrame, stations: DataFrame) -> DataFrame:
    """Departures and arrivals of the stations that occur in a trip: the facets
    put together by conditional sums, then looked up among the stations."""
    role, n = F.col("role"), F.col("n")
    counts = (
        facet_station_roles(docs)
        .groupBy("station_id")
        .agg(
            F.sum(F.when(role == "start", n).otherwise(0)).alias("trips_starting"),
            F.sum(F.when(role == "end", n).otherwise(0)).alias("trips_ending"),
        )
    )
    return counts.join(stations.select("station_id", F.col("name").alias("station_name"), "city"), "station_id").select(
        "station_id", "station_name", "city", "trips_starting", "trips_ending"
    )


def documents_as_json(docs: DataFrame, into: str = "text") -> DataFrame:
    """Every document as one line of JSON text."""
    return docs.select(F.to_json(F.struct(*docs.columns)).alias(into))
