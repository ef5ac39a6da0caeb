"""The registered queries: every operator over whole tables of the star schema.

Results are flat and made of plain scalars, so that they can be compared value
by value: decimals become doubles and dates ISO text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import model
from tripweave.functions.expressions import typed_event_value
from tripweave.operators import changes, documents, graph, quality, relational, stored, synth
from tripweave.session import fresh_folder
from tripweave.sources.star_view import star_schema_view
from tripweave.sources.store import Store
from tripweave.sources.tables import Checked, read_table, read_versions, scan_checked, write_table, write_version

Tables = dict[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

REACHABLE_FROM = 7
LARGE_STATION = 30
LOADED_FIRST = 5000  # cost below which trips are reloaded and above which appended
DELETED_COUNTRY = "NATION_7"
LATEST_TRIPS = 500
SEED = 42
EVENTS_PER_TRIP = 2

_ON_TABLES: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(name: str) -> Callable:
    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _ON_TABLES[name] = function
        return function

    return register


def _flat_column(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("double").alias(field.name)
    if isinstance(field.dataType, T.DateType):
        return column.cast("string").alias(field.name)
    if isinstance(field.dataType, T.IntegerType):
        return column.cast("bigint").alias(field.name)
    return column


def flat(df: DataFrame) -> DataFrame:
    return df.select(*[_flat_column(f) for f in df.schema.fields])


def queries() -> dict[str, Query]:
    """name -> (spark, star-schema folder) -> DataFrame."""

    def bound(function: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: flat(function(star_schema_view(spark, sf_dir)))

    return {name: bound(function) for name, function in _ON_TABLES.items()}


def on_tables() -> dict[str, Callable[[Tables], DataFrame]]:
    """The same queries as functions of already loaded tables."""
    return dict(_ON_TABLES)


# ---- Relational questions ---------------------------------------------------


@_query("q1_trip_details")
def _(t: Tables) -> DataFrame:
    return relational.trip_details(t["trips"], t["users"], t["stations"])


@_query("q2_user_stats")
def _(t: Tables) -> DataFrame:
    return relational.user_stats(t["trips"], t["users"])


@_query("q2_user_stats_zero")
def _(t: Tables) -> DataFrame:
    return relational.user_stats(t["trips"], t["users"], empty="zero")


@_query("q2_active_user_stats")
def _(t: Tables) -> DataFrame:
    return relational.active_user_stats(t["trips"])


@_query("q2_user_stats_staged")
def _(t: Tables) -> DataFrame:
    """By way of JSON lines: riders and durations are written, read back with
    their schema, and aggregated by text keys."""
    spark = t["trips"].sparkSession
    folder = fresh_folder(spark, "staged")
    key = F.col("user_id").cast("string")
    staged_users = t["users"].select("user_id", "name", "surname").withColumn("user_id", key)
    write_table(staged_users, f"{folder}/users", "json")
    write_table(relational.trip_durations(t["trips"]).withColumn("user_id", key), f"{folder}/trips", "json")
    durations = read_table(spark, f"{folder}/trips", model.STAGED_DURATIONS, "json")
    users = read_table(spark, f"{folder}/users", model.STAGED_USERS, "json")
    return relational.with_all_users(relational.duration_stats(durations), users, empty="zero")


def _two_loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    cheap = F.coalesce(F.col("total_cost") < LOADED_FIRST, F.lit(False))
    return t["trips"].where(cheap), t["trips"].where(~cheap)


def _stored_state(state: DataFrame) -> DataFrame:
    spark = state.sparkSession
    folder = fresh_folder(spark, "state")
    write_table(state, folder)
    return read_table(spark, folder, state.schema)


@_query("q2_user_stats_merged")
def _(t: Tables) -> DataFrame:
    """The state of a first load is stored; a second load is added without reading the first."""
    first, second = _two_loads(t)
    state = _stored_state(relational.user_state(relational.trip_durations(first)))
    state = relational.merged([state, relational.user_state(relational.trip_durations(second))], "user_id")
    return relational.with_all_users(relational.stats_of(state), t["users"], empty="null")


@_query("q3_station_counts_merged")
def _(t: Tables) -> DataFrame:
    first, second = _two_loads(t)
    counts = _stored_state(relational.station_role_counts(first))
    counts = relational.merged([counts, relational.station_role_counts(second)], "station_id")
    return relational.with_all_stations(counts, t["stations"])


@_query("q3_station_counts")
def _(t: Tables) -> DataFrame:
    return relational.station_counts(t["trips"], t["stations"])


@_query("q4_error_trips")
def _(t: Tables) -> DataFrame:
    return relational.trips_with_event(t["trips"], t["events"], "ERROR")


@_query("q4_error_trips_distinct")
def _(t: Tables) -> DataFrame:
    return relational.trips_with_event_distinct(t["trips"], t["events"], "ERROR")


@_query("trips_sorted")
def _(t: Tables) -> DataFrame:
    return relational.in_key_order(t["trips"].select("trip_id", "user_id", "start_time"), "trip_id")


@_query("trips_latest")
def _(t: Tables) -> DataFrame:
    return relational.latest(t["trips"].select("trip_id", "user_id", "start_time"), "trip_id", LATEST_TRIPS)


# ---- Documents ----------------------------------------------------------------


def _docs(t: Tables) -> DataFrame:
    return documents.embed_events(t["trips"], t["events"])


def _all_stations(t: Tables) -> DataFrame:
    """The stations after the upsert below: every rider is one too, and most of these have no trip."""
    return _upserted(t)


@_query("q1_trip_documents")
def _(t: Tables) -> DataFrame:
    return documents.trip_documents_report(_docs(t), t["users"], t["stations"])


@_query("q2_user_stats_nested")
def _(t: Tables) -> DataFrame:
    return documents.user_stats_nested(t["users"], t["trips"])


@_query("q3_active_station_counts")
def _(t: Tables) -> DataFrame:
    return documents.active_station_counts(_docs(t), _all_stations(t))


@_query("q4_error_trips_embedded")
def _(t: Tables) -> DataFrame:
    return documents.trips_with_embedded_event(_docs(t), "ERROR")


@_query("doc_facet_station_roles")
def _(t: Tables) -> DataFrame:
    return documents.facet_station_roles(_docs(t))


@_query("doc_embed_events")
def _(t: Tables) -> DataFrame:
    events = F.col("events")
    per_part = _docs(t).select(
        "trip_id",
        F.size(events).alias("n"),
        F.size(F.filter(events, lambda e: e["event_type"] == "ERROR")).alias("errors"),
        F.get(events, F.lit(0))["event_id"].alias("first"),
        F.get(events, F.size(events) - 1)["event_id"].alias("last"),
    )
    return per_part.groupBy("trip_id").agg(
        F.sum("n").alias("n_events"),
        F.sum("errors").alias("n_error"),
        F.min("first").alias("first_event_id"),
        F.max("last").alias("last_event_id"),
    )


@_query("doc_unwind_events")
def _(t: Tables) -> DataFrame:
    return documents.unwind_events(_docs(t))


@_query("doc_lookup_user_trips")
def _(t: Tables) -> DataFrame:
    nested = documents.lookup(
        t["users"].select("user_id"),
        t["trips"].select("trip_id", F.col("user_id").alias("rider"), "total_cost"),
        "user_id",
        "rider",
        "trips",
        "trip_id",
    )
    nothing = F.lit(0).cast("decimal(28,2)")
    cost = F.aggregate("trips", nothing, lambda total, trip: (total + trip["total_cost"]).cast("decimal(28,2)"))
    per_part = nested.select("user_id", F.size("trips").alias("n"), cost.alias("cost"))
    return per_part.groupBy("user_id").agg(F.sum("n").alias("n_trips"), F.sum("cost").alias("total_cost"))


@_query("events_typed")
def _(t: Tables) -> DataFrame:
    typed = typed_event_value("event_type", "value").alias("typed")
    return t["events"].select("event_id", "event_type", typed).select("event_id", "event_type", "typed.*")


# ---- Graph --------------------------------------------------------------------


@_query("graph_vertices")
def _(t: Tables) -> DataFrame:
    return graph.vertices(t["users"], t["trips_raw"], t["stations"])


@_query("graph_edges")
def _(t: Tables) -> DataFrame:
    return graph.edges(t["trips_raw"], t["users"], t["stations"])


@_query("graph_station_edges")
def _(t: Tables) -> DataFrame:
    return graph.station_edges(t["trips"])


@_query("graph_out_degree")
def _(t: Tables) -> DataFrame:
    return graph.out_degree(graph.station_edges(t["trips"]))


@_query("graph_reachable_stations")
def _(t: Tables) -> DataFrame:
    return graph.reachable_stations(t["trips"], t["users"], t["stations"], REACHABLE_FROM)


def _property_graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (
        graph.edges(t["trips"], t["users"], t["stations"]),
        graph.vertices(t["users"], t["trips"], t["stations"]),
    )


@_query("graph_path_stations")
def _(t: Tables) -> DataFrame:
    return graph.path_stations(*_property_graph(t), f"U:{REACHABLE_FROM}")


@_query("graph_path_counts")
def _(t: Tables) -> DataFrame:
    """How many paths leave every rider, by the type of their last edge."""
    found = graph.paths(*_property_graph(t), *graph.RIDER_TO_STATION)
    return found.groupBy(F.col("n0").alias("id"), F.col("type1").alias("type")).agg(F.count("*").alias("n_paths"))


@_query("graph_first_user_stations")
def _(t: Tables) -> DataFrame:
    return graph.first_user_stations(t["trips"], t["users"], t["stations"])


@_query("graph_station_degrees")
def _(t: Tables) -> DataFrame:
    return graph.station_degrees(t["trips"], t["users"], t["stations"])


@_query("graph_top_stations")
def _(t: Tables) -> DataFrame:
    return graph.top_stations(t["trips"], t["users"], t["stations"])


@_query("graph_pagerank")
def _(t: Tables) -> DataFrame:
    ranked = graph.pagerank(graph.station_edges(t["trips"]), t["stations"])
    return ranked.withColumn("rank", F.round("rank", 8))


@_query("graph_pagerank_top3")
def _(t: Tables) -> DataFrame:
    return graph.top_ranked(graph.pagerank(graph.station_edges(t["trips"]), t["stations"]))


def _components(t: Tables, trips: DataFrame) -> DataFrame:
    return graph.connected_components(graph.station_edges(trips), t["stations"])


@_query("graph_components")
def _(t: Tables) -> DataFrame:
    return _components(t, t["trips"])


@_query("graph_component_sizes")
def _(t: Tables) -> DataFrame:
    return graph.component_sizes(_components(t, t["trips"]), t["stations"])


@_query("graph_component_count")
def _(t: Tables) -> DataFrame:
    return graph.component_count(_components(t, t["trips"]))


# The station graph is one component; the property graph of all trips as they come is many.


def _vertex_components(t: Tables) -> tuple[DataFrame, DataFrame]:
    nodes = graph.vertices(t["users"], t["trips_raw"], t["stations"]).select(F.col("id").alias("station_id"), "name")
    links = graph.edges(t["trips_raw"], t["users"], t["stations"]).select("src", "dst")
    return graph.connected_components(links, nodes), nodes


@_query("graph_vertex_components")
def _(t: Tables) -> DataFrame:
    return _vertex_components(t)[0].withColumnRenamed("station_id", "id")


@_query("graph_vertex_component_sizes")
def _(t: Tables) -> DataFrame:
    return graph.component_sizes(*_vertex_components(t))


@_query("graph_vertex_component_count")
def _(t: Tables) -> DataFrame:
    return graph.component_count(_vertex_components(t)[0])


@_query("graph_vertex_components_merged")
def _(t: Tables) -> DataFrame:
    """Labels of a first load are stored; the trips of a second one bring their nodes and edges."""
    cheap = F.coalesce(F.col("total_cost") < LOADED_FIRST, F.lit(False))
    first, nodes = _vertex_components(t | {"trips_raw": t["trips_raw"].where(cheap)})
    new = t["trips_raw"].where(~cheap)
    added = graph.vertices(t["users"], new, t["stations"]).select(F.col("id").alias("station_id"))
    edges = graph.edges(new, t["users"], t["stations"])
    return graph.merged_components(_stored_state(first), edges, added).withColumnRenamed("station_id", "id")


# ---- Checks -------------------------------------------------------------------


def _raw(t: Tables) -> Tables:
    return {"users": t["users"], "stations": t["stations"], "trips": t["trips_raw"], "events": t["events"]}


@_query("check_unique")
def _(t: Tables) -> DataFrame:
    return quality.check_unique(_raw(t))


@_query("check_not_null")
def _(t: Tables) -> DataFrame:
    return quality.check_rows(_raw(t), ("not_null",))


@_query("check_values")
def _(t: Tables) -> DataFrame:
    return quality.check_rows(_raw(t), ("value",))


@_query("check_enum")
def _(t: Tables) -> DataFrame:
    return quality.check_rows(_raw(t), ("enum",))


@_query("check_lengths")
def _(t: Tables) -> DataFrame:
    return quality.check_rows(_raw(t), ("length",))


@_query("check_foreign_keys")
def _(t: Tables) -> DataFrame:
    # Events against the accepted trips too, so that those of rejected trips show.
    to_trips = [fk for fk in model.FOREIGN_KEYS if fk.child == "events"]
    accepted = quality.count_orphans(t["events"], to_trips, {"trips": t["trips"]})
    return quality.check_foreign_keys(_raw(t)).unionByName(
        accepted.withColumn("rule", F.lit("events.trip_id.accepted_trip"))
    )


@_query("check_documents")
def _(t: Tables) -> DataFrame:
    docs = documents.embed_events(t["trips_raw"], t["events"])
    docs = changes.backfill_battery_nested(docs)
    return quality.check_documents(docs, t["users"], t["stations"])


def _careless(broken: Column, value: Column) -> Column:
    """A JSON value that is text where ``broken``, and as it should be elsewhere."""
    return F.parse_json(F.when(broken, F.concat(F.lit('"'), value.cast("string"), F.lit('"'))).otherwise(value.cast("string")))


def _document_texts(t: Tables) -> dict[str, DataFrame]:
    """Documents as careless producers write them: trips with the value of every event, whatever its
    type, in the battery level as well; riders of one country with their key as text; large stations
    with their capacity as text."""
    level = lambda e: F.coalesce(F.try_parse_json(e["value"]), _careless(F.lit(True), e["value"]))
    docs = documents.embed_events(t["trips_raw"], t["events"])
    docs = docs.withColumn("events", F.transform("events", lambda e: e.withField("battery_level", level(e))))
    users = t["users"].withColumn("user_id", _careless(F.col("country") == DELETED_COUNTRY, F.col("user_id")))
    stations = t["stations"].withColumn("capacity", _careless(F.col("capacity") > LARGE_STATION, F.col("capacity")))
    return {name: documents.documents_as_json(df) for name, df in (("trips", docs), ("users", users), ("stations", stations))}


_DOCUMENT_SCHEMAS = {"trips": model.TRIP_DOCUMENT_V2, "users": model.USERS, "stations": model.STATIONS}


@_query("check_document_types")
def _(t: Tables) -> DataFrame:
    checked = [quality.check_document_types(df, "text", _DOCUMENT_SCHEMAS[name], name) for name, df in _document_texts(t).items()]
    return reduce(DataFrame.unionByName, checked)


@_query("check_summary")
def _(t: Tables) -> DataFrame:
    return quality.check_summary(_raw(t))


@_query("trips_accepted")
def _(t: Tables) -> DataFrame:
    accepted, _rejected = quality.split(t["trips_raw"], "trips", t)
    return accepted.select("trip_id")


@_query("trips_rejected")
def _(t: Tables) -> DataFrame:
    _accepted, rejected = quality.split(t["trips_raw"], "trips", t)
    return rejected.select("trip_id", F.explode("broken_rules").alias("rule"))


# ---- Changes ------------------------------------------------------------------


@_query("delete_users_cascade")
def _(t: Tables) -> DataFrame:
    doomed = t["users"].where(F.col("country") == DELETED_COUNTRY)
    return _remaining(changes.delete_cascade(t["users"], t["trips_raw"], t["events"], doomed))


def _remaining(left: Tables) -> DataFrame:
    """How many rows each table has, and its least and greatest key."""
    parts = []
    for name, df in left.items():
        key = F.col(model.KEYS[name]).cast("string")
        parts.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("n_remaining"),
                F.min(key).alias("min_id"),
                F.max(key).alias("max_id"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@_query("delete_stations_blocked")
def _(t: Tables) -> DataFrame:
    return changes.delete_blocked(_all_stations(t), t["trips"])


def _station_batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A station for every rider, and every station again as closed, without a capacity."""
    for_riders = t["users"].select(
        F.col("user_id").alias("station_id"), "name", F.length("surname").alias("capacity"), F.lit(1).alias("sequence")
    )
    closed = t["stations"].select(
        "station_id",
        F.concat("name", F.lit(" (closed)")).alias("name"),
        F.lit(None).cast("int").alias("capacity"),
        F.lit(2).alias("sequence"),
    )
    return for_riders, closed


def _upserted(t: Tables) -> DataFrame:
    """Both batches in one.  A key of both takes the later row; the keys that
    only riders have are inserted, without a city."""
    for_riders, closed = _station_batches(t)
    batch = for_riders.unionByName(closed)
    return changes.upsert(t["stations"], batch, "station_id", ["name", "capacity"], "sequence")


@_query("graph_upsert_stations")
def _(t: Tables) -> DataFrame:
    return _upserted(t)


@_query("evolve_add_column")
def _(t: Tables) -> DataFrame:
    evolved = changes.add_column(t["events"], "battery_level", T.IntegerType())
    return evolved.select("event_id", "trip_id", "event_type", "value", "battery_level")


@_query("evolve_backfill_table")
def _(t: Tables) -> DataFrame:
    return changes.backfill_battery(t["events"]).select("event_id", "trip_id", "event_type", "value", "battery_level")


@_query("evolve_backfill_nested")
def _(t: Tables) -> DataFrame:
    filled = changes.backfill_battery_nested(_docs(t))
    return documents.unwind_events(filled).select("event_id", "trip_id", "event_type", "value", "battery_level")


@_query("evolve_modified_count")
def _(t: Tables) -> DataFrame:
    return changes.modified_count(_docs(t))


@_query("evolve_sample_event")
def _(t: Tables) -> DataFrame:
    return changes.sample_event(changes.backfill_battery(t["events"]))


def _before_and_after(t: Tables, **which: bool) -> DataFrame:
    before = changes.add_column(t["events"], "battery_level", T.IntegerType())
    after = changes.backfill_battery(t["events"])
    rules = quality.battery_rules(**which)

    def counted(df: DataFrame, when: str) -> DataFrame:
        return quality.count_violations(df, rules).withColumn("rule", F.concat("rule", F.lit(f".{when}")))

    return counted(before, "before").unionByName(counted(after, "after"))


@_query("check_battery_range")
def _(t: Tables) -> DataFrame:
    return _before_and_after(t, only_battery=False)


@_query("check_battery_only")
def _(t: Tables) -> DataFrame:
    return _before_and_after(t, range_check=False)


# ---- Generator: one made row per row of a given table ---------------------------


def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.select((F.col(key) + 1).alias("id"))


def _made_trips(t: Tables) -> DataFrame:
    n_users, n_stations = t["users"].count(), t["stations"].count()
    return synth.trips(_ids(t["trips_raw"], "trip_id"), n_users, n_stations, SEED)


@_query("gen_users")
def _(t: Tables) -> DataFrame:
    return synth.users(_ids(t["users"], "user_id"), SEED)


@_query("gen_stations")
def _(t: Tables) -> DataFrame:
    return synth.stations(_ids(t["stations"], "station_id"), SEED)


@_query("gen_trips")
def _(t: Tables) -> DataFrame:
    return _made_trips(t)


@_query("gen_events")
def _(t: Tables) -> DataFrame:
    return synth.events(_made_trips(t), EVENTS_PER_TRIP, SEED)


@_query("gen_events_in_trip")
def _(t: Tables) -> DataFrame:
    return synth.events(_made_trips(t), EVENTS_PER_TRIP, SEED, event_time="trip", with_battery_level=True)


@_query("gen_options")
def _(t: Tables) -> DataFrame:
    """All tables of the generator for numbers of riders and trips that the given tables have, with other
    numbers of events and another seed than above: rows, and the least and the greatest key."""
    spark = t["trips"].sparkSession
    made = synth.tables(spark, t["users"].count(), t["trips"].count(), EVENTS_PER_TRIP + 1, SEED + 1)
    ends = []
    for name, df in made.items():
        key = F.col(model.KEYS[name]).cast("bigint")
        ends.append(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.min(key).alias("least"), F.max(key).alias("greatest")))
    return reduce(DataFrame.unionByName, ends)


# ---- Sources and sinks ----------------------------------------------------------


_COSTS = T.StructType([model.TRIPS[c] for c in ("trip_id", "user_id", "total_cost")])


def _round_trip(t: Tables, fmt: str) -> DataFrame:
    spark = t["trips"].sparkSession
    folder = fresh_folder(spark, f"io-{fmt}")
    write_table(t["trips"].select(_COSTS.names), folder, fmt)
    return read_table(spark, folder, _COSTS, fmt)


@_query("io_json_roundtrip")
def _(t: Tables) -> DataFrame:
    return _round_trip(t, "json")


@_query("io_csv_roundtrip")
def _(t: Tables) -> DataFrame:
    return _round_trip(t, "csv")


@_query("io_append_overwrite")
def _(t: Tables) -> DataFrame:
    """Clear and reload over an older content, then append the rest."""
    spark = t["trips"].sparkSession
    folder = fresh_folder(spark, "io-append")
    trips, cheap = t["trips"].select(_COSTS.names), F.col("total_cost") < LOADED_FIRST
    write_table(trips, folder)
    write_table(trips.where(cheap), folder, mode="overwrite")
    write_table(trips.where(~cheap), folder, mode="append")
    return read_table(spark, folder, _COSTS)


# So many events go into one part here, so that the stored documents of the small tables have parts.
_STORED_PART_ROWS = 2


def _stored_docs(t: Tables, trips: DataFrame) -> DataFrame:
    """Documents stored as nested Parquet, in parts, and read back with their schema."""
    spark = trips.sparkSession
    folder = fresh_folder(spark, "io-documents")
    write_table(documents.embed_events(trips, t["events"], part_rows=_STORED_PART_ROWS), folder)
    return read_table(spark, folder, model.TRIP_DOCUMENT)


@_query("io_documents_roundtrip")
def _(t: Tables) -> DataFrame:
    return documents.unwind_events(_stored_docs(t, t["trips"]))


@_query("io_documents_q4")
def _(t: Tables) -> DataFrame:
    return documents.trips_with_embedded_event(_stored_docs(t, t["trips"]), "ERROR")


@_query("io_documents_report")
def _(t: Tables) -> DataFrame:
    return documents.trip_documents_report(_stored_docs(t, t["trips"]), t["users"], t["stations"])


@_query("io_documents_types")
def _(t: Tables) -> DataFrame:
    text = documents.documents_as_json(_stored_docs(t, t["trips_raw"]).drop("end_time"))
    return quality.check_document_types(text, "text", model.TRIP_DOCUMENT, "trips")


@_query("io_documents_modified")
def _(t: Tables) -> DataFrame:
    return changes.modified_count(_stored_docs(t, t["trips"]))


def _damaged(t: Tables, fmt: str) -> Checked:
    """Trips as lines of text: those of the cheapest trips are cut off, and the next ones have no number for a
    rider.  They are scanned with the lines of all others."""
    spark, cost = t["trips"].sparkSession, F.col("total_cost")
    rider = F.when(cost.between(REPEATED_BELOW, 2 * REPEATED_BELOW), "nobody").otherwise(F.col("user_id").cast("string"))
    fields = t["trips"].select("trip_id", rider.alias("user_id"), "total_cost")
    if fmt == "json":
        line = F.regexp_replace(F.to_json(F.struct(*fields.columns)), r'"user_id":"(\d+)"', '"user_id":$1')
        short = F.substring(line, F.lit(1), F.length(line) - 8)
    else:
        line, short = F.concat_ws(",", *fields.columns), F.concat_ws(",", "trip_id", "user_id")
    folder = fresh_folder(spark, f"damaged-{fmt}")
    fields.select(F.when(cost < REPEATED_BELOW, short).otherwise(line).alias("value")).write.text(folder)
    return scan_checked(spark, folder, _COSTS, fresh_folder(spark, "checked"), fmt, header=False)


def _accepted_and_damaged(found: Checked, key: str) -> DataFrame:
    damaged = found.damaged.select(F.regexp_extract("line", key, 1).cast("bigint").alias("trip_id"), F.lit("damaged").alias("state"))
    return found.rows.select("trip_id", F.lit("accepted").alias("state")).unionByName(damaged)


@_query("io_json_damaged")
def _(t: Tables) -> DataFrame:
    return _accepted_and_damaged(_damaged(t, "json"), '"trip_id":(\\d+)')


@_query("io_csv_damaged")
def _(t: Tables) -> DataFrame:
    return _accepted_and_damaged(_damaged(t, "csv"), r"^(\d+)")


@_query("io_damaged_count")
def _(t: Tables) -> DataFrame:
    """How many lines were good and how many were not, as counted while they were read."""
    spark = t["trips"].sparkSession
    counts = {fmt: _damaged(t, fmt) for fmt in ("json", "csv")}
    rows = [F.struct(F.lit(fmt).alias("format"), F.lit(c.n_rows).alias("n_rows"), F.lit(c.n_damaged).alias("n_damaged")) for fmt, c in counts.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _mixed_documents(t: Tables) -> DataFrame:
    """One folder of documents of both versions: dear trips have their battery levels and say so, the others
    do not; the cheapest have levels although they are of the first version."""
    spark, cost = t["trips_raw"].sparkSession, F.col("total_cost")
    folder = fresh_folder(spark, "versions")
    docs = _stored_state(documents.embed_events(t["trips_raw"], t["events"]))  # read by three writes
    filled, old = changes.backfill_battery_nested(docs), F.coalesce(cost < LOADED_FIRST, F.lit(False))
    write_version(docs.where(old & (cost >= REPEATED_BELOW)), folder, 1)
    write_version(filled.where(old & (cost < REPEATED_BELOW)), folder, 1)
    write_version(filled.where(~old), folder, 2)
    return read_versions(spark, folder, {1: model.TRIP_DOCUMENT, 2: model.TRIP_DOCUMENT_V2})


@_query("io_documents_versions")
def _(t: Tables) -> DataFrame:
    each = _mixed_documents(t).select("version", "trip_id", F.explode("events").alias("e"))
    return each.select("version", "trip_id", "e.event_id", "e.event_type", "e.value", "e.battery_level")


@_query("check_document_versions")
def _(t: Tables) -> DataFrame:
    return quality.check_versions(_mixed_documents(t))


# ---- Stored tables that are changed in place ---------------------------------------

_BUCKETS = 4
REPEATED_BELOW = 1000  # trips cheaper than this come with a second batch again


def _store(t: Tables, **tables: DataFrame) -> Store:
    spark = t["trips"].sparkSession
    store = Store(spark, fresh_folder(spark, "store"), stored.layouts(_BUCKETS))
    store.create(tables)
    return store


@_query("stored_upsert_stations")
def _(t: Tables) -> DataFrame:
    store = _store(t, stations=t["stations"])
    for batch in _station_batches(t):
        stored.merge(store, "stations", batch, ["name", "capacity"], "sequence")
    return store.read("stations")


@_query("stored_merge_edges")
def _(t: Tables) -> DataFrame:
    """Edges of the cheap trips are stored; all edges, twice, come as a batch."""
    cheap = t["trips_raw"].where(F.col("total_cost") < LOADED_FIRST)
    store = _store(t, edges=graph.edges(cheap, t["users"], t["stations"]))
    everything = graph.edges(t["trips_raw"], t["users"], t["stations"])
    stored.merge(store, "edges", everything.unionByName(everything))
    return store.read("edges")


@_query("stored_delete_users")
def _(t: Tables) -> DataFrame:
    store = _store(t, users=t["users"], trips=t["trips_raw"], events=_events_v2(t))
    stored.delete_users(store, t["users"].where(F.col("country") == DELETED_COUNTRY))
    now = store.snapshot()
    return _remaining({name: now.read(name) for name in ("users", "trips", "events")})


@_query("stored_delete_stations")
def _(t: Tables) -> DataFrame:
    """All stations are to go, which trips forbid; then those that no trip uses."""
    store = _store(t, stations=_all_stations(t), trips=t["trips"])
    doomed = store.read("stations").select("station_id")
    try:
        stored.delete_stations(store, doomed)
    except stored.Blocked as blocked:
        stored.delete_stations(store, doomed.join(blocked.keys, "station_id", "left_anti"))
    return store.read("stations")


def _events_v2(t: Tables) -> DataFrame:
    return changes.add_column(t["events"], "battery_level", T.IntegerType())


@_query("stored_backfill_events")
def _(t: Tables) -> DataFrame:
    store = _store(t, events=_events_v2(t))
    stored.backfill_events(store)
    return store.read("events").select("event_id", "trip_id", "event_type", "value", "battery_level")


def _document_store(t: Tables) -> Store:
    docs = documents.embed_events(t["trips"], _events_v2(t), part_rows=_STORED_PART_ROWS)
    return _store(t, trip_documents=docs)


@_query("stored_backfill_documents")
def _(t: Tables) -> DataFrame:
    store = _document_store(t)
    stored.backfill_documents(store)
    filled = documents.unwind_events(store.read("trip_documents"))
    return filled.select("event_id", "trip_id", "event_type", "value", "battery_level")


@_query("stored_backfill_count")
def _(t: Tables) -> DataFrame:
    n = stored.backfill_documents(_document_store(t))
    return t["trips"].sparkSession.range(1).select(F.lit(n).cast("bigint").alias("n_trips"))


@_query("stored_insert_trips")
def _(t: Tables) -> DataFrame:
    """Two batches, each of them twice; the second brings the cheapest trips again."""
    store = _store(t, users=t["users"], stations=t["stations"])
    cost, trips = F.col("total_cost"), t["trips_raw"]
    batches = {"first": trips.where(cost < LOADED_FIRST), "second": trips.where((cost >= LOADED_FIRST) | (cost < REPEATED_BELOW))}
    for name, rows in batches.items():
        stored.insert(store, "trips", name, rows)
        stored.insert(store, "trips", name, rows)
    now = store.snapshot()
    accepted = now.read("trips").select("trip_id", F.lit("accepted").alias("rule"))
    rejected = now.read("trips_rejected").select("trip_id", F.explode("broken_rules").alias("rule"))
    return accepted.unionByName(rejected).groupBy("trip_id", "rule").agg(F.count("*").alias("n"))


@_query("stored_reachable_stations")
def _(t: Tables) -> DataFrame:
    """One rider's question, answered from the rider's bucket alone."""
    now = _store(t, users=t["users"], trips=t["trips"], stations=t["stations"]).snapshot()
    trips, users = (now.lookup(name, user_id=REACHABLE_FROM) for name in ("trips", "users"))
    return graph.reachable_stations(trips, users, now.read("stations"), REACHABLE_FROM)


@_query("stored_check_keys")
def _(t: Tables) -> DataFrame:
    """Dear trips and their events are checked against the cheap ones that are stored."""
    trips, cost = t["trips_raw"], F.col("total_cost")
    store = _store(t, trips=trips.where(cost < LOADED_FIRST), users=t["users"], stations=t["stations"])
    batch = trips.where((cost >= LOADED_FIRST) | (cost < REPEATED_BELOW))
    unique = stored.check_unique(store, "trips", batch)
    return unique.unionByName(stored.check_foreign_keys(store, "trips", batch)).unionByName(
        stored.check_foreign_keys(store, "events", t["events"])
    )
