"""Results that are kept up to date from stored states, text that may be damaged, and mixed versions."""

import datetime as dt
import random
from decimal import Decimal

import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave import model
from tripweave.operators import changes, documents, graph, quality, relational
from tripweave.sources import tables

# ---- States ----------------------------------------------------------------------


def drawn_trips(spark, n, seed):
    draw = random.Random(seed)
    rows = [h.trip(i, draw.choice([1, 1, 1, 2, 3, None]), draw.choice([10, 20, 30, None]), 20, minutes=draw.random() * 100) for i in range(n)]
    rows.append((n, 2, 10, 20, None, h.at(1), Decimal("1.00")))
    return h.trips(spark, *rows)


def test_states_of_parts_are_the_state_of_all(spark):
    parts = [drawn_trips(spark, n, n) for n in (50, 1, 30)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    states = [relational.user_state(relational.trip_durations(p)) for p in parts]
    assert h.rows(relational.stats_of(relational.merged(states, "user_id"))) == h.rows(relational.active_user_stats(whole))
    counts = relational.merged([relational.station_role_counts(p) for p in parts], "station_id")
    assert h.rows(counts) == h.rows(relational.station_role_counts(whole))
    one = relational.user_state(relational.trip_durations(parts[0].limit(0)))
    assert h.rows(relational.merged([states[0], one], "user_id")) == h.rows(states[0])


def test_sums_are_exact_and_wide(spark):
    begin, end = dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1, 0, 0, 0, 1)
    long = h.trips(spark, *[(i, 1, 10, 20, begin, end, Decimal("1.00")) for i in range(100)])
    state = relational.user_state(relational.trip_durations(long)).first()
    assert state.minutes == 100 * (end - begin).days * 1440 and state.micros == 100
    backwards = h.trips(spark, h.trip(1, 1, 10, 20, minutes=-1.5))
    assert relational.active_user_stats(backwards).first().avg_duration_minutes == -1.5


def test_a_merge_reads_the_state_and_the_batch_only(spark, tmp_path):
    first, second = drawn_trips(spark, 40, 1), drawn_trips(spark, 10, 2)
    tables.write_table(first, str(tmp_path / "trips"))
    old = tables.read_table(spark, str(tmp_path / "trips"), model.TRIPS)
    state = relational.user_state(relational.trip_durations(old))
    tables.write_table(state, str(tmp_path / "state"))
    stored = tables.read_table(spark, str(tmp_path / "state"), state.schema)
    plan = h.plan_of(relational.stats_of(relational.merged([stored, relational.user_state(relational.trip_durations(second))], "user_id")))
    assert "/state" in plan and "/trips" not in plan


# ---- Components ------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_merged_components_are_those_of_the_whole_graph(spark, seed):
    draw = random.Random(seed)
    nodes = list(range(40))
    loads = [(nodes[:20], 12), (nodes[10:35], 15), (nodes, 8), ([], 0)]
    seen_edges, seen_nodes, labels = [], [], None
    for known, n in loads:
        edges = [(draw.choice(nodes + [None, 99]), draw.choice(nodes), 1) for _ in range(n)]
        new = spark.createDataFrame([(k,) for k in known], "station_id bigint")
        df = spark.createDataFrame(edges, "src bigint, dst bigint, n_trips bigint")
        # Edges of a load only know the nodes that are there by then.
        seen_nodes = sorted({*seen_nodes, *known})
        seen_edges += [e for e in edges if e[0] in seen_nodes and e[1] in seen_nodes]
        if labels is None:
            labels = graph.connected_components(df, new)
        else:
            labels = graph.merged_components(labels, df, new)
        all_edges = spark.createDataFrame(seen_edges, "src bigint, dst bigint, n_trips bigint")
        whole = graph.connected_components(all_edges, spark.createDataFrame([(k,) for k in seen_nodes], "station_id bigint"))
        assert h.rows(labels) == h.rows(whole)


def test_merging_components_does_not_read_the_old_edges(spark, tmp_path):
    places = spark.range(1, 30).select(F.col("id").alias("station_id"))
    old = h.station_edges(spark, *[(i, i + 1, 1) for i in range(1, 20, 2)])
    tables.write_table(old, str(tmp_path / "edges"))
    edges = spark.read.parquet(str(tmp_path / "edges"))
    tables.write_table(graph.connected_components(edges, places), str(tmp_path / "labels"))
    labels = spark.read.parquet(str(tmp_path / "labels"))
    merged = graph.merged_components(labels, h.station_edges(spark, (2, 3, 1)), places)
    assert "/edges" not in h.plan_of(merged)
    assert {r.station_id: r.component for r in merged.collect()}[4] == 1


# ---- Damaged lines ---------------------------------------------------------------

SHAPE = "trip_id bigint, user_id bigint, total_cost decimal(8,2)"


def scanned(spark, tmp_path, text, fmt, **options):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(text, encoding="utf-8")
    schema = spark.createDataFrame([], SHAPE).schema
    return tables.scan_checked(spark, str(tmp_path / "in"), schema, str(tmp_path / "staged"), fmt, **options)


def test_damaged_json_lines(spark, tmp_path):
    good = ['{"trip_id":1,"user_id":2,"total_cost":3.50}', '{"trip_id":4}', '{"user_id":null,"trip_id":5,"more":[1]}']
    bad = ['{"trip_id":6,"user_id":2,', '{"trip_id":"x","user_id":2}', "no json", '{"trip_id":7,"total_cost":{"a":1}}', "é{"]
    found = scanned(spark, tmp_path, "\n".join([good[0], *bad, "", *good[1:]]) + "\n", "json")
    assert h.rows(found.rows) == [(1, 2, Decimal("3.50")), (4, None, None), (5, None, None)]
    assert sorted(r.line for r in found.damaged.collect()) == sorted(bad)
    assert {r.file.rsplit("/", 1)[1] for r in found.damaged.collect()} == {"a.txt"}
    assert (found.n_rows, found.n_damaged) == (3, 5)


def test_damaged_csv_lines(spark, tmp_path):
    good, bad = ["1,2,3.50", "4,,"], ["5,6", "7,x,1.00", "8,9,1.00,2", "what"]
    found = scanned(spark, tmp_path, "\n".join(["trip_id,user_id,total_cost", *good, *bad]) + "\n", "csv")
    assert h.rows(found.rows) == [(1, 2, Decimal("3.50")), (4, None, None)]
    assert sorted(r.line for r in found.damaged.collect()) == sorted(bad)
    assert (found.n_rows, found.n_damaged) == (2, 4)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_clean_and_empty_text(spark, tmp_path, small, fmt):
    schema = spark.createDataFrame([], SHAPE).schema
    rows = small["trips"].select(schema.names)
    tables.write_table(rows, str(tmp_path / "in"), fmt)
    found = tables.scan_checked(spark, str(tmp_path / "in"), schema, str(tmp_path / "staged"), fmt)
    assert h.rows(found.rows) == h.rows(rows) and found.damaged.count() == 0
    assert (found.n_rows, found.n_damaged) == (rows.count(), 0)
    # Asked again, the staged rows are read and not the text.
    assert found.rows.inputFiles() and all("/staged/" in f for f in found.rows.inputFiles())
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.txt").write_text("")
    none = tables.scan_checked(spark, str(tmp_path / "none"), schema, str(tmp_path / "staged2"), fmt)
    assert (none.rows.count(), none.n_rows, none.n_damaged) == (0, 0, 0)


def test_only_text_can_be_damaged(spark, tmp_path):
    with pytest.raises(ValueError, match="parquet"):
        tables.scan_checked(spark, str(tmp_path), model.TRIPS, str(tmp_path / "s"), "parquet")


# ---- Versions --------------------------------------------------------------------


def test_documents_of_two_versions_in_one_folder(spark, tmp_path):
    journeys = h.trips(spark, *[h.trip(i, 1, 10, 20) for i in range(1, 5)])
    happened = [h.event("a", 1, "BATTERY", "50"), h.event("b", 2, "BATTERY", "500"), h.event("c", 3, "BATTERY", "500"), h.event("d", 3, "BATTERY", "7"), h.event("e", 4, "X", "1")]
    docs = documents.embed_events(journeys, h.events(spark, *happened), part_rows=1)
    filled = changes.backfill_battery_nested(docs)
    folder = str(tmp_path / "docs")
    tables.write_version(docs.where("trip_id = 1"), folder, 1)
    tables.write_version(filled.where("trip_id = 2"), folder, 1)
    tables.write_version(filled.where("trip_id > 2"), folder, 2)
    mixed = tables.read_versions(spark, folder, {1: model.TRIP_DOCUMENT, 2: model.TRIP_DOCUMENT_V2})
    levels = {r.trip_id: (r.version, r.battery_level) for r in mixed.select("version", "trip_id", F.explode("events.battery_level").alias("battery_level")).where("trip_id < 3").collect()}
    assert levels == {1: (1, None), 2: (1, 500)}
    told = {(r.version, r.rule): r.n_violations for r in quality.check_versions(mixed).collect() if r.n_violations}
    assert told == {
        (1, "trips.events.battery_level.absent"): 1,
        (2, "trips.events.battery_level.range"): 1,
        (2, "trips.events.event_type.enum"): 1,
    }
    one = mixed.where("version = 2")
    assert all("version=2" in f for f in one.inputFiles()) or "PartitionFilters: [isnotnull(version" in h.plan_of(one)
