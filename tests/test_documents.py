import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave.operators import changes, documents, quality


@pytest.fixture
def journeys(spark):
    return h.trips(spark, h.trip(1, 1, 10, 20), h.trip(2, 2, 20, 10), h.trip(3, 2, 10, 10))


@pytest.fixture
def happened(spark):
    return h.events(
        spark,
        h.event("b", 1, "BATTERY", "85"),
        h.event("a", 1, "GPS", "40.0,9.0"),
        h.event("c", 3, "DELAY", "5"),
        h.event("z", None, "DELAY", "5"),
    )


def test_embedding_orders_events_and_keeps_trips_without(journeys, happened):
    docs = documents.embed_events(journeys, happened)
    found = {r.trip_id: [e.event_id for e in r.events] for r in docs.collect()}
    assert found == {1: ["a", "b"], 2: [], 3: ["c"]}
    assert "trip_id" not in docs.schema["events"].dataType.elementType.names


def test_unwind_drops_empty_arrays(journeys, happened):
    docs = documents.embed_events(journeys, happened)
    unwound = documents.unwind_events(docs).select(happened.columns)
    assert h.rows(unwound) == h.rows(happened.where("trip_id is not null"))


def test_a_large_group_is_cut_into_parts_and_stays_whole(spark):
    journeys = h.trips(spark, h.trip(1, 1, 10, 20), h.trip(2, 1, 20, 10), h.trip(3, 1, 20, 10))
    many = spark.range(3000).select(
        F.format_string("e%05d", "id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 100).cast("bigint").alias("trip_id"),
        F.lit(h.DAY).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("id") % 2 == 0, "ERROR").otherwise("GPS").alias("event_type"),
        F.lit("x").alias("value"),
    )
    few = h.events(spark, h.event("f", 2, "GPS", "1,1"))
    happened = many.unionByName(few)
    docs = documents.embed_events(journeys, happened, part_rows=50).cache()
    sizes = {(r.trip_id, r.part): len(r.events) for r in docs.collect()}
    assert sum(n for (t, _), n in sizes.items() if t == 1) == 1000
    assert max(sizes.values()) == 50 and sizes[(2, 0)] == 1 and sizes[(3, 0)] == 0
    parts = sorted((r.part, [e.event_id for e in r.events]) for r in docs.where("trip_id = 1").collect())
    together = [e for _, events in parts for e in events]
    assert together == sorted(together)
    assert len([k for k in sizes if k[0] == 1]) == 20
    assert h.rows(documents.trips_with_embedded_event(docs).select("trip_id")) == [(1,)]
    assert documents.facet_station_roles(docs).agg(F.sum("n")).first()[0] == 6
    unwound = documents.unwind_events(docs).select(happened.columns)
    assert h.rows(unwound) == h.rows(happened.where("trip_id in (1, 2)"))
    flagged = h.counts(quality.check_documents(docs, h.users(spark), h.stations(spark)))
    assert flagged == {}


def test_parts_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(documents, "_PARTS_PER_BLOCK", 4)
    df = spark.createDataFrame([(n, n) for n in (1, 3, 4, 5, 8, 9, 23)], "k int, parts int")
    found: dict = {}
    for row in documents._numbered_parts(df).collect():
        found.setdefault(row.k, []).append(row.part)
    assert {k: sorted(v) for k, v in found.items()} == {k: list(range(k)) for k in (1, 3, 4, 5, 8, 9, 23)}


def test_statistics_over_parts_are_exact(spark):
    riders = h.users(spark, 1, 2)
    journeys = h.trips(spark, *[h.trip(i, 1, 10, 20, minutes=i) for i in range(1, 101)])
    whole = h.rows(documents.user_stats_nested(riders, journeys))
    assert whole == [(1, "N1", "S1", 100, 50.5), (2, "N2", "S2", 0, 0.0)]
    assert h.rows(documents.user_stats_nested(riders, journeys, part_rows=7)) == whole


def test_nested_backfill_overwrites_and_leaves_other_events(journeys, happened):
    docs = documents.embed_events(journeys, happened)
    filled = changes.backfill_battery_nested(docs)
    assert changes.modified_count(docs).first()[0] == 1
    assert changes.modified_count(filled).first()[0] == 0
    levels = {r.event_id: r.battery_level for r in documents.unwind_events(filled).collect()}
    assert levels == {"a": None, "b": 85, "c": None}

    wrong = filled.withColumn(
        "events", F.transform("events", lambda e: e.withField("battery_level", F.lit(1).cast("int")))
    )
    again = changes.backfill_battery_nested(wrong)
    levels = {r.event_id: r.battery_level for r in documents.unwind_events(again).collect()}
    assert levels == {"a": 1, "b": 85, "c": 1}


def test_documents_of_the_first_version_stay_valid(spark, journeys, happened):
    docs = documents.embed_events(journeys, happened)
    people, places = h.users(spark, 1, 2), h.stations(spark, 10, 20)
    assert h.counts(quality.check_documents(docs, people, places)) == {}
    filled = changes.backfill_battery_nested(docs)
    assert h.counts(quality.check_documents(filled, people, places)) == {}


def test_document_rules_fire(spark, journeys):
    bad = h.events(
        spark, h.event("a", 1, "FOO", "x"), h.event("b", 1, "BATTERY", "101"), h.event("c", 2, "GPS", None)
    )
    docs = changes.backfill_battery_nested(documents.embed_events(journeys, bad))
    docs = docs.withColumn("user_id", F.when(F.col("trip_id") != 3, F.col("user_id")))
    shut = h.frame(spark, "stations", [(1, "S", "Roma", 0), (2, None, "Roma", 5)])
    assert h.counts(quality.check_documents(docs, h.users(spark, 1), shut)) == {
        "trips.user_id.required": 1,
        "trips.events.value.required": 1,
        "trips.events.event_type.enum": 1,
        "trips.events.battery_level.range": 1,
        "stations.name.required": 1,
        "stations.capacity.minimum": 1,
    }


def type_rules(spark, lines, name="trips", schema=None):
    from tripweave import model

    raw = spark.createDataFrame([(line,) for line in lines], "text string")
    return h.counts(quality.check_document_types(raw, "text", schema or model.TRIP_DOCUMENT_V2, name))


def test_type_rules_on_json_text(spark):
    lines = [
        '{"trip_id": 1, "user_id": 1, "total_cost": 2.50, "start_time": "2023-01-01T00:00:00", "events": []}',
        '{"trip_id": "x", "user_id": 1, "total_cost": "free", "events": [{"event_id": "a", "battery_level": "full"}]}',
        '{"trip_id": 3, "start_time": "yesterday"}',
        '{"trip_id": 4, "total_cost": null, "events": [{"battery_level": 50, "value": "12"}]}',
        "no json",
        "[1]",
    ]
    assert type_rules(spark, lines) == {
        "trips.json": 2,
        "trips.trip_id.type": 1,
        "trips.total_cost.type": 1,
        "trips.start_time.type": 1,
        "trips.events.type": 1,
    }


@pytest.mark.parametrize(
    ("field", "rule"),
    [
        ('"events": 5', "events"),
        ('"events": "x"', "events"),
        ('"events": {"event_id": "a"}', "events"),
        ('"events": [1, 2]', "events"),
        ('"events": [{"battery_level": "50"}]', "events"),
        ('"user_id": "7"', "user_id"),
        ('"events": [{"value": 12}]', "events"),
        ('"user_id": 1.5', "user_id"),
        ('"start_time": 20230101', "start_time"),
    ],
)
def test_each_wrong_shape_breaks_one_rule(spark, field, rule):
    assert type_rules(spark, ['{"trip_id": 1, ' + field + "}"]) == {f"trips.{rule}.type": 1}


def test_types_of_the_other_collections(spark):
    from tripweave import model

    assert type_rules(spark, ['{"user_id": "1", "birthdate": "1990-01-01"}'], "users", model.USERS) == {"users.user_id.type": 1}
    assert type_rules(spark, ['{"station_id": 1, "capacity": true, "name": 3}'], "stations", model.STATIONS) == {
        "stations.capacity.type": 1,
        "stations.name.type": 1,
    }


def test_small_keys_are_cut_without_being_ranged(spark, journeys, monkeypatch):
    monkeypatch.setattr(documents, "_in_parts", lambda *args: pytest.fail("ranged"))
    happened = h.events(spark, *[h.event(f"e{i}", 1 + i % 2, "GPS", "1,1") for i in range(7)])
    docs = documents.embed_events(journeys, happened, part_rows=2)
    found = sorted((r.trip_id, r.part, r.parts, [e.event_id for e in r.events]) for r in docs.collect())
    assert found == [
        (1, 0, 2, ["e0", "e2"]),
        (1, 1, 2, ["e4", "e6"]),
        (2, 0, 2, ["e1", "e3"]),
        (2, 1, 2, ["e5"]),
        (3, 0, 1, []),
    ]


@pytest.mark.parametrize("part_rows", [2, 4, 10])
def test_ranged_keys_are_cut_like_small_ones(spark, part_rows, monkeypatch):
    journeys = h.trips(spark, *[h.trip(i, 1, 10, 20) for i in (1, 2, 3, 3)], h.trip(None, 1, 10, 20))
    happened = h.events(spark, *[h.event(f"e{i:02d}", 1 if i < 13 else 3, "GPS", "1,1") for i in range(17)])

    def cut() -> list:
        docs = documents.embed_events(journeys, happened, part_rows=part_rows).collect()
        return sorted((r.trip_id or 0, r.part, r.parts, [e.event_id for e in r.events]) for r in docs)

    small = cut()
    monkeypatch.setattr(documents, "_WHOLE_ROWS", 5)
    assert cut() == small and max(parts for _, _, parts, _ in small) == -(-13 // part_rows)


def test_type_rules_read_the_text_once(spark, journeys, happened, tmp_path):
    from tripweave import model

    docs = documents.embed_events(journeys, happened, part_rows=1)
    documents.documents_as_json(docs).write.parquet(str(tmp_path / "text"))
    found = quality.check_document_types(spark.read.parquet(str(tmp_path / "text")), "text", model.TRIP_DOCUMENT, "trips")
    assert h.plan_of(found).count("FileScan") == 1 and h.counts(found) == {}


def test_shapes_inside_events_break_their_rule(spark):
    lines = ['{"trip_id": 1, "events": [null]}', '{"trip_id": 2, "events": [{"event_id": null}]}', '{"trip_id": 3, "events": null}', '{"trip_id": 4, "events": [[]]}', "null", "5", '"x"', "{}"]
    assert type_rules(spark, lines) == {"trips.json": 3, "trips.events.type": 2}
