import helpers as h
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators import changes, quality


@pytest.fixture
def happened(spark):
    return h.events(
        spark,
        h.event("a", 1, "BATTERY", "85"),
        h.event("b", 1, "BATTERY", "100"),
        h.event("c", 2, "BATTERY", "101"),
        h.event("d", 2, "GPS", "40.0,9.0"),
    )


def levels(df):
    return {r.event_id: r.battery_level for r in df.collect()}


def test_adding_a_column_twice_changes_nothing(happened):
    once = changes.add_column(happened, "battery_level", T.IntegerType())
    assert levels(once) == dict.fromkeys("abcd")
    filled = changes.backfill_battery(once)
    assert changes.add_column(filled, "battery_level", T.IntegerType()) is filled


def test_backfill_fills_nulls_only_unless_told(happened):
    filled = changes.backfill_battery(happened)
    assert levels(filled) == {"a": 85, "b": 100, "c": 101, "d": None}
    preset = filled.withColumn("battery_level", F.when(F.col("event_id") == "a", 7).cast("int"))
    assert levels(changes.backfill_battery(preset))["a"] == 7
    assert levels(changes.backfill_battery(preset, overwrite=True))["a"] == 85


def test_bad_text_fails_only_if_strict(spark, happened):
    bad = happened.unionByName(h.events(spark, h.event("x", 3, "BATTERY", "x")))
    with pytest.raises(PySparkException):
        changes.backfill_battery(bad).collect()
    assert levels(changes.backfill_battery(bad, strict=False))["x"] is None


def test_battery_rules(happened):
    before = changes.add_column(happened, "battery_level", T.IntegerType())
    after = changes.backfill_battery(happened)
    assert h.counts(quality.count_violations(before, quality.battery_rules())) == {
        "events.battery_level.only_battery": 3
    }
    assert h.counts(quality.count_violations(after, quality.battery_rules())) == {"events.battery_level.range": 1}
    on_gps = after.withColumn("battery_level", F.coalesce("battery_level", F.lit(1)))
    assert h.counts(quality.count_violations(on_gps, quality.battery_rules())) == {
        "events.battery_level.range": 1,
        "events.battery_level.only_battery": 1,
    }
    assert [r.event_id for r in changes.validate_battery(after).collect()] == ["c"]


def test_sample_event(happened):
    assert [tuple(r) for r in changes.sample_event(changes.backfill_battery(happened)).collect()] == [("a", "85", 85)]
    assert changes.sample_event(changes.backfill_battery(happened), "DELAY").collect() == []


def test_upsert_in_two_batches(spark):
    base = h.stations(spark, 1, 2, 3)
    shape = "station_id bigint, name string, city string, capacity int, n int"
    first = spark.createDataFrame([(2, "two", None, 9, 1), (4, "four", "Bari", 4, 1)], shape)
    second = spark.createDataFrame(
        [(4, "old", "Bari", 1, 1), (4, "new", "Bari", 5, 2), (None, "lost", "Bari", 5, 3)], shape
    )
    after = changes.upsert(base, first.drop("n"), "station_id")
    after = changes.upsert(after, second, "station_id", ["name", "city", "capacity"], sequence="n")
    assert h.rows(after) == [
        (1, "Station 1", "Roma", 10),
        (2, "two", None, 9),
        (3, "Station 3", "Roma", 10),
        (4, "new", "Bari", 5),
    ]


def test_upsert_leaves_properties_that_are_not_listed(spark):
    base = h.stations(spark, 1)
    batch = spark.createDataFrame([(1, "one"), (2, "two")], "station_id bigint, name string")
    assert h.rows(changes.upsert(base, batch, "station_id")) == [(1, "one", "Roma", 10), (2, "two", None, None)]


def test_upsert_with_null_sequences_keeps_the_row(spark):
    base = h.stations(spark, 1)
    shape = "station_id bigint, name string, capacity int, n int"
    batch = spark.createDataFrame([(1, "a", 5, None), (2, "b", 6, None), (2, "c", 7, 0)], shape)
    after = changes.upsert(base, batch, "station_id", ["name", "capacity"], sequence="n")
    assert h.rows(after) == [(1, "a", "Roma", 5), (2, "c", None, 7)]


def test_upsert_refuses_a_repeated_key_without_a_sequence(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b")], "station_id bigint, name string")
    with pytest.raises(PySparkException, match="repeats the key"):
        changes.upsert(h.stations(spark, 1), batch, "station_id").collect()


def test_upsert_same_batch_twice_is_the_same(spark):
    base, batch = h.stations(spark, 1, 2), h.stations(spark, 2, 3)
    once = changes.upsert(base, batch, "station_id")
    assert h.rows(changes.upsert(once, batch, "station_id")) == h.rows(once)
    assert h.rows(changes.upsert(h.stations(spark), batch, "station_id")) == h.rows(batch)
    assert h.rows(changes.upsert(base, h.stations(spark), "station_id")) == h.rows(base)


def test_delete_cascades_over_trips_to_events(spark, happened):
    people = h.users(spark, 1, 2)
    journeys = h.trips(spark, h.trip(1, 1, 10, 20), h.trip(2, 2, 10, 20))
    left = changes.delete_cascade(people, journeys, happened, people.where("user_id = 1"))
    assert [r[0] for r in h.rows(left["users"])] == [2]
    assert [r[0] for r in h.rows(left["trips"])] == [2]
    assert sorted(r.event_id for r in left["events"].collect()) == ["c", "d"]
    none = changes.delete_cascade(people, journeys, happened, people.where("user_id = 77"))
    assert none["events"].count() == 4 and none["trips"].count() == 2


def test_stations_in_use_may_not_be_deleted(spark):
    journeys = h.trips(spark, h.trip(1, 1, 10, 20))
    doomed = h.stations(spark, 10, 20, 30)
    assert h.rows(changes.delete_blocked(doomed, journeys)) == [(10,), (20,)]
