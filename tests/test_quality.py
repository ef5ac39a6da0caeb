import datetime as dt
from decimal import Decimal

import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave import model
from tripweave.operators import quality


@pytest.fixture
def broken(spark):
    """Tables in which every rule is broken exactly once."""
    born = dt.date(1990, 1, 1)
    long = "x" * 151
    users = [(1, "N", "S", born, "Italy"), (2, None, "S", born, "Italy"), (3, "N", None, born, "Italy")]
    users += [(4, "N", "S", None, "Italy"), (5, "N", "S", born, None), (None, "N", "S", born, "Italy")]
    users += [(6, long, "S", born, "Italy"), (7, "N", long, born, "Italy"), (8, "N", "S", born, long)]
    users += [(1, "N", "S", born, "Italy")]
    stations = [(10, "A", "Roma", 5), (20, "B", "Roma", 5), (30, None, "Roma", 5), (40, "D", None, 5)]
    stations += [(50, "E", "Roma", None), (60, "F", "Roma", 0), (70, long, "Roma", 5), (80, "H", long, 5)]
    stations += [(None, "I", "Roma", 5), (10, "A", "Roma", 5)]
    t0, t1, one = h.at(0), h.at(5), Decimal("1.00")
    trips = [(1, 1, 10, 20, t0, t1, one), (None, 1, 10, 20, t0, t1, one), (2, None, 10, 20, t0, t1, one)]
    trips += [(3, 1, None, 20, t0, t1, one), (4, 1, 10, None, t0, t1, one), (5, 1, 10, 20, None, t1, one)]
    trips += [(6, 1, 10, 20, t0, None, one), (7, 1, 10, 20, t0, t1, None), (8, 1, 10, 20, t0, t1, -one)]
    trips += [(9, 1, 10, 20, t0, t0, one), (10, 99, 10, 20, t0, t1, one), (11, 1, 99, 20, t0, t1, one)]
    trips += [(12, 1, 10, 99, t0, t1, one), (1, 1, 10, 20, t0, t1, one)]
    events = [("a", 1, t0, "GPS", "1,1"), (None, 1, t0, "GPS", "1,1"), ("b", None, t0, "GPS", "1,1")]
    events += [("c", 1, None, "GPS", "1,1"), ("d", 1, t0, None, "1,1"), ("e", 1, t0, "GPS", None)]
    events += [("f", 1, t0, "FOO", "1"), ("g", 99, t0, "GPS", "1,1"), ("a", 1, t0, "GPS", "1,1")]
    rows = {"users": users, "stations": stations, "trips": trips, "events": events}
    return {name: h.frame(spark, name, r) for name, r in rows.items()}


def test_every_rule_fires_once(spark, broken):
    summary = {r.rule: r.n_violations for r in quality.check_summary(broken).collect()}
    assert len(summary) == 39
    # No listed event type is longer than ten characters, so only this rule stays silent.
    assert summary.pop("events.event_type.length") == 0
    assert set(summary.values()) == {1}, {k: v for k, v in summary.items() if v != 1}


def test_length_limit_of_event_types(spark):
    happened = h.events(spark, h.event("a", 1, "ELEVENCHARS", "x"), h.event("b", 1, "TENLETTERS", "x"))
    assert h.counts(quality.check_rows({"events": happened}, ("length",))) == {"events.event_type.length": 1}


def test_split_names_the_broken_rules(spark, broken):
    accepted, rejected = quality.split(broken["trips"], "trips", broken)
    assert accepted.columns == broken["trips"].columns
    assert accepted.count() == 0  # the only sound trip is there twice
    by_trip = {r.trip_id: set(r.broken_rules) for r in rejected.collect()}
    assert by_trip[1] == {"trips.trip_id.unique"}
    assert by_trip[9] == {"trips.ends_after_start"}
    assert by_trip[10] == {"trips.user_id.foreign_key"}
    assert by_trip[11] == {"trips.start_station.foreign_key"}
    assert by_trip[12] == {"trips.end_station.foreign_key"}
    assert by_trip[4] == {"trips.end_station.not_null"}
    assert rejected.count() == broken["trips"].count()


def test_split_keeps_every_row_on_one_side(small):
    accepted, rejected = quality.split(small["trips_raw"], "trips", small)
    assert accepted.count() == 1182 and rejected.count() == 318
    assert h.rows(accepted) == h.rows(small["trips"])


def test_orphans_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    """The way without a broadcast, taken when offending keys are many."""
    journeys = h.trips(spark, *[h.trip(i, i % 50, 10, 20) for i in range(200)])
    parents = {"users": h.users(spark, *range(0, 50, 2)), "stations": h.stations(spark, 10, 20)}
    few = h.rows(quality.split(journeys, "trips", parents)[1])
    monkeypatch.setattr(quality, "small_side", lambda keys: (keys, keys.count()))
    assert h.rows(quality.split(journeys, "trips", parents)[1]) == few
    assert len(few) == 100


def test_duplicate_count_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "user_id bigint")
    assert h.counts(quality.count_duplicates(df, "users")) == {"users.user_id.unique": 2}


def test_checks_on_empty_tables_list_every_rule_as_zero(spark):
    empty = {name: h.frame(spark, name, []) for name in model.SCHEMAS}
    summary = quality.check_summary(empty).collect()
    assert len(summary) == 39 and {r.n_violations for r in summary} == {0}
    accepted, rejected = quality.split(empty["trips"], "trips", empty)
    assert accepted.collect() == [] and rejected.collect() == []


def test_a_check_passes_on_null(spark):
    df = spark.range(1).select(
        F.lit(None).cast("int").alias("capacity"), F.lit(1).alias("station_id"), F.lit("a").alias("name")
    )
    df = df.withColumn("city", F.lit("b"))
    assert h.counts(quality.check_rows({"stations": df}, ("value",))) == {}
