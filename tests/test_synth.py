import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave import model
from tripweave.functions.expressions import minutes_between, typed_event_value
from tripweave.operators import quality, synth


@pytest.fixture(scope="module")
def made(spark):
    tables = synth.tables(spark, n_users=1000, n_trips=5000, events_per_trip=3, seed=9)
    return {name: df.cache() for name, df in tables.items()}


def test_row_counts_and_columns(made):
    assert {name: df.count() for name, df in made.items()} == {
        "users": 1000,
        "stations": 20,
        "trips": 5000,
        "events": 15000,
    }
    for name, df in made.items():
        assert df.columns == model.SCHEMAS[name].names
        assert [f.dataType for f in df.schema] == [f.dataType for f in model.SCHEMAS[name]]


def test_number_of_stations():
    assert [synth.station_count(n) for n in (10, 1000, 10_000, 50_000)] == [20, 20, 200, 1000]


def test_every_check_passes(made):
    assert h.counts(quality.check_summary(made)) == {}


def test_ranges(made):
    born = made["users"].agg(F.min("birthdate"), F.max("birthdate")).first()
    assert born[0].isoformat() >= "1963-01-01" and born[1].isoformat() <= "2005-01-05"
    low, high = made["stations"].agg(F.min("capacity"), F.max("capacity")).first()
    assert 5 <= low <= high <= 50
    minutes = minutes_between("start_time", "end_time")
    row = made["trips"].agg(
        F.min(minutes),
        F.max(minutes),
        F.min("total_cost"),
        F.max("total_cost"),
        F.min("start_time"),
        F.max("start_time"),
    ).first()
    assert (row[0], row[1]) == (5, 180) and row[2] >= 0.5 and row[3] <= 25
    assert row[4].isoformat() >= "2023-01-01" and row[5].isoformat() < "2024-01-02"
    assert made["trips"].where("start_station = end_station").count() > 100


def test_event_values_have_the_form_of_their_type(made):
    value = typed_event_value("event_type", "value").alias("t")
    typed = made["events"].select("event_type", value).select("event_type", "t.*")
    by_type = {r.event_type: r.asDict() for r in typed.groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"),
        F.max("lon").alias("lon1"), F.count_distinct("error_code").alias("codes"), F.min("battery").alias("bat0"),
        F.max("battery").alias("bat1"), F.min("delay_min").alias("del0"), F.max("delay_min").alias("del1"),
    ).collect()}
    assert set(by_type) == set(model.EVENT_TYPES) and all(3000 < r["n"] < 4500 for r in by_type.values())
    gps = by_type["GPS"]
    assert 37 <= gps["lat0"] < 37.1 and 46.9 < gps["lat1"] <= 47 and 7 <= gps["lon0"] < 7.1 and 14.9 < gps["lon1"] <= 15
    assert by_type["ERROR"]["codes"] == 4
    assert (by_type["BATTERY"]["bat0"], by_type["BATTERY"]["bat1"]) == (0, 100)
    assert (by_type["DELAY"]["del0"], by_type["DELAY"]["del1"]) == (1, 60)


def test_same_seed_same_rows_under_any_partitioning(spark):
    def made_from(ids, seed):
        return h.rows(synth.trips(ids, 100, 20, seed).select("trip_id", "user_id", "start_station", "start_time"))

    ids = synth.keys(spark, 500)
    first = made_from(ids.repartition(1), 3)
    assert made_from(ids.repartition(8), 3) == first
    assert made_from(ids, 4) != first


def test_start_and_end_are_drawn_independently(spark):
    pairs = synth.trips(synth.keys(spark, 40_000), 100, 20, 3).groupBy("start_station", "end_station").count()
    expected = 40_000 / 400
    chi2 = pairs.agg(F.sum((F.col("count") - expected) ** 2 / expected)).first()[0]
    assert pairs.count() == 400 and 300 < chi2 < 510


def test_event_times(spark, made):
    late = synth.events(made["trips"], 2, 9, event_time="trip", with_battery_level=True)
    joined = late.join(made["trips"].select("trip_id", "start_time"), "trip_id")
    offset = minutes_between("start_time", "timestamp")
    low, high = joined.agg(F.min(offset), F.max(offset)).first()
    assert 0 <= low and high < 24 * 60
    assert h.counts(quality.count_violations(late, quality.battery_rules())) == {}
    with pytest.raises(ValueError):
        synth.events(made["trips"], 2, event_time="never")


def test_no_events_per_trip_gives_an_empty_table(made):
    none = synth.events(made["trips"], 0)
    assert none.columns == model.EVENTS.names and none.count() == 0


def test_generated_folders(spark, tmp_path):
    from tools.generate import generate, options

    from tripweave.operators import documents
    from tripweave.sources.tables import load_tables

    generate(spark, options(["--users", "100", "--trips", "300", "--events", "2", "--out", str(tmp_path)]))
    loaded = load_tables(spark, str(tmp_path / "tables"))
    counts = {n: len(df.collect()) for n, df in loaded.items()}
    assert counts == {"users": 100, "stations": 20, "trips": 300, "events": 600}
    docs = spark.read.parquet(str(tmp_path / "documents" / "trips"))
    assert docs.count() == 300 and documents.unwind_events(docs).count() == 600
    late = documents.unwind_events(docs).join(docs.select("trip_id", "start_time"), "trip_id")
    assert late.where("timestamp < start_time").count() == 0
