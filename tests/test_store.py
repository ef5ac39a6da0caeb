"""Stored tables: what a change rewrites, what it leaves, and what a broken run leaves behind."""

import helpers as h
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripweave import model
from tripweave.operators import changes, documents, graph, stored
from tripweave.sources import store as store_module
from tripweave.sources.store import Snapshot, Store


class Broken(Exception):
    pass


@pytest.fixture
def make(spark, tmp_path):
    def made(buckets=4, **tables):
        store = Store(spark, str(tmp_path / "store"), stored.layouts(buckets))
        store.create(tables)
        return store

    return made


@pytest.fixture
def breaks(monkeypatch):
    """A run that dies after it wrote its files and before its commit."""

    def broken(*_args, **_kwargs):
        raise Broken

    class Context:
        def __enter__(self):
            self.kept = Store.commit
            monkeypatch.setattr(Store, "commit", broken)

        def __exit__(self, *_):
            monkeypatch.setattr(Store, "commit", self.kept)

    return Context()


def paths(store, table):
    return {f.path for f in store.snapshot().files[table]}


def named(df, *ids):
    return df.where(F.col(df.columns[0]).isin(*ids))


def test_a_table_survives(spark, make):
    store = make(stations=h.stations(spark, *range(20)))
    assert h.rows(store.read("stations")) == h.rows(h.stations(spark, *range(20)))
    assert [f.dataType for f in store.read("stations").schema] == [f.dataType for f in model.STATIONS]
    assert store.read("users").count() == 0 and store.read("users").columns == model.USERS.names
    files = store.snapshot().files["stations"]
    assert sum(f.n_rows for f in files) == 20 and {f.bucket for f in files} <= set(range(4))


def test_merge_rewrites_only_files_with_its_keys(spark, make):
    store = make(buckets=8, stations=h.stations(spark, *range(40)))
    before = paths(store, "stations")
    batch = spark.createDataFrame([(3, "three"), (77, "new")], "station_id bigint, name string")
    stored.merge(store, "stations", batch)
    after = paths(store, "stations")
    assert len(before - after) == 1 and len(before & after) == len(before) - 1
    expected = changes.upsert(h.stations(spark, *range(40)), batch, "station_id")
    assert h.rows(store.read("stations")) == h.rows(expected)


def test_merge_of_new_keys_rewrites_nothing(spark, make):
    store = make(stations=h.stations(spark, 1, 2))
    before = paths(store, "stations")
    stored.merge(store, "stations", h.stations(spark, 3, 4))
    assert before < paths(store, "stations")
    assert h.rows(store.read("stations")) == h.rows(h.stations(spark, 1, 2, 3, 4))


def test_merge_by_sequence_and_into_an_empty_table(spark, make):
    store = make(stations=h.stations(spark))
    shape = "station_id bigint, name string, n int"
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "lost", 3)], shape)
    stored.merge(store, "stations", batch, ["name"], "n")
    assert h.rows(store.read("stations")) == [(1, "new", None, None)]
    with pytest.raises(PySparkException, match="repeats the key"):
        stored.merge(store, "stations", batch, ["name"])
    assert h.rows(store.read("stations")) == [(1, "new", None, None)]


def test_a_run_that_breaks_before_its_commit_changes_nothing(spark, make, breaks):
    store = make(stations=h.stations(spark, 1, 2, 3))
    before, rows = paths(store, "stations"), h.rows(store.read("stations"))
    batch = spark.createDataFrame([(3, "three"), (4, "four")], "station_id bigint, name string")
    with breaks, pytest.raises(Broken):
        stored.merge(store, "stations", batch)
    assert paths(store, "stations") == before and h.rows(store.read("stations")) == rows
    stored.merge(store, "stations", batch)
    assert {r.station_id: r.name for r in store.read("stations").collect()}[3] == "three" and store.read("stations").count() == 4


def test_edges_are_unique(spark, make):
    shape = "src string, dst string, type string"
    store = make(edges=spark.createDataFrame([("a", "b", "X")], shape))
    before = paths(store, "edges")
    batch = spark.createDataFrame([("a", "b", "X"), ("a", "b", "Y"), ("a", "b", "Y"), ("b", "a", "X")], shape)
    for _ in range(2):
        stored.merge(store, "edges", batch)
        assert h.rows(store.read("edges")) == [("a", "b", "X"), ("a", "b", "Y"), ("b", "a", "X")]
    assert before < paths(store, "edges")


def test_edges_are_dealt_by_a_part_of_their_key(spark, make):
    store = make(trips=h.trips(spark))
    with pytest.raises(ValueError, match="not dealt by its key"):
        stored.merge(store, "trips", h.trips(spark, h.trip(1, 1, 10, 20)))


# ---- Deletes --------------------------------------------------------------------


@pytest.fixture
def travelled(spark, make):
    journeys = [h.trip(i, i % 10, 10 + i % 3, 20) for i in range(60)]
    happened = [h.event(f"e{i}", i % 60, "GPS", "1,2") for i in range(200)]
    events = h.events(spark, *happened).withColumn("battery_level", F.lit(None).cast("int"))
    places = h.stations(spark, 10, 11, 12, 20, 30, 31)
    return make(buckets=16, users=h.users(spark, *range(10)), trips=h.trips(spark, *journeys), events=events, stations=places)


def test_delete_cascades_in_one_commit(spark, travelled, breaks):
    store = travelled
    before = {t: (paths(store, t), h.rows(store.read(t))) for t in ("users", "trips", "events", "stations")}
    doomed = spark.createDataFrame([(3,), (3,), (99,), (None,)], "user_id bigint")
    with breaks, pytest.raises(Broken):
        stored.delete_users(store, doomed)
    assert before == {t: (paths(store, t), h.rows(store.read(t))) for t in before}
    stored.delete_users(store, doomed)
    left = changes.delete_cascade(
        *(spark.createDataFrame(before[t][1], store.layouts[t].schema) for t in ("users", "trips", "events")), doomed
    )
    for table, df in left.items():
        assert h.rows(store.read(table)) == h.rows(df)
        assert before[table][0] & paths(store, table), table  # some files stay
    assert store.read("trips").count() == 54 and paths(store, "stations") == before["stations"][0]


def test_nothing_to_delete_rewrites_nothing(spark, travelled):
    before = {t: paths(travelled, t) for t in ("users", "trips", "events")}
    stored.delete_users(travelled, spark.createDataFrame([(99,)], "user_id bigint"))
    assert before == {t: paths(travelled, t) for t in before}


def test_blocked_delete_changes_no_file(spark, travelled):
    before = paths(travelled, "stations")
    with pytest.raises(stored.Blocked) as told:
        stored.delete_stations(travelled, spark.createDataFrame([(10,), (30,)], "station_id bigint"))
    assert h.rows(told.value.keys) == [(10,)] and paths(travelled, "stations") == before
    stored.delete_stations(travelled, spark.createDataFrame([(30,)], "station_id bigint"))
    assert [r[0] for r in h.rows(travelled.read("stations").select("station_id"))] == [10, 11, 12, 20, 31]


# ---- Backfill -------------------------------------------------------------------


def test_backfill_rewrites_files_with_battery_events_only(spark, make):
    rows = [h.event(f"e{i}", i, "BATTERY" if i == 5 else "GPS", "50") for i in range(40)]
    store = make(buckets=8, events=h.events(spark, *rows).withColumn("battery_level", F.lit(None).cast("int")))
    before = paths(store, "events")
    assert stored.backfill_events(store) == 1
    after = paths(store, "events")
    assert len(before - after) == 1 and len(after) == len(before)
    assert [r.event_id for r in store.read("events").where("battery_level = 50").collect()] == ["e5"]
    assert stored.backfill_events(store) == 0 and paths(store, "events") == after


def test_backfill_with_bad_text(spark, make):
    rows = [h.event("a", 1, "BATTERY", "x"), h.event("b", 1, "BATTERY", "7"), h.event("c", 1, "BATTERY", None)]
    store = make(events=h.events(spark, *rows).withColumn("battery_level", F.lit(None).cast("int")))
    before = paths(store, "events")
    with pytest.raises(PySparkException, match="not a battery level"):
        stored.backfill_events(store)
    assert paths(store, "events") == before
    assert stored.backfill_events(store, strict=False) == 1 and stored.backfill_events(store, strict=False) == 0


@pytest.mark.parametrize("part_rows", [2, 10_000])
def test_backfill_of_documents_counts_while_it_writes(spark, make, part_rows):
    happened = [h.event(f"e{i}", i % 9, "BATTERY" if i % 9 < 4 and i < 20 else "GPS", "50") for i in range(60)]
    journeys = h.trips(spark, *[h.trip(i, 1, 10, 20) for i in range(12)])
    events = h.events(spark, *happened).withColumn("battery_level", F.lit(None).cast("int"))
    docs = documents.embed_events(journeys, events, part_rows=part_rows)
    store = make(buckets=8, trip_documents=docs)
    before, expected = paths(store, "trip_documents"), changes.modified_count(docs).first()[0]
    assert stored.backfill_documents(store) == expected == 4
    after = paths(store, "trip_documents")
    assert before & after and before - after
    assert h.rows(documents.unwind_events(store.read("trip_documents"))) == h.rows(
        documents.unwind_events(changes.backfill_battery_nested(docs))
    )
    assert stored.backfill_documents(store) == 0 and paths(store, "trip_documents") == after


# ---- Inserts --------------------------------------------------------------------


@pytest.fixture
def ready(spark, make):
    return make(users=h.users(spark, 1, 2), stations=h.stations(spark, 10, 20))


def test_insert_checks_against_what_is_stored(spark, ready, breaks):
    good = [h.trip(1, 1, 10, 20), h.trip(2, 2, 20, 10)]
    bad = [h.trip(3, 9, 10, 20), h.trip(4, 1, 10, 99), h.trip(5, 1, 10, 20, minutes=-1), h.trip(6, 1, 10, 20), h.trip(6, 1, 10, 20)]
    first = h.trips(spark, *good, *bad)
    with breaks, pytest.raises(Broken):
        stored.insert(ready, "trips", "monday", first)
    assert ready.read("trips").count() == 0 and not ready.has_batch("monday")
    assert stored.insert(ready, "trips", "monday", first) and ready.has_batch("monday")
    assert not stored.insert(ready, "trips", "monday", first)
    assert [r[0] for r in h.rows(ready.read("trips").select("trip_id"))] == [1, 2]
    told = {(r.trip_id, *r.broken_rules) for r in ready.read("trips_rejected").collect()}
    assert told == {
        (3, "trips.user_id.foreign_key"),
        (4, "trips.end_station.foreign_key"),
        (5, "trips.ends_after_start"),
        (6, "trips.trip_id.unique"),
    }
    before = paths(ready, "trips")
    assert stored.insert(ready, "trips", "tuesday", h.trips(spark, good[0], h.trip(7, 2, 10, 10)))
    assert [r[0] for r in h.rows(ready.read("trips").select("trip_id"))] == [1, 2, 7] and before < paths(ready, "trips")
    assert ready.read("trips_rejected").where("trip_id = 1").first().broken_rules == ["trips.trip_id.unique"]


def test_an_empty_batch_is_a_batch(spark, ready):
    assert stored.insert(ready, "trips", "nothing", h.trips(spark)) and not stored.insert(ready, "trips", "nothing", h.trips(spark))
    assert ready.read("trips").count() == 0


# ---- Lookups --------------------------------------------------------------------


def test_one_riders_question_reads_one_bucket(spark, make):
    journeys = h.trips(spark, *[h.trip(i, i % 50, 10, 20) for i in range(500)])
    store = make(buckets=16, users=h.users(spark, *range(50)), trips=journeys, stations=h.stations(spark, 10, 20, 30))
    now = store.snapshot()
    own = now.lookup("trips", user_id=7)
    files = own.inputFiles()
    assert len(files) == 1 and len({f.bucket for f in now.files["trips"]}) > 8
    assert own.count() == 10
    scan = h.plan_of(own)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in scan
    asked = graph.reachable_stations(own, now.lookup("users", user_id=7), now.read("stations"), 7)
    assert h.rows(asked) == [(10, "Station 10", "Roma"), (20, "Station 20", "Roma")]
    assert now.lookup("trips", user_id=7777).count() == 0


def test_a_delete_looks_at_touched_buckets_only(spark, travelled, monkeypatch):
    read = []
    scan = Store._scan

    def noted(self, table, some):
        read.append((table, len(some)))
        return scan(self, table, some)

    monkeypatch.setattr(store_module.Store, "_scan", noted)
    now = travelled.snapshot()
    assert len(now.with_keys("users", spark.createDataFrame([(3,)], "user_id bigint"))) == 1
    assert read == [("users", 1)] and len(now.files["users"]) > 3


# ---- Filters --------------------------------------------------------------------


def test_filters_never_miss_a_key(spark):
    from tripweave.sources import filters

    rows = spark.range(5000).selectExpr("id AS k", "CAST(id % 3 AS int) AS b")
    parts = [filters.filter_rows(rows.where(c), "b", "k", 2) for c in ("k < 2000", "k >= 2000", "k < 10")]
    stored_filters = parts[0].unionByName(parts[1]).unionByName(parts[2])
    asked = spark.range(0, 20_000).selectExpr("id AS k")
    found = {(r.k, r.of) for r in filters.may_hold(stored_filters, asked, "k", 2).collect()}
    assert {(k, k % 3) for k in range(5000)} <= found
    assert len(found) - 5000 < 0.02 * 20_000 * 3  # few wrong answers: 1,667 keys have 65,536 bits
    assert filters.may_hold(stored_filters.limit(0), asked, "k", 2).count() == 0


def test_keys_are_checked_in_the_buckets_that_may_hold_them(spark, make, monkeypatch):
    journeys = [h.trip(i, i % 40, 10, 20) for i in range(400)]
    store = make(buckets=16, trips=h.trips(spark, *journeys), users=h.users(spark, *range(40)), stations=h.stations(spark, 10, 20))
    now = store.snapshot()
    assert len(now.may_hold("trips", "trip_id", spark.createDataFrame([(7,)], "trip_id bigint"))) == 1
    assert now.may_hold("trips", "trip_id", spark.createDataFrame([(10**6,), (None,)], "trip_id bigint")) == []
    assert h.rows(now.known("trips", "trip_id", spark.createDataFrame([(7,), (7,), (400,), (None,)], "trip_id bigint"))) == [(7,)]
    batch = h.trips(spark, h.trip(7, 1, 10, 20), h.trip(7, 1, 10, 20), h.trip(500, 99, 10, 77), h.trip(501, 1, 20, 10), h.trip(501, 2, 20, 10))
    assert h.counts(stored.check_unique(store, "trips", batch)) == {"trips.trip_id.unique": 3}
    assert h.counts(stored.check_foreign_keys(store, "trips", batch)) == {"trips.user_id.foreign_key": 1, "trips.end_station.foreign_key": 1}
    gone = h.events(spark, h.event("a", 7, "GPS", "1,2"), h.event("b", 900, "GPS", "1,2"))
    assert h.counts(stored.check_foreign_keys(store, "events", gone)) == {"events.trip_id.foreign_key": 1}


def test_filters_grow_with_the_table_and_outlive_deletes(spark, make):
    store = make(buckets=4, trips=h.trips(spark, h.trip(1, 1, 10, 20)), users=h.users(spark, 1, 2), stations=h.stations(spark, 10, 20))
    assert stored.insert(store, "trips", "more", h.trips(spark, h.trip(2, 2, 10, 20)))
    keys = spark.createDataFrame([(1,), (2,), (3,)], "trip_id bigint")
    assert h.rows(store.snapshot().known("trips", "trip_id", keys)) == [(1,), (2,)]
    stored.delete_users(store, spark.createDataFrame([(1,)], "user_id bigint"))
    assert h.rows(store.snapshot().known("trips", "trip_id", keys)) == [(2,)]
    assert stored.insert(store, "trips", "again", h.trips(spark, h.trip(1, 2, 10, 20)))
    assert h.rows(store.snapshot().known("trips", "trip_id", keys)) == [(1,), (2,)]


def test_a_backfill_leaves_rows_in_their_tasks(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), stored.layouts(4))
    docs = documents.embed_events(
        h.trips(spark, *[h.trip(i, 1, 10, 20) for i in range(20)]),
        h.events(spark, *[h.event(f"e{i}", i % 20, "BATTERY", str(i)) for i in range(60)]).withColumn("battery_level", F.lit(None).cast("int")),
        part_rows=2,
    )
    store.create({"trip_documents": docs})
    asked, write = [], Store.write
    monkeypatch.setattr(Store, "write", lambda self, table, df, **how: asked.append(how) or write(self, table, df, **how))
    assert stored.backfill_documents(store) == 20
    assert asked == [{"in_place": True}]
    levels = {r.event_id: r.battery_level for r in documents.unwind_events(store.read("trip_documents")).collect()}
    assert levels == {f"e{i}": i for i in range(60)}
    for bucket, files in enumerate([store.snapshot().of_buckets("trip_documents", [b]) for b in range(4)]):
        rows = store.snapshot().read("trip_documents", files)
        assert {r[0] for r in rows.select(store.layouts["trip_documents"].bucket()).collect()} <= {bucket}


def test_a_merge_of_keys_alone_does_not_look_for_files(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), stored.layouts(4))
    old = [(f"T:{i}", "S:1", "STARTS_AT") for i in range(10)]
    store.create({"edges": spark.createDataFrame(old, stored.EDGES)})
    monkeypatch.setattr(Snapshot, "with_keys", lambda *args: pytest.fail("looked for files"))
    new = [(f"T:{i}", "S:1", "STARTS_AT") for i in range(5, 15)]
    stored.merge(store, "edges", spark.createDataFrame(new + new + [(None, "S:1", "STARTS_AT")], stored.EDGES))
    assert h.rows(store.read("edges")) == sorted({*old, *new})


def test_files_of_keys_are_found_by_hashes_of_their_names(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), stored.layouts(4))
    store.create({"events": h.events(spark, *[h.event(f"e{i}", i, "GPS", "1,1") for i in range(40)])
                  .withColumn("battery_level", F.lit(None).cast("int"))})
    now = store.snapshot()
    keys = spark.createDataFrame([(3,), (3,), (99,), (None,)], "trip_id bigint")
    monkeypatch.setattr(Snapshot, "holding", lambda *args: pytest.fail("names were shuffled"))
    found = now.with_keys("events", keys)
    assert len(found) == 1 and 3 in {r.trip_id for r in now.read("events", found).collect()}
    assert now.with_keys("events", keys.where("trip_id = 99")) == []


def test_a_delete_leaves_rows_in_their_tasks(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), stored.layouts(4))
    store.create({
        "users": h.users(spark, 1, 2),
        "trips": h.trips(spark, *[h.trip(i, 1 + i % 2, 10, 20) for i in range(20)]),
        "events": h.events(spark, *[h.event(f"e{i}", i % 20, "GPS", "1,1") for i in range(60)]).withColumn("battery_level", F.lit(None).cast("int")),
    })
    asked, write = {}, Store.write
    monkeypatch.setattr(Store, "write", lambda self, table, df, **how: asked.update({table: how}) or write(self, table, df, **how))
    stored.delete_users(store, h.users(spark, 2))
    assert [asked[t] for t in ("users", "trips", "events")] == [{"in_place": True}] * 3
    left = [store.read(t).count() for t in ("users", "trips", "events")]
    assert left == [1, 10, 30]
