"""Operators against plain loops over random small tables, with missing parents,
null keys and one heavy key."""

import random

import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave.operators import changes, documents, graph, quality, relational


def random_key(chance, n, unknown=True):
    draw = chance.random()
    if draw < 0.33:
        return 0  # the heavy key
    if unknown and draw < 0.38:
        return None
    return chance.randrange(n + (3 if unknown else 0))


@pytest.fixture(params=range(3))
def case(request, spark):
    chance = random.Random(request.param)
    riders, places = range(8), range(6)
    journeys = [
        h.trip(i, random_key(chance, 8), random_key(chance, 6), random_key(chance, 6), i, chance.randrange(1, 300))
        for i in range(60)
    ]
    kinds = ["GPS", "ERROR", "BATTERY", "DELAY"]
    happened = [
        h.event(f"e{i:03d}", random_key(chance, 60), chance.choice(kinds), str(chance.randrange(100)))
        for i in range(150)
    ]
    frames = {
        "users": h.users(spark, *riders),
        "stations": h.stations(spark, *places),
        "trips": h.trips(spark, *journeys).repartition(5),
        "events": h.events(spark, *happened).repartition(5),
    }
    return chance, set(riders), set(places), journeys, happened, frames


def test_relational(case):
    _chance, riders, places, journeys, happened, t = case
    details = relational.trip_details(t["trips"], t["users"], t["stations"])
    kept = [j for j in journeys if j[1] in riders and j[2] in places and j[3] in places]
    assert sorted(r.trip_id for r in details.collect()) == [j[0] for j in kept]

    for row in relational.user_stats(t["trips"], t["users"]).collect():
        spans = [(j[5] - j[4]).total_seconds() / 60 for j in journeys if j[1] == row.user_id]
        assert row.num_trips == len(spans)
        assert row.avg_duration_minutes == (pytest.approx(sum(spans) / len(spans), abs=0.0051) if spans else None)

    for row in relational.station_counts(t["trips"], t["stations"]).collect():
        assert row.trips_starting == sum(j[2] == row.station_id for j in journeys)
        assert row.trips_ending == sum(j[3] == row.station_id for j in journeys)

    for kind in ("ERROR", "DELAY"):
        expected = sorted({e[1] for e in happened if e[3] == kind and e[1] is not None and e[1] < 60})
        for find in (relational.trips_with_event, relational.trips_with_event_distinct):
            assert sorted(r.trip_id for r in find(t["trips"], t["events"], kind).collect()) == expected


@pytest.mark.parametrize("part_rows", [10_000, 9])
def test_documents(case, part_rows):
    _chance, _riders, _places, journeys, happened, t = case
    docs = documents.embed_events(t["trips"], t["events"], part_rows).cache()
    found: dict = {j[0]: [] for j in journeys}
    for row in docs.collect():
        ids = [e.event_id for e in row.events]
        assert ids == sorted(ids)
        found[row.trip_id] += ids
    expected = {j[0]: sorted(e[0] for e in happened if e[1] == j[0]) for j in journeys}
    assert {k: sorted(v) for k, v in found.items()} == expected

    battery = {e[1] for e in happened if e[3] == "BATTERY" and e[1] in found}
    assert changes.modified_count(docs).first()[0] == len(battery)
    filled = documents.unwind_events(changes.backfill_battery_nested(docs))
    levels = {r.event_id: r.battery_level for r in filled.collect()}
    assert levels == {e[0]: int(e[4]) if e[3] == "BATTERY" else None for e in happened if e[1] in found}


def test_graph(case):
    _chance, riders, places, journeys, _happened, t = case
    expected = set()
    for j in journeys:
        if j[1] in riders and j[2] in places and j[3] in places:
            expected |= {
                (f"U:{j[1]}", f"T:{j[0]}", "PERFORMED"),
                (f"T:{j[0]}", f"S:{j[2]}", "STARTS_AT"),
                (f"T:{j[0]}", f"S:{j[3]}", "ENDS_AT"),
            }
    found = [tuple(r) for r in graph.edges(t["trips"], t["users"], t["stations"]).collect()]
    assert len(found) == len(expected) and set(found) == expected

    for user in (0, 3):
        visited = {s for j in journeys if j[1] == user and {j[2], j[3]} <= set(places) for s in (j[2], j[3])}
        rows = graph.reachable_stations(t["trips"], t["users"], t["stations"], user).collect()
        assert sorted(r.station_id for r in rows) == sorted(visited)


def test_checks(case):
    _chance, riders, places, journeys, happened, t = case
    counts = {r.rule: r.n_violations for r in quality.check_foreign_keys(t).collect()}
    keys = {j[0] for j in journeys}
    assert counts == {
        "trips.user_id.foreign_key": sum(j[1] is not None and j[1] not in riders for j in journeys),
        "trips.start_station.foreign_key": sum(j[2] is not None and j[2] not in places for j in journeys),
        "trips.end_station.foreign_key": sum(j[3] is not None and j[3] not in places for j in journeys),
        "events.trip_id.foreign_key": sum(e[1] is not None and e[1] not in keys for e in happened),
    }
    accepted, rejected = quality.split(t["trips"], "trips", t)
    good = [j[0] for j in journeys if j[1] in riders and j[2] in places and j[3] in places]
    assert sorted(r.trip_id for r in accepted.collect()) == good
    assert rejected.count() == len(journeys) - len(good)
    accepted, rejected = quality.split(t["events"], "events", t)
    assert sorted(r.event_id for r in accepted.collect()) == sorted(e[0] for e in happened if e[1] in keys)


def test_deletes(case):
    _chance, riders, _places, journeys, happened, t = case
    doomed = t["users"].where(F.col("user_id") < 3)
    left = changes.delete_cascade(t["users"], t["trips"], t["events"], doomed)
    gone = {j[0] for j in journeys if j[1] in (0, 1, 2)}
    assert sorted(r.user_id for r in left["users"].collect()) == sorted(riders - {0, 1, 2})
    assert sorted(r.trip_id for r in left["trips"].collect()) == [j[0] for j in journeys if j[0] not in gone]
    assert sorted(r.event_id for r in left["events"].collect()) == [e[0] for e in happened if e[1] not in gone]


def test_upserts(case, spark):
    chance = case[0]
    state = {i: (f"Station {i}", "Roma", 10) for i in range(6)}
    current = h.stations(spark, *range(6))
    for _ in range(2):
        batch = []
        for n in range(25):
            key = random_key(chance, 10, unknown=False)
            batch.append((key, chance.choice(["a", "b", None]), chance.choice([1, None]), n))
        for key, name, capacity, _n in batch:
            state[key] = (name, state.get(key, (None, None, None))[1], capacity)
        rows = spark.createDataFrame(batch, "station_id bigint, name string, capacity int, n int").repartition(4)
        current = changes.upsert(current, rows, "station_id", ["name", "capacity"], "n")
    assert {r.station_id: (r.name, r.city, r.capacity) for r in current.collect()} == state
    assert current.count() == len(state)
