import random

import helpers as h
import pytest
from pyspark.sql import functions as F

from tripweave.operators import graph, relational


def plain_pagerank(pairs, nodes, damping=0.85, rounds=20):
    """The same definition, on small dictionaries."""
    n, degree = len(nodes), {}
    for src, _dst in pairs:
        degree[src] = degree.get(src, 0) + 1
    rank = dict.fromkeys(nodes, 1 / n)
    for _ in range(rounds):
        after = dict.fromkeys(nodes, (1 - damping) / n)
        for src, dst in pairs:
            if src in rank and dst in after:
                after[dst] += damping * rank[src] / degree[src]
        rank = after
    return rank


def plain_components(pairs, nodes):
    parent = {v: v for v in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        if a in parent and b in parent:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {v: root(v) for v in nodes}


def edges_of(spark, pairs):
    return (
        spark.createDataFrame(list(pairs), "src bigint, dst bigint")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n_trips"))
    )


def labels_of(df):
    return {r.station_id: r.component for r in df.collect()}


# 1 -> 2 twice, 1 -> 3, 3 -> 3, 2 -> 9 where 9 is unknown, 4 alone
FIXTURE = [(1, 2), (1, 2), (1, 3), (3, 3), (2, 9), (9, 1)]


def test_rank_of_multiple_edges_loops_and_lost_shares(spark):
    ranked = graph.pagerank(edges_of(spark, FIXTURE), h.stations(spark, 1, 2, 3, 4))
    found = {r.station_id: r["rank"] for r in ranked.collect()}
    assert found == pytest.approx(plain_pagerank(FIXTURE, [1, 2, 3, 4]))
    assert sum(found.values()) < 1
    assert found[1] == pytest.approx(0.15 / 4)  # the unknown source gives nothing


def test_rank_counts_trips_that_end_nowhere(spark):
    """A trip without an end takes its share with it; one without a start gives none."""
    pairs = [(1, 2), (1, None), (2, 1), (None, 2)]
    ranked = graph.pagerank(edges_of(spark, pairs), h.stations(spark, 1, 2))
    found = {r.station_id: r["rank"] for r in ranked.collect()}
    assert found == pytest.approx(plain_pagerank(pairs, [1, 2]))
    assert labels_of(graph.connected_components(edges_of(spark, pairs), h.stations(spark, 1, 2))) == {1: 1, 2: 1}


def test_rank_on_random_graphs(spark):
    chance = random.Random(5)
    for n_nodes, n_edges in ((12, 30), (40, 60)):
        pairs = [(chance.randrange(n_nodes + 3), chance.randrange(n_nodes + 3)) for _ in range(n_edges)]
        ranked = graph.pagerank(edges_of(spark, pairs), h.stations(spark, *range(n_nodes)))
        found = {r.station_id: r["rank"] for r in ranked.collect()}
        assert found == pytest.approx(plain_pagerank(pairs, list(range(n_nodes))))


def test_rank_with_heavy_sources_in_pieces(spark, monkeypatch):
    """Stations 0 and 1 have links to everywhere; a third of all links are theirs."""
    chance = random.Random(6)
    nodes = list(range(60))
    pairs = [(hub, dst) for hub in (0, 1) for dst in nodes]
    pairs += [(chance.randrange(63), chance.randrange(63)) for _ in range(240)]
    expected = plain_pagerank(pairs, nodes)
    for bound in (7, 50):
        monkeypatch.setattr(graph, "_LINKS_PER_PIECE", bound)
        ranked = graph.pagerank(edges_of(spark, pairs), h.stations(spark, *nodes))
        assert {r.station_id: r["rank"] for r in ranked.collect()} == pytest.approx(expected)
    monkeypatch.setattr(graph, "small_side", lambda keys: (keys, keys.count()))
    ranked = graph.pagerank(edges_of(spark, pairs), h.stations(spark, *nodes))
    assert {r.station_id: r["rank"] for r in ranked.collect()} == pytest.approx(expected)


def test_rank_sums_to_one_without_sinks(spark):
    ranked = graph.pagerank(edges_of(spark, [(1, 2), (2, 3), (3, 1), (1, 3)]), h.stations(spark, 1, 2, 3))
    assert ranked.agg(F.sum("rank")).first()[0] == pytest.approx(1.0)


def test_zero_rounds_and_other_damping(spark):
    places = h.stations(spark, 1, 2)
    start = graph.pagerank(edges_of(spark, [(1, 2)]), places, rounds=0)
    assert h.rows(start.select("station_id", "rank")) == [(1, 0.5), (2, 0.5)]
    ranked = graph.pagerank(edges_of(spark, [(1, 2)]), places, damping=0.5, rounds=7)
    assert {r.station_id: r["rank"] for r in ranked.collect()} == pytest.approx(
        plain_pagerank([(1, 2)], [1, 2], 0.5, 7)
    )


def test_best_ranks_break_ties_by_key(spark):
    ranked = graph.pagerank(edges_of(spark, [(1, 2), (2, 1), (3, 4), (4, 3)]), h.stations(spark, 4, 3, 2, 1))
    assert [r.station_id for r in graph.top_ranked(ranked).collect()] == [1, 2, 3]


def test_unknown_stations_do_not_bridge(spark):
    found = graph.connected_components(edges_of(spark, FIXTURE), h.stations(spark, 1, 2, 3, 4))
    assert labels_of(found) == {1: 1, 2: 1, 3: 1, 4: 4}
    found = graph.connected_components(edges_of(spark, [(5, 9), (9, 6)]), h.stations(spark, 5, 6))
    assert labels_of(found) == {5: 5, 6: 6}


def test_a_path_longer_than_a_hundred_rounds(spark):
    chance = random.Random(1)
    for names in (list(range(300)), chance.sample(range(10_000), 300)):
        pairs = list(zip(names, names[1:], strict=False))
        found = labels_of(graph.connected_components(edges_of(spark, pairs), h.stations(spark, *names)))
        assert found == dict.fromkeys(names, min(names))


def test_components_of_random_graphs(spark):
    chance = random.Random(7)
    for n_nodes, n_edges in ((30, 20), (200, 120), (60, 200)):
        pairs = [(chance.randrange(n_nodes + 5), chance.randrange(n_nodes + 5)) for _ in range(n_edges)]
        nodes = list(range(n_nodes))
        found = graph.connected_components(edges_of(spark, pairs), h.stations(spark, *nodes)).cache()
        expected = plain_components(pairs, nodes)
        assert labels_of(found) == expected
        assert graph.component_count(found).first()[0] == len(set(expected.values()))


def test_components_of_a_star(spark):
    """One station that is part of every link."""
    pairs = [(500, i) for i in range(500)] + [(600, 601)]
    nodes = list(range(501)) + [600, 601]
    found = graph.connected_components(edges_of(spark, pairs), h.stations(spark, *nodes)).cache()
    assert labels_of(found) == dict.fromkeys(range(501), 0) | {600: 600, 601: 600}
    sizes = graph.component_sizes(found, h.stations(spark, *nodes))
    assert [tuple(r) for r in sizes.collect()] == [(0, "Station 0", 501), (600, "Station 600", 2)]


def test_components_of_text_keys_compare_as_text(spark):
    places = spark.createDataFrame([("10", "a"), ("9", "b"), ("8", "c")], "station_id string, name string")
    links = spark.createDataFrame([("9", "10", 1)], "src string, dst string, n_trips bigint")
    assert labels_of(graph.connected_components(links, places)) == {"10": "10", "9": "10", "8": "8"}


def test_rounds_of_components_move_numbers_of_known_size(spark, monkeypatch):
    """Text keys stay out of the rounds, and no round inherits the size that was estimated for the joins before it."""
    seen, moves = [], graph._moves

    def sized(pairs, rounds):
        seen.append((dict(pairs.dtypes), int(str(pairs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))))
        return moves(pairs, rounds)

    monkeypatch.setattr(graph, "_moves", sized)
    names = [f"T:{i}" for i in range(60)]
    places = spark.createDataFrame([(n,) for n in names], "station_id string")
    links = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "src string, dst string")
    assert labels_of(graph.connected_components(links, places)) == dict.fromkeys(names, "T:0")
    assert len(seen) > 1
    assert all(types == {"a": "bigint", "b": "bigint"} and size < 1 << 20 for types, size in seen)


def test_components_of_repeated_and_missing_keys(spark):
    """Each row of the stations keeps its row, and a missing key is linked to nothing."""
    places = spark.createDataFrame([("b",), ("b",), ("a",), (None,), (None,), ("c",)], "station_id string")
    links = spark.createDataFrame([("b", "a"), (None, "c"), ("c", "z"), ("z", "a")], "src string, dst string")
    found = h.rows(graph.connected_components(links, places))
    assert found == [("a", "a"), ("b", "a"), ("b", "a"), ("c", "c"), (None, None), (None, None)]


def test_empty_graph(spark):
    nothing, nowhere = edges_of(spark, []), h.stations(spark)
    assert graph.pagerank(nothing, nowhere).collect() == []
    found = graph.connected_components(nothing, nowhere)
    assert found.collect() == []
    assert graph.component_count(found).first()[0] == 0
    assert graph.component_sizes(found, nowhere).collect() == []
    assert graph.top_stations(h.trips(spark), h.users(spark), nowhere).collect() == []
    assert graph.reachable_stations(h.trips(spark), h.users(spark), nowhere, 1).collect() == []
    assert graph.edges(h.trips(spark), h.users(spark), nowhere).collect() == []
    assert graph.vertices(h.users(spark), h.trips(spark), nowhere).collect() == []


def test_edges_need_all_three_ends_and_are_unique(spark):
    journeys = h.trips(
        spark,
        h.trip(1, 1, 10, 20),
        h.trip(1, 1, 10, 20),
        h.trip(2, 1, 10, 10),
        h.trip(3, 9, 10, 20),
        h.trip(4, 1, 10, 99),
        h.trip(5, 1, None, 20),
    )
    found = h.rows(graph.edges(journeys, h.users(spark, 1), h.stations(spark, 10, 20)))
    assert found == [
        ("T:1", "S:10", "STARTS_AT"),
        ("T:1", "S:20", "ENDS_AT"),
        ("T:2", "S:10", "ENDS_AT"),
        ("T:2", "S:10", "STARTS_AT"),
        ("U:1", "T:1", "PERFORMED"),
        ("U:1", "T:2", "PERFORMED"),
    ]


def test_a_round_trip_is_one_reachable_station(spark):
    journeys = h.trips(spark, h.trip(1, 1, 10, 10), h.trip(2, 1, 10, 20), h.trip(3, 2, 30, 30))
    places = h.stations(spark, 10, 20, 30)
    assert [r[0] for r in h.rows(graph.reachable_stations(journeys, h.users(spark, 1, 2), places, 1))] == [10, 20]
    assert [r[0] for r in h.rows(graph.first_user_stations(journeys, h.users(spark, 1, 2), places))] == [10, 20]


def test_degrees_agree_with_station_counts(small):
    degrees = graph.station_degrees(small["trips"], small["users"], small["stations"])
    total = degrees.agg(F.sum("total_trips")).first()[0]
    assert total == 2 * small["trips"].count()
    counts = relational.station_counts(small["trips"], small["stations"])
    assert h.rows(degrees.select("station_id", "outgoing_trips", "incoming_trips")) == h.rows(
        counts.select("station_id", "trips_starting", "trips_ending")
    )


def test_graph_has_three_edges_per_accepted_trip(small):
    made = graph.edges(small["trips"], small["users"], small["stations"])
    assert made.count() == 3 * small["trips"].count()


def test_trips_with_a_missing_end_do_not_count(spark):
    riders, places = h.users(spark, 1), h.stations(spark, 10, 20)
    journeys = h.trips(spark, h.trip(1, 1, 10, 99), h.trip(2, 1, 20, 20), h.trip(3, 0, 10, 20))
    assert [r.station_id for r in graph.reachable_stations(journeys, riders, places, 1).collect()] == [20]
    assert [r.sid for r in graph.first_user_stations(journeys, riders, places).collect()] == [20]
    degrees = graph.station_degrees(journeys, riders, places)
    assert h.rows(degrees.select("station_id", "outgoing_trips", "incoming_trips", "total_trips")) == [(10, 0, 0, 0), (20, 1, 1, 2)]
    links, nodes = graph.edges(journeys, riders, places), graph.vertices(riders, journeys, places)
    assert [r.id for r in graph.path_stations(links, nodes, "U:1").collect()] == ["S:20"]


def test_paths_follow_labels_and_types(spark):
    riders, places = h.users(spark, 1, 2), h.stations(spark, 10, 20, 30)
    journeys = h.trips(spark, h.trip(1, 1, 10, 20), h.trip(2, 1, 10, 10), h.trip(3, 2, 30, 20))
    links, nodes = graph.edges(journeys, riders, places), graph.vertices(riders, journeys, places)
    found = h.rows(graph.paths(links, nodes, *graph.RIDER_TO_STATION, start="U:1"))
    assert found == [
        ("U:1", "PERFORMED", "T:1", "ENDS_AT", "S:20"),
        ("U:1", "PERFORMED", "T:1", "STARTS_AT", "S:10"),
        ("U:1", "PERFORMED", "T:2", "ENDS_AT", "S:10"),
        ("U:1", "PERFORMED", "T:2", "STARTS_AT", "S:10"),
    ]
    ends = graph.paths(links, nodes, ["TRIP", "STATION"], [("ENDS_AT",)])
    assert h.rows(ends.select("n0", "n1")) == [("T:1", "S:20"), ("T:2", "S:10"), ("T:3", "S:20")]
    assert graph.paths(links, nodes, ["USER", "STATION"], [("PERFORMED",)]).collect() == []
    with pytest.raises(ValueError):
        graph.paths(links, nodes, ["USER"], [("PERFORMED",)])
