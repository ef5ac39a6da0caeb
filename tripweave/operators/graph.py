"""The property graph of riders, trips and stations, and the station graph."""

from __future__ import annotations

import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.relational import station_counts
from tripweave.session import cut_lineage, fixed_plan, fresh_folder, small_side
from tripweave.sources.tables import read_table, write_table

# ---- Fixed values of the ranking -------------------------------------------
DAMPING = 0.85
ROUNDS = 20
# ----------------------------------------------------------------------------

# Rounds of a rank that go into one plan before its lineage is cut.
_ROUNDS_PER_PLAN = 10

# Rounds of the components whose moves go into one plan.
_MOVES_PER_PLAN = 3

# Links per partition of the rank, and links of one source that may lie together.
_LINKS_PER_PARTITION = 500_000
_LINKS_PER_PIECE = 1_000_000


def _node(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def vertices(users: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """All nodes with their label; properties of other labels are null."""
    parts = [
        users.select(_node("U:", "user_id").alias("id"), F.lit("USER").alias("label"), "name", "surname", "country"),
        trips.select(
            _node("T:", "trip_id").alias("id"),
            F.lit("TRIP").alias("label"),
            F.col("total_cost").cast("double").alias("total_cost"),
        ),
        stations.select(
            _node("S:", "station_id").alias("id"), F.lit("STATION").alias("label"), "name", "city", "capacity"
        ),
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.select("id", "label", "name", "surname", "country", "city", "capacity", "total_cost")


def connected_trips(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """The trips whose rider and both stations exist."""
    station = stations.select("station_id")
    return (
        trips.join(station.withColumnRenamed("station_id", "start_station"), "start_station", "left_semi")
        .join(station.withColumnRenamed("station_id", "end_station"), "end_station", "left_semi")
        .join(users.select("user_id"), "user_id", "left_semi")
        .select(trips.columns)
    )


def edges(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Typed edges (src, dst, type), each once.  A trip with a missing rider or
    station gets none.

    Edges are made distinct as pairs of plain keys, and only then get the names
    of their nodes, so the shuffle carries no text but the type.
    """

    def edge(src: str, dst: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.col(src).alias("src"), F.col(dst).alias("dst"))

    per_trip = F.array(
        edge("user_id", "trip_id", "PERFORMED"),
        edge("trip_id", "start_station", "STARTS_AT"),
        edge("trip_id", "end_station", "ENDS_AT"),
    )
    pairs = connected_trips(trips, users, stations).select(F.inline(per_trip)).distinct()
    performed = F.col("type") == "PERFORMED"
    return pairs.select(
        F.when(performed, _node("U:", "src")).otherwise(_node("T:", "src")).alias("src"),
        F.when(performed, _node("T:", "dst")).otherwise(_node("S:", "dst")).alias("dst"),
        "type",
    )


def station_edges(trips: DataFrame) -> DataFrame:
    """The station graph (src, dst, n_trips): parallel trips are one row."""
    return trips.groupBy(F.col("start_station").alias("src"), F.col("end_station").alias("dst")).agg(
        F.count("*").alias("n_trips")
    )


def out_degree(edges: DataFrame) -> DataFrame:
    """(src, out_degree): leaving trips per station, parallel ones counted."""
    return edges.where(F.col("src").isNotNull()).groupBy("src").agg(F.sum("n_trips").alias("out_degree"))


def vertices_of(vertices: DataFrame, *labels: str) -> DataFrame:
    """The nodes with one of the labels."""
    return vertices.where(F.col("label").isin(*labels))


def edges_of(edges: DataFrame, *types: str) -> DataFrame:
    """The edges with one of the types."""
    return edges.where(F.col("type").isin(*types))


def paths(
    edges: DataFrame, vertices: DataFrame, labels: list[str], types: list[tuple[str, ...]], start: object = None
) -> DataFrame:
    """All directed paths over the property graph: (n0, type0, n1, type1, n2, ...), one row for each.

    ``labels`` names the label of every node of the path, ``types`` for every step the edge types
    that may be taken; ``start`` fixes the first node.  Each step is an equi-join on the node that the
    path has reached, on edges of the wanted types only.
    """
    if len(labels) != len(types) + 1:
        raise ValueError("a path has one node more than it has steps")
    found = vertices_of(vertices, labels[0]).select(F.col("id").alias("n0"))
    if start is not None:
        found = found.where(F.col("n0") == F.lit(start))
    for i, (label, kinds) in enumerate(zip(labels[1:], types, strict=True)):
        here, there = f"n{i}", f"n{i + 1}"
        step = edges_of(edges, *kinds).select(F.col("src").alias(here), F.col("type").alias(f"type{i}"), F.col("dst").alias(there))
        ends = vertices_of(vertices, label).select(F.col("id").alias(there))
        found = found.join(step, here).join(ends, there, "left_semi")
    return found.select(*[c for i in range(len(types)) for c in (f"n{i}", f"type{i}")], f"n{len(types)}")


RIDER_TO_STATION = (["USER", "TRIP", "STATION"], [("PERFORMED",), ("STARTS_AT", "ENDS_AT")])


def path_stations(edges: DataFrame, vertices: DataFrame, rider: str) -> DataFrame:
    """(id, name, city) of the stations that paths from one rider's node lead to."""
    reached = paths(edges, vertices, *RIDER_TO_STATION, start=rider).select(F.col("n2").alias("id"))
    return vertices_of(vertices, "STATION").join(reached, "id", "left_semi").select("id", "name", "city")


def _stations_of(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct stations at either end of the given trips."""
    ends = trips.select(F.explode(F.array("start_station", "end_station")).alias("station_id")).distinct()
    return ends.join(stations, "station_id")


def reachable_stations(trips: DataFrame, users: DataFrame, stations: DataFrame, user_id: object) -> DataFrame:
    """The stations at either end of any trip of one rider.  As in all questions on the graph, a trip
    with a missing rider or station has no edges and does not count."""
    own = connected_trips(trips.where(F.col("user_id") == F.lit(user_id)), users, stations)
    return _stations_of(own, stations).select("station_id", F.col("name").alias("station_name"), "city")


def first_user_stations(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """The same for one rider who has a trip: the one with the smallest key."""
    connected = connected_trips(trips, users, stations)
    first = connected.agg(F.min("user_id").alias("user_id"))
    visited = _stations_of(connected.join(first, "user_id", "left_semi"), stations)
    return visited.select(F.col("station_id").alias("sid"), "name")


def station_degrees(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Leaving, arriving and total trips of every station; a round trip adds two."""
    return station_counts(connected_trips(trips, users, stations), stations).select(
        "station_id",
        F.col("name").alias("station_name"),
        "city",
        F.col("trips_starting").alias("outgoing_trips"),
        F.col("trips_ending").alias("incoming_trips"),
        (F.col("trips_starting") + F.col("trips_ending")).alias("total_trips"),
    )


def top_stations(trips: DataFrame, users: DataFrame, stations: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest stations; the smaller key wins a tie."""
    return station_degrees(trips, users, stations).orderBy(F.col("total_trips").desc(), "station_id").limit(k)


def pagerank(
    edges: DataFrame, stations: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """(station_id, name, rank) after a fixed number of rounds.

    A station shares its rank among its leaving trips.  The share of a trip to
    an unknown station is lost, and so is all of a station that no trip leaves;
    ranks are not scaled back to one.

    ``edges`` holds distinct station pairs, so a round costs the number of pairs
    and not that of trips.  They are weighted, partitioned by source and stored
    once.  A round joins them with the ranks, adds up per target before the
    shuffle, and leaves the new ranks partitioned like the edges, so neither
    side of the next join moves.  Every station has an edge of weight zero to
    itself, which keeps stations without arrivals among the targets.

    A source with more than ``_LINKS_PER_PIECE`` targets, which only a graph with
    more stations than that can have, is cut into pieces, and its rank goes to
    each of them.
    """
    nodes = stations.select(F.col("station_id").alias("id"))
    n = nodes.count()
    if n == 0:
        return stations.select("station_id", "name", F.lit(0.0).alias("rank"))

    base = (1.0 - damping) / n
    edges = cut_lineage(edges)  # used twice below; the trips are read once
    known = (
        edges.join(out_degree(edges), "src")
        .select("src", "dst", (F.col("n_trips") / F.col("out_degree")).alias("weight"))
        .join(nodes.withColumnRenamed("id", "dst"), "dst", "left_semi")
        .join(nodes.withColumnRenamed("id", "src"), "src", "left_semi")
        .select("src", "dst", "weight")
    )
    own = nodes.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("weight"))
    links = known.unionByName(own)
    key, heavy = ["src"], None
    if n > _LINKS_PER_PIECE:
        many = links.groupBy("src").agg(F.ceil(F.count("*") / _LINKS_PER_PIECE).cast("int").alias("pieces"))
        heavy, n_heavy = small_side(many.where(F.col("pieces") > 1))
        if n_heavy:
            key = ["src", "piece"]
            piece = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("pieces")).cast("int"), F.lit(0))
            links = links.join(heavy, "src", "left").select("src", piece.alias("piece"), "dst", "weight")

    # As many partitions as the links need, whatever the session is set up for, and
    # fixed, so that the links stay aligned with the ranks of each round.  A lost
    # block of the cache is rebuilt from the checkpoint.
    partitions = math.ceil((edges.count() + n) / _LINKS_PER_PARTITION)
    links = links.repartition(partitions, *key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        links.count()  # fills the cache; a plan knows its partitioning only from then on
        ranks = nodes.select(F.col("id").alias("src"), F.lit(1.0 / n).alias("rank"))
        with fixed_plan(stations.sparkSession, partitions):
            for i in range(1, rounds + 1):
                if "piece" in key:
                    pieces = F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)
                    ranks = ranks.join(heavy, "src", "left").select("src", F.explode(pieces).alias("piece"), "rank")
                share = F.sum(F.col("rank") * F.col("weight"))
                # Links and ranks lie together: hash the few ranks of a partition.
                shares = links.join(ranks.hint("shuffle_hash"), key).groupBy(F.col("dst").alias("src"))
                ranks = shares.agg((F.lit(base) + F.lit(damping) * share).alias("rank"))
                if i % _ROUNDS_PER_PLAN == 0 or i == rounds:
                    ranks = cut_lineage(ranks)
    finally:
        links.unpersist()
    return stations.select("station_id", "name").join(ranks.withColumnRenamed("src", "station_id"), "station_id")


def top_ranked(ranked: DataFrame, k: int = 3, digits: int = 8) -> DataFrame:
    """The ``k`` best ranks.  Ranks are compared rounded, since the last bits of
    a distributed sum depend on its order; the smaller key wins a tie."""
    rounded = ranked.withColumn("rank", F.round("rank", digits))
    return rounded.orderBy(F.col("rank").desc(), "station_id").limit(k)


def undirected_pairs(edges: DataFrame, stations: DataFrame, number: str = "station_id") -> DataFrame:
    """Distinct (a, b) with a < b of linked, known, different stations, each named by its column ``number``."""
    known = stations.select("station_id", F.col(number).alias("number")).dropDuplicates(["station_id"])
    ends = [known.select(F.col("station_id").alias(c), F.col("number").alias(f"{c}_number")) for c in ("src", "dst")]
    a, b = F.col("src_number"), F.col("dst_number")
    linked = edges.where(F.col("src") != F.col("dst")).select("src", "dst").join(ends[0], "src").join(ends[1], "dst")
    return linked.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from files.

    Not by a checkpoint: that keeps the size that was estimated for it, for a join the product of its sides.  Round
    on round the numbers get millions of digits, and planning takes longer than the work.  Files have a real size.
    """
    folder = fresh_folder(df.sparkSession, "graph")
    write_table(df, folder)
    return read_table(df.sparkSession, folder, df.schema)


def _numbered(stations: DataFrame) -> DataFrame:
    """(station_id, number, rows): every different key with a number, stored.  Numbers ascend with the keys,
    since they follow the ranges that the keys are dealt into and their order in each."""
    spread = stations.select("station_id").repartitionByRange("station_id")
    keys = spread.groupBy("station_id").agg(F.count("*").alias("rows")).sortWithinPartitions("station_id")
    return _stored(keys.select("station_id", F.monotonically_increasing_id().alias("number"), "rows"))


def connected_components(edges: DataFrame, stations: DataFrame) -> DataFrame:
    """(station_id, component): the smallest station key that can be reached,
    ignoring directions.  Unknown stations do not connect their neighbours.

    Works by contraction.  In each round every station that still has a link
    moves to the one of itself and its neighbours that is first in an order
    drawn anew for the round; links between stations that moved together vanish
    and the rest are made distinct again.  A constant share of the stations
    disappears per round on average, so a long path needs logarithmically many
    rounds, and the work of all rounds together is a small multiple of the
    first.  There is no limit on rounds: in every round each linked group loses
    at least one station.

    Keys are numbered in their order first, so the rounds move pairs of integers, whatever the keys are.  Each
    round stores its moves; they are followed from the last round back, so every round is joined with
    its own stations only.
    """
    nodes = _numbered(stations)
    pairs = _stored(undirected_pairs(edges, nodes, "number"))
    moves = []
    while not pairs.isEmpty():
        move = _stored(_moves(pairs, len(moves)))
        moves.append(move)
        to_a = move.select("a", F.col("root").alias("ra"))
        to_b = move.select(F.col("a").alias("b"), F.col("root").alias("rb"))
        moved = pairs.join(to_a, "a").join(to_b, "b").where(F.col("ra") != F.col("rb"))
        pairs = _stored(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if not moves:
        return stations.select("station_id", F.col("station_id").alias("component"))
    roots = moves.pop()
    for i, move in enumerate(reversed(moves), 1):
        further = roots.select(F.col("a").alias("root"), F.col("root").alias("last"))
        roots = move.join(further, "root", "left").select("a", F.coalesce("last", "root").alias("root"))
        if i % _MOVES_PER_PLAN == 0:
            roots = _stored(roots)
    roots = _stored(roots)  # used twice below
    # The least number is that of the least key.
    smallest = roots.groupBy("root").agg(F.min("a").alias("number"))
    names = smallest.join(nodes, "number").select("root", F.col("station_id").alias("found"))
    found = nodes.join(roots.join(names, "root").select(F.col("a").alias("number"), "found"), "number", "left")
    found = found.select("station_id", F.coalesce("found", "station_id").alias("component"))
    if nodes.where(F.col("rows") > 1).isEmpty():
        return found
    return stations.select("station_id").join(found, F.equal_null(stations["station_id"], found["station_id"])).select(stations["station_id"], "component")


def merged_components(labels: DataFrame, edges: DataFrame, stations: DataFrame) -> DataFrame:
    """(station_id, component) after ``edges`` were added to the graph that ``labels`` came from, and
    ``stations`` to its stations; the edges of that graph are not read again.

    The new edges are contracted to links between stored components, which join; all other components
    keep their label.  The result is the same as that of the whole graph at once.
    """
    new = stations.select("station_id").distinct().join(labels.select("station_id"), "station_id", "left_anti")
    known = labels.select("station_id", "component").unionByName(new.withColumn("component", F.col("station_id")))
    ends = [known.select(F.col("station_id").alias(c), F.col("component").alias(f"{c}_root")) for c in ("src", "dst")]
    linked = edges.where(F.col("src") != F.col("dst")).select("src", "dst").join(ends[0], "src").join(ends[1], "dst")
    linked = linked.where(F.col("src_root") != F.col("dst_root")).select(F.col("src_root").alias("src"), F.col("dst_root").alias("dst"))
    linked = _stored(linked.distinct())
    touched = linked.select(F.explode(F.array("src", "dst")).alias("station_id")).distinct()
    moved = connected_components(linked, touched).where(F.col("station_id") != F.col("component"))
    moved, _n = small_side(moved.select(F.col("station_id").alias("component"), F.col("component").alias("joined")))
    return known.join(moved, "component", "left").select("station_id", F.coalesce("joined", "component").alias("component"))


def _moves(pairs: DataFrame, rounds: int) -> DataFrame:
    """(a, root): where each linked station moves in this round, from the stored pairs alone."""
    seed = F.lit(rounds)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", seed)).alias("b"))
    stays = F.xxhash64("a", seed) <= F.xxhash64("b", seed)
    return nearest.select("a", F.when(stays, F.col("a")).otherwise(F.col("b")).alias("root"))


def component_sizes(components: DataFrame, stations: DataFrame) -> DataFrame:
    """(component, root_name, size), largest first, the smaller key on a tie."""
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    names = stations.select(F.col("station_id").alias("component"), F.col("name").alias("root_name"))
    return (
        sizes.join(names, "component", "left")
        .select("component", "root_name", "size")
        .orderBy(F.col("size").desc(), "component")
    )


def component_count(components: DataFrame) -> DataFrame:
    """(num_components), zero for an empty graph."""
    return components.where(F.col("station_id") == F.col("component")).agg(F.count("*").alias("num_components"))

