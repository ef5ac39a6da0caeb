"""Time the headline queries and print one line of JSON.

As in the published numbers, loading is not part of a query's time: the star
schema is first written as the four mobility tables and the trip documents, and
the queries run on those files.  The load time is reported on its own.  A query
runs to its full result, which goes to Spark's no-op sink; reported is the median
of ``BENCH_RUNS`` runs, and next to it the first run, which compiles its code.

    BENCH_SF_DIR  star-schema folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    runs per query (default 3)
    BENCH_POINT   users,trips,events per trip: bench generated tables of this
                  size instead, for instance 50000,100000,10
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators import changes, documents, graph, quality, relational, stored, synth
from tripweave.plans.registry import REACHABLE_FROM
from tripweave.session import build_session, fresh_folder
from tripweave.sources.star_view import star_schema_view
from tripweave.sources.store import Snapshot, Store
from tripweave.sources.tables import load_tables, save_tables, write_table

Tables = dict[str, DataFrame]


def load(spark: SparkSession, sf_dir: str, point: str) -> Tables:
    folder = fresh_folder(spark, "bench")
    if point:
        view = synth.tables(spark, *[int(n) for n in point.split(",")])
    else:
        view = star_schema_view(spark, sf_dir)
    save_tables({name: view[name] for name in ("users", "stations", "trips", "events")}, folder)
    tables = load_tables(spark, folder)
    write_table(documents.embed_events(tables["trips"], tables["events"]), f"{folder}/trip_documents")
    store = Store(spark, f"{folder}/store", stored.layouts(16))
    store.create({name: tables[name] for name in ("users", "stations", "trips")})
    return tables | {"docs": spark.read.parquet(f"{folder}/trip_documents"), "stored": store.snapshot()}


def pagerank(t: Tables) -> DataFrame:
    return graph.top_ranked(graph.pagerank(graph.station_edges(t["trips"]), t["stations"]))


def components(t: Tables) -> DataFrame:
    found = graph.connected_components(graph.station_edges(t["trips"]), t["stations"])
    return graph.component_sizes(found, t["stations"])


def one_rider(now: Snapshot) -> DataFrame:
    """One rider's question on the stored layout: the rider's bucket of each table."""
    trips, users = (now.lookup(name, user_id=REACHABLE_FROM) for name in ("trips", "users"))
    return graph.reachable_stations(trips, users, now.read("stations"), REACHABLE_FROM)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "q1_trip_details": lambda t: relational.trip_details(t["trips"], t["users"], t["stations"]),
    "q2_user_stats": lambda t: relational.user_stats(t["trips"], t["users"]),
    "q3_station_counts": lambda t: relational.station_counts(t["trips"], t["stations"]),
    "q4_error_trips": lambda t: relational.trips_with_event(t["trips"], t["events"]),
    "q1_trip_documents": lambda t: documents.trip_documents_report(t["docs"], t["users"], t["stations"]),
    "q2_user_stats_zero": lambda t: relational.user_stats(t["trips"], t["users"], empty="zero"),
    "q3_active_station_counts": lambda t: documents.active_station_counts(t["docs"], t["stations"]),
    "q4_error_trips_embedded": lambda t: documents.trips_with_embedded_event(t["docs"]),
    "graph_reachable_stations": lambda t: graph.reachable_stations(t["trips"], t["users"], t["stations"], REACHABLE_FROM),
    "stored_reachable_stations": lambda t: one_rider(t["stored"]),
    "graph_top_stations": lambda t: graph.top_stations(t["trips"], t["users"], t["stations"]),
    "graph_pagerank_top3": pagerank,
    "graph_component_sizes": components,
    "q2_user_stats_nested": lambda t: documents.user_stats_nested(t["users"], t["trips"]),
    "doc_lookup_user_trips": lambda t: documents.lookup(
        t["users"].select("user_id"),
        t["trips"].select("trip_id", F.col("user_id").alias("rider"), "total_cost"),
        "user_id",
        "rider",
        "trips",
        "trip_id",
    ),
    "trips_rejected": lambda t: quality.split(t["trips"], "trips", t)[1],
    "check_summary": lambda t: quality.check_summary({n: t[n] for n in ("users", "stations", "trips", "events")}),
    "check_rows": lambda t: quality.check_rows({n: t[n] for n in ("users", "stations", "trips", "events")}),
    "evolve_backfill_table": lambda t: changes.backfill_battery(t["events"]),
    "evolve_backfill_nested": lambda t: changes.backfill_battery_nested(t["docs"]),
}


def run(query: Callable[[Tables], DataFrame], tables: Tables) -> float:
    start = time.perf_counter()
    query(tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    point = os.environ.get("BENCH_POINT", "")
    tables = load(spark, sf_dir, point)
    loaded = time.perf_counter() - start

    times = {name: [run(query, tables) for _ in range(runs)] for name, query in QUERIES.items()}
    medians = {name: round(statistics.median(t), 4) for name, t in times.items()}
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": point or (float(scale.group(1)) if scale else sf_dir),
                "first_run": {name: round(t[0], 4) for name, t in times.items()},
                "load_sec": round(loaded, 4),
                "trips": tables["trips"].count(),
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
