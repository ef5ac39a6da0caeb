"""Write generated tables, or trip documents with embedded events, to a folder.

    python tools/generate.py --users 1000 --trips 10000 --events 2 --target both --out /data/made
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.operators import documents, synth  # noqa: E402
from tripweave.session import build_session  # noqa: E402
from tripweave.sources.tables import save_tables, write_table  # noqa: E402


def options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--users", type=int, default=1000)
    parser.add_argument("--trips", type=int, default=10_000)
    parser.add_argument("--events", type=int, default=2, help="events per trip")
    parser.add_argument("--target", choices=["tables", "documents", "both"], default="both")
    parser.add_argument("--seed", type=int, default=1)
    parser.add_argument("--format", choices=["parquet", "json"], default="parquet")
    parser.add_argument("--out", required=True)
    return parser.parse_args(arguments)


def generate(spark: SparkSession, chosen: argparse.Namespace) -> None:
    """Tables have events at any time of the year; documents have them within a
    day of the start of their trip."""
    made = synth.tables(spark, chosen.users, chosen.trips, chosen.events, chosen.seed)
    if chosen.target in ("tables", "both"):
        save_tables(made, f"{chosen.out}/tables", chosen.format)
    if chosen.target in ("documents", "both"):
        events = synth.events(made["trips"], chosen.events, chosen.seed, event_time="trip")
        docs = documents.embed_events(made["trips"], events)
        save_tables({n: made[n] for n in ("users", "stations")}, f"{chosen.out}/documents", chosen.format)
        write_table(docs, f"{chosen.out}/documents/trips", chosen.format, mode="overwrite")


if __name__ == "__main__":
    generate(build_session("generate"), options())
