"""Hand-made tables and small conveniences."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tripweave import model

DAY = dt.datetime(2023, 5, 1)


def at(minutes: float) -> dt.datetime:
    return DAY + dt.timedelta(minutes=minutes)


def frame(spark, table: str, rows: list[tuple]):
    schema = model.SCHEMAS[table]
    # Nullable here, so that fixtures can break the rules.
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(rows, loose)


def trip(trip_id, user_id, start, end, begin=0, minutes=10.0, cost="1.00"):
    return (trip_id, user_id, start, end, at(begin), at(begin + minutes), Decimal(cost))


def event(event_id, trip_id, kind, value, minute=1):
    return (event_id, trip_id, at(minute), kind, value)


def users(spark, *ids):
    return frame(spark, "users", [(i, f"N{i}", f"S{i}", dt.date(1990, 1, 1), "Italy") for i in ids])


def stations(spark, *ids):
    return frame(spark, "stations", [(i, f"Station {i}", "Roma", 10) for i in ids])


def trips(spark, *rows):
    return frame(spark, "trips", list(rows))


def events(spark, *rows):
    return frame(spark, "events", list(rows))


def station_edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src bigint, dst bigint, n_trips bigint")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def without_cached_plans(plan: str) -> str:
    """The plan without what once filled the caches it reads."""
    kept, depth = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and indent > depth:
            continue
        depth = indent if "InMemoryRelation" in line else None
        kept.append(line)
    return "\n".join(kept)


def counts(df) -> dict:
    """Rule -> number of violations, without the zeros."""
    return {r[0]: r[1] for r in df.collect() if r[1]}
