"""The relational questions: trip details, rider statistics, station counts and
trips with a given event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.expressions import mean_minutes, minutes_and_micros, null_as


def trip_details(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip with its rider and the names of its two stations.

    Three equi-joins.  Stations are normally small enough to be broadcast by
    size; riders may not be, and the shuffle on riders is the one where a heavy
    rider shows, which adaptive skew handling splits.
    """
    riders = users.select(
        "user_id",
        F.col("name").alias("user_name"),
        F.col("surname").alias("user_surname"),
        "birthdate",
        "country",
    )

    def names(role: str) -> DataFrame:
        return stations.select(F.col("station_id").alias(f"{role}_id"), F.col("name").alias(f"{role}_name"))

    return (
        trips.join(names("start"), F.col("start_station") == F.col("start_id"))
        .join(names("end"), F.col("end_station") == F.col("end_id"))
        .join(riders, "user_id")
        .select(
            "trip_id",
            "user_id",
            "user_name",
            "user_surname",
            "birthdate",
            "country",
            F.col("start_name").alias("start_station"),
            F.col("end_name").alias("end_station"),
            "start_time",
            "end_time",
            "total_cost",
        )
    )


def trip_durations(trips: DataFrame) -> DataFrame:
    """(user_id, minutes, micros): all that rider statistics need of a trip."""
    minutes, micros = minutes_and_micros("start_time", "end_time")
    return trips.select("user_id", minutes.alias("minutes"), micros.alias("micros"))


def user_state(durations: DataFrame) -> DataFrame:
    """(user_id, num_trips, known, minutes, micros): counts and exact sums of the riders in ``durations``.

    Unknown durations count as trips but not in the sums.  States of different trips may be
    stored, and merged by :func:`merged`.
    """
    known = durations.where(F.col("user_id").isNotNull()).groupBy("user_id")
    return known.agg(F.count("*").alias("num_trips"), F.count("minutes").alias("known"), *_added("minutes", "micros"))


def _added(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def merged(states: list[DataFrame], key: str) -> DataFrame:
    """One state from the states of different trips: everything but the key adds up.

    The trips themselves are not read again, so a batch costs its own trips and the stored state.
    """
    columns = [c for c in states[0].columns if c != key]
    return reduce(DataFrame.unionByName, states).groupBy(key).agg(*_added(*columns))


def stats_of(state: DataFrame) -> DataFrame:
    """(user_id, num_trips, avg_duration_minutes) from a state."""
    return state.select("user_id", "num_trips", mean_minutes("minutes", "micros", "known").alias("avg_duration_minutes"))


def duration_stats(durations: DataFrame) -> DataFrame:
    """(user_id, num_trips, avg_duration_minutes) of the riders in ``durations``.  Sums are exact, so a
    mean does not depend on the order of tasks."""
    return stats_of(user_state(durations))


def active_user_stats(trips: DataFrame) -> DataFrame:
    """The same of the riders that have trips."""
    return duration_stats(trip_durations(trips))


def with_all_users(stats: DataFrame, users: DataFrame, empty: str) -> DataFrame:
    """Rider statistics with names; ``empty`` as in :func:`user_stats`."""
    if empty not in ("null", "zero", "drop"):
        raise ValueError(f"empty must be null, zero or drop, not {empty!r}")
    mean = F.col("avg_duration_minutes")
    joined = users.select("user_id", "name", "surname").join(stats, "user_id", "inner" if empty == "drop" else "left")
    return joined.select(
        "user_id",
        "name",
        "surname",
        null_as("num_trips", 0).alias("num_trips"),
        (null_as(mean, 0.0) if empty == "zero" else mean).alias("avg_duration_minutes"),
    )


def user_stats(trips: DataFrame, users: DataFrame, empty: str = "null") -> DataFrame:
    """Trip count and mean duration per rider.

    ``empty`` says what a rider without trips gets as the mean: ``"null"``,
    ``"zero"``, or ``"drop"`` to leave the rider out.  Trips are aggregated
    before they meet the riders.
    """
    return with_all_users(active_user_stats(trips), users, empty)


def station_role_counts(trips: DataFrame) -> DataFrame:
    """(station_id, trips_starting, trips_ending) of the stations with a trip.

    One pass: every trip is turned into its two roles and counted per station,
    so the trips of a station are never paired with each other.
    """
    roles = trips.select(
        F.inline(
            F.array(
                F.struct(F.col("start_station").alias("station_id"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
                F.struct(F.col("end_station").alias("station_id"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
            )
        )
    )
    return (
        roles.where(F.col("station_id").isNotNull())
        .groupBy("station_id")
        .agg(F.sum("starts").alias("trips_starting"), F.sum("ends").alias("trips_ending"))
    )


def station_counts(trips: DataFrame, stations: DataFrame, active_only: bool = False) -> DataFrame:
    """Departures and arrivals per station.  Stations that no trip uses count
    zero, or are left out with ``active_only``."""
    return with_all_stations(station_role_counts(trips), stations, active_only)


def with_all_stations(counts: DataFrame, stations: DataFrame, active_only: bool = False) -> DataFrame:
    """Station counts with names, from a state made by :func:`station_role_counts`."""
    return (
        stations.select("station_id", "name", "city")
        .join(counts, "station_id", "inner" if active_only else "left")
        .select(
            "station_id",
            "name",
            "city",
            null_as("trips_starting", 0).alias("trips_starting"),
            null_as("trips_ending", 0).alias("trips_ending"),
        )
    )


_TRIP_FIELDS = ["trip_id", "user_id", "start_time", "end_time", "total_cost"]


def trips_with_event(trips: DataFrame, events: DataFrame, event_type: str = "ERROR") -> DataFrame:
    """Trips that have at least one event of the given type, each once.

    The event side is reduced to distinct trip keys before its shuffle, and the
    semi join uses the same partitioning, so a trip with very many events costs
    one row per task.
    """
    matching = events.where(F.col("event_type") == event_type).select("trip_id").distinct()
    return trips.select(_TRIP_FIELDS).join(matching, "trip_id", "left_semi")


def trips_with_event_distinct(trips: DataFrame, events: DataFrame, event_type: str = "ERROR") -> DataFrame:
    """The same question as an inner join followed by DISTINCT.

    The event keys are made distinct before the join as well, which leaves the
    last DISTINCT nothing to shuffle: rows are already grouped by trip.
    """
    matching = events.where(F.col("event_type") == event_type).select("trip_id").distinct()
    return trips.select(_TRIP_FIELDS).join(matching, "trip_id").distinct()


def in_key_order(df: DataFrame, key: str) -> DataFrame:
    """Ascending by key.  The reports are unordered unless this is asked for,
    because a total order costs a range shuffle."""
    return df.orderBy(key)


def latest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest keys, largest first."""
    return df.orderBy(F.col(key).desc()).limit(n)
