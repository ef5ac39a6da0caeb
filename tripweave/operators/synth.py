"""Synthetic mobility data, made by Spark tasks.

Every value is a draw fixed by the seed, the column and the key of its row, so
the same seed gives the same rows under any partitioning.  Generators take a
DataFrame of keys (``id``), so data can be made for a range of numbers or for
the keys of an existing table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.expressions import draw_below, draw_from
from tripweave.model import BATTERY_MAX, ERROR_VALUES, EVENT_TYPES

# ---- Fixed values of the generated data ------------------------------------
CITIES = [
    "Milano", "Roma", "Napoli", "Torino", "Bologna", "Firenze", "Venezia", "Genova",
    "Palermo", "Bari", "Catania", "Verona", "Padova", "Trieste", "Brescia",
]
COUNTRIES = ["Italy", "Germany", "France", "Spain", "UK", "USA", "Japan", "Brazil"]
NAMES = [
    "Luca", "Marco", "Sara", "Giulia", "Andrea", "Matteo", "Anna", "Elena",
    "Francesco", "Davide", "Alice", "Chiara", "Lorenzo", "Riccardo", "Valeria",
]
SURNAMES = [
    "Rossi", "Ferrari", "Esposito", "Bianchi", "Romano", "Colombo", "Ricci",
    "Marino", "Greco", "Bruno", "Gallo", "Conti", "De Luca",
]
BASE_DATE = "2023-01-01"
YOUNGEST_DAYS, OLDEST_DAYS = 18 * 365, 60 * 365
CAPACITY = (5, 50)
TRIP_MINUTES = (5, 180)
COST_CENTS = (50, 2500)
YEAR_DAYS = 365
DELAY_MINUTES = (1, 60)
LATITUDE, LONGITUDE = (37, 47), (7, 15)
MIN_STATIONS, USERS_PER_STATION = 20, 50
# ----------------------------------------------------------------------------

_DAY_SECONDS = 24 * 60 * 60
_MICRO_DEGREES = 1_000_000


def keys(spark: SparkSession, n: int) -> DataFrame:
    """The keys 1..n."""
    return spark.range(1, n + 1)


def station_count(n_users: int) -> int:
    return max(MIN_STATIONS, n_users // USERS_PER_STATION)


def _between(bounds: tuple[int, int], seed: int, column: str, key: Column) -> Column:
    low, high = bounds
    return low + draw_below(high - low + 1, seed, column, key)


def _base_time() -> Column:
    return F.lit(BASE_DATE).cast("timestamp_ntz")


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def _time_in_year(seed: int, column: str, key: Column) -> Column:
    days = draw_below(YEAR_DAYS + 1, seed, f"{column}:day", key)
    return _base_time() + _seconds(days * _DAY_SECONDS + draw_below(_DAY_SECONDS, seed, f"{column}:second", key))


def users(ids: DataFrame, seed: int = 1) -> DataFrame:
    """One rider per key, 18 to 60 years old at the base date."""
    key = F.col("id")
    age = _between((YOUNGEST_DAYS, OLDEST_DAYS), seed, "user:birthdate", key).cast("int")
    return ids.select(
        key.alias("user_id"),
        draw_from(NAMES, seed, "user:name", key).alias("name"),
        draw_from(SURNAMES, seed, "user:surname", key).alias("surname"),
        F.date_sub(F.lit(BASE_DATE).cast("date"), age).alias("birthdate"),
        draw_from(COUNTRIES, seed, "user:country", key).alias("country"),
    )


def stations(ids: DataFrame, seed: int = 1) -> DataFrame:
    """One station per key, named after its city and its zero-based number."""
    key = F.col("id")
    city = draw_from(CITIES, seed, "station:city", key)
    number = (key - 1).cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return ids.select(
        key.alias("station_id"),
        F.concat(F.lit("Station_"), city, F.lit("_"), padded).alias("name"),
        city.alias("city"),
        _between(CAPACITY, seed, "station:capacity", key).cast("int").alias("capacity"),
    )


def trips(ids: DataFrame, n_users: int, n_stations: int, seed: int = 1) -> DataFrame:
    """One trip per key between stations 1..n_stations, by riders 1..n_users."""
    key = F.col("id")
    start = _time_in_year(seed, "trip:start", key)
    minutes = _between(TRIP_MINUTES, seed, "trip:minutes", key)
    return ids.select(
        key.alias("trip_id"),
        (1 + draw_below(n_users, seed, "trip:user", key)).alias("user_id"),
        (1 + draw_below(n_stations, seed, "trip:from", key)).alias("start_station"),
        (1 + draw_below(n_stations, seed, "trip:to", key)).alias("end_station"),
        start.alias("start_time"),
        (start + _seconds(minutes * 60)).alias("end_time"),
        (_between(COST_CENTS, seed, "trip:cost", key) / F.lit(100)).cast("decimal(8,2)").alias("total_cost"),
    )


def _degrees(bounds: tuple[int, int], seed: int, column: str, key: Column) -> Column:
    low, high = bounds
    micro = _between((low * _MICRO_DEGREES, high * _MICRO_DEGREES), seed, column, key)
    whole = F.floor(micro / F.lit(_MICRO_DEGREES)).cast("string")
    return F.concat(whole, F.lit("."), F.lpad((micro % _MICRO_DEGREES).cast("string"), 6, "0"))


def event_value(event_type: Column, seed: int, key: Column) -> Column:
    """The text of an event value, in the form its type prescribes."""
    place = F.concat(
        _degrees(LATITUDE, seed, "event:lat", key), F.lit(","), _degrees(LONGITUDE, seed, "event:lon", key)
    )
    return (
        F.when(event_type == "GPS", place)
        .when(event_type == "ERROR", draw_from(ERROR_VALUES, seed, "event:error", key))
        .when(event_type == "BATTERY", draw_below(BATTERY_MAX + 1, seed, "event:battery", key).cast("string"))
        .otherwise(_between(DELAY_MINUTES, seed, "event:delay", key).cast("string"))
    )


def events(
    trips: DataFrame,
    per_trip: int,
    seed: int = 1,
    event_time: str = "year",
    with_battery_level: bool = False,
) -> DataFrame:
    """``per_trip`` events for every trip; none at all if it is zero.

    ``event_time`` is ``"year"`` for any time of the year, as in the tables, or
    ``"trip"`` for up to a day after the start of the trip, as in documents.
    """
    if event_time not in ("year", "trip"):
        raise ValueError(f"event_time must be year or trip, not {event_time!r}")
    # An empty sequence cannot be written with F.sequence, which would count down.
    numbers = F.sequence(F.lit(1), F.lit(max(per_trip, 1)))
    base = trips if per_trip > 0 else trips.where(F.lit(False))
    base = base.select("trip_id", "start_time", F.explode(numbers).alias("i"))
    number = (F.col("trip_id") - 1) * max(per_trip, 1) + F.col("i")
    base = base.select("trip_id", "start_time", number.alias("event_id"))
    key = F.col("event_id")
    kind = draw_from(EVENT_TYPES, seed, "event:type", key)
    if event_time == "year":
        time = _time_in_year(seed, "event:time", key)
    else:
        time = F.col("start_time") + _seconds(draw_below(_DAY_SECONDS, seed, "event:offset", key))
    made = base.select("event_id", "trip_id", time.alias("timestamp"), kind.alias("event_type"))
    made = made.withColumn("value", event_value(F.col("event_type"), seed, key))
    made = made.withColumn("event_id", key.cast("string"))
    if with_battery_level:
        level = F.when(F.col("event_type") == "BATTERY", F.col("value").cast("int"))
        made = made.withColumn("battery_level", level)
    return made


def tables(
    spark: SparkSession, n_users: int, n_trips: int, events_per_trip: int, seed: int = 1
) -> dict[str, DataFrame]:
    """All four tables at one scale point."""
    n_stations = station_count(n_users)
    made = trips(keys(spark, n_trips), n_users, n_stations, seed)
    return {
        "users": users(keys(spark, n_users), seed),
        "stations": stations(keys(spark, n_stations), seed),
        "trips": made,
        "events": events(made, events_per_trip, seed),
    }
