"""The mobility tables as a view over a star schema of orders and line items.

A customer is a rider, a supplier a station, an order a trip and a line item an
event.  Every derivation is a projection, or an aggregate over fixed-width
values that is combined before its shuffle, so neither a customer nor an order
that holds a large share of the rows slows it down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.model import ERROR_VALUES
from tripweave.operators.quality import keep_valid_rows

# Line number and supplier of a line packed in one bigint.  The smallest and
# the largest packed value of an order name its first and its last line, and
# plain min and max of a bigint stay in the hash aggregate.
_SUPPLIER_SPACE = 10**12


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = _scan(spark, sf_dir, "customer"), _scan(spark, sf_dir, "nation")
    days_back = (F.lit(18 * 365) + (F.col("c_custkey") * 7919) % 15331).cast("int")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.date_sub(F.lit("2023-01-01").cast("date"), days_back).alias("birthdate"),
        F.col("n_name").alias("country"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = _scan(spark, sf_dir, "supplier"), _scan(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        (5 + F.col("s_suppkey") % 46).cast("int").alias("capacity"),
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order: from the supplier of its first line to that of its
    last line, and until its last shipment.  An order without lines has neither
    stations nor an end, and is left for the checks to find."""
    supplier = F.col("l_suppkey").cast("bigint")
    fits = supplier.isNull() | supplier.between(0, _SUPPLIER_SPACE - 1)
    complaint = F.raise_error(F.concat(F.lit("no station can have the key "), supplier.cast("string"))).cast("bigint")
    line = F.col("l_linenumber").cast("bigint") * _SUPPLIER_SPACE + F.when(fits, supplier).otherwise(complaint)
    ends = (
        _scan(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("trip_id"))
        .agg(
            F.min(line).alias("first_line"),
            F.max(line).alias("last_line"),
            F.max("l_shipdate").alias("end_time"),
        )
    )
    orders = _scan(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_totalprice").cast("decimal(8,2)").alias("total_cost"),
    )
    return orders.join(ends, "trip_id", "left").select(
        "trip_id",
        "user_id",
        (F.col("first_line") % _SUPPLIER_SPACE).alias("start_station"),
        (F.col("last_line") % _SUPPLIER_SPACE).alias("end_station"),
        "start_time",
        "end_time",
        "total_cost",
    )


def _event_type() -> Column:
    return (
        F.when(F.col("l_returnflag") == "R", "ERROR")
        .when(F.col("l_returnflag") == "A", "GPS")
        .when(F.col("l_linestatus") == "O", "BATTERY")
        .otherwise("DELAY")
    )


def _event_value() -> Column:
    def digits(number: Column, width: int) -> Column:
        return F.lpad(number.cast("string"), width, "0")

    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    faults = F.array(*[F.lit(v) for v in ERROR_VALUES])
    place = F.concat(
        (37 + part % 10).cast("string"),
        F.lit("."),
        digits(supplier % 1000000, 6),
        F.lit(","),
        (7 + part % 8).cast("string"),
        F.lit("."),
        digits(part % 1000000, 6),
    )
    return (
        F.when(F.col("l_returnflag") == "R", F.get(faults, (part % 4).cast("int")))
        .when(F.col("l_returnflag") == "A", place)
        .when(F.col("l_linestatus") == "O", (F.col("l_quantity") * 2).cast("int").cast("string"))
        .otherwise((1 + part % 60).cast("string"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per line item: a projection, without any shuffle.

    Number, part, supplier and day of a line make it unique within its order, so
    the text of all five is the key.
    """
    day = F.date_format("l_shipdate", "yyyyMMdd")
    return _scan(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day).alias("event_id"),
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_shipdate").alias("timestamp"),
        _event_type().alias("event_type"),
        _event_value().alias("value"),
    )


def star_schema_view(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables, lazily.  ``trips_raw`` holds every trip, and ``events`` refers
    to it; ``trips`` holds the trips that keep the row rules.  Key rules (unique, known rider and
    stations) are not part of that; :func:`tripweave.operators.quality.split` applies them too."""
    raw = trips_raw(spark, sf_dir)
    return {
        "users": users(spark, sf_dir),
        "stations": stations(spark, sf_dir),
        "trips_raw": raw,
        "trips": keep_valid_rows(raw, "trips"),
        "events": events(spark, sf_dir),
    }
