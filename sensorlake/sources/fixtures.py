"""Deterministic mappings from the shared test tables onto the raw shapes.

Each mapping reads a whole table and lets Spark derive the raw frame from it,
so its work grows with the table.  The same mappings are spelled in SQL in
``sensorlake.plans.oracle`` for the DuckDB oracle.

* F1 ``dense_hourly_counts(events)``: unique (location, date, hour) grain.
* F2 ``readings_with_duplicates(lineitem)``: repeated ids, non-unique grain.
* F2d ``dense_daily_hour_series(lineitem)``: unique grain, long history.
* F3 ``sensors_from_suppliers(supplier)``: moved sensors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mappings (shared with the SQL spelling).
F1_LOCATIONS, F1_EVENTS_PER_LOCATION = 10, 1000
F1_DAY_ZERO = dt.date(2024, 1, 1)
F1_ID_STRIDE = 1_000_000
F2_ID_STRIDE = 8
F2D_LOCATIONS, F2D_LINES_PER_LOCATION = 5, 12_000
F2_ORPHAN_EVERY, F2_ORPHAN_SHIFT = 50, 1_000_000
F2D_DAY_ZERO = dt.date(1990, 1, 1)
F2D_ID_STRIDE = 100_000_000
F3_INSTALL_ZERO = dt.date(2010, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(date_col) -> F.Column:
    return F.date_format(date_col, "yyyy_MM")


def _directions(n: F.Column) -> list[F.Column]:
    d1 = F.floor(n / 2).cast("bigint")
    return [d1.alias("direction_1"), (n - d1).cast("bigint").alias("direction_2")]


def _locations(table_: DataFrame, least: int, per: int) -> int:
    """Number of locations, in proportion to the table's rows."""
    return max(least, table_.count() // per)


def dense_hourly_counts(events: DataFrame) -> DataFrame:
    """events counted per (user_id modulo the locations, date, hour)."""
    n = _locations(events, F1_LOCATIONS, F1_EVENTS_PER_LOCATION)
    cells = events.groupBy(
        (F.col("user_id") % n).alias("location_id"),
        F.to_date("ts").alias("sensing_date"),
        F.hour("ts").cast("bigint").alias("hourday"),
    ).agg(F.count(F.lit(1)).alias("n"))
    day = F.datediff("sensing_date", F.lit(F1_DAY_ZERO)).cast("bigint")
    return cells.select(
        (F.col("location_id") * F1_ID_STRIDE + day * 24 + F.col("hourday")).alias("id"),
        "location_id",
        "sensing_date",
        "hourday",
        *_directions(F.col("n")),
        F.col("n").alias("pedestriancount"),
        F.concat(F.lit("S"), F.col("location_id").cast("string")).alias("sensor_name"),
        _month("sensing_date").alias("month"),
    )


def readings_with_duplicates(lineitem: DataFrame) -> DataFrame:
    """one reading per lineitem; ids repeat, the hourly grain is not unique,
    every 50th order's readings name a location no sensor has."""
    orphan = F.col("l_orderkey") % F2_ORPHAN_EVERY == 0
    location = F.col("l_suppkey") + F.when(orphan, F.lit(F2_ORPHAN_SHIFT)).otherwise(F.lit(0))
    qty = F.col("l_quantity")
    date = F.to_date("l_shipdate")
    return lineitem.select(
        (F.col("l_orderkey") * F2_ID_STRIDE + F.col("l_linenumber")).alias("id"),
        location.alias("location_id"),
        date.alias("sensing_date"),
        (F.col("l_partkey") % 24).alias("hourday"),
        *_directions(qty),
        qty.cast("bigint").alias("pedestriancount"),
        F.concat(F.lit("S"), location.cast("string")).alias("sensor_name"),
        _month(date).alias("month"),
    )


def dense_daily_hour_series(lineitem: DataFrame) -> DataFrame:
    """F2d: quantities summed per (l_suppkey modulo the locations, date,
    l_partkey % 24)."""
    n = _locations(lineitem, F2D_LOCATIONS, F2D_LINES_PER_LOCATION)
    cells = lineitem.groupBy(
        (F.col("l_suppkey") % n).alias("location_id"),
        F.to_date("l_shipdate").alias("sensing_date"),
        (F.col("l_partkey") % 24).alias("hourday"),
    ).agg(F.sum("l_quantity").cast("bigint").alias("n"))
    day = F.datediff("sensing_date", F.lit(F2D_DAY_ZERO)).cast("bigint")
    return cells.select(
        (F.col("location_id") * F2D_ID_STRIDE + day * 24 + F.col("hourday")).alias("id"),
        "location_id",
        "sensing_date",
        "hourday",
        *_directions(F.col("n")),
        F.col("n").alias("pedestriancount"),
        F.concat(F.lit("S"), F.col("location_id").cast("string")).alias("sensor_name"),
        _month("sensing_date").alias("month"),
    )


def sensors_from_suppliers(supplier: DataFrame) -> DataFrame:
    """suppliers as sensors; every 4th moved a year later."""
    sup = supplier

    def shape(df: DataFrame, shift_days: int, suffix: str) -> DataFrame:
        return df.select(
            F.col("s_suppkey").alias("location_id"),
            F.concat(F.col("s_name"), F.lit(suffix)).alias("sensor_description"),
            F.col("s_name").alias("sensor_name"),
            F.date_add(F.lit(F3_INSTALL_ZERO), (F.col("s_suppkey") % 365).cast("int") + shift_days).alias(
                "installation_date"
            ),
            F.lit("Outdoor").alias("location_type"),
            F.when(F.col("s_acctbal") >= 0, F.lit("A")).otherwise(F.lit("R")).alias("status"),
            F.lit("North").alias("direction_1"),
            F.lit("South").alias("direction_2"),
            (F.lit(-37.80) - F.col("s_nationkey") * F.lit(0.001)).alias("latitude"),
            (F.lit(144.90) + F.col("s_suppkey") * F.lit(0.001)).alias("longitude"),
        )

    return shape(sup, 0, "").unionByName(shape(sup.filter(F.col("s_suppkey") % 4 == 0), 365, " (moved)"))


def f1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_hourly_counts(table(spark, sf_dir, "events"))


def f2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_with_duplicates(table(spark, sf_dir, "lineitem"))


def f2d_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_daily_hour_series(table(spark, sf_dir, "lineitem"))


def f3_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors_from_suppliers(table(spark, sf_dir, "supplier"))
