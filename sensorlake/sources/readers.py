"""Readers of the landing tables and published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import observed_at
from ..schemas import RAW_COUNTS, RAW_SENSORS
from . import versions

MARTS = ("dim_sensors", "mart_daily_location", "mart_hourly_profile")
FORECAST_MARTS = ("mart_forecast", "mart_forecast_metrics")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Monthly-partitioned raw counts with a pinned schema.

    Filters on ``month`` prune partitions; filters on other columns are
    pushed into the Parquet reader.
    """
    rows = versions.read(spark, path, "month", schema=RAW_COUNTS)
    return spark.createDataFrame([], RAW_COUNTS) if rows is None else rows.select(*RAW_COUNTS.names)


def read_sensors(spark: SparkSession, path: str) -> DataFrame:
    """Raw sensor reference table."""
    rows = versions.read(spark, path, schema=RAW_SENSORS)
    return spark.createDataFrame([], RAW_SENSORS) if rows is None else rows.select(*RAW_SENSORS.names)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The current version of one mart."""
    rows = versions.read(spark, path)
    if rows is None:
        raise FileNotFoundError(f"no mart at {path}")
    return rows


def read_marts(spark: SparkSession, marts_dir: str) -> dict[str, DataFrame]:
    """The three SQL marts (S3)."""
    return {name: read_mart(spark, f"{marts_dir}/{name}") for name in MARTS}


def read_forecast(spark: SparkSession, marts_dir: str) -> tuple[DataFrame, DataFrame] | None:
    """Forecast and metrics marts, or ``None`` when either is absent.

    The forecast gains ``ts`` = date + hour.
    """
    paths = [f"{marts_dir}/{name}" for name in FORECAST_MARTS]
    fc, metrics = (versions.read(spark, p) for p in paths)
    if fc is None or metrics is None:
        return None
    return fc.withColumn("ts", observed_at("sensing_date", "hour_of_day")), metrics


def observations(fct: DataFrame) -> DataFrame:
    """The four columns the forecaster reads (S15); pruning reaches the scan."""
    return fct.select("location_id", "sensing_date", "hour_of_day", "pedestrian_count").filter(
        F.col("location_id").isNotNull()
        & F.col("sensing_date").isNotNull()
        & F.col("hour_of_day").isNotNull()
    )
