"""Fact, dimension and marts.

Join strategy is left to the planner: the dimension is one row per sensor
location, so its estimated size is small and Spark broadcasts it; if the
estimate is above ``spark.sql.autoBroadcastJoinThreshold`` it falls back to a
sort-merge join, and AQE re-plans with runtime sizes.  Aggregations run
before the dimension join so the join touches groups, not readings (R3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal


def hourly_fact(stg_counts: DataFrame) -> DataFrame:
    """``fct_hourly_counts``: staging counts with calendar attributes."""
    d = F.col("sensing_date")
    return stg_counts.select(
        "observation_id",
        "location_id",
        "sensing_date",
        "hour_of_day",
        cal.observed_at(d, "hour_of_day").alias("observed_at"),
        cal.day_name(d).alias("day_name"),
        cal.iso_day_of_week(d).alias("iso_day_of_week"),
        cal.is_weekend(d).alias("is_weekend"),
        "direction_1_count",
        "direction_2_count",
        "pedestrian_count",
    )


def activity_bounds(stg_counts: DataFrame) -> DataFrame:
    """First and last observed date per location (A1)."""
    return stg_counts.groupBy("location_id").agg(
        F.min("sensing_date").alias("first_observed_date"),
        F.max("sensing_date").alias("last_observed_date"),
    )


def sensor_dim(stg_sensors: DataFrame, stg_counts: DataFrame) -> DataFrame:
    """``dim_sensors``: sensors + active flag + activity bounds."""
    return stg_sensors.join(activity_bounds(stg_counts), "location_id", "left").select(
        "location_id",
        "location_name",
        "sensor_name",
        "installation_date",
        "location_type",
        "status",
        (F.col("status") == "A").alias("is_active"),
        "direction_1",
        "direction_2",
        "latitude",
        "longitude",
        "first_observed_date",
        "last_observed_date",
    )


def fallback_name(name: str = "location_name", key: str = "location_id") -> Column:
    """``coalesce(name, 'Location ' || id)`` (P5)."""
    return F.coalesce(F.col(name), F.concat(F.lit("Location "), F.col(key).cast("string")))


def daily_totals(fct: DataFrame) -> DataFrame:
    """Daily totals per location (A2)."""
    return fct.groupBy("location_id", "sensing_date", "iso_day_of_week", "is_weekend").agg(
        F.sum("pedestrian_count").cast("bigint").alias("daily_count"),
        F.count(F.lit(1)).alias("hours_reported"),
    )


def daily_mart(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """``mart_daily_location``: daily totals per location with names."""
    return named_daily(daily_totals(fct), dim)


def named_daily(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Daily totals with the dimension's names."""
    names = dim.select("location_id", "location_name", "latitude", "longitude")
    return daily.join(names, "location_id", "left").select(
        "location_id",
        fallback_name().alias("location_name"),
        "latitude",
        "longitude",
        "sensing_date",
        "iso_day_of_week",
        "is_weekend",
        "daily_count",
        "hours_reported",
    )


def max_date(df: DataFrame, col: str = "sensing_date") -> Column:
    """Global max date as a scalar-subquery column (A3), evaluated once."""
    return df.agg(F.max(col)).scalar()


def hourly_profile(fct: DataFrame, dim: DataFrame, days: int = 90, last: Column | None = None) -> DataFrame:
    """``mart_hourly_profile``: trailing-``days`` mean per weekday and hour.

    The window ends at the fact's own max date, not the report anchor (T11);
    ``last`` is that date where the caller knows it.
    """
    recent = cal.trailing(fct, "sensing_date", max_date(fct) if last is None else last, days)
    prof = recent.groupBy(
        "location_id", "iso_day_of_week", "day_name", "is_weekend", "hour_of_day"
    ).agg(
        F.avg("pedestrian_count").alias("avg_count"),
        F.count(F.lit(1)).alias("n_observations"),
    )
    names = dim.select("location_id", "location_name")
    return prof.join(names, "location_id", "left").select(
        "location_id",
        fallback_name().alias("location_name"),
        "iso_day_of_week",
        "day_name",
        "is_weekend",
        "hour_of_day",
        "avg_count",
        "n_observations",
    )
