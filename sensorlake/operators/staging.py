"""Staging: pin types, rename, keep one row per key.

Deduplication is ``row_number() == 1`` over a window.  Spark plans that as a
map-side ``WindowGroupLimit`` before the shuffle, so a key repeated across a
third of the input is reduced to one row per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int(df: DataFrame, name: str) -> Column:
    """Cast to INT; fractional inputs round half-even first."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        col = F.bround(col)
    return col.cast("int")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (a total order)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# Order of the tie-break columns after the documented key; spelled the same
# way in the oracle SQL.
COUNTS_ORDER = [
    "sensing_date",
    "location_id",
    "hour_of_day",
    "pedestrian_count",
    "direction_1_count",
    "direction_2_count",
    "sensor_name",
]


def typed_counts(raw: DataFrame) -> DataFrame:
    """Raw counts with pinned types and names."""
    return raw.select(
        F.col("id").alias("observation_id"),
        to_int(raw, "location_id").alias("location_id"),
        F.col("sensing_date").cast("date").alias("sensing_date"),
        to_int(raw, "hourday").alias("hour_of_day"),
        to_int(raw, "direction_1").alias("direction_1_count"),
        to_int(raw, "direction_2").alias("direction_2_count"),
        to_int(raw, "pedestriancount").alias("pedestrian_count"),
        F.col("sensor_name").cast("string").alias("sensor_name"),
    )


def stage_counts(raw: DataFrame) -> DataFrame:
    """``stg_counts``: typed counts, one row per observation id, earliest date."""
    return keep_first(typed_counts(raw), ["observation_id"], [F.asc_nulls_last(c) for c in COUNTS_ORDER])


SENSORS_TIEBREAK = [
    "location_name",
    "sensor_name",
    "location_type",
    "status",
    "direction_1",
    "direction_2",
    "latitude",
    "longitude",
]


def stage_sensors(raw: DataFrame) -> DataFrame:
    """``stg_sensors``: typed sensors, latest installation per location."""
    typed = raw.select(
        to_int(raw, "location_id").alias("location_id"),
        F.col("sensor_description").cast("string").alias("location_name"),
        F.col("sensor_name").cast("string").alias("sensor_name"),
        F.col("installation_date").cast("date").alias("installation_date"),
        "location_type",
        "status",
        "direction_1",
        "direction_2",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )
    order = [F.desc_nulls_last("installation_date")] + [F.asc_nulls_last(c) for c in SENSORS_TIEBREAK]
    return keep_first(typed, ["location_id"], order)
