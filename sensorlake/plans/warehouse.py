"""The warehouse chain: raw -> staging -> fact / dimension -> marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import marts, staging
from ..session import checkpointed


@dataclass
class Warehouse:
    stg_counts: DataFrame
    stg_sensors: DataFrame
    fct_hourly_counts: DataFrame
    dim_sensors: DataFrame
    mart_daily_location: DataFrame
    mart_hourly_profile: DataFrame


def build_warehouse(
    raw_counts: DataFrame, raw_sensors: DataFrame, profile_days: int = 90, materialize: bool = False
) -> Warehouse:
    """Chain every model lazily.

    With ``materialize`` the deduplicated staging counts (the one model that
    needs a full shuffle of the readings) are written once with a reliable
    checkpoint and every later model, check and subquery reads them, the way
    the pipeline reads its staging table.
    """
    stg_c = staging.stage_counts(raw_counts)
    if materialize:
        stg_c = checkpointed(stg_c)
    stg_s = staging.stage_sensors(raw_sensors)
    fct = marts.hourly_fact(stg_c)
    dim = marts.sensor_dim(stg_s, stg_c)
    return Warehouse(
        stg_counts=stg_c,
        stg_sensors=stg_s,
        fct_hourly_counts=fct,
        dim_sensors=dim,
        mart_daily_location=marts.daily_mart(fct, dim),
        mart_hourly_profile=marts.hourly_profile(fct, dim, profile_days),
    )
