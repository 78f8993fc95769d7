"""End-to-end run: refresh -> warehouse -> data tests -> marts -> forecast.

One driver process replaces the reference's chain of command-line stages.
Staging counts and daily totals follow the refreshed months (``root/store``,
see ``plans.incremental``).  Dimension and marts are written under
``root/warehouse`` and tested there; tables that pass become the current
versions under ``root/marts``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.quantile import BoostParams
from ..sources import export, readers, refresh, versions
from . import incremental
from .forecast import forecast
from .warehouse import Warehouse


@dataclass
class PipelineResult:
    refreshed_months: DataFrame
    checks: DataFrame
    exported: DataFrame
    anchor: dt.date | None


def build_materialized(spark: SparkSession, months: list[str], raw_counts_dir: str, raw_sensors: DataFrame, root: str,
                       profile_days: int = 90) -> Warehouse:
    """Bring the store up to date after ``months`` of the raw table were
    replaced, and write dimension and marts under ``root/warehouse``; the data
    tests read the written tables."""
    store = f"{root}/store"
    if not versions.current(spark, store).number:
        months = sorted(versions.current(spark, raw_counts_dir).parts)  # a first run
    if months:
        raw = readers.read_counts(spark, raw_counts_dir).filter(F.col(refresh.PARTITION).isin(months))
        incremental.refresh(spark, raw, months, store)
    wh = incremental.warehouse(spark, store, raw_sensors, profile_days)
    written = {
        name: export.publish(getattr(wh, name), name, "table", f"{root}/warehouse/{name}")
        for name in ("dim_sensors", "mart_daily_location", "mart_hourly_profile")
    }
    return replace(wh, **written)


def run_pipeline(
    spark: SparkSession,
    source_counts: DataFrame,
    source_sensors: DataFrame,
    root: str,
    today: dt.date,
    full: bool = False,
    folds: int = 4,
    horizon_days: int = 7,
    params: BoostParams | None = None,
    run_forecast: bool = True,
    holiday_dates: DataFrame | None = None,
) -> PipelineResult:
    """Refresh the landing tables under ``root/raw``, rebuild and test the
    warehouse, export the marts to ``root/marts`` and write the forecast marts.
    Raises ``DataQualityError`` when an error-severity data test fails."""
    raw_counts_dir, raw_sensors_dir = f"{root}/raw/counts", f"{root}/raw/sensors"
    marts_dir = f"{root}/marts"
    refresh.refresh_sensors(source_sensors, raw_sensors_dir)
    months = refresh.refresh(spark, source_counts, raw_counts_dir, today, full=full)
    names = [r[refresh.PARTITION] for r in months.select(refresh.PARTITION).collect()]
    wh = build_materialized(spark, names, raw_counts_dir, readers.read_sensors(spark, raw_sensors_dir), root)
    suite = quality.run_suite(quality.warehouse_checks(wh))
    # One row per check, run once.
    checks = quality.enforce(spark.createDataFrame(suite.collect(), suite.schema))
    tables = {
        "dim_sensors": wh.dim_sensors,
        "mart_daily_location": wh.mart_daily_location,
        "mart_hourly_profile": wh.mart_hourly_profile,
    }
    exported = export.export_marts(spark, tables, marts_dir)
    anchor = None
    if run_forecast:
        obs = readers.observations(wh.fct_hourly_counts)
        res = forecast(obs, horizon_days, folds, params, holiday_dates=holiday_dates)
        anchor = res.anchor
        extra = {"mart_forecast": res.forecast}
        if res.metrics is not None:
            extra["mart_forecast_metrics"] = res.metrics
        exported = exported.unionByName(export.export_marts(spark, extra, marts_dir))
    return PipelineResult(months, checks, exported, anchor)
