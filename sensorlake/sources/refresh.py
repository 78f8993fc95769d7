"""Idempotent trailing-window refresh of monthly partitions.

The refresh window starts at the source's first date on a full run (or when
nothing is stored yet), else ``lookback_days`` before the latest stored date;
it ends ``today``.  Every calendar month touching the window is re-read from
the source with a half-open date predicate and replaces its partition whole; all
of them are committed at once (``sources.versions``).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from . import versions

PARTITION = "month"
LOOKBACK_DAYS = 7
#: Partitions that hold dated rows (not the one of null months).
MONTH = re.compile(r"\d{4}_\d{2}")


def stored_max_date(spark: SparkSession, dest: str) -> DataFrame:
    """One row ``stored_max``: latest stored date, null when nothing is stored.

    Only the newest ``month=`` partition can hold the maximum, and its files'
    footers have it: no data page is read.
    """
    version = versions.current(spark, dest)
    newest = [max(dated)] if (dated := [m for m in version.parts if MONTH.fullmatch(m)]) else []
    last = versions.largest(spark, dest, PARTITION, version, "sensing_date", newest)
    return spark.createDataFrame([(last,)], "stored_max date")


def source_min_date(source: DataFrame) -> DataFrame:
    """One row ``source_min``: earliest date the source has."""
    return source.agg(F.min("sensing_date").alias("source_min"))


def refresh_window(
    stored: DataFrame,
    source_min: DataFrame,
    today: Column | dt.date,
    lookback_days: int = LOOKBACK_DAYS,
    full: bool = False,
) -> DataFrame:
    """One row ``(window_start, window_end)``."""
    today_c = today if isinstance(today, Column) else F.lit(today)
    smin = source_min.select("source_min").scalar()
    smax = stored.select("stored_max").scalar()
    start = smin if full else F.coalesce(F.date_sub(smax, lookback_days), smin)
    return stored.sparkSession.range(1).select(
        start.alias("window_start"), today_c.cast("date").alias("window_end")
    )


def months(window: DataFrame) -> DataFrame:
    """Every month intersecting ``[window_start, window_end]`` (S8):
    ``month_start``, ``next_month`` and the partition value ``month``."""
    seq = F.sequence(month_start("window_start"), F.col("window_end"), F.expr("INTERVAL 1 MONTH"))
    m = window.select(F.explode(seq).alias("month_start"))
    return m.select(
        "month_start",
        F.add_months("month_start", 1).alias("next_month"),
        F.date_format("month_start", "yyyy_MM").alias(PARTITION),
    )


def in_months(df: DataFrame, planned: list, date_col: str = "sensing_date") -> DataFrame:
    """Rows whose date falls in the planned months, half-open.

    ``planned`` is the collected month plan (a few rows).  The months of a
    plan are consecutive, so the predicate is one literal range
    ``[first month start, last next month)`` that reaches the Parquet scan as
    a pushed filter; a source that is itself partitioned by ``month`` is also
    pruned to the planned months.
    """
    d = F.col(date_col)
    lo = min(r["month_start"] for r in planned)
    hi = max(r["next_month"] for r in planned)
    out = df.filter((d >= F.lit(lo)) & (d < F.lit(hi)))
    if PARTITION in df.columns:
        out = out.filter(F.col(PARTITION).isin([r[PARTITION] for r in planned]))
    return out


def refresh_counts(spark: SparkSession, source: DataFrame, dest: str, window: DataFrame) -> DataFrame:
    """Replace every planned month of ``dest`` with the source's rows.

    Months with new rows and months that have none any more (T9) change in one
    commit.  Sorted files have tight Parquet statistics for later date
    filters.  Returns the plan with the rows now stored per month (S14).
    """
    planned = months(window).collect()
    if not planned:
        return spark.createDataFrame([], "month_start date, next_month date, month string, rows bigint")
    names = [r[PARTITION] for r in planned]
    rows = in_months(source, planned).withColumn(PARTITION, F.date_format("sensing_date", "yyyy_MM"))
    version, _ = versions.replace(rows, dest, PARTITION, names, sort=("sensing_date", "id"))
    plan = spark.createDataFrame(planned)
    stored = versions.read(spark, dest, PARTITION, version, only=names)
    if stored is None:
        return plan.select("month_start", "next_month", PARTITION, F.lit(0).cast("bigint").alias("rows"))
    stored = stored.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("rows"))
    return plan.join(stored, PARTITION, "left").select(
        "month_start", "next_month", PARTITION, F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
    )


def refresh_sensors(source: DataFrame, dest: str) -> None:
    """Full replacement of the sensor reference table (S11) in one commit."""
    versions.replace(source, dest)


def refresh(
    spark: SparkSession,
    source: DataFrame,
    dest: str,
    today: dt.date,
    lookback_days: int = LOOKBACK_DAYS,
    full: bool = False,
) -> DataFrame:
    """Plan the window from stored state and refresh.

    The window is two driver scalars, fixed before the destination changes.
    The source's first date is read only for a full run or an empty
    destination, as in the reference; an incremental run never scans the
    whole source.
    """
    stored = None if full else stored_max_date(spark, dest).first()[0]
    if stored is not None:
        start = stored - dt.timedelta(days=lookback_days)
    else:
        start = source_min_date(source).first()[0]
    if start is None:
        return spark.createDataFrame([], "month_start date, next_month date, month string, rows bigint")
    window = spark.createDataFrame([(start, today)], "window_start date, window_end date")
    return refresh_counts(spark, source, dest, window)
