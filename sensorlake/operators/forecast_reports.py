"""Report frames over the forecast marts (P11, P12, A8, A13, A19, A20, U2, O4,
J9, E9, E11).

``today`` is a parameter (a date column or literal); ``local_today`` gives
the calendar date in a named zone for callers that want the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import days_inclusive, local_date, observed_at
from ..functions import labels as lb
from .backtest import MODEL, NAIVE
from .reports import city_daily

DATE = "sensing_date"


def local_today(tz: str = "Australia/Melbourne") -> Column:
    """Today's date in ``tz``."""
    return local_date(F.current_timestamp(), tz)


def still_future(fc: DataFrame, anchor: Column, today: Column) -> DataFrame:
    """Forecast rows after the anchor and not in the past."""
    return fc.filter((F.col(DATE) > anchor) & (F.col(DATE) >= today))


def forecast_status(fc: DataFrame, anchor: Column, today: Column) -> DataFrame:
    """One row: rows stored, rows still future, last forecast date, and
    ``stale`` = had rows but none remain (P12, A20)."""
    future = (F.col(DATE) > anchor) & (F.col(DATE) >= today)
    agg = fc.agg(
        F.count(F.lit(1)).alias("rows_stored"),
        F.count_if(future).alias("rows_remaining"),
        F.max(DATE).alias("forecast_end"),
    )
    return agg.withColumn("stale", (F.col("rows_stored") > 0) & (F.col("rows_remaining") == 0))


def forecast_panel(daily: DataFrame, fc: DataFrame, anchor: Column, today: Column, days: int = 42) -> DataFrame:
    """Citywide actuals over ``days`` and the daily sum of p50, joined by a
    bridge point (anchor, last actual) (A12, A13, U2, O4).

    Output ``(series, sensing_date, value)``, series ``actual`` or ``forecast``.
    """
    hist = city_daily(daily).filter(F.col(DATE) > F.date_sub(anchor, days))
    fut = still_future(fc, anchor, today).groupBy(DATE).agg(F.sum("p50").alias("value"))
    # The panel (actuals included) is drawn only while forecast rows remain.
    has_fc = fut.agg((F.count(F.lit(1)) > 0).alias("has")).scalar()
    actual = hist.select(F.lit("actual").alias("series"), DATE, F.col("daily_count").cast("double").alias("value"))
    forecast = fut.select(F.lit("forecast").alias("series"), DATE, "value")
    bridge = hist.agg(F.max_by("daily_count", DATE).cast("double").alias("value")).select(
        F.lit("forecast").alias("series"), anchor.alias(DATE), "value"
    ).filter(F.col("value").isNotNull())
    return actual.unionByName(forecast).unionByName(bridge).filter(has_fc)


def forecast_coverage(daily: DataFrame, fc: DataFrame, anchor: Column, today: Column) -> DataFrame:
    """One row: active locations (last 14 days), forecast locations, rows,
    expected rows = active x days x 24 from max(today, anchor + 1) to the last
    forecast date, and their ratio (0 when nothing is expected) (A8, A19, E11)."""
    d = F.col(DATE)
    active = daily.filter(d > F.date_sub(anchor, 14)).agg(
        F.count_distinct("location_id").alias("active_locations")
    )
    fut = still_future(fc, anchor, today).agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.count_distinct("location_id").alias("forecast_locations"),
        F.max(DATE).alias("forecast_end"),
    )
    start = F.greatest(today, F.date_add(anchor, 1))
    days = days_inclusive(start, F.col("forecast_end"))
    out = fut.select(
        "forecast_rows",
        "forecast_locations",
        active.scalar().alias("active_locations"),
        F.coalesce(days, F.lit(0)).alias("forecast_days"),
    )
    expected = (F.col("active_locations") * F.col("forecast_days") * 24).cast("bigint")
    return out.withColumn("expected_rows", expected).withColumn(
        "row_coverage",
        F.when(F.col("expected_rows") != 0, F.col("forecast_rows") / F.col("expected_rows")).otherwise(F.lit(0.0)),
    )


def compare_methods(metrics: DataFrame) -> DataFrame:
    """Model and baseline side by side per scope and fold, with the relative
    WAPE improvement 1 - wape_model / wape_naive (J9, A20)."""

    def pick(method: str, col: str) -> Column:
        return F.max(F.when(F.col("method") == method, F.col(col)))

    out = metrics.groupBy("scope", "fold_cutoff").agg(
        pick(MODEL, "wape").alias("model_wape"),
        pick(NAIVE, "wape").alias("naive_wape"),
        pick(MODEL, "mae").alias("model_mae"),
        pick(NAIVE, "mae").alias("naive_mae"),
        pick(MODEL, "band_coverage").alias("band_coverage"),
        pick(MODEL, "n_rows").alias("n_rows"),
    )
    return out.withColumn("improvement", 1 - F.try_divide(F.col("model_wape"), F.col("naive_wape")))


def forecast_labels(compared: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row of display labels: overall error, change against the baseline,
    band coverage, and how much of the expected forecast is there (E20)."""
    overall = compared.filter("scope = 'overall'").select(
        lb.percent(F.col("model_wape")).alias("wape_label"),
        lb.signed_points((1 - F.try_divide(F.col("model_wape"), F.col("naive_wape"))) * 100).alias("improvement_label"),
        lb.percent(F.col("band_coverage"), 0).alias("band_label"),
    )
    rows = coverage.select(
        lb.percent(F.col("row_coverage")).alias("coverage_label"),
        F.format_string("%d of %d active locations", "forecast_locations", "active_locations").alias("locations_label"),
    )
    # One row on each side.
    return overall.withColumn("_one", F.lit(1)).join(rows.withColumn("_one", F.lit(1)), "_one").drop("_one")


def location_forecast(daily: DataFrame, fc: DataFrame, anchor: Column, today: Column, days: int = 365) -> DataFrame:
    """Hourly band per location name: the name's first id by date over the
    last ``days`` (O4), joined to its still-future forecast, with ``ts`` (E4)."""
    last = daily.filter(F.col(DATE) > F.date_sub(anchor, days))
    first_id = last.groupBy("location_name").agg(
        F.min_by("location_id", F.struct(F.col(DATE), F.col("location_id"))).alias("location_id")
    )
    fut = still_future(fc, anchor, today).select("location_id", DATE, "hour_of_day", "p10", "p50", "p90")
    return first_id.join(fut, "location_id").select(
        "location_name",
        "location_id",
        observed_at(DATE, "hour_of_day").alias("ts"),
        "p10",
        "p50",
        "p90",
    )
