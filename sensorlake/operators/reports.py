"""Report frames over the marts.

Every report takes the daily mart already cut at the anchor (``cut_at``) and
the anchor as a column (a scalar subquery or a literal).  Reports that the
reference computes for one chosen location are computed here for all
locations at once, keyed by location; a caller filters on the key.
Unpartitioned windows only run after a reduction to one row per date (R5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.calendar import trailing

DATE = "sensing_date"


def _d() -> Column:
    return F.col(DATE)


def busiest(daily: DataFrame, anchor: Column, days: int = 7) -> DataFrame:
    """One row: the name with the largest total over the last ``days`` dates,
    HTML-escaped, or ``n/a`` (A9).  Names merge ids sharing a name (T12).
    Ties go to the smaller name."""
    last = daily.filter((_d() > F.date_sub(anchor, days)) & (_d() <= anchor))
    per = last.groupBy("location_name").agg(F.sum("daily_count").alias("total_count"))
    top = per.orderBy(F.col("total_count").desc(), F.col("location_name").asc()).limit(1)
    return top.agg(
        F.coalesce(labels.html_escape(F.max("location_name")), F.lit("n/a")).alias("busiest_location"),
        F.max("total_count").alias("busiest_total"),
    )


def kpis(daily: DataFrame, anchor: Column) -> DataFrame:
    """One row of headline numbers in a single pass over the last 14 days (R2).

    day_total vs the same weekday a week earlier, last 7 days vs the 7 before,
    sensors reporting on the anchor date, busiest location; percentage deltas
    are null when the comparison total is 0 (A7, A8, P8, P9).
    """
    d = _d()
    start7 = F.date_sub(anchor, 6)
    start14 = F.date_sub(anchor, 13)
    cnt = F.col("daily_count")
    window = daily.filter((d >= start14) & (d <= anchor))
    agg = window.agg(
        F.coalesce(F.sum(F.when(d == anchor, cnt)), F.lit(0)).cast("bigint").alias("day_total"),
        F.coalesce(F.sum(F.when(d == F.date_sub(anchor, 7), cnt)), F.lit(0)).cast("bigint").alias(
            "same_day_last_week_total"
        ),
        F.coalesce(F.sum(F.when(d >= start7, cnt)), F.lit(0)).cast("bigint").alias("last7_total"),
        F.coalesce(F.sum(F.when(d < start7, cnt)), F.lit(0)).cast("bigint").alias("prior7_total"),
        F.count_distinct(F.when(d == anchor, F.col("location_id"))).alias("sensors_reporting"),
    )

    def pct(a: str, b: str) -> Column:
        return F.when(F.col(b) != 0, (F.try_divide(F.col(a), F.col(b)) - 1) * 100)

    top = busiest(daily, anchor)
    return agg.select(
        anchor.alias("anchor_date"),
        "day_total",
        "same_day_last_week_total",
        pct("day_total", "same_day_last_week_total").alias("day_delta_pct"),
        "last7_total",
        "prior7_total",
        pct("last7_total", "prior7_total").alias("week_delta_pct"),
        "sensors_reporting",
        top.select("busiest_location").scalar().alias("busiest_location"),
    )


def kpi_labels(k: DataFrame) -> DataFrame:
    """Display strings for the KPI row."""
    return k.select(
        "anchor_date",
        labels.compact_number(F.col("day_total")).alias("day_total_label"),
        labels.signed_percent(F.col("day_delta_pct")).alias("day_delta_label"),
        labels.compact_number(F.col("last7_total")).alias("last7_total_label"),
        labels.signed_percent(F.col("week_delta_pct")).alias("week_delta_label"),
        F.col("sensors_reporting").cast("string").alias("sensors_label"),
        F.date_format("anchor_date", "dd MMM yyyy").alias("data_through_label"),
    )


def top_locations(daily: DataFrame, anchor: Column, k: int = 10, days: int = 28) -> DataFrame:
    """The ``k`` names with the largest total over ``days``.

    A top-k: ``TakeOrderedAndProject`` keeps k rows per task, so only k x
    tasks rows reach the final merge.  ``rank`` 1 is the busiest.
    """
    last = trailing(daily, DATE, anchor, days)
    per = last.groupBy("location_name").agg(F.sum("daily_count").cast("bigint").alias("total_count"))
    order = [F.col("total_count").desc(), F.col("location_name").asc()]
    top = per.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def location_map(daily: DataFrame, anchor: Column, days: int = 28) -> DataFrame:
    """Mean daily count and coordinates per location over ``days``.

    Coordinates are constant per location, so ``min`` is the deterministic
    equal of "first non-null" (T8).
    """
    last = trailing(daily, DATE, anchor, days)
    per = last.groupBy("location_id", "location_name").agg(
        F.avg("daily_count").alias("avg_daily"),
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
    )
    return per.dropna(subset=["latitude", "longitude"]).select(
        "location_id",
        "location_name",
        "avg_daily",
        "latitude",
        "longitude",
        labels.marker_radius(F.col("avg_daily")).alias("radius"),
        labels.thousands(F.col("avg_daily")).alias("avg_label"),
    )


def city_daily(daily: DataFrame) -> DataFrame:
    """Citywide total per date."""
    return daily.groupBy(DATE).agg(F.sum("daily_count").cast("bigint").alias("daily_count"))


def rolling_mean(col: str, order: list[str], partition: list[str] | None = None, rows: int = 7) -> Column:
    """Mean over the current and ``rows - 1`` preceding *rows* (not days, T5)."""
    w = Window.orderBy(*order).rowsBetween(-(rows - 1), 0)
    if partition:
        w = w.partitionBy(*partition)
    return F.avg(col).over(w)


def city_trend(daily: DataFrame, anchor: Column, days: int | None = 90) -> DataFrame:
    """Citywide daily totals over ``days`` (None: all) with a 7-row rolling
    mean (A12, W3).

    The range filter runs before the window, as in the reference; the window
    sees one row per date.
    """
    city = city_daily(daily)
    city = city if days is None else trailing(city, DATE, anchor, days)
    return city.withColumn("rolling7", rolling_mean("daily_count", [DATE]))


def location_trend(daily: DataFrame, anchor: Column, days: int = 365) -> DataFrame:
    """Per-name daily series with a 7-row rolling mean.

    Window groups are one name's rows over ``days`` dates: bounded by the
    number of ids sharing a name times ``days``.
    """
    last = trailing(daily, DATE, anchor, days)
    return last.select(
        "location_name",
        "location_id",
        DATE,
        "daily_count",
        rolling_mean("daily_count", [DATE, "location_id"], ["location_name"]).alias("rolling7"),
    )


def week_rhythm(profile: DataFrame) -> DataFrame:
    """Sum of ``avg_count`` per weekday and hour, hours as 24 columns ``h00``..``h23``,
    one row per weekday Monday..Sunday, absent weekdays kept as nulls (A14)."""
    hours = list(range(24))
    piv = profile.groupBy("day_name").pivot("hour_of_day", hours).agg(F.sum("avg_count"))
    piv = piv.select("day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    # Seven weekday names from a rule (2024-01-01 is a Monday).
    week = profile.sparkSession.range(7).select(
        (F.col("id") + 1).cast("int").alias("day_order"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "EEEE").alias(
            "day_name"
        ),
    )
    return F.broadcast(week).join(piv, "day_name", "left").select("day_order", "day_name", *[f"h{h:02d}" for h in hours])


def location_profile(profile: DataFrame) -> DataFrame:
    """Observation-weighted mean per name, weekend flag and hour."""
    return profile.groupBy("location_name", "is_weekend", "hour_of_day").agg(
        F.try_divide(F.sum(F.col("avg_count") * F.col("n_observations")), F.sum("n_observations")).alias(
            "avg_count"
        )
    )


def location_names(daily: DataFrame) -> DataFrame:
    """Distinct non-null names, sorted (O3)."""
    return daily.select("location_name").dropna().distinct().orderBy("location_name")
