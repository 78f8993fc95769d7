"""Registry of checked queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads whole shared tables through a fixture mapping
(``sensorlake.sources.fixtures``) and runs library operators on them.
Doubles are rounded to 6 decimals at the output edge only, so that the
order-insensitive hash against the DuckDB oracle is stable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import labels as lb
from ..operators import anchor as anc
from ..operators import backtest as bt
from ..operators import features as ft
from ..operators import forecast_reports as fr
from ..operators import marts, staging
from ..operators import quality as dq
from ..operators import reports as rp
from ..operators.boosting import BoostParams, Forest
from ..operators.forest import CATEGORY, LEAF
from ..operators.quantile import bands, raw_scores
from ..schemas import TARGET
from ..sources import export as ex
from ..sources import fixtures as fx
from ..sources import fs
from ..sources import readers as rd
from ..sources import refresh as rf
from ..sources import versions
from ..streaming import landing as ls
from . import incremental as inc
from .forecast import backtest_only, forecast_mart, forecastable
from .forecast import forecast as run_forecast
from .warehouse import build_warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (output edge only)."""
    cols = [
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def wh_f2(spark: SparkSession, sf: str, materialize: bool = False):
    return build_warehouse(fx.f2_counts(spark, sf), fx.f3_sensors(spark, sf), materialize=materialize)


def wh_f1(spark: SparkSession, sf: str, materialize: bool = False):
    return build_warehouse(fx.f1_counts(spark, sf), fx.f3_sensors(spark, sf), materialize=materialize)


# ---------------------------------------------------------------- staging and marts


@query("stg_counts_dedup")
def q_stg_counts(spark, sf):
    return staging.stage_counts(fx.f2_counts(spark, sf))


@query("stg_sensors_latest")
def q_stg_sensors(spark, sf):
    return rounded(staging.stage_sensors(fx.f3_sensors(spark, sf)))


@query("fct_hourly")
def q_fct(spark, sf):
    return marts.hourly_fact(staging.stage_counts(fx.f1_counts(spark, sf)))


@query("dim_sensors")
def q_dim(spark, sf):
    return rounded(wh_f2(spark, sf).dim_sensors)


@query("mart_daily")
def q_daily(spark, sf):
    return rounded(wh_f2(spark, sf).mart_daily_location)


@query("mart_profile")
def q_profile(spark, sf):
    return rounded(wh_f2(spark, sf).mart_hourly_profile)


# ---------------------------------------------------------------- data quality



@query("dq_suite")
def q_dq_suite(spark, sf):
    # The suite reads the staging counts about eight times (checks, fact,
    # dimension, marts): materialise them once, as the pipeline does.
    return dq.run_suite(dq.warehouse_checks(wh_f2(spark, sf, materialize=True)))


@query("dq_suite_f1")
def q_dq_suite_f1(spark, sf):
    return dq.run_suite(dq.warehouse_checks(wh_f1(spark, sf, materialize=True)))


@query("dq_duplicate_ids")
def q_dq_dup_ids(spark, sf):
    return dq.unique(fx.f2_counts(spark, sf), ["id"])


@query("dq_duplicate_cells")
def q_dq_dup_cells(spark, sf):
    stg = staging.stage_counts(fx.f2_counts(spark, sf))
    return dq.unique_combination(stg, ["location_id", "sensing_date", "hour_of_day"])


@query("dq_orphans")
def q_dq_orphans(spark, sf):
    wh = wh_f2(spark, sf)
    return dq.relationships(wh.fct_hourly_counts, "location_id", wh.dim_sensors, "location_id")


# ---------------------------------------------------------------- anchor and reports


def daily_at_anchor(wh):
    """The daily mart written once and read back (reports read a stored mart,
    with its pruning and push-down), its anchor as a literal, and the mart cut
    at the anchor."""
    spark = wh.mart_daily_location.sparkSession
    path = f"{fs.scratch_dir(spark, 'daily')}/mart_daily_location"
    ex.write_mart(wh.mart_daily_location, path)
    daily = rd.read_mart(spark, path)
    a = anc.anchor_literal(daily, weight="hours_reported")
    return anc.cut_at(daily, a), a


@query("anchor_date")
def q_anchor(spark, sf):
    wh = wh_f2(spark, sf)
    return anc.anchor_date(wh.mart_daily_location, weight="hours_reported")


@query("anchor_date_f1")
def q_anchor_f1(spark, sf):
    return anc.anchor_date(wh_f1(spark, sf).fct_hourly_counts)


@query("coverage_threshold")
def q_cov_thr(spark, sf):
    cov = anc.coverage(wh_f2(spark, sf).fct_hourly_counts)
    return rounded(anc.coverage_threshold(cov))


@query("kpis")
def q_kpis(spark, sf):
    daily, a = daily_at_anchor(wh_f1(spark, sf))
    return rounded(rp.kpis(daily, a))


@query("kpis_f2")
def q_kpis_f2(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rounded(rp.kpis(daily, a))


@query("kpi_labels")
def q_kpi_labels(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rp.kpi_labels(rp.kpis(daily, a))


@query("busiest")
def q_busiest(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rp.busiest(daily, a)


@query("top_locations")
def q_top(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rp.top_locations(daily, a)


@query("location_map")
def q_map(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rounded(rp.location_map(daily, a))


@query("city_trend_90")
def q_city90(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rounded(rp.city_trend(daily, a, 90))


@query("city_trend_all")
def q_city_all(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rounded(rp.city_trend(daily, a, None))


@query("location_trend")
def q_loc_trend(spark, sf):
    daily, a = daily_at_anchor(wh_f2(spark, sf))
    return rounded(rp.location_trend(daily, a, 365))


@query("week_rhythm")
def q_rhythm(spark, sf):
    return rounded(rp.week_rhythm(wh_f2(spark, sf).mart_hourly_profile))


@query("week_rhythm_f1")
def q_rhythm_f1(spark, sf):
    return rounded(rp.week_rhythm(wh_f1(spark, sf).mart_hourly_profile))


@query("location_profile")
def q_loc_profile(spark, sf):
    return rounded(rp.location_profile(wh_f2(spark, sf).mart_hourly_profile))


@query("location_names")
def q_names(spark, sf):
    daily, _ = daily_at_anchor(wh_f2(spark, sf))
    return rp.location_names(daily)


# ---------------------------------------------------------------- refresh and export



def _f2_dates(spark, sf):
    src = fx.f2_counts(spark, sf)
    stored = src.agg(F.max("sensing_date").alias("stored_max"))
    today = F.date_add(stored.scalar(), 3)
    return src, stored, today


@query("month_plan")
def q_month_plan(spark, sf):
    """Months re-read by an incremental run (7-day lookback from the stored max,
    ``today`` = stored max + 3) and by a full run, over F2."""
    src, stored, today = _f2_dates(spark, sf)
    smin = rf.source_min_date(src)
    inc = rf.months(rf.refresh_window(stored, smin, today)).withColumn("mode", F.lit("incremental"))
    full = rf.months(rf.refresh_window(stored, smin, today, full=True)).withColumn("mode", F.lit("full"))
    return inc.unionByName(full)


@query("refresh_counts")
def q_refresh(spark, sf):
    """Full refresh of F2 into a fresh folder, then an incremental one from a
    source whose last five days of counts changed (late corrections); the
    stored table must equal the current source."""
    src = fx.f2_counts(spark, sf)
    dest = fs.scratch_dir(spark, "refresh")
    last = src.agg(F.max("sensing_date")).collect()[0][0]
    rf.refresh(spark, src, dest, today=last, full=True)
    # Second run: the newest rows arrive late with changed counts.
    changed = src.withColumn(
        "pedestriancount",
        F.when(F.col("sensing_date") > F.date_sub(F.lit(last), 5), F.col("pedestriancount") + 1).otherwise(
            F.col("pedestriancount")
        ),
    )
    rf.refresh(spark, changed, dest, today=last)
    return rd.read_counts(spark, dest)


def incremental_f2(spark, sf):
    """F2 in the incremental store: all months from a source that lacks some
    readings and has others wrong or a month late, then the newest months and
    every month they moved from, as they are."""
    src, root = fx.f2_counts(spark, sf), fs.scratch_dir(spark, "store")
    date = F.col("sensing_date")
    month = inc.month_of(date)
    # Each month, its first day, and the first day three months later.
    first = F.trunc(F.max(date), "month")
    held = src.groupBy(month).agg(first, F.add_months(first, 3)).collect()
    newest_first = max(r[1] for r in held if r[1])
    cut = F.lit(newest_first).cast("date")
    late = date >= F.add_months(cut, -2)
    moved = late & (F.col("id") % 7 == 0)
    wrong = src.filter(~(late & (F.col("id") % 97 == 0)))
    wrong = wrong.withColumn("pedestriancount", F.col("pedestriancount") + F.when(late, 1).otherwise(0))
    wrong = wrong.withColumn("sensing_date", F.when(moved, F.add_months(date, -1)).otherwise(date))
    every = [r[0] for r in held]
    newest = [r[0] for r in held if r[2] and r[2] >= newest_first]
    inc.refresh(spark, wrong, every, root)
    inc.refresh(spark, src.filter(month.isin(newest)), newest, root)
    return root


@query("incremental_staging")
def q_incremental_staging(spark, sf):
    """Staging counts of F2 after an incremental refresh."""
    root = incremental_f2(spark, sf)
    return inc.read(spark, root, inc.STAGED, versions.current(spark, root))


@query("incremental_daily")
def q_incremental_daily(spark, sf):
    """Daily mart of F2 from the months' stored totals (A1, A2)."""
    return rounded(inc.warehouse(spark, incremental_f2(spark, sf), fx.f3_sensors(spark, sf)).mart_daily_location)


@query("incremental_profile")
def q_incremental_profile(spark, sf):
    """Trailing profile of F2 from the months of its window."""
    return rounded(inc.warehouse(spark, incremental_f2(spark, sf), fx.f3_sensors(spark, sf)).mart_hourly_profile)


@query("export_audit")
def q_export(spark, sf):
    """Export the three marts of F2 and return the rows written per mart."""
    wh = wh_f2(spark, sf, materialize=True)
    tables = {
        "dim_sensors": wh.dim_sensors,
        "mart_daily_location": wh.mart_daily_location,
        "mart_hourly_profile": wh.mart_hourly_profile,
    }
    return ex.export_marts(spark, tables, fs.scratch_dir(spark, "marts"))


@query("export_roundtrip")
def q_export_roundtrip(spark, sf):
    """Daily mart of F1 written as a zstd mart and read back."""
    d = fs.scratch_dir(spark, "marts")
    wh = wh_f1(spark, sf)
    ex.export_marts(spark, {"mart_daily_location": wh.mart_daily_location}, d)
    return rounded(rd.read_mart(spark, f"{d}/mart_daily_location"))


# ---------------------------------------------------------------- features and naive backtest



def obs_of(raw):
    return rd.observations(marts.hourly_fact(staging.stage_counts(raw)))


def obs_f1(spark, sf):
    return obs_of(fx.f1_counts(spark, sf))


def obs_f2d(spark, sf):
    return obs_of(fx.f2d_counts(spark, sf))


LAG_OUT = ["location_id", "sensing_date", "hour_of_day", TARGET, *ft.LAG_COLS, "lag_mean_4w"]


@query("holidays")
def q_holidays(spark, sf):
    return cal.holidays(spark, cal.years_of(fx.f2_counts(spark, sf), "sensing_date"))


@query("holidays_f1")
def q_holidays_f1(spark, sf):
    return cal.holidays(spark, cal.years_of(fx.f1_counts(spark, sf), "sensing_date"))


def _lags(obs, method):
    out = ft.add_lags(obs, obs, method=method)
    return rounded(out.withColumn("lag_mean_4w", ft.row_mean(ft.LAG_COLS)).select(*LAG_OUT))


@query("lag_features")
def q_lags_join(spark, sf):
    return _lags(obs_f1(spark, sf), "join")


@query("lag_features_shift")
def q_lags_shift(spark, sf):
    return _lags(obs_f1(spark, sf), "shift")


@query("lag_features_f2d")
def q_lags_f2d(spark, sf):
    return _lags(obs_f2d(spark, sf), "shift")


@query("calendar_features")
def q_calendar(spark, sf):
    obs = obs_f1(spark, sf)
    return rounded(ft.featurize(obs, obs, lag_method="shift"))


@query("future_frame")
def q_future(spark, sf):
    obs = obs_f1(spark, sf)
    return rounded(ft.future_frame(obs, anc.anchor_literal(obs), lag_method="shift"))


@query("future_frame_2026")
def q_future_2026(spark, sf):
    """F1 moved to end on 2025-12-28: the horizon's holidays are next year's."""
    obs = obs_f1(spark, sf)
    late = F.datediff(F.lit("2025-12-28").cast("date"), obs.agg(F.max("sensing_date")).scalar())
    obs = obs.withColumn("sensing_date", F.date_add("sensing_date", late))
    return rounded(ft.future_frame(obs, anc.anchor_literal(obs), lag_method="shift"))


@query("naive_backtest")
def q_naive(spark, sf):
    obs = obs_f1(spark, sf)
    feat = ft.featurize(obs, obs, lag_method="shift")
    return rounded(bt.naive_backtest(feat, anc.anchor_literal(obs), folds=4))


@query("naive_backtest_f2d")
def q_naive_f2d(spark, sf):
    obs = obs_f2d(spark, sf)
    feat = ft.featurize(obs, obs, lag_method="shift")
    return rounded(bt.naive_backtest(feat, anc.anchor_literal(obs), folds=4))


# ---------------------------------------------------------------- forecast reports



def naive_forecast_mart(obs, anchor, horizon_days=7):
    """Forecast-mart stand-in for the report checks: a seasonal-naive
    forecast (p50 = lag_7d, or the four-week lag mean when that week is
    missing; band = min/max of the weekly lags) for the future frame, in the
    mart's columns."""
    fut = forecastable(ft.future_frame(obs, anchor, horizon_days, lag_method="shift"))
    lags = [F.col(c) for c in ft.LAG_COLS]
    band = {
        "p10": F.least(*lags).cast("double"),
        "p50": F.coalesce(F.col("lag_7d"), F.col("lag_mean_4w")).cast("double"),
        "p90": F.greatest(*lags).cast("double"),
    }
    return forecast_mart(fut.withColumns(band), anchor)


def forecast_setup(spark, sf, today_offset=1):
    """F1 warehouse, its daily mart cut at the anchor, a seasonal-naive
    forecast mart, and ``today`` = anchor + ``today_offset`` days.  The
    staging counts feed both the mart and the observations, so they are
    materialised once."""
    wh = wh_f1(spark, sf, materialize=True)
    daily, a = daily_at_anchor(wh)
    obs = rd.observations(wh.fct_hourly_counts)  # a projection of the materialised staging
    fc = naive_forecast_mart(obs, anc.anchor_literal(obs)).drop("generated_at")
    return daily, fc, a, F.date_add(a, today_offset)


@query("forecast_status")
def q_fc_status(spark, sf):
    _, fc, a, today = forecast_setup(spark, sf)
    return fr.forecast_status(fc, a, today)


@query("forecast_status_stale")
def q_fc_status_stale(spark, sf):
    _, fc, a, today = forecast_setup(spark, sf, today_offset=30)
    return fr.forecast_status(fc, a, today)


@query("forecast_panel")
def q_fc_panel(spark, sf):
    daily, fc, a, today = forecast_setup(spark, sf, today_offset=3)
    return rounded(fr.forecast_panel(daily, fc, a, today))


@query("forecast_coverage")
def q_fc_cov(spark, sf):
    daily, fc, a, today = forecast_setup(spark, sf, today_offset=2)
    return rounded(fr.forecast_coverage(daily, fc, a, today))


@query("location_forecast")
def q_loc_fc(spark, sf):
    daily, fc, a, today = forecast_setup(spark, sf)
    return rounded(fr.location_forecast(daily, fc, a, today))


@query("compare_methods_naive")
def q_compare_naive(spark, sf):
    """Method comparison over the naive backtest (model columns null)."""
    obs = obs_f1(spark, sf)
    m = bt.naive_backtest(ft.featurize(obs, obs, lag_method="shift"), anc.anchor_literal(obs), folds=4)
    return rounded(fr.compare_methods(m))


# ---------------------------------------------------------------- quantile models (rows-only checks)


#: Rounds chosen by the error out of sample (README, "Model check"): on these
#: tables it is lowest after some ten steps of 0.2.
FIT = BoostParams(rounds=10, learning_rate=0.2)


@query("quantile_forecast")
def q_quantile_forecast(spark, sf):
    """Forecast mart of F1 from the boosted quantile models (no backtest)."""
    res = run_forecast(obs_f1(spark, sf), folds=0, params=FIT)
    return res.forecast.drop("generated_at")


@query("model_backtest")
def q_model_backtest(spark, sf):
    """Four-fold backtest of the boosted quantile models vs seasonal-naive on F2d."""
    return backtest_only(obs_f2d(spark, sf), folds=4, params=FIT)


@query("compare_methods")
def q_compare(spark, sf):
    return fr.compare_methods(backtest_only(obs_f2d(spark, sf), folds=4, params=FIT))


# ---------------------------------------------------------------- streaming ingest



@query("landing_stream_ingest")
def q_landing_stream(spark, sf):
    """F2 landed as exports in two waves: first the months before the newest,
    then the newest with the month before it again, its counts corrected and
    some ids withdrawn.  An available-now stream after each wave maintains the
    raw table."""
    src = fx.f2_counts(spark, sf).drop("month")
    landing, dest = fs.scratch_dir(spark, "landing"), fs.scratch_dir(spark, "landed")
    ckpt = fs.scratch_dir(spark, "landing-ckpt")
    cut = src.agg(F.max("sensing_date")).collect()[0][0]
    cut = cut.replace(day=1)
    ls.land_months(src.filter(F.col("sensing_date") < F.lit(cut)), landing)
    ls.start_landing_ingest(spark, landing, dest, ckpt).awaitTermination()
    # Second wave: the newest month, plus a complete re-export of the month before.
    date = F.col("sensing_date")
    again = (date >= F.add_months(F.lit(cut), -1)) & (date < F.lit(cut))
    fixed = src.withColumn("pedestriancount", F.col("pedestriancount") + F.when(again, 1).otherwise(0))
    ls.land_months(fixed.filter((date >= F.lit(cut)) | again & (F.col("id") % 97 != 0)), landing)
    ls.start_landing_ingest(spark, landing, dest, ckpt).awaitTermination()
    return staging.stage_counts(rd.read_counts(spark, dest))


# ---------------------------------------------------------------- publication and read-back



@query("forecast_readback")
def q_fc_readback(spark, sf):
    """Forecast and metrics marts written (S13) and read back with ``ts``."""
    obs = obs_f1(spark, sf)
    a = anc.anchor_literal(obs)
    fc = naive_forecast_mart(obs, a).drop("generated_at")
    metrics = bt.naive_backtest(ft.featurize(obs, obs, lag_method="shift"), a, folds=4)
    d = fs.scratch_dir(spark, "fc-marts")
    ex.export_marts(spark, {"mart_forecast": fc, "mart_forecast_metrics": metrics}, d)
    got, _ = rd.read_forecast(spark, d)
    return rounded(got)


@query("staged_table")
def q_staged_table(spark, sf):
    """``stg_counts`` of F2 published as a table (S16) and read back."""
    stg = staging.stage_counts(fx.f2_counts(spark, sf))
    return ex.publish(stg, "stg_counts_f2", "table", fs.scratch_dir(spark, "stg"))


@query("rhythm_cells")
def q_rhythm_cells(spark, sf):
    """Weekly rhythm as heatmap cells with zero-padded hour labels."""
    prof = wh_f2(spark, sf).mart_hourly_profile
    cells = prof.groupBy("day_name", "hour_of_day").agg(F.sum("avg_count").alias("avg_count"))
    return rounded(cells.select("day_name", lb.hour_label(F.col("hour_of_day")).alias("hour_label"), "avg_count"))


# ---------------------------------------------------------------- fixed bands, labels, read-backs



@query("lag_features_f2")
def q_lags_f2(spark, sf):
    """Lags on a grain that is not unique: rows multiply."""
    return _lags(obs_of(fx.f2_counts(spark, sf)), "multiset")


@query("holiday_flags")
def q_holiday_flags(spark, sf):
    """Holidays among four days from each shipment, per year."""
    days = F.array(*[F.date_add(F.to_date("l_shipdate"), d) for d in range(4)])
    frame = fx.table(spark, sf, "lineitem").select(F.explode(days).alias("sensing_date"))
    flagged = ft.add_calendar(frame)
    return flagged.groupBy(F.year("sensing_date").cast("bigint").alias("year")).agg(
        F.count("*").alias("days"), F.sum(F.col("is_holiday").cast("bigint")).alias("holidays")
    )


def band_test(spark, sf, folds=4):
    """F2d test rows with a fixed band: least, mean and greatest lag."""
    obs = obs_f2d(spark, sf)
    anchor = anc.anchor_literal(obs)
    rows = bt.test_rows(ft.featurize(obs, obs, lag_method="shift"), anchor, folds)
    lags = [F.col(c) for c in ft.LAG_COLS]
    rows = rows.withColumns({"p10": F.least(*lags), "p50": F.col("lag_mean_4w"), "p90": F.greatest(*lags)})
    return bt.score(rows, anchor, folds, with_model=True)


@query("band_scores")
def q_band_scores(spark, sf):
    """Output stage of the quantile models on fixed raw scores."""
    obs = obs_f2d(spark, sf)
    feat = bt.trainable(ft.featurize(obs, obs, lag_method="shift"))
    feat = feat.filter(F.col("lag_7d").isNotNull() & F.col("lag_14d").isNotNull() & F.col("lag_21d").isNotNull())
    raw = {
        "p10": F.log1p("lag_7d"),
        "p50": F.log1p("lag_14d") - 0.1,
        "p90": F.lit(0.3) - F.log1p("lag_21d"),
    }
    return rounded(feat.select("location_id", "sensing_date", "hour_of_day", *bands(raw)))


#: Two trees with a category, missing values on either side, and a flag.
FIXED_FOREST = Forest(0.5, 1.0, [
    {
        "feature": [9, CATEGORY, LEAF, LEAF, 0, LEAF, LEAF],
        "cut": [30.0, 0.0, 0.0, 0.0, 11.0, 0.0, 0.0],
        "missing_left": [False] * 7,
        "left_set": [[], [1, 3, 4], [], [], [], [], []],
        "right": [4, 3, 0, 0, 6, 0, 0],
        "value": [0.0, 0.0, 0.5, 0.25, 0.0, -0.75, 1.5],
        "depth": 2,
    },
    {
        "feature": [5, LEAF, 2, LEAF, LEAF],
        "cut": [10.0, 0.0, 0.0, 0.0, 0.0],
        "missing_left": [True, False, False, False, False],
        "left_set": [[]] * 5,
        "right": [2, 0, 4, 0, 0],
        "value": [0.0, 0.125, 0.0, -0.5, 2.0],
        "depth": 2,
    },
])


@query("forest_scores")
def q_forest_scores(spark, sf):
    """Scores of a fixed forest on all rows of F2d, missing lags included (M4)."""
    obs = obs_f2d(spark, sf)
    scored = raw_scores(ft.featurize(obs, obs, lag_method="shift"), {"p50": FIXED_FOREST})
    return rounded(scored.select("location_id", "sensing_date", "hour_of_day", F.col("_raw_p50").alias("score")))


@query("local_dates")
def q_local_dates(spark, sf):
    """Events by their date in a named zone."""
    events = fx.table(spark, sf, "events").select("ts", cal.local_date("ts", "Australia/Melbourne").alias("local_date"))
    return events.groupBy("local_date").agg(F.count("*").alias("events"), F.max(F.to_date("ts")).alias("last_utc_date"))


@query("forecast_stamp")
def q_forecast_stamp(spark, sf):
    """Forecastable rows per location, stamped with the run's time."""
    obs = obs_f1(spark, sf)
    fc = naive_forecast_mart(obs, anc.anchor_literal(obs))
    at = F.max("generated_at")
    fresh = (at <= F.current_timestamp()) & (at > F.current_timestamp() - F.expr("INTERVAL 1 DAY"))
    return fc.groupBy("location_id", "anchor_date").agg(
        F.count("*").alias("rows"), (F.min("generated_at") == at).alias("one_stamp"), fresh.alias("stamped_today")
    )


@query("band_backtest")
def q_band_backtest(spark, sf):
    """Scores of a fixed band and of the baseline."""
    return rounded(band_test(spark, sf))


@query("compare_methods_band")
def q_compare_band(spark, sf):
    return rounded(fr.compare_methods(band_test(spark, sf)))


@query("forecast_labels")
def q_forecast_labels(spark, sf):
    """Labels of F2d's fixed band and of F1's forecast coverage."""
    daily, fc, a, today = forecast_setup(spark, sf, today_offset=2)
    coverage = fr.forecast_coverage(daily, fc, a, today)
    return fr.forecast_labels(fr.compare_methods(band_test(spark, sf)), coverage)


@query("sensors_refresh")
def q_sensors_refresh(spark, sf):
    """Sensor table replaced twice and read back."""
    dest = fs.scratch_dir(spark, "sensors")
    rf.refresh_sensors(fx.f3_sensors(spark, sf).limit(0), dest)
    rf.refresh_sensors(fx.f3_sensors(spark, sf), dest)
    return rounded(rd.read_sensors(spark, dest))


@query("marts_readback")
def q_marts_readback(spark, sf):
    """Rows of the three marts of F2, read back by their reader (S3)."""
    wh, d = wh_f2(spark, sf, materialize=True), fs.scratch_dir(spark, "marts")
    ex.export_marts(spark, {name: getattr(wh, name) for name in rd.MARTS}, d)
    counts = [df.agg(F.lit(n).alias("table"), F.count("*").alias("rows")) for n, df in rd.read_marts(spark, d).items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
