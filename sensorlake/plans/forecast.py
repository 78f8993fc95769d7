"""Backtest with the quantile models, final fit and the forecast marts (M6, M7).

The anchor is one scalar (collected), because every fold filters its
training rows on a literal cutoff.  Features are computed once and
checkpointed; the models of all folds, and those of the forecast, are fitted
in one pass, and all folds are scored together in one aggregate.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anchor as anc
from ..operators import backtest as bt
from ..operators import features as ft
from ..operators import quantile as qt
from ..session import checkpointed


@dataclass
class ForecastResult:
    forecast: DataFrame
    metrics: DataFrame | None  # None when folds = 0
    anchor: dt.date


def cutoffs(anchor: dt.date, folds: int) -> dict[int, dt.date]:
    return {k: anchor - dt.timedelta(days=7 * k) for k in range(1, folds + 1)}


def require_rows(train: DataFrame, anchor: dt.date, folds: int) -> None:
    """Refuse folds that end before the first training row."""
    first = train.agg(F.min("sensing_date")).first()[0]
    last = anchor - dt.timedelta(days=7 * folds)
    if first is None or first > last:
        raise ValueError(f"fold {folds} (cutoff {last}) has no training rows; use fewer folds")


def score_folds(feat: DataFrame, anchor: dt.date, folds: int, models: dict[dt.date, qt.QuantileForecaster]) -> DataFrame:
    """Metrics of fitted models and the seasonal-naive baseline on the same
    test rows, per fold and overall."""
    a = F.lit(anchor)
    # Some weeks of rows: every fold reads them, not the whole frame.
    tests = checkpointed(bt.test_rows(feat, a, folds))
    scored = [qt.predict(models[day], tests.filter(F.col("fold") == k)) for k, day in cutoffs(anchor, folds).items()]
    return bt.score(reduce(DataFrame.unionByName, scored), a, folds, with_model=True)


def model_backtest(feat: DataFrame, anchor: dt.date, folds: int, params: qt.BoostParams | None = None) -> DataFrame:
    """Rolling-origin backtest: every fold trains on rows up to its cutoff (M6)."""
    train = bt.trainable(feat)
    require_rows(train, anchor, folds)
    models = qt.fit_all(qt.labelled(train), list(cutoffs(anchor, folds).values()), params)
    return score_folds(feat, anchor, folds, models)


def prepare(obs: DataFrame, lag_method: str = "auto", holiday_dates: DataFrame | None = None):
    """Checkpointed observations, anchor (one scalar), checkpointed feature
    frame and the resolved lag method.

    The observations feed several reads (anchor, lag branches, active
    locations, future lags), so they are materialised once instead of
    re-deriving them from their source each time.
    """
    obs = checkpointed(obs)
    anchor = anc.anchor_date(obs).first()[0]
    if anchor is None:
        raise ValueError("no observations to anchor on")
    if lag_method == "auto":
        # Build with the one-shuffle method and read the duplicate flag back
        # from the checkpointed result (a scan that stops at the first hit);
        # only a non-unique grain is built again, row by row of its cells.
        feat = checkpointed(ft.featurize(obs, obs, holiday_dates, lag_method="shift", dup_flag=True))
        if feat.filter(F.col("_dup")).limit(1).collect():
            lag_method = "multiset"
            feat = checkpointed(ft.featurize(obs, obs, holiday_dates, lag_method="multiset"))
        else:
            lag_method = "shift"
            feat = feat.drop("_dup")
    else:
        feat = checkpointed(ft.featurize(obs, obs, holiday_dates, lag_method=lag_method))
    return obs, anchor, feat, lag_method


def backtest_only(obs: DataFrame, folds: int = 4, params: qt.BoostParams | None = None,
                  lag_method: str = "auto", holiday_dates: DataFrame | None = None) -> DataFrame:
    """Backtest metrics without the final fit (M6)."""
    _, anchor, feat, _ = prepare(obs, lag_method, holiday_dates)
    return model_backtest(feat, anchor, folds, params)


def forecastable(future: DataFrame) -> DataFrame:
    """Horizon rows with at least one weekly lag."""
    return future.filter(F.col("lag_mean_4w").isNotNull())


def forecast_mart(scored: DataFrame, anchor: dt.date, generated_at: dt.datetime | None = None) -> DataFrame:
    """Horizon rows with bands in the mart's columns, stamped with the anchor
    and the time of the run (M7, E10)."""
    stamp = F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp()
    return scored.select(
        F.col("location_id").cast("int").alias("location_id"),
        "sensing_date",
        "hour_of_day",
        "p10",
        "p50",
        "p90",
        F.lit(anchor).alias("anchor_date"),
        stamp.alias("generated_at"),
    )


def forecast(
    obs: DataFrame,
    horizon_days: int = 7,
    folds: int = 4,
    params: qt.BoostParams | None = None,
    lag_method: str = "auto",
    generated_at: dt.datetime | None = None,
    holiday_dates: DataFrame | None = None,
) -> ForecastResult:
    """Backtest, fit on history through the anchor, forecast ``horizon_days``
    per active location and hour (M7).  The models of the folds and of the
    forecast are fitted together; the marts are lazily defined.  A caller's
    ``holiday_dates`` (column ``holiday_date``) replace the generated ones."""
    obs, anchor, feat, lag_method = prepare(obs, lag_method, holiday_dates)
    train = bt.trainable(feat)
    if folds > 0:
        require_rows(train, anchor, folds)
    models = qt.fit_all(qt.labelled(train), [anchor, *cutoffs(anchor, folds).values()], params)
    metrics = score_folds(feat, anchor, folds, models) if folds > 0 else None
    future = forecastable(ft.future_frame(obs, F.lit(anchor), horizon_days, holiday_dates, lag_method))
    return ForecastResult(forecast_mart(qt.predict(models[anchor], future), anchor, generated_at), metrics, anchor)
