"""Quantile forecasters: one boosted forest per quantile on log counts (M2-M4,
E13, E14, E16).

``operators.boosting`` fits all forests of all forecasters together,
``operators.forest`` scores them.  Missing lags stay missing (T13); the
location is a category, whatever the number of locations.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TARGET
from . import boosting, forest
from .boosting import BoostParams, Forest, Task  # noqa: F401
from .features import CALENDAR_COLS, LAG_COLS

QUANTILES = {"p10": 0.10, "p50": 0.50, "p90": 0.90}
NUMERIC_FEATURES = ["hour_of_day", *CALENDAR_COLS, *LAG_COLS, "lag_mean_4w"]


@dataclass
class QuantileForecaster:
    """Forests keyed by output column (M3)."""

    models: dict[str, Forest]


def category() -> Column:
    """The location as a category; a null one is a location of its own."""
    return F.coalesce(F.col("location_id").cast("long"), F.lit(-(2**63)))


def labelled(train: DataFrame) -> DataFrame:
    """Training rows: sensing_date, category, features, label = log1p(target)."""
    features = [F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]
    label = F.log1p(F.col(TARGET).cast("double")).alias("label")
    return train.select("sensing_date", category().alias("category"), *features, label)


def fit_all(
    data: DataFrame,
    last_days: list[dt.date],
    params: BoostParams | None = None,
    quantiles: dict[str, float] = QUANTILES,
) -> dict[dt.date, QuantileForecaster]:
    """One forecaster per last day of training, from ``labelled`` rows, all
    fitted in one pass (M3, E13)."""
    days = sorted(set(last_days), reverse=True)
    tasks = [Task(alpha, fold) for fold in range(len(days)) for alpha in quantiles.values()]
    rows = data.withColumn("fold", boosting.folds_of(F.col("sensing_date"), days)).filter("fold > 0")
    forests = iter(boosting.fit(rows, NUMERIC_FEATURES, tasks, params or BoostParams()))
    return {day: QuantileForecaster({name: next(forests) for name in quantiles}) for day in days}


def uncrossed(cols: list[Column]) -> list[Column]:
    """Row-wise ascending sort of the quantile columns."""
    arr = F.array_sort(F.array(*cols))
    return [arr[i] for i in range(len(cols))]


def bands(raw: dict[str, Column]) -> list[Column]:
    """Raw scores by output name, ascending in quantile, as counts: expm1,
    clipped at 0, sorted row-wise (E13, E14, E16)."""
    counts = [F.greatest(F.expm1(c), F.lit(0.0)) for c in raw.values()]
    return [c.alias(n) for c, n in zip(uncrossed(counts), raw, strict=True)]


def raw_scores(frame: DataFrame, forests: dict[str, Forest], features: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """``frame`` with ``_raw_<name>``, the score by each forest."""
    packed = frame.withColumns({"_x": F.array(*[F.col(c).cast("double") for c in features]), "_category": category()})
    raw = {f"_raw_{n}": forest.scored(f, F.col("_x"), F.col("_category")) for n, f in forests.items()}
    return packed.withColumns(raw).drop("_x", "_category")


def predict(fc: QuantileForecaster, frame: DataFrame) -> DataFrame:
    """Frame + p10/p50/p90 on the count scale: expm1, clipped at 0, sorted
    row-wise so the band never crosses (M4, E13, E14, E16)."""
    names = sorted(fc.models, key=lambda n: fc.models[n].alpha)
    out = raw_scores(frame, {n: fc.models[n] for n in names})
    return out.select(*frame.columns, *bands({n: F.col(f"_raw_{n}") for n in names}))
