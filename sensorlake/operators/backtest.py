"""Rolling-origin backtest scores.

Fold k (1..folds) has cutoff = anchor - 7k; it trains on rows dated on or
before the cutoff and is scored on the following 7 days.  The test windows
of the folds are disjoint, so every test row carries its fold index
``floor((anchor - date) / 7) + 1`` and all folds are scored in one grouped
aggregate; only model fitting needs one job per fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TARGET

MODEL, NAIVE = "model", "seasonal_naive"
METRIC_COLS = ["scope", "fold_cutoff", "method", "n_rows", "mae", "wape", "band_coverage"]


def trainable(feat: DataFrame) -> DataFrame:
    """Rows with a lag mean and a target."""
    return feat.filter(F.col("lag_mean_4w").isNotNull() & F.col(TARGET).isNotNull())


def fold_of(date: Column, anchor: Column) -> Column:
    return F.floor(F.datediff(anchor, date) / 7).cast("int") + 1


def test_rows(feat: DataFrame, anchor: Column, folds: int) -> DataFrame:
    """Scored rows of every fold with ``fold`` and ``fold_cutoff`` (P14):
    date in (cutoff, cutoff + 7], target and lag_7d present."""
    k = fold_of(F.col("sensing_date"), anchor)
    return (
        feat.filter(
            (F.col("sensing_date") <= anchor)
            & F.col(TARGET).isNotNull()
            & F.col("lag_7d").isNotNull()
        )
        .withColumn("fold", k)
        .filter((F.col("fold") >= 1) & (F.col("fold") <= folds))
        .withColumn("fold_cutoff", F.date_sub(anchor, F.col("fold") * 7))
    )


def score(scored: DataFrame, anchor: Column, folds: int, with_model: bool) -> DataFrame:
    """Metrics table from test rows.

    ``scored`` has fold, target, lag_7d and, when ``with_model``, p10/p50/p90.
    Folds without test rows still get a row (n_rows 0, null ratios).
    """
    actual = F.col(TARGET).cast("double")
    methods = [F.struct(F.lit(NAIVE).alias("method"), F.col("lag_7d").cast("double").alias("point"),
                        F.lit(None).cast("boolean").alias("covered"))]
    if with_model:
        covered = (actual >= F.col("p10")) & (actual <= F.col("p90"))
        methods.insert(0, F.struct(F.lit(MODEL).alias("method"), F.col("p50").alias("point"),
                                   covered.alias("covered")))
    long = scored.select("fold", actual.alias("actual"), F.explode(F.array(*methods)).alias("m")).select(
        "fold", "actual", "m.method", "m.point", "m.covered"
    )
    per_fold = long.groupBy("fold", "method").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.abs(F.col("actual") - F.col("point"))).alias("sum_abs_err"),
        F.sum("actual").alias("sum_actual"),
        F.avg(F.col("covered").cast("double")).alias("band_coverage"),
    )
    # Every (fold, method) pair, from the fold count and method list.
    names = [MODEL, NAIVE] if with_model else [NAIVE]
    grid = scored.sparkSession.range(1, folds + 1).select(
        F.col("id").cast("int").alias("fold"), F.explode(F.array(*[F.lit(n) for n in names])).alias("method")
    )
    per_fold = F.broadcast(grid).join(per_fold, ["fold", "method"], "left").select(
        "fold",
        "method",
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("sum_abs_err", F.lit(0.0)).alias("sum_abs_err"),
        F.coalesce("sum_actual", F.lit(0.0)).alias("sum_actual"),
        F.when(F.col("method") == MODEL, F.col("band_coverage")).alias("band_coverage"),
    )
    # Each (fold, method) row also feeds its method's overall row; one small
    # aggregate yields both (sums of sums, unweighted mean of fold coverages).
    scopes = F.array(
        F.struct(F.lit("fold").alias("scope"), F.col("fold").alias("key")),
        F.struct(F.lit("overall").alias("scope"), F.lit(None).cast("int").alias("key")),
    )
    both = (
        per_fold.select("*", F.explode(scopes).alias("s"))
        .groupBy(F.col("s.scope").alias("scope"), F.col("s.key").alias("fold"), "method")
        .agg(
            F.sum("n_rows").cast("bigint").alias("n_rows"),
            F.sum("sum_abs_err").alias("sum_abs_err"),
            F.sum("sum_actual").alias("sum_actual"),
            F.avg("band_coverage").alias("band_coverage"),
        )
    )
    return both.select(
        "scope",
        F.date_sub(anchor, F.col("fold") * 7).alias("fold_cutoff"),
        "method",
        "n_rows",
        F.try_divide(F.col("sum_abs_err"), F.col("n_rows").cast("double")).alias("mae"),
        F.try_divide(F.col("sum_abs_err"), F.col("sum_actual")).alias("wape"),
        "band_coverage",
    )


def naive_backtest(feat: DataFrame, anchor: Column, folds: int = 4) -> DataFrame:
    """Seasonal-naive (same hour one week earlier) scores per fold and overall (M5)."""
    return score(test_rows(feat, anchor, folds), anchor, folds, with_model=False)
