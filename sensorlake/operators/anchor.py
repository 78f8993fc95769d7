"""Coverage-based anchor date.

A feed's last days are incomplete while readings keep arriving.  The anchor
is the latest date with at least ``ratio`` times the median coverage (exact)
of the last ``tail`` dates present; reports and forecasts count from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(df: DataFrame, date_col: str = "sensing_date", weight: str | None = None) -> DataFrame:
    """Per-date coverage: row count, or the sum of ``weight`` (A5)."""
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.filter(F.col(date_col).isNotNull())
        .groupBy(F.col(date_col).alias("sensing_date"))
        .agg(measure.alias("coverage"))
    )


def coverage_threshold(cov: DataFrame, tail: int = 28, ratio: float = 0.8) -> DataFrame:
    """One row: ``ratio`` x median coverage of the ``tail`` latest dates.

    The tail is a top-k (bounded) so the exact median is cheap.
    """
    last = cov.orderBy(F.col("sensing_date").desc()).limit(tail)
    return last.agg((F.median("coverage") * F.lit(ratio)).alias("threshold"))


def anchor_date(
    df: DataFrame,
    date_col: str = "sensing_date",
    weight: str | None = None,
    tail: int = 28,
    ratio: float = 0.8,
) -> DataFrame:
    """One-row frame ``anchor_date``: latest date with coverage >= threshold."""
    cov = coverage(df, date_col, weight)
    thr = coverage_threshold(cov, tail, ratio).scalar()
    return cov.filter(F.col("coverage") >= thr).agg(F.max("sensing_date").alias("anchor_date"))


def anchor_literal(df: DataFrame, **kw) -> Column:
    """The anchor computed once on the driver (one scalar) as a literal, so
    every later predicate on it is a constant the optimizer can push down."""
    return F.lit(anchor_date(df, **kw).first()[0]).cast("date")


def cut_at(df: DataFrame, anchor: Column, date_col: str = "sensing_date") -> DataFrame:
    """Rows on or before the anchor."""
    return df.filter(F.col(date_col) <= anchor)
