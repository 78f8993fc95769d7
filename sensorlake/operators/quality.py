"""Declarative data-quality checks.

A check yields the failing rows as a DataFrame; the suite turns a list of
checks into one results table ``(model, check, columns, severity, failures,
status)`` and ``enforce`` raises when an error-severity check failed.
Row-level checks of one model (not-null, ranges) are folded into a single
aggregate with ``count_if`` so they share one scan (R6); key checks are
aggregates, the referential check is a left-anti join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


# ---------------------------------------------------------------- failing rows


def unique(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """Key values (non-null) that occur more than once, with their count (Q1)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (
        df.filter(nonnull)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations of ``cols`` (nulls included) occurring more than once (Q5)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def not_null_condition(col: str) -> Column:
    return F.col(col).isNull()


def range_condition(col: str, lo=None, hi=None) -> Column:
    """Violation of an inclusive range; nulls are not violations (Q3)."""
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null (Q2)."""
    return df.filter(not_null_condition(col))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows outside ``[lo, hi]`` (Q3)."""
    return df.filter(range_condition(col, lo, hi))


def _parent_keys(parent: DataFrame, key: str, col: str) -> DataFrame:
    return parent.select(F.col(key).alias(col)).filter(F.col(col).isNotNull())


def relationships(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null ``col`` has no ``key`` in ``parent``."""
    return df.filter(F.col(col).isNotNull()).join(_parent_keys(parent, key, col), col, "left_anti")


def orphan_count(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """One row ``failures``: the number of orphaned child rows.

    Child rows are first counted per key (partial aggregation), so the
    anti join sees one row per distinct key: a key holding a third of the
    rows costs one row in the join, not a third of the data in one task.
    """
    per_key = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(_parent_keys(parent, key, col), col, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


# ---------------------------------------------------------------- suite


@dataclass
class Check:
    kind: str  # unique | not_null | accepted_range | relationships | unique_combination
    columns: list[str]
    severity: str = ERROR
    args: dict = field(default_factory=dict)


@dataclass
class ModelChecks:
    model: str
    df: DataFrame
    checks: list[Check]


def _label(check: Check) -> str:
    return ",".join(check.columns)


def _row(model: str, check: Check, failures: Column) -> list[Column]:
    return [
        F.lit(model).alias("model"),
        F.lit(check.kind).alias("check"),
        F.lit(_label(check)).alias("columns"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    ]


def _row_condition(c: Check) -> Column:
    if c.kind == "not_null":
        return not_null_condition(c.columns[0])
    return range_condition(c.columns[0], c.args.get("min"), c.args.get("max"))


def _model_results(mc: ModelChecks) -> list[DataFrame]:
    """Result rows of one model's checks.

    The model's first key check (unique / unique_combination) and all its
    row-level checks share ONE grouped aggregate keyed by that key: per group
    the row count and the violation counts, then a global sum.  A model with
    no key check gets one global ``count_if`` aggregate (R6).
    """
    out: list[DataFrame] = []
    row_level = [c for c in mc.checks if c.kind in ("not_null", "accepted_range")]
    keyed = [c for c in mc.checks if c.kind in ("unique", "unique_combination")]
    counts = [F.count_if(_row_condition(c)).alias(f"c{i}") for i, c in enumerate(row_level)]
    results: list[tuple[Check, Column]] = []
    if keyed:
        key = keyed.pop(0)
        per_key = mc.df.groupBy(*key.columns).agg(F.count(F.lit(1)).alias("_n"), *counts)
        dup = F.col("_n") > 1
        if key.kind == "unique":
            dup = dup & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key.columns])
        agg = per_key.agg(
            F.count_if(dup).alias("k"),
            *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(row_level))],
        )
        results.append((key, F.col("k")))
    elif row_level:
        agg = mc.df.agg(*counts)
    if results or row_level:
        results += [(c, F.col(f"c{i}")) for i, c in enumerate(row_level)]
        rows = F.array(*[F.struct(*_row(mc.model, c, v)) for c, v in results])
        out.append(agg.select(F.explode(rows).alias("r")).select("r.*"))
    for c in keyed + [c for c in mc.checks if c.kind == "relationships"]:
        if c.kind == "relationships":
            counted = orphan_count(mc.df, c.columns[0], c.args["to"], c.args["field"])
            out.append(counted.select(*_row(mc.model, c, F.col("failures"))))
            continue
        failing = unique(mc.df, c.columns) if c.kind == "unique" else unique_combination(mc.df, c.columns)
        out.append(failing.agg(*_row(mc.model, c, F.count(F.lit(1)))))
    return out


def run_suite(models: list[ModelChecks]) -> DataFrame:
    """Results table, one row per check, with ``status`` pass / warn / fail (Q6)."""
    parts = [df for mc in models for df in _model_results(mc)]
    res = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == WARN, F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return res.withColumn("status", status)


class DataQualityError(RuntimeError):
    pass


def enforce(results: DataFrame) -> DataFrame:
    """Raise if an error-severity check failed; warnings pass through.

    Collects the results table, which has one row per declared check.
    """
    failed = results.filter(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r.model}.{r.columns} {r.check}: {r.failures} failing" for r in failed]
        raise DataQualityError("data tests failed: " + "; ".join(lines))
    return results


def warehouse_checks(wh) -> list[ModelChecks]:
    """The declared tests of every model (staging and marts)."""
    return [
        ModelChecks(
            "stg_counts",
            wh.stg_counts,
            [
                Check("unique", ["observation_id"]),
                Check("not_null", ["observation_id"]),
                Check("not_null", ["location_id"]),
                Check("accepted_range", ["hour_of_day"], args={"min": 0, "max": 23}),
                Check("not_null", ["pedestrian_count"]),
                Check("accepted_range", ["pedestrian_count"], args={"min": 0}),
            ],
        ),
        ModelChecks(
            "stg_sensors",
            wh.stg_sensors,
            [
                Check("unique", ["location_id"]),
                Check("not_null", ["location_id"]),
                Check("not_null", ["latitude"]),
                Check("not_null", ["longitude"]),
            ],
        ),
        ModelChecks(
            "fct_hourly_counts",
            wh.fct_hourly_counts,
            [
                Check("unique", ["observation_id"]),
                Check("not_null", ["observation_id"]),
                Check("not_null", ["location_id"]),
                Check(
                    "relationships",
                    ["location_id"],
                    WARN,
                    {"to": wh.dim_sensors, "field": "location_id"},
                ),
            ],
        ),
        ModelChecks(
            "dim_sensors",
            wh.dim_sensors,
            [Check("unique", ["location_id"]), Check("not_null", ["location_id"])],
        ),
        ModelChecks(
            "mart_daily_location",
            wh.mart_daily_location,
            [
                Check("unique_combination", ["location_id", "sensing_date"]),
                Check("not_null", ["daily_count"]),
            ],
        ),
        ModelChecks(
            "mart_hourly_profile",
            wh.mart_hourly_profile,
            [Check("unique_combination", ["location_id", "iso_day_of_week", "hour_of_day"])],
        ),
    ]
