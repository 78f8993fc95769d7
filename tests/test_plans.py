"""Plan-shape tests: the scale properties the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import D
from sensorlake.operators import features as ft
from sensorlake.operators import quality as dq
from sensorlake.operators import staging
from sensorlake.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    p = plan(staging.stage_counts(Q.fx.f2_counts(spark, SF)))
    assert re.search(r"WindowGroupLimit .*Partial", p)
    assert p.index("Final") < p.index("Partial")          # final above the exchange, partial below it


def test_shift_lags_take_one_exchange_and_holidays_a_broadcast(spark):
    obs = spark.createDataFrame(
        [(1, D("2024-01-01"), 0, 3), (1, D("2024-01-08"), 0, 4)],
        "location_id int, sensing_date date, hour_of_day int, pedestrian_count int")
    p = plan(ft.featurize(obs, obs, lag_method="shift"))
    assert p.count("Join") == p.count("BroadcastHashJoin")
    # One for the lags; the other dedups the generated calendar.
    assert len(re.findall(r"Exchange hashpartitioning\(location_id#\d+, hour_of_day#\d+, ", p)) == 1
    assert p.count("Exchange hash") == 2


@pytest.mark.parametrize("name", [
    "mart_daily", "mart_profile", "dim_sensors", "dq_duplicate_cells", "dq_orphans", "anchor_date",
    "lag_features_f2d", "calendar_features", "week_rhythm", "holidays", "naive_backtest_f2d", "month_plan",
])
def test_no_cartesian_products(spark, name):
    p = plan(Q.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(Q.QUERIES["mart_daily"](spark, SF))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [r for r in read if "l_orderkey" in r]
    assert lineitem and all("l_extendedprice" not in r and "l_comment" not in r for r in lineitem)


def test_orphan_count_with_a_hot_key(spark):
    child = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"))
    parent = spark.range(10).select(F.col("id").alias("k"))
    want = dq.relationships(child, "k", parent, "k").count()
    assert dq.orphan_count(child, "k", parent, "k").first()["failures"] == want > 1000


def test_multiset_lags_take_one_exchange(spark):
    obs = spark.range(10).selectExpr(
        "cast(id as int) location_id", "date'2024-01-01' sensing_date", "1 hour_of_day", "cast(id as int) pedestrian_count").repartition(2, "pedestrian_count")
    p = ft.lags_by_multiset(obs, obs)._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning(location_id") == 1 and "Join" not in p
