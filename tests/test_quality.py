import pytest

from conftest import D
from sensorlake.operators import quality as dq
from sensorlake.operators.staging import stage_counts
from sensorlake.plans.warehouse import build_warehouse


def base(spark, extra=()):
    data = [(1, 1, D("2024-01-01"), 0, 1, 1, 2, "a", "x"), (2, 1, D("2024-01-01"), 1, 1, 1, 3, "a", "x"), *extra]
    cols = "id long, location_id long, sensing_date date, hourday long, direction_1 long, direction_2 long, " \
           "pedestriancount long, sensor_name string, month string"
    counts = spark.createDataFrame(data, cols)
    sens = spark.createDataFrame(
        [(1, "Main", "s1", D("2020-01-01"), "o", "A", "N", "S", -37.8, 144.9)],
        "location_id long, sensor_description string, sensor_name string, installation_date date, "
        "location_type string, status string, direction_1 string, direction_2 string, latitude double, longitude double")
    return counts, sens


def suite(spark, extra=()):
    counts, sens = base(spark, extra)
    res = dq.run_suite(dq.warehouse_checks(build_warehouse(counts, sens)))
    return {(r.model, r.check, r.columns): (r.failures, r.status) for r in res.collect()}


def test_clean_suite_passes(spark):
    res = suite(spark)
    assert len(res) == 19 and all(v == (0, "pass") for v in res.values())


@pytest.mark.parametrize("extra,key", [
    ([(3, 1, D("2024-01-01"), 24, 1, 1, 2, "a", "x")], ("stg_counts", "accepted_range", "hour_of_day")),   # Q3
    ([(3, 1, D("2024-01-01"), 2, 1, 1, -1, "a", "x")], ("stg_counts", "accepted_range", "pedestrian_count")),
    ([(3, 1, D("2024-01-01"), 2, 1, 1, None, "a", "x")], ("stg_counts", "not_null", "pedestrian_count")),  # Q2
    ([(3, None, D("2024-01-01"), 2, 1, 1, 1, "a", "x")], ("stg_counts", "not_null", "location_id")),
])
def test_planted_faults_fail(spark, extra, key):
    res = suite(spark, extra)
    assert res[key] == (1, "fail")


def test_orphan_is_a_warning_and_enforce(spark):
    res = suite(spark, [(3, 7, D("2024-01-01"), 2, 1, 1, 1, "a", "x")])   # Q4
    assert res[("fct_hourly_counts", "relationships", "location_id")] == (1, "warn")
    counts, sens = base(spark, [(3, 7, D("2024-01-01"), 2, 1, 1, 1, "a", "x")])
    dq.enforce(dq.run_suite(dq.warehouse_checks(build_warehouse(counts, sens))))  # warn does not raise
    counts, sens = base(spark, [(3, 1, D("2024-01-01"), 99, 1, 1, 1, "a", "x")])
    with pytest.raises(dq.DataQualityError):
        dq.enforce(dq.run_suite(dq.warehouse_checks(build_warehouse(counts, sens))))


def test_unique_ignores_nulls_and_combination_counts_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b")], "k long, v string")
    assert dq.unique(df, "k").count() == 1          # Q1: the null key is ignored
    assert dq.unique_combination(df, ["k", "v"]).count() == 2   # Q5: nulls form a group
    counts, _ = base(spark, [(2, 1, D("2024-01-01"), 1, 1, 1, 3, "a", "x")])
    assert dq.unique(counts, "id").count() == 1     # duplicate raw id
    assert dq.unique(stage_counts(counts), "observation_id").count() == 0


def test_relationships_anti_join(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert [r.k for r in dq.relationships(child, "k", parent, "k").collect()] == [2]
