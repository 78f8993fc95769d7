import datetime as dt

from pyspark.sql import functions as F

from sensorlake.operators.quantile import BoostParams
from sensorlake.plans.pipeline import run_pipeline
from sensorlake.sources import fixtures as fx
from sensorlake.sources import fs, readers

SF = "/root/testdata/sf0.001"


def test_run_pipeline_end_to_end(spark):
    root = fs.scratch_dir(spark, "test-pipeline")
    counts = fx.f1_counts(spark, SF).drop("month")
    sensors = fx.f3_sensors(spark, SF)
    res = run_pipeline(spark, counts, sensors, root, today=dt.date(2024, 1, 30), full=True,
                       folds=2, horizon_days=3, params=BoostParams(rounds=2))
    audit = {r.table: r.rows for r in res.exported.collect()}
    assert set(audit) == {"dim_sensors", "mart_daily_location", "mart_hourly_profile",
                          "mart_forecast", "mart_forecast_metrics"}
    marts = readers.read_marts(spark, f"{root}/marts")
    assert marts["mart_daily_location"].count() == audit["mart_daily_location"] > 0
    statuses = {r.status for r in res.checks.collect()}
    assert statuses <= {"pass", "warn"}            # orphan sensor 9 is a warning only
    fc, metrics = readers.read_forecast(spark, f"{root}/marts")
    assert fc.count() == audit["mart_forecast"] and metrics.count() == 6
    assert fc.filter(F.col("p10") > F.col("p90")).count() == 0
    # Second, incremental run over unchanged data leaves the raw table as it was.
    before = readers.read_counts(spark, f"{root}/raw/counts").count()
    run_pipeline(spark, counts, sensors, root, today=dt.date(2024, 1, 30), run_forecast=False)
    assert readers.read_counts(spark, f"{root}/raw/counts").count() == before == counts.count()
