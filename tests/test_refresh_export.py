import datetime as dt

from pyspark.sql import functions as F

from conftest import D, rows
from sensorlake.sources import export, fs, readers, refresh


def src(spark, dates):
    data = [(i, 1, d, 0, 1, 1, 2, "s") for i, d in enumerate(dates)]
    return spark.createDataFrame(
        data, "id long, location_id long, sensing_date date, hourday long, direction_1 long, direction_2 long, "
              "pedestriancount long, sensor_name string")


def test_window_and_months(spark):
    stored = spark.createDataFrame([(D("2024-03-03"),)], "stored_max date")
    smin = spark.createDataFrame([(D("2023-11-20"),)], "source_min date")
    w = refresh.refresh_window(stored, smin, D("2024-04-02")).first()
    assert (w.window_start, w.window_end) == (D("2024-02-25"), D("2024-04-02"))
    assert rows(refresh.months(refresh.refresh_window(stored, smin, D("2024-04-02"))), "month") == [
        ("2024_02",), ("2024_03",), ("2024_04",)]
    nothing = spark.createDataFrame([(None,)], "stored_max date")
    assert refresh.refresh_window(nothing, smin, D("2024-01-01")).first().window_start == D("2023-11-20")
    assert refresh.refresh_window(stored, smin, D("2024-04-02"), full=True).first().window_start == D("2023-11-20")


def test_refresh_is_idempotent_and_drops_emptied_months(spark):
    dest = fs.scratch_dir(spark, "test-refresh")
    dates = [D("2024-01-15"), D("2024-02-10"), D("2024-03-01"), D("2024-03-02")]
    source = src(spark, dates)
    refresh.refresh(spark, source, dest, today=D("2024-03-02"), full=True)
    first = rows(readers.read_counts(spark, dest))
    refresh.refresh(spark, source, dest, today=D("2024-03-02"))
    assert rows(readers.read_counts(spark, dest)) == first          # twice = once
    # March disappears from the source: the touched month must go.
    audit = refresh.refresh(spark, src(spark, dates[:2]), dest, today=D("2024-03-05"))
    assert {r.month: r.rows for r in audit.collect()} == {"2024_02": 1, "2024_03": 0}
    assert rows(readers.read_counts(spark, dest), "sensing_date") == [(D("2024-01-15"),), (D("2024-02-10"),)]
    assert refresh.stored_max_date(spark, dest).first()[0] == D("2024-02-10")
    assert refresh.stored_max_date(spark, dest + "-none").first()[0] is None


def test_export_counts_rows_and_forecast_reader(spark):
    d = fs.scratch_dir(spark, "test-export")
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    audit = export.export_marts(spark, {"a": df, "b": df.filter("id < 3")}, d)
    assert rows(audit) == [("a", 10), ("b", 3)]
    assert readers.read_mart(spark, f"{d}/a").count() == 10
    assert readers.read_forecast(spark, d) is None
    fc = spark.createDataFrame([(1, D("2024-01-01"), 5, 1.0, 2.0, 3.0)],
                               "location_id int, sensing_date date, hour_of_day int, p10 double, p50 double, p90 double")
    export.export_marts(spark, {"mart_forecast": fc, "mart_forecast_metrics": df}, d)
    got, _ = readers.read_forecast(spark, d)
    assert got.first().ts == dt.datetime(2024, 1, 1, 5)
