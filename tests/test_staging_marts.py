import datetime as dt

from pyspark.sql import functions as F

from conftest import D, rows
from sensorlake.operators import marts, staging


def raw(spark, data):
    cols = "id long, location_id long, sensing_date date, hourday long, direction_1 long, direction_2 long, " \
           "pedestriancount long, sensor_name string, month string"
    return spark.createDataFrame(data, cols)


def test_dedup_keeps_earliest_date_and_nulls_last(spark):
    df = raw(spark, [
        (1, 10, None, 5, 1, 1, 2, "a", "x"),            # null date loses (T2)
        (1, 10, D("2024-01-02"), 5, 1, 1, 2, "a", "x"),
        (1, 10, D("2024-01-03"), 6, 1, 1, 2, "a", "x"),
        (2, 10, D("2024-01-02"), 7, 3, 4, 7, "a", "x"),
        (2, 10, D("2024-01-02"), 6, 3, 4, 7, "a", "x"),  # equal date: smaller hour wins (T3)
    ])
    out = staging.stage_counts(df)
    assert rows(out, "observation_id", "sensing_date", "hour_of_day") == [
        (1, D("2024-01-02"), 5), (2, D("2024-01-02"), 6)]
    assert dict(out.dtypes)["location_id"] == "int"


def test_fractional_inputs_round_half_even(spark):
    df = spark.createDataFrame([(1, 2.5, 1.5, 3.5)], "id long, location_id double, hourday double, pedestriancount double")
    df = df.select("id", "location_id", F.lit(D("2024-01-01")).alias("sensing_date"), "hourday",
                   F.lit(1).alias("direction_1"), F.lit(1).alias("direction_2"), "pedestriancount",
                   F.lit("s").alias("sensor_name"))
    r = staging.stage_counts(df).first()
    assert (r.location_id, r.hour_of_day, r.pedestrian_count) == (2, 2, 4)  # T1


def sensors(spark, data):
    cols = "location_id long, sensor_description string, sensor_name string, installation_date date, " \
           "location_type string, status string, direction_1 string, direction_2 string, latitude double, longitude double"
    return spark.createDataFrame(data, cols)


def test_latest_sensor_wins(spark):
    df = sensors(spark, [
        (1, "old", "s1", D("2020-01-01"), "o", "A", "N", "S", -37.8, 144.9),
        (1, "new", "s1", D("2021-01-01"), "o", "A", "N", "S", -37.8, 144.9),
        (1, "undated", "s1", None, "o", "A", "N", "S", -37.8, 144.9),
        (2, "only", "s2", None, "o", None, "N", "S", -37.7, 144.8),
    ])
    out = staging.stage_sensors(df)
    assert rows(out, "location_id", "location_name") == [(1, "new"), (2, "only")]


def test_fact_calendar_columns(spark):
    df = raw(spark, [(1, 1, D("2024-01-06"), 23, 1, 1, 2, "a", "x"), (2, 1, D("2024-01-08"), 25, 1, 1, 2, "a", "x")])
    fct = marts.hourly_fact(staging.stage_counts(df))
    got = rows(fct, "observation_id", "day_name", "iso_day_of_week", "is_weekend", "observed_at")
    assert got == [
        (1, "Saturday", 6, True, dt.datetime(2024, 1, 6, 23)),
        (2, "Monday", 1, False, dt.datetime(2024, 1, 9, 1)),  # hour 25 rolls over
    ]


def test_dim_daily_profile(spark):
    counts = raw(spark, [
        (1, 1, D("2024-01-01"), 0, 1, 1, 2, "a", "x"),
        (2, 1, D("2024-01-01"), 1, 1, 1, 4, "a", "x"),
        (3, 2, D("2024-01-01"), 1, 1, 1, 5, "b", "x"),      # orphan location 2
        (4, 1, D("2023-09-01"), 1, 1, 1, 9, "a", "x"),      # outside 90 days
        (5, 1, D("2023-10-03"), 1, 1, 1, 7, "a", "x"),      # exactly max - 90: excluded
    ])
    sens = sensors(spark, [(1, "Main St", "s1", D("2020-01-01"), "o", None, "N", "S", -37.8, 144.9)])
    stg_c, stg_s = staging.stage_counts(counts), staging.stage_sensors(sens)
    fct = marts.hourly_fact(stg_c)
    dim = marts.sensor_dim(stg_s, stg_c)
    d = dim.first()
    assert d.is_active is None and d.first_observed_date == D("2023-09-01")  # null-propagating flag
    daily = marts.daily_mart(fct, dim)
    assert rows(daily, "location_id", "location_name", "sensing_date", "daily_count", "hours_reported") == [
        (1, "Main St", D("2023-09-01"), 9, 1), (1, "Main St", D("2023-10-03"), 7, 1),
        (1, "Main St", D("2024-01-01"), 6, 2), (2, "Location 2", D("2024-01-01"), 5, 1)]
    prof = marts.hourly_profile(fct, dim)
    assert rows(prof, "location_id", "hour_of_day", "avg_count", "n_observations") == [
        (1, 0, 2.0, 1), (1, 1, 4.0, 1), (2, 1, 5.0, 1)]


def test_marts_preserve_totals_on_fixture(spark):
    from sensorlake.sources import fixtures as fx
    from sensorlake.plans.warehouse import build_warehouse

    sf = "/root/testdata/sf0.001"
    wh = build_warehouse(fx.f2_counts(spark, sf), fx.f3_sensors(spark, sf))
    fct_total = wh.fct_hourly_counts.agg(F.sum("pedestrian_count")).first()[0]
    daily_total = wh.mart_daily_location.agg(F.sum("daily_count")).first()[0]
    assert fct_total == daily_total > 0                                       # sum(daily) = sum(fct)
    assert wh.mart_daily_location.agg(F.sum("hours_reported")).first()[0] == wh.fct_hourly_counts.count()
    assert wh.stg_counts.count() == fx.f2_counts(spark, sf).select("id").distinct().count()
