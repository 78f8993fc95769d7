import datetime as dt

from pyspark.sql import functions as F

from conftest import D, rows
from sensorlake.functions import calendar as cal
from sensorlake.operators import features as ft


def years(spark, *ys):
    return spark.createDataFrame([(y,) for y in ys], "year int")


def test_holidays_2024(spark):
    got = {r.holiday_name: r.holiday_date for r in cal.holidays(spark, years(spark, 2024)).collect()}
    assert got["New Year's Day"] == D("2024-01-01")
    assert got["Australia Day"] == D("2024-01-26")
    assert got["Labour Day"] == D("2024-03-11")
    assert got["Good Friday"] == D("2024-03-29") and got["Easter Monday"] == D("2024-04-01")
    assert got["King's Birthday"] == D("2024-06-10")
    assert got["Melbourne Cup Day"] == D("2024-11-05")
    assert got["Friday before the AFL Grand Final"] == D("2024-09-27")
    assert "Christmas Day (observed)" not in got


def test_easter_and_weekend_substitutes(spark):
    h = cal.holidays(spark, years(spark, 2000, 2011, 2021, 2022))
    friday = {r.holiday_date.year: r.holiday_date for r in h.filter("holiday_name = 'Good Friday'").collect()}
    easter = {y: d + dt.timedelta(days=2) for y, d in friday.items()}
    assert easter == {2000: D("2000-04-23"), 2011: D("2011-04-24"), 2021: D("2021-04-04"), 2022: D("2022-04-17")}
    sunday = {r.holiday_date.year for r in h.filter("holiday_name = 'Easter Sunday'").collect()}
    assert sunday == {2021, 2022}                                        # a public holiday from 2016
    subs = rows(h.filter(F.col("holiday_name").contains("observed")), "holiday_date", "holiday_name")
    assert (D("2021-12-27"), "Christmas Day (observed)") in subs       # Sat 25th
    assert (D("2021-12-28"), "Boxing Day (observed)") in subs          # Sun 26th
    assert (D("2022-12-27"), "Christmas Day (observed)") in subs       # Sun 25th, Mon 26th is Boxing Day
    assert (D("2022-01-03"), "New Year's Day (observed)") in subs


def obs(spark, data):
    return spark.createDataFrame(data, "location_id int, sensing_date date, hour_of_day int, pedestrian_count int")


def test_join_and_shift_agree_on_unique_grain(spark):
    base = D("2024-01-01")
    data = [(l, base + dt.timedelta(days=d), h, l * 100 + d * 3 + h)
            for l in (1, 2) for d in range(0, 40, 3) for h in (0, 5)]
    o = obs(spark, data)
    j = rows(ft.add_lags(o, o, method="join"))
    s = rows(ft.add_lags(o, o, method="shift"))
    assert j == s and len(j) == len(data)
    assert ft.grain_is_unique(o)


def test_duplicate_cell_multiplies_rows_in_join(spark):
    o = obs(spark, [(1, D("2024-01-01"), 0, 5), (1, D("2024-01-01"), 0, 6), (1, D("2024-01-08"), 0, 7)])
    assert not ft.grain_is_unique(o)
    frame = o.filter(F.col("sensing_date") == D("2024-01-08"))
    out = rows(ft.add_lags(frame, o, method="auto"), "lag_7d")     # T6: falls back to join
    assert out == [(5,), (6,)]


def test_lag_mean_and_calendar(spark):
    o = obs(spark, [(1, D("2024-01-26"), 3, 8), (1, D("2024-01-19"), 3, 4), (1, D("2024-01-05"), 3, 2),
                    (None, D("2024-01-19"), 3, 100)])
    f = ft.featurize(o.filter(F.col("location_id").isNotNull()), o)
    r = {x.sensing_date: x for x in f.collect()}
    top = r[D("2024-01-26")]
    assert (top.lag_7d, top.lag_14d, top.lag_21d, top.lag_28d) == (4, None, 2, None)
    assert top.lag_mean_4w == 3.0 and top.is_holiday == 1 and top.day_of_week == 4 and top.month == 1
    assert r[D("2024-01-05")].lag_mean_4w is None                     # all lags null
    assert r[D("2024-01-19")].lag_7d is None                          # null key never matches (T7)


def test_future_scaffold(spark):
    a = D("2024-01-30")
    o = obs(spark, [(1, a, 0, 1), (2, a - dt.timedelta(days=13), 0, 1), (3, a - dt.timedelta(days=14), 0, 1)])
    sc = ft.future_scaffold(o, F.lit(a), 7)
    assert sc.count() == 2 * 7 * 24
    assert rows(sc.agg(F.min("sensing_date"), F.max("sensing_date"), F.max("hour_of_day"))) == [
        (D("2024-01-31"), D("2024-02-06"), 23)]


def test_future_frame_join_and_shift_agree_with_bounded_history(spark):
    base = D("2024-01-01")
    data = [(l, base + dt.timedelta(days=d), h, l * 10 + d + h) for l in (1, 2) for d in range(0, 60) for h in (0, 7)]
    o = obs(spark, data)
    a = F.lit(base + dt.timedelta(days=59))
    j = rows(ft.future_frame(o, a, 7, lag_method="join"))
    s = rows(ft.future_frame(o, a, 7, lag_method="shift"))
    assert j == s and len(j) == 2 * 7 * 24
    # every horizon row with history 7 days back got its lag
    assert all(r[3] is not None for r in s if r[2] in (0, 7))


# Public holidays of the state, as published, 2015 to 2027, by
# rule: weekday substitutes included; finals after 2025 by the last-Saturday rule.
PUBLISHED = {
    "Good Friday": "2015-04-03 2016-03-25 2017-04-14 2018-03-30 2019-04-19 2020-04-10 2021-04-02 2022-04-15 2023-04-07 2024-03-29 2025-04-18 2026-04-03 2027-03-26",
    "Labour Day": "2015-03-09 2016-03-14 2017-03-13 2018-03-12 2019-03-11 2020-03-09 2021-03-08 2022-03-14 2023-03-13 2024-03-11 2025-03-10 2026-03-09 2027-03-08",
    "King's Birthday": "2015-06-08 2016-06-13 2017-06-12 2018-06-11 2019-06-10 2020-06-08 2021-06-14 2022-06-13 2023-06-12 2024-06-10 2025-06-09 2026-06-08 2027-06-14",
    "Melbourne Cup Day": "2015-11-03 2016-11-01 2017-11-07 2018-11-06 2019-11-05 2020-11-03 2021-11-02 2022-11-01 2023-11-07 2024-11-05 2025-11-04 2026-11-03 2027-11-02",
    "Friday before the AFL Grand Final": "2015-10-02 2016-09-30 2017-09-29 2018-09-28 2019-09-27 2020-10-23 2021-09-24 2022-09-23 2023-09-29 2024-09-27 2025-09-26 2026-09-25 2027-09-24",
    "New Year's Day (observed)": "2017-01-02 2022-01-03 2023-01-02",
    "Australia Day (observed)": "2019-01-28 2020-01-27 2025-01-27",
    "Christmas Day (observed)": "2016-12-27 2021-12-27 2022-12-27 2027-12-27",
    "Boxing Day (observed)": "2015-12-28 2020-12-28 2021-12-28 2026-12-28 2027-12-28",
}


def test_holidays_as_published(spark):
    got = {}
    for r in cal.holidays(spark, years(spark, *range(2015, 2028))).collect():
        got.setdefault(r.holiday_name, []).append(str(r.holiday_date))
    assert {n: sorted(got[n]) for n in PUBLISHED} == {n: d.split() for n, d in PUBLISHED.items()}


def test_horizon_into_years_without_announced_finals(spark):
    df = spark.createDataFrame([(D("2026-01-01"),), (D("2026-09-25"),), (D("2030-09-27"),), (D("2026-01-02"),)], "sensing_date date")
    assert [r.is_holiday for r in ft.add_calendar(df).orderBy("sensing_date").collect()] == [1, 0, 1, 1]
    own = spark.createDataFrame([(D("2026-01-02"),)], "holiday_date date")
    assert [r.is_holiday for r in ft.add_calendar(df, own).orderBy("sensing_date").collect()] == [0, 1, 0, 0]


def test_multiset_equals_joins_on_any_grain(spark):
    """Repeated cells, null values and null keys, frame and observations apart or one."""
    import random

    rng = random.Random(6)
    schema = "location_id int, sensing_date date, hour_of_day int, pedestrian_count int"

    def some(n):
        return [(rng.choice([1, 2, None]), rng.choice([None, *[D("2024-01-01") + dt.timedelta(days=7 * k + j) for k in range(6) for j in (0, 1)]]),
                 rng.choice([0, 1, None]), rng.choice([None, 3, 4, 5])) for _ in range(n)]

    o = spark.createDataFrame(some(90), schema)
    frame = spark.createDataFrame(some(30), schema).drop("pedestrian_count").withColumn("other", F.lit("x"))
    for f in (o, frame):
        joined, got = ft.lags_by_join(f, o), ft.lags_by_multiset(f, o)
        assert got.columns == joined.columns and got.dtypes == joined.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
    assert ft.lags_by_join(o, o).count() > o.count()
