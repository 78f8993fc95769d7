import datetime as dt

from pyspark.sql import functions as F

from conftest import D, rows
from sensorlake.functions import labels
from sensorlake.operators import anchor as anc
from sensorlake.operators import reports as rp


def daily(spark, data):
    return spark.createDataFrame(
        data, "location_id int, location_name string, sensing_date date, daily_count long, hours_reported long, "
              "latitude double, longitude double")


def test_anchor_skips_thin_newest_day(spark):
    base = D("2024-01-01")
    data = [(i % 4, f"L{i % 4}", base + dt.timedelta(days=i // 4), 10, 24, -37.8, 144.9) for i in range(4 * 30)]
    data.append((0, "L0", base + dt.timedelta(days=30), 10, 1, -37.8, 144.9))   # 1% coverage
    df = daily(spark, data)
    assert anc.anchor_date(df, weight="hours_reported").first()[0] == base + dt.timedelta(days=29)
    assert anc.anchor_date(df).first()[0] == base + dt.timedelta(days=29)


def test_kpis_zero_denominator_and_busiest(spark):
    a = D("2024-01-14")
    df = daily(spark, [
        (1, "A & B", a, 100, 24, None, None),
        (2, "C", a, 50, 24, None, None),
        (1, "A & B", a - dt.timedelta(days=9), 30, 24, None, None),   # prior week only
    ])
    k = rp.kpis(df, F.lit(a)).first()
    assert (k.day_total, k.same_day_last_week_total, k.day_delta_pct) == (150, 0, None)   # T14
    assert (k.last7_total, k.prior7_total) == (150, 30)
    assert abs(k.week_delta_pct - 400.0) < 1e-9
    assert k.sensors_reporting == 2 and k.busiest_location == "A &amp; B"
    empty = rp.busiest(df.filter("false"), F.lit(a)).first()
    assert empty.busiest_location == "n/a"


def test_names_merge_ids_in_rankings(spark):
    a = D("2024-01-14")
    df = daily(spark, [
        (1, "Same", a, 10, 24, -37.8, 144.9),
        (2, "Same", a, 15, 24, -37.7, 144.8),
        (3, "Other", a, 20, 24, -37.6, 144.7),
    ])
    top = rows(rp.top_locations(df, F.lit(a), k=10), "rank", "location_name", "total_count")
    assert top == [(1, "Same", 25), (2, "Other", 20)]       # T12: merged by name
    m = rows(rp.location_map(df, F.lit(a)), "location_id", "avg_daily")
    assert m == [(1, 10.0), (2, 15.0), (3, 20.0)]           # the map keeps ids apart


def test_rolling_counts_rows_not_days(spark):
    a = D("2024-01-10")
    data = [(1, "X", a - dt.timedelta(days=d), v, 24, None, None) for d, v in [(0, 70), (1, 60), (5, 10), (9, 0)]]
    city = rp.city_trend(daily(spark, data), F.lit(a), 90)
    got = rows(city, "sensing_date", "rolling7")
    # a 4-day gap does not shrink the window: the 7-row frame spans all four rows (T5)
    assert got[-1] == (a, (0 + 10 + 60 + 70) / 4)
    assert got[0] == (a - dt.timedelta(days=9), 0.0)


def test_week_rhythm_keeps_absent_days(spark):
    prof = spark.createDataFrame(
        [(1, "Monday", 8, 10.0, 3), (2, "Monday", 8, 5.0, 1), (1, "Sunday", 23, 2.0, 1)],
        "location_id int, day_name string, hour_of_day int, avg_count double, n_observations long")
    out = {r.day_name: r for r in rp.week_rhythm(prof).collect()}
    assert list(out) and len(out) == 7
    assert out["Monday"].h08 == 15.0 and out["Sunday"].h23 == 2.0
    assert out["Tuesday"].h08 is None
    wprof = prof.withColumn("location_name", F.lit("N")).withColumn("is_weekend", F.col("day_name") == "Sunday")
    lp = {(r.is_weekend, r.hour_of_day): r.avg_count for r in rp.location_profile(wprof).collect()}
    assert lp[(False, 8)] == (10.0 * 3 + 5.0) / 4


def test_labels(spark):
    df = spark.createDataFrame([(1_250_000.0, 12_499.0, 812.4, -3.25, 'a<b"c\'&')], "a double, b double, c double, p double, s string")
    r = df.select(labels.compact_number(F.col("a")).alias("a"), labels.compact_number(F.col("b")).alias("b"),
                  labels.compact_number(F.col("c")).alias("c"), labels.signed_percent(F.col("p")).alias("p"),
                  labels.signed_percent(F.lit(None)).alias("n"), labels.thousands(F.lit(12345.6)).alias("t"),
                  labels.html_escape(F.col("s")).alias("s")).first()
    assert (r.a, r.b, r.c, r.p, r.n, r.t) == ("1.2M", "12K", "812", "-3.2%", None, "12,346")  # ties to even
    assert r.s == "a&lt;b&quot;c&#x27;&amp;"


def test_today_in_a_zone(spark):
    import datetime as dt
    from zoneinfo import ZoneInfo

    from sensorlake.operators.forecast_reports import local_today

    zone = "Pacific/Kiritimati"
    before = dt.datetime.now(ZoneInfo(zone)).date()
    got = spark.range(1).select(local_today(zone)).first()[0]
    assert before <= got <= dt.datetime.now(ZoneInfo(zone)).date()
