
import pytest
from pyspark.sql import functions as F

from conftest import D
from sensorlake.operators import backtest as bt
from sensorlake.operators import features as ft
from sensorlake.operators import quantile as qt
from sensorlake.plans.forecast import forecast, model_backtest, prepare


@pytest.fixture(scope="module")
def obs(spark):
    # 6 weeks, 3 locations, 24 hours, a weekly rhythm plus noise.
    base = D("2024-01-01")
    return (
        spark.range(42 * 3 * 24)
        .select(
            (F.col("id") % 3 + 1).cast("int").alias("location_id"),
            F.date_add(F.lit(base), (F.col("id") / 72).cast("int")).alias("sensing_date"),
            ((F.col("id") / 3).cast("int") % 24).cast("int").alias("hour_of_day"),
            F.col("id"),
        )
        .withColumn(
            "pedestrian_count",
            (F.col("hour_of_day") * 10 + F.col("location_id") * 5 + (F.rand(7) * 20)).cast("int"),
        )
        .drop("id")
    )


def test_boosted_quantiles_are_ordered_and_calibrated(spark, obs):
    feat = ft.featurize(obs, obs)
    train = bt.trainable(feat)
    fc = qt.fit_all(qt.labelled(train), [D("2024-02-11")], qt.BoostParams(rounds=6, learning_rate=0.3))[D("2024-02-11")]
    pred = qt.predict(fc, train).cache()
    bad = pred.filter((F.col("p10") > F.col("p50")) | (F.col("p50") > F.col("p90")) | (F.col("p10") < 0))
    assert bad.count() == 0
    below = pred.agg(F.avg((F.col("pedestrian_count") <= F.col("p90")).cast("double"))).first()[0]
    assert 0.6 < below <= 1.0
    below10 = pred.agg(F.avg((F.col("pedestrian_count") < F.col("p10")).cast("double"))).first()[0]
    assert below10 < 0.4


def test_model_beats_the_baseline_out_of_sample(spark, obs):
    feat = ft.featurize(obs, obs)
    m = model_backtest(feat, D("2024-02-11"), 1, qt.BoostParams(rounds=20, learning_rate=0.2))
    wape = {r.method: r.wape for r in m.filter("scope = 'overall'").collect()}
    assert wape["model"] < 0.9 * wape["seasonal_naive"]


def test_uncrossing(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0)], "a double, b double, c double")
    assert list(df.select(*qt.uncrossed([F.col("a"), F.col("b"), F.col("c")])).first()) == [1.0, 2.0, 3.0]


def test_backtest_and_forecast(spark, obs):
    res = forecast(obs, horizon_days=2, folds=2, params=qt.BoostParams(rounds=3))
    m = {(r.scope, r.method): r for r in res.metrics.collect()}
    assert set(m) == {("fold", "model"), ("fold", "seasonal_naive"), ("overall", "model"), ("overall", "seasonal_naive")}
    assert m[("overall", "model")].n_rows == m[("overall", "seasonal_naive")].n_rows == 2 * 7 * 3 * 24
    assert 0 <= m[("overall", "model")].band_coverage <= 1
    assert m[("overall", "seasonal_naive")].band_coverage is None
    assert res.anchor == D("2024-02-11")
    fc = res.forecast
    assert fc.count() == 3 * 2 * 24
    assert fc.filter((F.col("p10") > F.col("p50")) | (F.col("p50") > F.col("p90"))).count() == 0


def test_empty_fold_raises(spark, obs):
    feat = ft.featurize(obs, obs)
    with pytest.raises(ValueError, match="no training rows"):
        model_backtest(feat, D("2024-02-11"), 5, qt.BoostParams(rounds=1))   # T15


def test_prepare_detects_duplicate_grain_from_the_features(spark, obs):
    _, _, feat, method = prepare(obs)
    assert method == "shift" and "_dup" not in feat.columns
    dup = obs.unionByName(obs.limit(1))
    _, _, feat2, method2 = prepare(dup)
    assert method2 == "multiset" and feat2.count() == feat.count() + 1 + 4   # T6: lags multiply rows


def test_forecast_into_2026_and_own_calendar(spark, obs):
    """The horizon crosses the year's end; a caller's calendar reaches the features."""
    late = obs.withColumn("sensing_date", F.date_add("sensing_date", 685))   # ends 2025-12-27
    res = forecast(late, folds=0, params=qt.BoostParams(rounds=2, leaves=4))
    assert res.anchor == D("2025-12-27") and res.metrics is None
    assert res.forecast.filter("sensing_date >= '2026-01-01'").count() == 3 * 3 * 24
    own = spark.createDataFrame([(D("2025-12-20"),)], "holiday_date date")
    _, _, feat, _ = prepare(late, holiday_dates=own)
    assert [str(r[0]) for r in feat.filter("is_holiday = 1").select("sensing_date").distinct().collect()] == ["2025-12-20"]
