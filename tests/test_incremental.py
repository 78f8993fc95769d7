import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sensorlake.operators import staging
from sensorlake.plans import incremental as inc
from sensorlake.plans.warehouse import build_warehouse
from sensorlake.sources import fs, versions

SCHEMA = ("id long, location_id long, sensing_date date, hourday long, direction_1 long, direction_2 long, "
          "pedestriancount long, sensor_name string")
MONTHS = ["2024_01", "2024_02", "2024_03", "2024_04", "2024_05"]


def reading(rng, month):
    y, m = map(int, month.split("_"))
    day = dt.date(y, m, rng.randint(1, 28))
    return (rng.randint(1, 60), rng.randint(1, 4), day, rng.randint(0, 23), 1, 1, rng.randint(0, 50), "s")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def sensors(spark):
    data = [(i, f"L{i}", f"s{i}", dt.date(2020, 1, i), "Outdoor", "A", "N", "S", 1.0, 2.0) for i in (1, 2, 3)]
    return spark.createDataFrame(data, "location_id long, sensor_description string, sensor_name string, installation_date date, "
                                       "location_type string, status string, direction_1 string, direction_2 string, latitude double, longitude double")


def staged(spark, root):
    got = inc.read(spark, root, inc.STAGED, versions.current(spark, root))
    return [] if got is None else rows(got)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_refreshes_equal_a_full_rebuild(spark, seed):
    """Ids wander between months; months gain, lose and empty their rows."""
    rng, root, raw = random.Random(seed), fs.scratch_dir(spark, "t-inc"), {m: [] for m in MONTHS}
    for turn in range(5):
        months = MONTHS[:3] if turn == 0 else rng.sample(MONTHS, rng.randint(1, 2))
        for m in months:
            raw[m] = [r for r in raw[m] if rng.random() < 0.6] + [reading(rng, m) for _ in range(rng.randint(0, 25))]
            raw[m] = [] if rng.random() < 0.15 else raw[m]
        every = [r for m in MONTHS for r in raw[m]]
        inc.refresh(spark, frame(spark, [r for m in months for r in raw[m]]), months, root)
        assert staged(spark, root) == rows(staging.stage_counts(frame(spark, every)))
    full, got = build_warehouse(frame(spark, every), sensors(spark)), inc.warehouse(spark, root, sensors(spark))
    for model in ("dim_sensors", "mart_daily_location", "mart_hourly_profile", "fct_hourly_counts"):
        assert rows(getattr(got, model)) == rows(getattr(full, model)), model


def test_corrections_touch_their_month_alone(spark):
    root, rng = fs.scratch_dir(spark, "t-inc"), random.Random(3)
    data = [(i, 1, dt.date(2024, 1 + i % 5, 1 + i % 28), i % 24, 1, 1, i, "s") for i in range(200)]
    assert inc.refresh(spark, frame(spark, data), MONTHS, root) == set(MONTHS)
    before = versions.current(spark, root).parts
    may = [(*r[:6], r[6] + 1, r[7]) for r in data if r[2].month == 5] + [(1000 + i, *reading(rng, "2024_05")[1:]) for i in range(5)]
    assert inc.refresh(spark, frame(spark, may), ["2024_05"], root) == {"2024_05"}
    after = versions.current(spark, root).parts
    assert {p for p in after if before.get(p) != after[p]} == {f"{k}.2024_05" for k in (inc.CANDIDATES, inc.STAGED, inc.DAILY)}


def test_withdrawn_row_brings_back_the_runner_up(spark):
    root = fs.scratch_dir(spark, "t-inc")
    jan, mar = (7, 1, dt.date(2024, 1, 5), 1, 1, 1, 10, "s"), (7, 1, dt.date(2024, 3, 5), 1, 1, 1, 30, "s")
    inc.refresh(spark, frame(spark, [jan, mar]), MONTHS, root)
    assert [r[2] for r in staged(spark, root)] == [jan[2]]
    assert inc.refresh(spark, frame(spark, []), ["2024_01"], root) == {"2024_01", "2024_03"}
    assert [r[2] for r in staged(spark, root)] == [mar[2]]
    inc.refresh(spark, frame(spark, [jan]), ["2024_01"], root)
    assert [r[2] for r in staged(spark, root)] == [jan[2]]


def test_a_refresh_that_dies_is_repeated(spark, monkeypatch):
    root, rng = fs.scratch_dir(spark, "t-inc"), random.Random(4)
    first, second = ([reading(rng, "2024_02") for _ in range(30)] for _ in range(2))
    inc.refresh(spark, frame(spark, first), ["2024_02"], root)
    before = staged(spark, root)
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            inc.refresh(spark, frame(spark, second), ["2024_02"], root)
    assert staged(spark, root) == before
    inc.refresh(spark, frame(spark, second), ["2024_02"], root)
    assert staged(spark, root) == rows(staging.stage_counts(frame(spark, second)))


def test_profile_reads_the_months_of_its_window(spark):
    root = fs.scratch_dir(spark, "t-inc")
    data = [(i, 1, dt.date(2023, 1, 1) + dt.timedelta(days=i), i % 24, 1, 1, i, "s") for i in range(500)]
    inc.refresh(spark, frame(spark, data), sorted({r[2].strftime("%Y_%m") for r in data}), root)
    profile = inc.warehouse(spark, root, sensors(spark)).mart_hourly_profile
    files = {f.split("part=staged.")[1][:7] for f in profile.inputFiles() if "part=staged." in f}
    assert files == {"2024_02", "2024_03", "2024_04", "2024_05"}
    assert profile.agg(F.sum("n_observations")).first()[0] == 90


def test_replacing_every_stored_month_looks_up_no_ids(spark, monkeypatch):
    """The candidates alone say which row is first: no id is compared with
    what was stored."""
    rng, root = random.Random(5), fs.scratch_dir(spark, "t-inc")
    joined = []
    join = type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, *a, **k: joined.append(a) or join(self, *a, **k))
    for months in (MONTHS[:3], MONTHS[:4]):
        data = [reading(rng, m) for m in months for _ in range(20)] + [(None, *reading(rng, m)[1:]) for m in months]
        inc.refresh(spark, frame(spark, data), months, root)
        assert not joined
        assert staged(spark, root) == rows(staging.stage_counts(frame(spark, data)))


@pytest.mark.parametrize("many", [1_000_000, 0])
def test_other_months_candidates_are_read_once(spark, monkeypatch, many):
    """For the touched ids; other ids of these months keep their staged rows,
    and rows of replaced months are as corrected."""
    rng, root = random.Random(6), fs.scratch_dir(spark, "t-inc")
    monkeypatch.setattr(inc, "MANY", many)
    raw = {m: [reading(rng, m) for _ in range(30)] + [(None, *reading(rng, m)[1:])] for m in MONTHS}
    inc.refresh(spark, frame(spark, sum(raw.values(), [])), MONTHS, root)
    raw["2024_02"] = [(*r[:6], r[6] + 1, r[7]) for r in raw["2024_02"][10:]] + [reading(rng, "2024_02") for _ in range(10)]
    reads, read = [], inc.read
    monkeypatch.setattr(inc, "read", lambda s, r, kind, v, months=None: reads.append((kind, months)) or read(s, r, kind, v, months))
    assert len(inc.refresh(spark, frame(spark, raw["2024_02"]), ["2024_02"], root)) > 1
    assert len([m for kind, m in reads if kind == inc.CANDIDATES and (m is None or m - {"2024_02"})]) == 1
    assert staged(spark, root) == rows(staging.stage_counts(frame(spark, sum(raw.values(), []))))
