import pytest

from conftest import D, rows
from sensorlake.sources import fs, readers
from sensorlake.streaming import landing as ls


def exports(spark, data):
    full = [(i, 1, d, 0, 1, 1, n, "s") for i, d, n in data]
    return spark.createDataFrame(
        full, "id long, location_id long, sensing_date date, hourday long, direction_1 long, direction_2 long, "
              "pedestriancount long, sensor_name string")


@pytest.fixture
def folders(spark):
    return tuple(fs.scratch_dir(spark, p) for p in ("t-land", "t-dest", "t-ckpt"))


def run(spark, land, dest, ckpt):
    ls.start_landing_ingest(spark, land, dest, ckpt).awaitTermination()
    return rows(readers.read_counts(spark, dest), "id", "pedestriancount")


JAN, FEB = D("2024-01-05"), D("2024-02-05")


def test_stream_replaces_months_and_restarts_cleanly(spark, folders):
    land, dest, ckpt = folders
    ls.land_months(exports(spark, [(1, JAN, 2), (2, FEB, 3), (5, FEB, 5)]), land)
    assert run(spark, land, dest, ckpt) == [(1, 2), (2, 3), (5, 5)]
    # February again: a correction, a new reading, one withdrawn.
    ls.land_months(exports(spark, [(2, FEB, 9), (3, D("2024-02-06"), 4)]), land)
    got = run(spark, land, dest, ckpt)
    assert got == [(1, 2), (2, 9), (3, 4)]
    assert run(spark, land, dest, ckpt) == got                                  # nothing new
    assert run(spark, land, dest, fs.scratch_dir(spark, "t-other")) == got      # a stream that starts over


def test_two_exports_in_one_batch(spark, folders):
    ls.land_months(exports(spark, [(1, JAN, 3), (2, JAN, 1)]), folders[0])
    ls.land_months(exports(spark, [(1, JAN, 9)]), folders[0])
    assert run(spark, *folders) == [(1, 9)]


def test_a_month_in_many_files(spark, folders):
    ls.land_months(exports(spark, [(i, JAN, i) for i in range(200)]).repartition(8), folders[0])
    assert run(spark, *folders) == [(i, i) for i in range(200)]


def test_an_incomplete_export_is_not_read(spark, folders):
    land = folders[0]
    ls.land_months(exports(spark, [(1, JAN, 3)]), land)
    exports(spark, [(1, JAN, 7)]).write.parquet(f"{land}/data/export=9/month=2024_01")   # no manifest yet
    assert run(spark, *folders) == [(1, 3)]


def test_withdrawn_month_and_missing_date(spark, folders):
    ls.land_months(exports(spark, [(1, JAN, 3), (2, FEB, 4)]), folders[0])
    run(spark, *folders)
    ls.land_months(exports(spark, [(1, JAN, 5)]), folders[0], withdrawn=("2024_02",))
    assert run(spark, *folders) == [(1, 5)]
    with pytest.raises(Exception, match="without sensing_date"):
        ls.land_months(exports(spark, [(1, None, 5)]), folders[0])
