import pytest
from pyspark.sql import functions as F

from conftest import rows
from sensorlake.sources import export, fs, readers, versions


def parts(spark, data):
    return spark.createDataFrame([(i, m) for i, m in data], "id long, month string")


def table(spark, dest, version=None):
    got = versions.read(spark, dest, "month", version)
    return [] if got is None else rows(got, "id", "month")


@pytest.fixture
def dest(spark):
    return fs.scratch_dir(spark, "test-versions")


def test_replaced_new_and_emptied_parts_appear_together(spark, dest):
    first, n = versions.replace(parts(spark, [(1, "a"), (2, "b"), (3, "c")]), dest, "month")
    assert n == 3
    reader = versions.read(spark, dest, "month")
    versions.replace(parts(spark, [(20, "b"), (4, "d")]), dest, "month", ["b", "c", "d"])
    assert table(spark, dest) == [(1, "a"), (4, "d"), (20, "b")]
    # A reader made before goes on with its version; so does one that names it.
    assert rows(reader, "id") == [(1,), (2,), (3,)]
    assert table(spark, dest, first) == [(1, "a"), (2, "b"), (3, "c")]
    versions.replace(parts(spark, []), dest, "month", ["a", "b", "d"])
    assert table(spark, dest) == []


def test_a_killed_writer_changes_nothing(spark, dest, monkeypatch):
    versions.replace(parts(spark, [(1, "a"), (2, "b")]), dest, "month")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            versions.replace(parts(spark, [(9, "a")]), dest, "month", ["a", "b"])
    assert table(spark, dest) == [(1, "a"), (2, "b")]
    # A task that fails while it writes, likewise; then the work is repeated.
    broken = parts(spark, [(9, "a")]).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        versions.replace(broken, dest, "month", ["a", "b"])
    assert table(spark, dest) == [(1, "a"), (2, "b")]
    versions.replace(parts(spark, [(9, "a")]), dest, "month", ["a", "b"])
    assert table(spark, dest) == [(9, "a")]
    assert versions.vacuum(spark, dest, "month", keep=1) == 3
    assert table(spark, dest) == [(9, "a")]


def test_two_writers_do_not_overwrite_each_other(spark, dest):
    seen, _ = versions.replace(parts(spark, [(1, "a")]), dest, "month")
    versions.commit(spark, dest, seen, {"a": seen.parts["a"]})
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, dest, seen, {})
    assert table(spark, dest) == [(1, "a")]


def test_rows_that_no_version_could_show_are_refused(spark, dest):
    versions.replace(parts(spark, [(1, "a")]), dest, "month")
    with pytest.raises(ValueError, match="not replaced"):
        versions.replace(parts(spark, [(2, "z")]), dest, "month", ["a"])
    with pytest.raises(ValueError, match="without month"):
        versions.replace(parts(spark, [(2, None)]), dest, "month")
    assert table(spark, dest) == [(1, "a")]


def test_vacuum_keeps_what_versions_list(spark, dest):
    for i in range(4):
        versions.replace(parts(spark, [(i, "a"), *([(9, "b")] if i == 0 else [])]), dest, "month", ["a", "b"] if i == 0 else ["a"])
    before = versions.at(spark, dest, 3)
    assert versions.vacuum(spark, dest, "month", keep=2) == 2
    assert table(spark, dest) == [(3, "a"), (9, "b")] and table(spark, dest, before) == [(2, "a"), (9, "b")]


def test_published_table_is_there_at_any_moment(spark, dest, monkeypatch):
    name = "t_published"
    export.publish(spark.range(3), name, "table", dest)
    monkeypatch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        export.publish(spark.range(5), name, "table", dest)
    assert spark.table(name).count() == 3
    monkeypatch.undo()
    statements, sql = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: statements.append(q) or sql(q, *a, **k))
    assert export.publish(spark.range(5), name, "table", dest).count() == 5 == spark.table(name).count()
    assert not any("DROP" in q for q in statements)
    old = versions.at(spark, dest, 1)
    assert versions.read(spark, dest, version=old).count() == 3
    other = export.publish(spark.range(2).withColumn("x", F.lit(1)), name, "table", dest)
    assert other.columns == ["id", "x"] and readers.read_mart(spark, dest).count() == 2
    export.publish(spark.range(0).withColumn("x", F.lit(1)), name, "table", dest)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 0
    sql(f"DROP TABLE {name}")


def test_largest_value_from_footers(spark, dest):
    version, _ = versions.replace(parts(spark, [(i, "ab"[i % 2]) for i in range(100)]), dest, "month")
    assert versions.largest(spark, dest, "month", version, "id") == 99
    assert versions.largest(spark, dest, "month", version, "id", ["a"]) == 98
    assert versions.largest(spark, dest, "month", versions.Version(0), "id") is None
    confs = {k: spark.conf.get(k, None) for k in versions._FOOTERS}
    with versions.from_footers(spark):
        plan = versions.read(spark, dest, "month").agg(F.max("id"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    assert {k: spark.conf.get(k, None) for k in versions._FOOTERS} == confs
