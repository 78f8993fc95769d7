"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from oracle_check import compare, duck
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_every_query_has_an_oracle_or_is_a_model():
    """Corpus operators without SQL have brute-force tests in tests/llm."""
    missing = {q for q in set(queries()) - set(oracle_sql()) if q != "pipeline" and not q.startswith("op")}
    assert missing <= {"quantile_forecast", "model_backtest", "compare_methods"}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "daily_count" in df.columns


def test_entry_without_the_corpus_operators(monkeypatch):
    import sys

    for name in [m for m in sys.modules if m.startswith(("sensorlake.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "sensorlake.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    names = set(queries())
    assert "mart_daily" in names and not any(n == "pipeline" or n.startswith("op") for n in names)
    assert set(oracle_sql()) <= names
