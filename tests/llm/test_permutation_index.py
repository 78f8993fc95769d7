import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm.permutation_index import search

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k=5):
    seen = {}
    for i, v in rows:
        if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v):
            seen[(i, tuple(v))] = np.array(v, np.float32).astype(float)
    out = {}
    for (q, _), x in seen.items():
        if q % every == 0:
            near = [(-(x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()), i) for (i, _), y in seen.items() if i != q]
            out.setdefault(q, []).extend(near)
    return {q: sorted(set((round(s, 9), i) for s, i in n))[:k] for q, n in out.items()}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"]))
    return out


def awkward(n=400):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(30)]  # equal vectors: ties
    rows += [rows[3], rows[3], (None, rows[5][1]), (1000, None), (1001, []), (1002, [0.0] * 8)]
    rows += [(1003, [1.0, None] + [0.0] * 6), (1004, [float("nan")] * 8), (1005, [float("inf")] + [1.0] * 7), (1006, [1.0, 2.0])]
    rows += [(1010, [1e30] * 7 + [2e30]), (1020, [-1e-30] * 7 + [3e-30])]
    return rows


def test_small_tables_are_exact(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("rank", F.lit("clash")).withColumn("score", F.lit(1))
    assert got(search(df, F.col("vec_id") % 10 == 0)) == brute(rows, 10)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(i * 10, [1.0 + i] * 4 + [1.0] * 4) for i in range(n)]
    found = got(search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0))
    assert {q: len(v) for q, v in found.items()} == {i * 10: n - 1 for i in range(n) if n > 1}


def test_recall_on_a_larger_table(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((9000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    found = got(search(df, F.col("vec_id") % 300 == 0))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 9000, 300):
        s = unit @ unit[q]
        s[q] = -9
        hits += len(set(np.argsort(-s)[:5]) & {i for _, i in found[q]})
    assert hits / (5 * 30) >= 0.9


def test_recall_with_a_third_of_equal_rows(spark):
    """Queries that the common vector is near to, though others are nearer."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((9000, 32)).astype(np.float32)
    x[1::3] = x[1]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit[1]
    asked = [i for i in range(9000) if 0.25 < near[i] < 0.45][:40]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    found = got(search(df, F.col("vec_id").isin([*asked, 1, 4])))
    hits = 0
    for q in asked:
        s = unit @ unit[q]
        s[q] = -9
        hits += len(set(np.argsort(-s, kind="stable")[:5].tolist()) & {i for _, i in found[q]})
    assert hits / (5 * len(asked)) >= 0.9
    assert [i for _, i in found[1]] == [4, 7, 10, 13, 16] and [i for _, i in found[4]] == [1, 7, 10, 13, 16]


def test_recall_on_uncorrelated_vectors(spark):
    """16,000 random vectors of 128 dimensions have no near neighbours at all:
    the hardest case for any ranking by pivots."""
    x = np.random.default_rng(7).standard_normal((16_000, 128))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, len(x), 50):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(got[q] & set(np.argsort(-near)[:5].tolist()))
    assert hits / (5 * len(got)) >= 0.95
