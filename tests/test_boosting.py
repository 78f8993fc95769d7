"""The boosted trees against plain in-memory versions of the same definitions."""

import heapq
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import boosting as B
from sensorlake.operators import forest
from sensorlake.operators.boosting import Bins, BoostParams, Task

FEATURES = ["f0", "f1"]


def table(spark, n=1500, categories=40, seed=1, folds=1, missing=0.2):
    rng = np.random.default_rng(seed)
    f0 = np.round(rng.normal(size=n), 1)
    f1 = rng.integers(0, 6, n).astype(float)
    f0[rng.random(n) < missing] = np.nan
    category = rng.integers(0, categories, n)
    label = np.where(np.isnan(f0), 2.0, f0) + (category % 3) + 0.2 * f1 + 0.3 * rng.normal(size=n)
    fold = rng.integers(1, folds + 1, n)
    rows = [(int(c), int(k), float(y), None if np.isnan(a) else float(a), float(b)) for c, k, y, a, b in zip(category, fold, label, f0, f1)]
    return spark.createDataFrame(rows, "category long, fold int, label double, f0 double, f1 double"), rows


def route(tree, row):
    """A row's leaf in an exported tree."""
    at = 0
    while tree["feature"][at] != forest.LEAF:
        f = tree["feature"][at]
        if f == forest.CATEGORY:
            left = row[0] in tree["left_set"][at]
        elif row[3 + f] is None:
            left = tree["missing_left"][at]
        else:
            left = row[3 + f] <= tree["cut"][at]
        at = at + 1 if left else tree["right"][at]
    return at


def plain_tree(rows, residual, alpha, params, edges):
    """Best-first growth by trying every split on the rows themselves."""
    g = np.where(residual > 0, alpha, alpha - 1.0)
    category = np.array([r[0] for r in rows])
    x = np.array([[np.nan if v is None else v for v in r[3:]] for r in rows])

    def best(idx):
        found = (0.0, None)
        whole = g[idx].sum() ** 2 / len(idx)

        def consider(left, penalty, found):
            a, b = idx[left], idx[~left]
            if min(len(a), len(b)) < params.min_leaf_rows:
                return found
            gain = g[a].sum() ** 2 / (len(a) + penalty) + g[b].sum() ** 2 / (len(b) + penalty) - whole
            return (gain, (a, b)) if gain > found[0] + 1e-9 else found

        for f in range(x.shape[1]):
            v = x[idx, f]
            for missing_left in [False, True] if np.isnan(v).any() else [False]:
                for e in edges[f]:
                    found = consider(np.where(np.isnan(v), missing_left, v <= e), 0.0, found)
        own = [c for c in np.unique(category[idx]) if (category[idx] == c).sum() >= params.category_smooth]
        mean = {c: g[idx][category[idx] == c].sum() / ((category[idx] == c).sum() + params.category_smooth) for c in own}
        order = sorted(own, key=lambda c: (mean[c], c))
        for way in (order, order[::-1]):
            for k in range(1, min(params.category_most, len(way)) + 1):
                found = consider(np.isin(category[idx], way[:k]), params.category_penalty, found)
        return found

    leaves, heap, names = {0: np.arange(len(rows))}, [], 1

    def offer(node):
        gain, parts = best(leaves[node])
        if parts:
            heapq.heappush(heap, (-gain, node, parts))

    offer(0)
    while heap and len(leaves) < params.leaves:
        _, node, parts = heapq.heappop(heap)
        del leaves[node]
        for part in parts:
            leaves[names] = part
            offer(names)
            names += 1
    return list(leaves.values())


def lower_quantile(values, alpha):
    values = np.sort(values)
    return values[max(int(np.ceil(alpha * len(values) - 1e-9)) - 1, 0)]


@pytest.mark.parametrize("alpha", [0.1, 0.5])
def test_trees_are_best_first_and_leaves_hold_quantiles(spark, alpha):
    """Two rounds, without sampling, against trees grown on the rows."""
    df, rows = table(spark)
    params = BoostParams(rounds=2, leaves=9, depth=0, min_leaf_rows=30, subsample=1.1, colsample=1.0, sketch=4000, bins=4000)
    (got,) = B.fit(df, FEATURES, [Task(alpha)], params)
    label = np.array([r[2] for r in rows])
    edges = [sorted({r[3 + f] for r in rows if r[3 + f] is not None}) for f in range(2)]
    score = np.full(len(rows), got.init)
    assert np.isclose(got.init, lower_quantile(label, alpha))
    for tree in got.trees:
        ends = np.array([route(tree, r) for r in rows])
        parts = {frozenset(np.flatnonzero(ends == e).tolist()) for e in set(ends)}
        want = plain_tree(rows, label - score, alpha, params, edges)
        assert parts == {frozenset(p.tolist()) for p in want}
        for p in want:
            value = params.learning_rate * lower_quantile((label - score)[p], alpha)
            assert np.isclose(tree["value"][ends[p[0]]], value)
        score += np.array([tree["value"][e] for e in ends])


def test_models_fitted_together_equal_models_fitted_alone(spark):
    """Folds and quantiles share jobs, not results."""
    df, _ = table(spark, folds=2)
    params = BoostParams(rounds=3, leaves=7, subsample=1.1, colsample=1.0)
    together = B.fit(df, FEATURES, [Task(0.5, 1), Task(0.9, 1), Task(0.5, 0)], params)
    alone = B.fit(df.filter("fold > 1").withColumn("fold", F.lit(1)), FEATURES, [Task(0.5)], params)
    assert together[0].trees == alone[0].trees and together[0].init == alone[0].init
    assert together[2].trees != together[0].trees


def test_jobs_do_not_depend_on_the_number_of_models(spark, monkeypatch):
    df, _ = table(spark, n=600, folds=3)
    jobs = []
    summed = B._summed
    monkeypatch.setattr(B, "_summed", lambda *a: jobs.append(a[3]) or summed(*a))
    params = BoostParams(rounds=2, leaves=4, depth=2)
    used = []
    for tasks in ([Task(0.5)], [Task(a, k) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for k in range(3)]):
        jobs.clear()
        B.fit(df, FEATURES, tasks, params)
        used.append(len(jobs))
    assert used[0] == used[1] == 2 * (2 + 1)


def test_missing_values_carry_the_signal(spark):
    rng = np.random.default_rng(3)
    rows = [(1, 1, float(10 * m + rng.normal()), None if m else float(rng.normal()), 0.0) for m in rng.integers(0, 2, 1000)]
    df = spark.createDataFrame(rows, "category long, fold int, label double, f0 double, f1 double")
    (got,) = B.fit(df, FEATURES, [Task(0.5)], BoostParams(rounds=30, learning_rate=0.3, leaves=4))
    x, c = F.array("f0", "f1"), F.col("category")
    error = df.select(F.avg(F.abs(forest.scored(got, x, c) - F.col("label")))).first()[0]
    assert error < 1.0


def test_many_categories(spark):
    """50,000 locations: no list of them is needed, splits stay small."""
    df = spark.range(100_000).select(
        (F.col("id") % 50_000).alias("category"),
        F.lit(1).alias("fold"),
        (F.when(F.col("id") % 50_000 < 20, 5.0).otherwise(0.0) + F.rand(1)).alias("label"),
        F.rand(2).alias("f0"),
        F.lit(0.0).alias("f1"),
    )
    few = BoostParams(rounds=2, leaves=4, category_smooth=1.0, category_penalty=0.0, min_leaf_rows=20, colsample=1.0)
    (got,) = B.fit(df, FEATURES, [Task(0.999)], few)
    named = [s for t in got.trees for s in t["left_set"] if s]
    assert all(len(s) <= few.category_most for s in named)
    assert len(got.trees) == 2


def test_forest_walk_equals_the_trees_without_python(spark):
    df, rows = table(spark, seed=5)
    (got,) = B.fit(df, FEATURES, [Task(0.5)], BoostParams(rounds=4, leaves=12))
    out = df.withColumn("x", F.array("f0", "f1"))
    out = out.withColumn("score", forest.scored(got, F.col("x"), F.col("category")))
    want = sorted(got.init + sum(t["value"][route(t, r)] for t in got.trees) for r in rows)
    assert np.allclose(sorted(r["score"] for r in out.collect()), want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "from_json" not in plan and "Invoke" not in plan


def test_a_large_forest_plans_quickly(spark):
    df, _ = table(spark, n=300)
    (got,) = B.fit(df, FEATURES, [Task(0.5)], BoostParams(rounds=2, leaves=31, min_leaf_rows=5))
    got.trees = got.trees * 600
    began = time.time()
    df.select(forest.scored(got, F.array("f0", "f1"), F.col("category")).alias("s"))._jdf.queryExecution().executedPlan()
    assert time.time() - began < 5


def test_unknown_category_and_missing_values_have_a_side(spark):
    df, _ = table(spark)
    (got,) = B.fit(df, FEATURES, [Task(0.5)], BoostParams(rounds=3))
    other = spark.createDataFrame([(None, None, None), (10**12, 1e9, -1e9)], "category long, f0 double, f1 double")
    assert other.filter(forest.scored(got, F.array("f0", "f1"), F.col("category")).isNull()).count() == 0


def test_sketches_merge_within_their_bound():
    rng = np.random.default_rng(2)
    parts = [rng.normal(size=n) + i for i, n in enumerate((5, 400, 3000, 10_000))]
    values, weight = map(np.concatenate, zip(*(B.sketch(p, 64) for p in parts)))
    every = np.sort(np.concatenate(parts))
    assert weight.sum() == len(every)
    for alpha in (0.1, 0.5, 0.9):
        got = B.weighted_quantile(values, weight, alpha)
        rank = np.searchsorted(every, got) / len(every)
        assert abs(rank - alpha) <= 1 / 64


def test_bins_keep_missing_and_far_values_apart():
    bins = Bins((np.array([1.0, 2.0]), np.array([])))
    placed = bins.place(np.array([[np.nan, np.nan], [0.0, 3.0], [1.5, np.nan], [9.0, 0.0]]))
    assert placed[:, 0].tolist() == [0, 1, 2, 2] and placed[0, 1] == 3


def test_no_rows_is_an_error(spark):
    df, _ = table(spark, n=10)
    with pytest.raises(ValueError, match="empty training set"):
        B.fit(df.limit(0), FEATURES, [Task(0.5)], BoostParams(rounds=1))


def blocks(n_blocks, models, seed=4):
    """Blocks as stored, with the arrays they were made of."""
    rng, bins = np.random.default_rng(seed), Bins(tuple(np.arange(w, dtype=float) for w in (63, 63, 24, 7, 2)))
    out, made = [], []
    for number in range(n_blocks):
        n = int(rng.integers(3000, 5000))
        raw = np.stack([rng.integers(0, len(e), n).astype(float) for e in bins.edges], axis=1)
        raw[rng.random(raw.shape) < 0.2] = np.nan
        x, category, fold = bins.place(raw), rng.integers(-3, 9, n), rng.integers(1, 3, n).astype(np.uint8)
        label, score = rng.normal(size=n), rng.normal(size=(models, n))
        made.append(B.Block(number, x, category, fold, label > score, label, score))
        out.append(made[-1].state())
    return bins, made, [B._states(out[i : i + 2]) for i in range(0, n_blocks, 2)]


def test_blocks_of_a_task_are_counted_together(monkeypatch):
    """One row per node for all blocks, with the counts of every single row;
    a node is counted once a chunk, however many blocks that has."""
    tasks, params = [Task(0.1, 1), Task(0.5), Task(0.9)], BoostParams()
    bins, made, batches = blocks(5, len(tasks))
    split = {0: B.Split(0, 30, True, None, 1, 2), 1: B.Split(-1, 0, False, np.array([-2, 4, 5]), 3, 4)}
    growing = {m: (split, {2, 3, 4}) for m in range(len(tasks))}
    calls, counted = [], B.Counter.bins
    monkeypatch.setattr(B.Counter, "bins", lambda self, rows, up: calls.append(len(rows)) or counted(self, rows, up))
    got = {(r["model"], r["node"]): r for b in B._histograms(tasks, growing, bins.first, 1, params)(iter(batches)) for r in b.to_pylist()}
    assert len(calls) == len(got) == 9
    assert min(calls) < B.CELLS < max(calls)  # counted by feature, and by pack
    for (m, node), row in got.items():
        want = np.zeros((2, bins.first[-1]), np.int64)
        by_category = {}
        for b in made:
            rng = np.random.default_rng([params.seed, 1, b.number])
            for i, drawn in enumerate(rng.random(len(b.fold)) < params.subsample):
                if not drawn or b.fold[i] <= tasks[m].fold:
                    continue
                at = 2 if b.x[i, 0] > 30 else 3 if b.category[i] in (-2, 4, 5) else 4
                if at == node:
                    want[0, b.x[i]] += 1
                    want[1, b.x[i]] += int(b.above[m, i])
                    n, p = by_category.get(int(b.category[i]), (0, 0))
                    by_category[int(b.category[i])] = n + 1, p + int(b.above[m, i])
        assert (np.frombuffer(row["bins"], np.int64).reshape(2, -1) == want).all()
        lists = [np.frombuffer(row[c], np.int64).tolist() for c in ("category", "rows", "above")]
        assert {c: (n, p) for c, n, p in zip(*lists)} == by_category


def test_packs_hold_every_feature_within_their_cells():
    first = np.cumsum([0, 64, 64, 64, 64, 64, 25, 8, 3, 13, 3, 6000])
    packs, width = B.packs(first), np.diff(first)
    assert sorted(f for p in packs for f in p) == list(range(len(width)))
    assert all(np.prod(width[list(p)]) <= B.CELLS for p in packs if len(p) > 1) and (10,) in packs


def test_new_scores_keep_the_blocks(spark):
    tasks = [Task(0.1, 1), Task(0.5)]
    bins, made, batches = blocks(4, len(tasks))
    split = {0: B.Split(0, 30, False, None, 1, 2)}
    step = B._next_scores(tasks, {m: (split, {1: 0.25, 2: -0.5}) for m in range(2)}, bins.first)
    got = [r for b in step(iter(batches)) for r in b.to_pylist()]
    assert [r["block"] for r in got] == [b.number for b in made]
    for r, b in zip(got, made):
        left = (b.x[:, 0] <= 30) & (b.x[:, 0] != 0)
        score = b.score + np.where(left, 0.25, -0.5) * np.stack([b.fold > t.fold for t in tasks])
        want = B.Block(b.number, b.x, b.category, b.fold, b.label > score, b.label, score).state()
        assert tuple(r[c] for c in ("block", "rows", "x", "category", "fold", "label", "above", "score")) == want


def test_the_stored_blocks_come_few_at_a_time(spark, monkeypatch):
    """Spark's reader holds a row group's rows, each of them a block: a group
    of all of a task's blocks took an executor's memory."""
    kept, batch_bytes = [], set()
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    summed, was = B._summed, spark.conf.get(setting)
    monkeypatch.setattr(B, "delete", lambda _, path: kept.append(path))
    monkeypatch.setattr(B, "_summed", lambda *a: batch_bytes.add(spark.conf.get(setting)) or summed(*a))
    df = spark.range(0, 400_000, 1, 4).selectExpr("id % 3 category", "1 fold", "id % 7 label", "id % 11 f0", "id % 5 f1")
    B.fit(df, FEATURES, [Task(0.5)], BoostParams(rounds=2, leaves=2))
    for state in (p for p in kept if "/state-" in p):
        files = [pq.ParquetFile(f).metadata for f in Path(state.removeprefix("file:")).glob("*.parquet")]
        groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
        assert sum(groups) >= 400_000 / B.BLOCK and max(f.num_rows for f in files) > max(groups)
        assert max(groups) <= 4
    assert len([p for p in kept if "/state-" in p]) == 2
    assert batch_bytes == {str(B.SENT)} and spark.conf.get(setting) == was


def test_a_task_sends_what_it_holds(monkeypatch):
    """Counts and residuals of a task of many rows come in parts that add up."""
    tasks, params = [Task(0.1, 1), Task(0.5)], BoostParams(sketch=16)
    bins, made, batches = blocks(12, len(tasks))
    split = {0: B.Split(0, 30, True, None, 1, 2)}
    trees = {m: (split, {1, 2}) for m in range(len(tasks))}
    columns = {m: np.arange(-1, len(bins.edges)) for m in trees}

    def sent(step):
        return [r for b in step(tasks, trees, bins.first, 1, params)(iter(batches)) for r in b.to_pylist()]

    def merged(rows, key, step):
        rows = sorted(rows, key=lambda r: (r["model"], r[key]))
        schema = {"node": B._HISTOGRAM_SCHEMA, "leaf": B._SKETCH_SCHEMA}[key]
        return [r for b in step(iter([pa.RecordBatch.from_pylist(rows, schema)])) for r in b.to_pylist()]

    monkeypatch.setattr(B, "COUNTED", 5000)
    monkeypatch.setattr(B, "SCORED", 5000)
    whole, leaves = sent(B._histograms), sent(B._residuals)
    assert len(whole) == len(leaves) == 4
    monkeypatch.setattr(B, "CATEGORIES", 50)
    monkeypatch.setattr(B, "RESIDUALS", 5000)
    monkeypatch.setattr(B, "SENT", 1)  # every row a batch
    parts, sketches = sent(B._histograms), sent(B._residuals)
    assert len(parts) > 2 * len(whole) and len(sketches) > 2 * len(leaves)

    splits = B._best_splits(tasks, columns, bins.first, params)
    by_node = {(r["model"], r["node"]): r for r in merged(whole, "node", splits)}
    assert len(by_node) == 4 and all(r["feature"] > -2 for r in by_node.values())
    assert {(r["model"], r["node"]): r for r in merged(parts, "node", splits)} == by_node

    weight = lambda rows: sum(np.frombuffer(r["weight"], np.int64).sum() for r in rows)
    assert weight(sketches) == weight(leaves) == sum(r["rows"] for r in by_node.values())
    values = {(r["model"], r["leaf"]): r["value"] for r in merged(sketches, "leaf", B._leaf_values(tasks))}
    every = {at: [] for at in values}
    for b in made:
        drawn = np.random.default_rng([params.seed, 1, b.number]).random(len(b.fold)) < params.subsample
        for m, t in enumerate(tasks):
            for leaf, side in ((1, b.x[:, 0] <= 30), (2, b.x[:, 0] > 30)):
                every[m, leaf].append((b.label - b.score[m])[drawn & (b.fold > t.fold) & side])
    for (m, leaf), value in values.items():
        rank = (np.concatenate(every[m, leaf]) <= value).mean()
        assert abs(rank - tasks[m].alpha) <= 1 / (2 * params.sketch) + 0.01
