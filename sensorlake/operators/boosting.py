"""Gradient-boosted quantile trees, many models in one pass (M2, M3, M6).

All models (every fold of a backtest, every quantile) are fitted together on
one table of training rows.  A model differs from the others by its quantile
and by the rows it may see; rows are binned once and shared, each carries one
score per model.  A round grows one tree per model:

* Each *wave* is one job.  Tasks route their rows down the trees so far and
  return, per (model, open node), how many rows and how many rows above their
  score fall into each bin of each feature: the pinball loss has no other
  gradients.  These histograms are added up by (model, node) and give the
  node's best split; only that one row per node reaches the driver.
* Trees grow by largest gain to ``leaves`` leaves.  A wave asks for the
  children of all nodes that the order by gain splits as far as it is known;
  when it knows all it needs, the tree is exactly the best-first one.  A tree
  takes as many waves as it is deep (``depth`` at most), whatever the number
  of models.
* A leaf's value is the quantile of its residuals, from mergeable sketches of
  up to ``sketch`` equal shares of a task's residuals (of every ``RESIDUALS``
  of them): exact for leaves of so few rows a task, else within
  1 / (2 ``sketch``) of the rank.
* The next round's rows, with their new scores, are a written table: a lost
  executor repeats one round's tasks at most.
* A task's memory does not grow with its rows: the table's row groups hold a
  few blocks, batches a few megabytes, and counts and residuals are sent when
  so many are held.

Missing values have a bin of their own, and every split learns the side they
go to.  Categories (the location) are split by the order of their gradients;
the smaller side, up to ``category_most`` of them, is named in the split, so a
tree's size does not grow with the number of categories, and no list of them
reaches the driver.  Rows are dealt out by category, so that tasks hold few
each.  Rows are sampled per round, columns per tree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settings, ship_code
from ..sources.fs import delete, scratch_dir

#: Rows per block of the training table, and rows per task that it aims at.
BLOCK = 16_384
PER_TASK = 1_000_000
#: Rows of a task that are counted together, and that get new scores together.
COUNTED = 64 * BLOCK
SCORED = 16 * BLOCK
#: Cells of the bins of some features that are counted together, at most.
CELLS = 4096
#: Categories with counts, and residuals, that a task holds before it sends them.
CATEGORIES = 1 << 20
RESIDUALS = 8 << 20
#: Bytes of a batch between the JVM and Python.
SENT = 8 << 20
#: A block is a row of megabytes: one a page, few a row group.  Spark's reader
#: holds a row group's rows at once, the writer a page's.
_STORED = {"parquet.page.row.count.limit": 1, "parquet.block.row.count.limit": 4, "parquet.enable.dictionary": "false"}


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 400
    learning_rate: float = 0.06
    leaves: int = 63
    depth: int = 8  # 0: no bound
    min_leaf_rows: int = 40
    subsample: float = 0.9
    colsample: float = 0.9
    bins: int = 63
    sketch: int = 128
    category_smooth: float = 10.0
    category_penalty: float = 10.0
    category_most: int = 32
    seed: int = 42


@dataclass(frozen=True)
class Task:
    """One model: its quantile, and the last day it may learn from, as its
    place among all models' last days (0: the latest)."""

    alpha: float
    fold: int = 0


@dataclass
class Split:
    feature: int  # -1: the category
    cut: int  # the last bin that goes left
    missing_left: bool
    left_set: np.ndarray | None
    left: int = -1
    right: int = -1

    def goes_left(self, chunk: Chunk, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Each feature's bins stand from ``first``, the bin of missing values."""
        if self.left_set is not None:
            return np.isin(chunk.known, self.left_set)[chunk.code[rows]]
        at = chunk.x[self.feature][rows]
        left = at <= self.cut
        return left if self.missing_left else left & (at != first[self.feature])


@dataclass
class Tree:
    """Known nodes of a growing tree: what a node's best split would be."""

    size: dict[int, int] = field(default_factory=dict)
    level: dict[int, int] = field(default_factory=lambda: {0: 0})
    gain: dict[int, float] = field(default_factory=dict)
    split: dict[int, Split] = field(default_factory=dict)
    names: int = 1

    def learn(self, node: int, size: int, gain: float, split: Split | None, depth: int) -> None:
        self.size[node] = size
        if split is not None and gain > 0:
            split.left, split.right, self.names = self.names, self.names + 1, self.names + 2
            self.gain[node], self.split[node] = gain, split
            for child in (split.left, split.right):
                self.level[child] = self.level[node] + 1
                if self.level[child] == depth:
                    self.size[child] = 0  # a leaf: its split is not asked for

    def chosen(self, leaves: int) -> tuple[set[int], set[int]]:
        """Nodes that the order by gain splits, as far as it is known, and
        their children of unknown gain."""
        heap = [(-self.gain[0], 0)] if 0 in self.gain else []
        done, unknown = set(), set() if self.size else {0}
        while heap and len(done) < leaves - 1:
            _, node = heapq.heappop(heap)
            done.add(node)
            for child in (self.split[node].left, self.split[node].right):
                if child in self.gain:
                    heapq.heappush(heap, (-self.gain[child], child))
                elif child not in self.size:
                    unknown.add(child)
        return done, unknown


# --- rows in blocks -------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Upper bounds of the bins of each feature.  Feature f's bins stand from
    ``first[f]`` on, the one of missing values first."""

    edges: tuple[np.ndarray, ...]

    @property
    def first(self) -> np.ndarray:
        return np.cumsum([0, *(len(e) + 1 for e in self.edges)])

    def place(self, values: np.ndarray) -> np.ndarray:
        """Bins of a matrix of feature values (rows x features, NaN: missing)."""
        out = np.empty(values.shape, np.uint16)
        for f, (first, edges) in enumerate(zip(self.first, self.edges)):
            at = np.minimum(np.searchsorted(edges, values[:, f]), max(len(edges) - 1, 0)) + 1
            out[:, f] = first + np.where(np.isnan(values[:, f]), 0, at)
        return out


_STATE = "block long, rows int, x binary, category binary, fold binary, label binary, above binary, score binary"
_STATE_SCHEMA = pa.schema([("block", pa.int64()), ("rows", pa.int32()), *((c, pa.binary()) for c in ("x", "category", "fold", "label", "above", "score"))])


@dataclass(frozen=True)
class Block:
    number: int
    x: np.ndarray
    category: np.ndarray
    fold: np.ndarray  # of how many of the models' last days a row is not after
    above: np.ndarray  # by model: whether the label is above the score
    label: np.ndarray
    score: np.ndarray

    def state(self) -> tuple:
        columns = (self.x, self.category, self.fold, self.label, np.packbits(self.above), self.score)
        return (self.number, len(self.category), *(c.tobytes() for c in columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some ``SENT`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= SENT:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _states(blocks: list[tuple]) -> pa.RecordBatch:
    return _batch(blocks, _STATE_SCHEMA)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows, their binary values as views of the batch."""
    for batch in batches:
        columns = [(f.name, c, pa.types.is_binary(f.type)) for f, c in zip(batch.schema, batch.columns)]
        for i in range(batch.num_rows):
            yield {name: c[i].as_buffer() if view else c[i].as_py() for name, c, view in columns}


@dataclass(frozen=True)
class Chunk:
    """Blocks of a task side by side: a tree's node is then counted once for
    all of their rows, not once a block."""

    blocks: list[tuple[int, int]]  # number, rows
    x: np.ndarray  # by feature
    known: np.ndarray  # the distinct categories, and each row's place there
    code: np.ndarray
    fold: np.ndarray
    above: np.ndarray  # by model
    label: np.ndarray | None
    score: np.ndarray | None  # by model

    @staticmethod
    def read(rows: list[dict], models: int) -> Chunk:
        def get(c: str, kind, *shape: int, axis: int = -1) -> np.ndarray | None:
            if c in rows[0]:
                return np.concatenate([np.frombuffer(r[c], kind).reshape(*shape, r["rows"]) for r in rows], axis)

        x = [np.frombuffer(r["x"], np.uint16).reshape(r["rows"], -1).T for r in rows]
        above = [np.unpackbits(np.frombuffer(r["above"], np.uint8), count=models * r["rows"]).reshape(models, -1) for r in rows]
        category = pa.array(get("category", np.int64)).dictionary_encode()
        return Chunk(
            [(r["block"], r["rows"]) for r in rows],
            np.concatenate(x, axis=1, out=np.empty((len(x[0]), sum(r["rows"] for r in rows)), np.uint16)),
            category.dictionary.to_numpy(),
            category.indices.to_numpy(),
            get("fold", np.uint8),
            np.concatenate(above, axis=1).view(bool),
            get("label", np.float64),
            get("score", np.float64, models),
        )

    def sampled(self, round_: int, params: BoostParams) -> np.ndarray:
        drawn = [np.random.default_rng([params.seed, round_, number]).random(n) for number, n in self.blocks]
        return np.concatenate(drawn) < params.subsample

    def seen(self, tasks: list[Task], models, sampled: np.ndarray | None = None) -> dict[int, np.ndarray]:
        """The rows that each of some models may learn from, or those sampled."""
        by_fold = {}
        for k in {tasks[m].fold for m in models}:
            may = self.fold > k
            by_fold[k] = np.flatnonzero(may if sampled is None else may & sampled)
        return {m: by_fold[tasks[m].fold] for m in models}


def _chunks(batches: Iterator[pa.RecordBatch], models: int, most: int) -> Iterator[Chunk]:
    """A task's rows, some at a time.  Nothing of a chunk is held here."""
    held, size = [], 0
    for row in _rows(batches):
        held.append(row)
        size += row["rows"]
        row = None
        if size >= most:
            chunk, held, size = [Chunk.read(held, models)], [], 0
            yield chunk.pop()
    if held:
        chunk, held = [Chunk.read(held, models)], []
        yield chunk.pop()


def packs(first: np.ndarray) -> list[tuple[int, ...]]:
    """Features by the table their bins are counted in together: one of at
    most ``CELLS`` cells, unless a feature alone has more."""
    width, out = np.diff(first), []
    for f in np.argsort(-width, kind="stable").tolist():
        fits = (p for p in out if np.prod(width[p]) * width[f] <= CELLS)
        if (pack := next(fits, None)) is None:
            out.append([f])
        else:
            pack.append(f)
    return [tuple(p) for p in out]


class Counter:
    """Counts rows, and rows above, by bin and by category.  The features of a
    pack are counted in one table, which pays for nodes of many rows."""

    def __init__(self, chunk: Chunk, first: np.ndarray):
        self.chunk, self.first, self.width = chunk, first, np.diff(first)
        self.packs = [(p, self._cells(p)) for p in packs(first)]
        self.each = np.ascontiguousarray(chunk.x.T, np.min_scalar_type(2 * int(first[-1])))
        self.each *= 2
        self.code = chunk.code * 2

    def _cells(self, pack: tuple[int, ...]) -> np.ndarray:
        cell = np.zeros(self.chunk.x.shape[1], np.int32)
        for f in pack:
            cell *= np.int32(self.width[f])
            cell += self.chunk.x[f].astype(np.int32) - np.int32(self.first[f])
        return cell * 2

    def bins(self, rows: np.ndarray, up: np.ndarray) -> np.ndarray:
        out = np.empty((2, self.first[-1]), np.int64)
        if len(rows) < CELLS:
            n = np.bincount((self.each[rows] + up[:, None]).ravel(), minlength=2 * self.first[-1]).reshape(-1, 2)
            out[:] = n.sum(axis=1), n[:, 1]
            return out
        for pack, cell in self.packs:
            shape = (*self.width[list(pack)], 2)
            n = np.bincount(cell[rows] + up, minlength=np.prod(shape)).reshape(shape)
            for i, f in enumerate(pack):
                by_bin = n.sum(axis=tuple(j for j in range(len(pack)) if j != i))
                out[:, self.first[f] : self.first[f + 1]] = by_bin.sum(axis=1), by_bin[:, 1]
        return out

    def categories(self, rows: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, ...]:
        n = np.bincount(self.code[rows] + up, minlength=2 * len(self.chunk.known)).reshape(-1, 2)
        some = n.any(axis=1)
        return self.chunk.known[some], n[some].sum(axis=1), n[some, 1]


def _blocks(bins: Bins, init: np.ndarray, features: list[str]):
    """Rows (category, fold, label, features) as blocks with starting scores."""

    def made(number: int, rows: pa.Table) -> pa.RecordBatch:
        get = lambda c, kind: rows.column(c).to_numpy().astype(kind)
        x = bins.place(np.stack([get(c, np.float64) for c in features], axis=1))
        label = get("label", np.float64)
        score = np.repeat(init[:, None], len(label), axis=1)
        block = Block(number, x, get("category", np.int64), get("fold", np.uint8), label > score, label, score)
        return _states([block.state()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= BLOCK:
                rows = pa.Table.from_batches(held)
                yield made(number, rows.slice(0, BLOCK))
                number, size = number + 1, size - BLOCK
                held = rows.slice(BLOCK).to_batches()
        if size:
            yield made(number, pa.Table.from_batches(held))

    return run


# --- what tasks do in a round -----------------------------------------------------


def _route(split: dict[int, Split], wanted: set[int], chunk: Chunk, rows: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows that reach each wanted node."""
    todo = [(0, rows)]
    while todo:
        node, rows = todo.pop()
        if node in wanted:
            yield node, rows
        elif node in split and len(rows):
            s = split[node]
            left = s.goes_left(chunk, rows, first)
            todo += [(s.left, rows[left]), (s.right, rows[~left])]


def _on_the_way(tree: Tree, done: set[int]) -> dict[int, Split]:
    return {n: tree.split[n] for n in done}


_HISTOGRAM = "model int, node int, bins binary, category binary, rows binary, above binary"
_HISTOGRAM_SCHEMA = pa.schema([("model", pa.int32()), ("node", pa.int32()), *((c, pa.binary()) for c in ("bins", "category", "rows", "above"))])


def _added(key: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of their counts."""
    key, at = np.unique(key, return_inverse=True)
    return key, *(np.bincount(at, c, len(key)).astype(np.int64) for c in counts)


def _histograms(tasks: list[Task], growing: dict[int, tuple[dict[int, Split], set[int]]], first: np.ndarray, round_: int, params: BoostParams):
    def counts(chunk: Chunk) -> Iterator[tuple]:
        count, seen = Counter(chunk, first), chunk.seen(tasks, growing, chunk.sampled(round_, params))
        for m, (split, wanted) in growing.items():
            for node, rows in _route(split, wanted, chunk, seen[m], first):
                if len(rows):
                    up = chunk.above[m, rows]
                    yield (m, node), count.bins(rows, up), count.categories(rows, up)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """A row per node, for so many chunks as make ``CATEGORIES``."""
        bins: dict[tuple[int, int], np.ndarray] = {}
        categories: dict[tuple[int, int], list] = {}
        size = 0

        def taken() -> Iterator[tuple]:
            while bins:
                (m, node), here = bins.popitem()
                key, n, p = _added(*map(np.concatenate, zip(*categories.pop((m, node)))))
                yield m, node, here.tobytes(), key.tobytes(), n.tobytes(), p.tobytes()

        for chunk in _chunks(batches, len(tasks), COUNTED):
            for at, here, some in counts(chunk):
                bins[at] = bins.get(at, 0) + here
                categories.setdefault(at, []).append(some)
                size += len(some[0])
            del chunk
            if size >= CATEGORIES:
                yield from taken()
                size = 0
        yield from taken()

    return lambda batches: _batches(held(batches), _HISTOGRAM_SCHEMA)


_SPLIT = "model int, node int, rows long, gain double, feature int, cut int, missing_left boolean, left_set array<long>"
_SPLIT_SCHEMA = pa.schema(
    [("model", pa.int32()), ("node", pa.int32()), ("rows", pa.int64()), ("gain", pa.float64()), ("feature", pa.int32())]
    + [("cut", pa.int32()), ("missing_left", pa.bool_()), ("left_set", pa.list_(pa.int64()))]
)


def best_split(alpha: float, n: np.ndarray, p: np.ndarray, categories: tuple, columns: np.ndarray, first: np.ndarray, params: BoostParams):
    """(gain, feature, cut, missing_left, left_set) of a node's best split on
    the sampled ``columns`` (-1: the category) from its rows ``n`` and rows
    above ``p`` by bin; feature -2 if it has none."""
    width = first[1] - first[0]
    total, above = n[:width].sum(), p[:width].sum()
    least = params.min_leaf_rows
    gradient = lambda rows, up: up - (1 - alpha) * rows  # noqa: E731  of the pinball loss, negated
    whole = gradient(total, above) ** 2 / max(total, 1)
    best = (0.0, -2, 0, False, None)

    def gains(left_n, left_p, penalty=0.0):
        right_n, right_p = total - left_n, above - left_p
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gradient(left_n, left_p) ** 2 / (left_n + penalty) + gradient(right_n, right_p) ** 2 / (right_n + penalty) - whole
        return np.where((left_n >= least) & (right_n >= least), gain, 0.0)

    for f in columns[columns >= 0]:
        a, b = first[f], first[f + 1]
        up_to, above_to = np.cumsum(n[a + 1 : b]), np.cumsum(p[a + 1 : b])
        for missing_left in [False, True] if n[a] else [False]:
            gain = gains(up_to + missing_left * n[a], above_to + missing_left * p[a])
            if gain.size and gain.max() > best[0]:
                at = int(gain.argmax())
                # Without missing values, they would follow the larger side.
                side = missing_left if n[a] else bool(2 * up_to[at] >= total)
                best = (float(gain[at]), int(f), int(a + 1 + at), side, None)
    if (columns == -1).any():
        key, rows, up = categories
        often = rows >= params.category_smooth
        key, rows, up = key[often], rows[often], up[often]
        order = np.lexsort((key, gradient(rows, up) / (rows + params.category_smooth)))
        for way in (order, order[::-1]):
            way = way[: min(params.category_most, len(way))]
            gain = gains(np.cumsum(rows[way]), np.cumsum(up[way]), params.category_penalty)
            if gain.size and gain.max() > best[0]:
                at = int(gain.argmax())
                best = (float(gain[at]), -1, 0, False, np.sort(key[way[: at + 1]]))
    return best


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    """Sorted rows by model and key, one of them at a time."""
    return groupby(_rows(batches), lambda r: (r["model"], r[key]))


def _best_splits(tasks: list[Task], columns: dict[int, np.ndarray], first: np.ndarray, params: BoostParams):
    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        width = first[1] - first[0]
        for (m, node), rows in _by_key(batches, "node"):
            here, categories = 0, []
            for row in rows:
                here = here + np.frombuffer(row["bins"], np.int64).reshape(2, -1)
                categories.append([np.frombuffer(row[c], np.int64) for c in ("category", "rows", "above")])
            found = best_split(tasks[m].alpha, *here, _added(*map(np.concatenate, zip(*categories))), columns[m], first, params)
            yield m, node, int(here[0, :width].sum()), *found

    return lambda batches: _batches(splits(batches), _SPLIT_SCHEMA)


_SKETCH = "model int, leaf int, value binary, weight binary"
_VALUE_SCHEMA = pa.schema([("model", pa.int32()), ("leaf", pa.int32()), ("value", pa.float64())])
_SKETCH_SCHEMA = pa.schema([("model", pa.int32()), ("leaf", pa.int32()), ("value", pa.binary()), ("weight", pa.binary())])


def sketch(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` values that stand for equal shares of ``values``, each
    the middle of its share, and the shares' sizes."""
    values = np.sort(values)
    if len(values) <= most:
        return values, np.ones(len(values), np.int64)
    cut = np.linspace(0, len(values), most + 1).astype(np.int64)
    return values[(cut[:-1] + cut[1:] - 1) // 2], np.diff(cut)


def weighted_quantile(values: np.ndarray, weight: np.ndarray, alpha: float) -> float:
    """The smallest value with at least ``alpha`` of the weight up to it."""
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weight[order])
    return float(values[order[min(np.searchsorted(reached, alpha * reached[-1]), len(order) - 1)]])


def _residuals(tasks: list[Task], trees: dict[int, tuple[dict[int, Split], set[int]]], first: np.ndarray, round_: int, params: BoostParams):
    def residuals(chunk: Chunk) -> Iterator[tuple]:
        seen = chunk.seen(tasks, trees, chunk.sampled(round_, params))
        for m, (split, leaves) in trees.items():
            for leaf, rows in _route(split, leaves, chunk, seen[m], first):
                if len(rows):
                    yield (m, leaf), chunk.label[rows] - chunk.score[m, rows]

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """A sketch per leaf, for so many chunks as make ``RESIDUALS``."""
        held: dict[tuple[int, int], list] = {}
        size = 0

        def taken() -> Iterator[tuple]:
            while held:
                (m, leaf), parts = held.popitem()
                value, weight = sketch(np.concatenate(parts), params.sketch)
                yield m, leaf, value.tobytes(), weight.tobytes()

        for chunk in _chunks(batches, len(tasks), SCORED):
            for at, values in residuals(chunk):
                held.setdefault(at, []).append(values)
                size += len(values)
            del chunk
            if size >= RESIDUALS:
                yield from taken()
                size = 0
        yield from taken()

    return lambda batches: _batches(sketches(batches), _SKETCH_SCHEMA)


def _leaf_values(tasks: list[Task]):
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (m, leaf), rows in _by_key(batches, "leaf"):
            parts = [(np.frombuffer(r["value"]), np.frombuffer(r["weight"], np.int64)) for r in rows]
            yield m, leaf, weighted_quantile(*map(np.concatenate, zip(*parts)), tasks[m].alpha)

    return lambda batches: _batches(values(batches), _VALUE_SCHEMA)


def _next_scores(tasks: list[Task], trees: dict[int, tuple[dict[int, Split], dict[int, float]]], first: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, len(tasks), SCORED):
            seen, score = chunk.seen(tasks, trees), chunk.score
            for m, (split, values) in trees.items():
                for leaf, rows in _route(split, set(values), chunk, seen[m], first):
                    score[m, rows] += values[leaf]
            at = 0
            for number, n in chunk.blocks:
                part, at = slice(at, at + n), at + n
                label, scores = chunk.label[part], score[:, part]
                category = chunk.known[chunk.code[part]]
                yield _states([Block(number, chunk.x[:, part].T, category, chunk.fold[part], label > scores, label, scores).state()])
            del chunk, seen, score, label, scores, category

    return run


# --- fitting -----------------------------------------------------------------------


@dataclass
class Forest:
    """A fitted model: its starting score and its trees, as lists over their
    nodes (see ``operators.forest``)."""

    alpha: float
    init: float
    trees: list[dict[str, list]] = field(default_factory=list)


def _exported(split: dict[int, Split], values: dict[int, float], bins: Bins) -> dict[str, list]:
    """A tree's nodes in pre-order.  A leaf has feature -2."""
    out: dict[str, list] = {c: [] for c in ("feature", "cut", "missing_left", "left_set", "right", "value")}
    depth = 0

    def add(node: int, level: int) -> None:
        nonlocal depth
        depth = max(depth, level)
        s = split.get(node)
        at = len(out["feature"])
        cut = float(bins.edges[s.feature][s.cut - bins.first[s.feature] - 1]) if s and s.feature >= 0 else 0.0
        out["feature"].append(s.feature if s else -2)
        out["cut"].append(cut)
        out["missing_left"].append(bool(s and s.missing_left))
        out["left_set"].append(s.left_set.tolist() if s and s.left_set is not None else [])
        out["right"].append(0)
        out["value"].append(0.0 if s else values[node])
        if s:
            add(s.left, level + 1)
            out["right"][at] = len(out["feature"])
            add(s.right, level + 1)

    add(0, 0)
    return out | {"depth": depth}


def fit(rows: DataFrame, features: list[str], tasks: list[Task], params: BoostParams) -> list[Forest]:
    """One forest per task, in their order.

    ``rows``: category (long), fold (of how many of the tasks' last days a row
    is not after; a task learns from rows with fold > its own), label, and the
    features as numbers, null where missing.
    """
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(SENT)}):
        return _fit(rows, features, tasks, params)


def _fit(rows: DataFrame, features: list[str], tasks: list[Task], params: BoostParams) -> list[Forest]:
    spark = rows.sparkSession
    ship_code(spark)
    root = scratch_dir(spark, "boost")

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.options(compression="lz4", **(_STORED if name.startswith("state") else {})).parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    rows = write(rows.select("category", F.col("fold").cast("int").alias("fold"), "label", *[F.col(c).cast("double").alias(c) for c in features]), "rows")
    bins, init, size = _edges(rows, features, tasks, params)
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PER_TASK))
    # By category, a large one over several tasks.
    dealt = rows.repartitionByRange(parts, "category", F.xxhash64(*rows.columns))
    state = write(dealt.mapInArrow(_blocks(bins, init, features), _STATE), "state-0")
    delete(spark, f"{root}/rows")
    forests = [Forest(t.alpha, float(i)) for t, i in zip(tasks, init)]
    for round_ in range(params.rounds):
        trees = _grow(state, tasks, bins, round_, params)
        leaves = {m: (_on_the_way(t, done), _leaves(t, done)) for m, (t, done) in trees.items()}
        found = _summed(state, _residuals(tasks, leaves, bins.first, round_, params), _SKETCH, "leaf", _leaf_values(tasks), "model int, leaf int, value double")
        values: dict[int, dict[int, float]] = {m: {n: 0.0 for n in ends} for m, (_, ends) in leaves.items()}
        for r in found:
            values[r["model"]][r["leaf"]] = params.learning_rate * r["value"]
        for m, (split, _) in leaves.items():
            forests[m].trees.append(_exported(split, values[m], bins))
        if round_ + 1 < params.rounds:
            step = _next_scores(tasks, {m: (split, values[m]) for m, (split, _) in leaves.items()}, bins.first)
            state = write(state.mapInArrow(step, _STATE), f"state-{round_ + 1}")
        delete(spark, f"{root}/state-{round_}")
    delete(spark, root)
    return forests


def _edges(rows: DataFrame, features: list[str], tasks: list[Task], params: BoostParams) -> tuple[Bins, np.ndarray, int]:
    """Bins from the rows that every model may see, starting scores, rows."""
    shares = [(i + 1) / params.bins for i in range(params.bins)]
    last = max(t.fold for t in tasks)
    common = F.col("fold") > last
    sketched = [F.percentile_approx(F.when(common, F.col(c)), shares, 10_000).alias(c) for c in features]
    # One sketch of the labels per fold, in a bounded number of tasks: a single
    # one merges their sketches.
    alphas = {k: sorted({t.alpha for t in tasks if t.fold == k}) for k in {t.fold for t in tasks}}
    starts = [F.percentile_approx(F.when(F.col("fold") > k, F.col("label")), a, 10_000).alias(f"init_{k}") for k, a in alphas.items()]
    few = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    got = few.agg(F.count("*"), *starts, *sketched).first()
    if any(got[f"init_{k}"] is None for k in alphas):
        raise ValueError("cannot fit a quantile model on an empty training set")
    edges = tuple(np.unique(np.array(got[c] or [], np.float64)) for c in features)
    init = [got[f"init_{t.fold}"][alphas[t.fold].index(t.alpha)] for t in tasks]
    return Bins(edges), np.array(init, np.float64), got[0]


def _summed(state: DataFrame, send, sent: str, key: str, merge, merged: str) -> list:
    """What tasks send by (model, key), merged on the executors, which hold
    one key's at a time."""
    columns = [c for c in state.columns if c not in ("label", "score") or "leaf" == key]
    parts = state.select(*columns).mapInArrow(send, sent)
    return parts.repartition("model", key).sortWithinPartitions("model", key).mapInArrow(merge, merged).collect()


def _leaves(tree: Tree, done: set[int]) -> set[int]:
    ends = {c for n in done for c in (tree.split[n].left, tree.split[n].right)} - done
    return ends or {0}


def _grow(state: DataFrame, tasks: list[Task], bins: Bins, round_: int, params: BoostParams) -> dict[int, tuple[Tree, set[int]]]:
    """One tree per model: the known nodes and those of them that are split."""
    trees = {m: Tree() for m in range(len(tasks))}
    every = np.array([-1, *range(len(bins.edges))])
    taken = max(1, round(params.colsample * len(every)))
    columns = {m: np.random.default_rng([params.seed, round_, m]).permutation(every)[:taken] for m in trees}
    while True:
        growing = {}
        for m, tree in trees.items():
            done, unknown = tree.chosen(params.leaves)
            if unknown:
                growing[m] = (_on_the_way(tree, done), unknown)
        if not growing:
            return {m: (t, t.chosen(params.leaves)[0]) for m, t in trees.items()}
        send = _histograms(tasks, growing, bins.first, round_, params)
        found = _summed(state, send, _HISTOGRAM, "node", _best_splits(tasks, columns, bins.first, params), _SPLIT)
        for r in found:
            left_set = None if r["left_set"] is None else np.array(r["left_set"], np.int64)
            split = Split(r["feature"], r["cut"], r["missing_left"], left_set) if r["feature"] > -2 else None
            trees[r["model"]].learn(r["node"], r["rows"], r["gain"], split, params.depth)
        for m, (_, unknown) in growing.items():
            for node in unknown - trees[m].size.keys():
                trees[m].learn(node, 0, 0.0, None, params.depth)  # no sampled row is there


def folds_of(date: Column, last_days: list) -> Column:
    """How many of the last days a date is not after (last days descending)."""
    return sum(((date <= F.lit(d)).cast("int") for d in last_days), F.lit(0))
