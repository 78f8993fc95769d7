r"""Toxicity scores from a factorization machine over hashed terms.

A document's features are its distinct words (runs of characters other than
ASCII punctuation, space and controls; A-Z lower-cased) and the first four and
five characters of longer words, hashed into ``2**BITS`` bins.  The machine
scores b + sum_i w_i x + sum_{i<j} <v_i, v_j> x^2 over the present features:
the factors learn pairs, such as an insult next to a group's name, that no sum
of single weights expresses.

Fitting uses a bounded sample of the labelled rows, the ``SAMPLE`` first in
the order of a hash of doc_id, in one task.  Every bin that two examples share
is kept, as a term that says nothing alone may in a pair; bins without an
association of their own with the label learn at ``PACE`` of the rate, and all
weights shrink by ``SHRINK``, so that chance does not outweigh the others.
Four fifths of the sample fit the machine by AdaGrad, the last fifth fits the
logistic that turns its output into a probability.  The model is at most
2**BITS bins, some six megabytes, whatever the corpus.  Scoring reads every whole text, row by row, without a shuffle.

Edge cases: a null or empty text has no features and scores the machine's
intercept; labels that are null, or without a document, are not learned from;
a doc_id with several labels gives one example for each; with examples of one
class only (or none) every score is that class's share (0 without examples).
Repeated rows score alike.  Columns beside doc_id and text, and beside doc_id
and toxic in the labels, are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

BITS = 18
SAMPLE = 20_000
FACTORS = 4
EPOCHS = 20
VALUE = np.float32(0.3)
#: Deviation, in standard errors, above which a bin learns at the full rate,
#: and the part of it for the others.
DEVIATION = 4.0
PACE = 0.1
#: L2 penalty of weights and factors.
SHRINK = 1e-3

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text: str | None) -> np.ndarray:
    """Distinct bins of a text's terms, ascending."""
    if not text:
        return np.empty(0, np.int32)
    found = set(WORDS.findall(text.lower() if text.isascii() else text.translate(_UPPER)))
    found |= {w[:4] + "*" for w in found if len(w) > 4} | {w[:5] + "*" for w in found if len(w) > 5}
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return np.unique(hashed >> np.uint64(64 - BITS)).astype(np.int32)


class FactorizationMachine:
    def __init__(self, bins: np.ndarray, factors: int, seed: int = 7):
        """``bins``: the kept bins; the others are no features."""
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[bins] = np.arange(len(bins))
        self.b, self.w = 0.0, np.zeros(len(bins), np.float32)
        self.v = (0.01 * np.random.default_rng(seed).standard_normal((len(bins), factors))).astype(np.float32)
        self.slope, self.shift = 1.0, 0.0

    def raw(self, bins: np.ndarray) -> float:
        x = self.place[bins]
        return self._raw(x[x >= 0])[0]

    def _raw(self, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        v = self.v[x]
        s = v.sum(axis=0)
        pairs = 0.5 * float((s * s).sum() - (v * v).sum())
        return float(self.b + VALUE * self.w[x].sum() + VALUE * VALUE * pairs), v, s

    def probability(self, bins: np.ndarray) -> float:
        return _logistic(self.slope * self.raw(bins) + self.shift)

    def fit(self, examples: list[np.ndarray], labels: np.ndarray, epochs: int, rate: float = 0.1, pace: np.ndarray | None = None) -> None:
        """AdaGrad on the logistic loss; ``pace``: each bin's part of the rate."""
        pace = np.full(len(self.w), rate, np.float32) if pace is None else (rate * pace).astype(np.float32)
        rng = np.random.default_rng(11)
        kept = [p[p >= 0] for p in (self.place[x] for x in examples)]
        gb, gw, gv = 1e-6, np.full(len(self.w), 1e-6, np.float32), np.full(len(self.w), 1e-6, np.float32)
        for _ in range(epochs):
            for i in rng.permutation(len(kept)):
                x, y = kept[i], labels[i]
                z, v, s = self._raw(x)
                g = _logistic(z) - y
                if abs(g) < 0.01:
                    continue
                step = g * VALUE + SHRINK * self.w[x]
                gw[x] += step * step
                self.w[x] -= pace[x] * step / np.sqrt(gw[x])
                step = g * VALUE * VALUE * (s - v) + SHRINK * v
                gv[x] += (step * step).mean(axis=1)
                self.v[x] -= 0.2 * step * (pace[x] / np.sqrt(gv[x]))[:, None]
                gb += g * g
                self.b -= rate * g / gb**0.5

    def calibrate(self, examples: list[np.ndarray], labels: np.ndarray) -> None:
        """Fit slope and shift of the output's logistic (smoothed targets)."""
        z = np.array([self.raw(x) for x in examples])
        n1 = labels.sum()
        n0 = len(labels) - n1
        if n1 == 0 or n0 == 0:
            return
        target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        design = np.stack([z, np.ones_like(z)], axis=1)
        beta = np.array([1.0, 0.0])

        def loss(beta):
            t = design @ beta
            return float(np.logaddexp(0, t).sum() - target @ t)

        for _ in range(50):  # damped Newton steps
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
            step = np.linalg.solve(hess, design.T @ (p - target))
            size, before = 1.0, loss(beta)
            while size > 1e-4 and loss(beta - size * step) > before:
                size /= 2
            beta = beta - size * step
            if np.abs(size * step).max() < 1e-8:
                break
        if beta[0] > 0:
            self.slope, self.shift = float(beta[0]), float(beta[1])


def _logistic(z: float) -> float:
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def kept_bins(examples: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bins that two examples share, and the part of the rate at which each
    learns, by its deviation from independence of the label."""
    n, share = len(labels), labels.mean()
    every = np.concatenate(examples) if n else np.empty(0, np.int32)
    toxic = np.concatenate([x for x, y in zip(examples, labels) if y] or [np.empty(0, np.int32)])
    df = np.bincount(every, minlength=1 << BITS)
    expected = df * share
    spread = np.sqrt(expected * (1 - share) * (1 - df / max(n, 1)) + 1e-9)
    z = np.abs(np.bincount(toxic, minlength=1 << BITS) - expected) / spread
    bins = np.flatnonzero(df >= 2)
    return bins, np.where(z[bins] > DEVIATION, 1.0, PACE)


def train(examples: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS) -> FactorizationMachine:
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        machine = FactorizationMachine(np.empty(0, np.int64), factors)
        machine.b = 60.0 * share - 30.0
        return machine
    late = np.arange(len(labels)) % 5 == 4
    early = ~late if labels[~late].any() else np.ones(len(labels), bool)
    first = [x for x, e in zip(examples, early) if e]
    bins, pace = kept_bins(first, labels[early])
    machine = FactorizationMachine(bins, factors)
    machine.fit(first, labels[early], EPOCHS, pace=pace)
    machine.calibrate([x for x, e in zip(examples, late) if e], labels[late])
    return machine


def fit(docs: DataFrame, labels: DataFrame) -> FactorizationMachine:
    """Fit on the labelled documents; ``labels`` holds (doc_id, toxic) rows
    that may be learned from."""
    ship(docs.sparkSession)
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    # At most SAMPLE rows of two numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bins = [features(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "bins": [x.tobytes() for x in bins]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "toxic": [], "bins": []}), *batches])
        rows = rows.sort_values(["doc_id", "toxic", "bins"])
        # Deal the examples out evenly, whatever the order of ids.
        rows = rows.iloc[np.random.default_rng(3).permutation(len(rows))]
        examples = [np.frombuffer(x, np.int32) for x in rows["bins"]]
        machine = train(examples, rows["toxic"].to_numpy(dtype=np.int64))
        yield pd.DataFrame({"model": [pickle.dumps(machine)]})

    extracted = chosen.mapInPandas(extract, "doc_id long, toxic int, bins binary")
    model = extracted.repartition(1).mapInPandas(learn, "model binary").collect()
    return pickle.loads(bytes(model[0]["model"])) if model else train([], np.empty(0, np.int64))


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` added or replaced."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.value.probability(features(t)) for t in texts], dtype="float64")

    return docs.withColumn("score", scored(F.col("text"))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def held_out(doc_id: str, folds: int, fold: int):
    """Whether a row belongs to the held-out fold (crc32 of the id as text; a
    null id belongs to none)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))
