r"""Quality scores from a byte-level convolutional network in numpy.

A text's UTF-8 bytes, with a zero byte for its ends, are embedded; ``FILTERS``
learned filters ``WIDTH`` bytes wide slide over them.  The positions fall into
overlapping chunks of ``CHUNK`` (each shares a quarter with the next, the last
one ends with the text), which cover the whole text.  Every filter's largest
response in a chunk is the chunk's feature; the mean, the largest and the
smallest over all chunks enter one logistic output.  So a text is judged by
what its chunks hold, and by what one of them lacks.

A filter's response to a byte at one of its places is a table entry, so the
convolution adds ``WIDTH`` rows of the table per position.  Texts are scored
row by row, in blocks of positions, without a shuffle.

Fitting uses a bounded sample of the labelled documents, the ``SAMPLE`` first
in the order of a hash of the document, in one task; of a sampled text over
``LESSON`` chunks, so many evenly spaced ones are learned from.  Four fifths
of the sample fit the network by Adam (the gradient flows to the bytes of the
largest responses), the last fifth fits the logistic that turns its output
into a probability.  The model has a fixed size of some 0.3 MB.

Edge cases: a null or empty text is one chunk of ends; labels that are null,
or without a document, are not learned from; equal examples count once; with
examples of one class only (or none) every score is that class's share (0
without examples).  Repeated rows score alike.  Columns beside doc_id and
text, and beside doc_id and the label, are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_hash

FILTERS = 32
WIDTH = 7
EMBEDDING = 8
CHUNK = 256
#: Chunks consist of four units and advance by three.
UNIT = CHUNK // 4
SAMPLE = 4096
LESSON = 40
EPOCHS = 12
BATCH = 32
RATE = 0.01
SHRINK = 1e-4
#: Positions per block of the convolution.
BLOCK = 32 * UNIT


def octets(text: str | None) -> np.ndarray:
    """A text's bytes between ends, at least a chunk's worth."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    short = max(0, CHUNK - len(raw))
    return np.concatenate([np.zeros(WIDTH - 1, np.uint8), raw, np.zeros(short + WIDTH - 1, np.uint8)])


def chunk_starts(units: int) -> np.ndarray:
    """First units of the chunks that cover so many units (at least four)."""
    starts = np.arange(0, max(units - 3, 1), 3)
    return starts if starts[-1] + 4 >= units else np.r_[starts, units - 4]


class ByteNetwork:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
        self.weights = {
            "bytes": draw(1.0, 256, EMBEDDING),
            "filters": draw((WIDTH * EMBEDDING) ** -0.5, WIDTH, EMBEDDING, FILTERS),
            "offsets": np.zeros(FILTERS, np.float32),
            "output": draw(0.05, 3 * FILTERS),
            "bias": np.zeros(1, np.float32),
        }
        self.slope, self.shift = 1.0, 0.0
        self.table = self._table()

    def _table(self) -> np.ndarray:
        """Response by place in the filter, byte and filter."""
        return np.ascontiguousarray(np.einsum("be,kef->kbf", self.weights["bytes"], self.weights["filters"]))

    def _responses(self, raw: np.ndarray) -> np.ndarray:
        """Responses at the positions of ``raw`` (..., positions + WIDTH - 1)."""
        n = raw.shape[-1] - WIDTH + 1
        out = self.table[0].take(raw[..., :n], axis=0)
        row = np.empty_like(out)
        for k in range(1, WIDTH):
            self.table[k].take(raw[..., k : k + n], axis=0, out=row, mode="clip")
            out += row
        return out

    def _chunks(self, raw: np.ndarray) -> np.ndarray:
        """Chunk features of a whole text."""
        n = len(raw) - WIDTH + 1
        units = []
        for a in range(0, n, BLOCK):
            found = self._responses(raw[a : min(a + BLOCK, n) + WIDTH - 1])
            units.append(np.maximum.reduceat(found, np.arange(0, len(found), UNIT), axis=0))
        units = np.concatenate(units)
        starts = chunk_starts(len(units))
        top = np.maximum.reduce([units[starts + i] for i in range(4)])
        return np.maximum(top + self.weights["offsets"], 0)

    def _pooled(self, chunks: np.ndarray) -> np.ndarray:
        return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])

    def raw(self, text: str | None) -> float:
        return float(self._pooled(self._chunks(octets(text))) @ self.weights["output"] + self.weights["bias"][0])

    def probability(self, text: str | None) -> float:
        return float(_logistic(self.slope * self.raw(text) + self.shift))

    def raw_of_lesson(self, rows: np.ndarray) -> float:
        top = np.concatenate([self._responses(rows[a : a + 8]).max(axis=1) for a in range(0, len(rows), 8)])
        chunks = np.maximum(top + self.weights["offsets"], 0)
        return float(self._pooled(chunks) @ self.weights["output"] + self.weights["bias"][0])

    # --- fitting ---

    def fit(self, lessons: list[np.ndarray], labels: np.ndarray, epochs: int) -> None:
        """Adam on the logistic loss; a lesson holds a text's chunks as rows of
        bytes."""
        rng = np.random.default_rng(11)
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        steps = epochs * -(-len(lessons) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(lessons))
            for a in range(0, len(order), BATCH):
                picked = order[a : a + BATCH]
                gradient = self._gradient([lessons[i] for i in picked], labels[picked])
                step += 1
                rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
                for k, w in self.weights.items():
                    g = gradient[k] + SHRINK * w
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    w -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                self.table = self._table()

    def _gradient(self, lessons: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        rows = np.concatenate(lessons)
        size = np.array([len(x) for x in lessons])
        first = np.cumsum(size) - size
        text = np.repeat(np.arange(len(size)), size)
        top, at = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64)
        for a in range(0, len(rows), 8):
            found = self._responses(rows[a : a + 8])
            at[a : a + 8] = found.argmax(axis=1)
            top[a : a + 8] = found.max(axis=1)
        chunks = np.maximum(top + self.weights["offsets"], 0)
        pooled = np.stack([self._pooled(chunks[f : f + s]) for f, s in zip(first, size)])
        z = pooled @ self.weights["output"] + self.weights["bias"][0]
        dz = ((_logistic(z) - labels) / len(labels)).astype(np.float32)
        w_mean, w_max, w_min = self.weights["output"].reshape(3, FILTERS)
        d = dz[text, None] * w_mean / size[text, None]
        # The largest and smallest chunk of each text take the rest.
        columns = np.arange(FILTERS)
        for i, (f, s) in enumerate(zip(first, size)):
            part = chunks[f : f + s]
            d[f + part.argmax(axis=0), columns] += dz[i] * w_max
            d[f + part.argmin(axis=0), columns] += dz[i] * w_min
        d = np.where(chunks > 0, d, 0).astype(np.float32)
        place = np.arange(WIDTH)
        seen = rows[np.arange(len(rows))[:, None, None], at[:, :, None] + place]
        flat = ((place * 256 + seen) * FILTERS + columns[:, None]).reshape(-1)
        weight = np.broadcast_to(d[:, :, None], seen.shape).reshape(-1)
        table = np.bincount(flat, weight, WIDTH * 256 * FILTERS).reshape(WIDTH, 256, FILTERS).astype(np.float32)
        return {
            "bytes": np.einsum("kbf,kef->be", table, self.weights["filters"]),
            "filters": np.einsum("kbf,be->kef", table, self.weights["bytes"]),
            "offsets": d.sum(axis=0),
            "output": dz @ pooled,
            "bias": dz.sum(keepdims=True),
        }

    def calibrate(self, lessons: list[np.ndarray], labels: np.ndarray) -> None:
        """Slope and shift of the output's logistic, by Newton steps on
        smoothed targets."""
        n1 = labels.sum()
        n0 = len(labels) - n1
        if not n1 or not n0:
            return
        target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        z = np.array([self.raw_of_lesson(x) for x in lessons])
        design = np.stack([z, np.ones_like(z)], axis=1)
        beta = np.array([1.0, 0.0])
        loss = lambda b: float(np.logaddexp(0, design @ b).sum() - target @ (design @ b))
        for _ in range(50):
            p = _logistic(design @ beta)
            curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
            move = np.linalg.solve(curve, design.T @ (p - target))
            part = 1.0
            while part > 1e-4 and loss(beta - part * move) > loss(beta):
                part /= 2
            beta = beta - part * move
            if np.abs(part * move).max() < 1e-8:
                break
        if beta[0] > 0:
            self.slope, self.shift = float(beta[0]), float(beta[1])


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30.0, 30.0)))


def lesson(text: str | None) -> np.ndarray:
    """Up to ``LESSON`` chunks of a text, evenly spaced, as rows of bytes."""
    raw = octets(text)
    units = -(-(len(raw) - WIDTH + 1) // UNIT)
    starts = chunk_starts(units)
    if len(starts) > LESSON:
        starts = starts[np.linspace(0, len(starts) - 1, LESSON).round().astype(int)]
    starts = np.minimum(starts * UNIT, len(raw) - CHUNK - WIDTH + 1)
    return raw[starts[:, None] + np.arange(CHUNK + WIDTH - 1)]


class Share:
    """The model of examples of one class."""

    def __init__(self, share: float):
        self.share = share

    def probability(self, text: str | None) -> float:
        return self.share


def train(lessons: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> ByteNetwork | Share:
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Share(share)
    late = np.arange(len(labels)) % 5 == 4
    early = ~late if len(set(labels[~late])) == 2 else np.ones(len(labels), bool)
    network = ByteNetwork()
    network.fit([x for x, e in zip(lessons, early) if e], labels[early], epochs)
    network.calibrate([x for x, e in zip(lessons, late) if e], labels[late])
    return network


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> ByteNetwork | Share:
    """Fit on the labelled documents; ``labels`` holds (doc_id, label) rows
    that may be learned from."""
    ship(docs.sparkSession)
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().distinct()
    rows = docs.select("doc_id", text_hash().alias("hash")).join(known, "doc_id").distinct()
    order = [F.xxhash64("doc_id", "hash"), "doc_id", "hash", "label"]
    # At most SAMPLE rows of three numbers.
    sample = F.broadcast(rows.orderBy(*order).limit(SAMPLE))
    chosen = docs.select("doc_id", "text", text_hash().alias("hash")).join(sample, ["doc_id", "hash"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What training needs of a text, whatever its length."""
        for b in batches:
            yield pd.DataFrame({**{c: b[c] for c in ("doc_id", "hash", "label")}, "lesson": [lesson(t).tobytes() for t in b["text"]]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "hash": [], "label": [], "lesson": []}), *batches])
        rows = rows.sort_values(["hash", "doc_id", "label"])
        lessons = [np.frombuffer(x, np.uint8).reshape(-1, CHUNK + WIDTH - 1) for x in rows["lesson"]]
        yield pd.DataFrame({"model": [pickle.dumps(train(lessons, rows["label"].to_numpy(dtype=np.int64)))]})

    lessons = chosen.mapInPandas(cut, "doc_id long, hash long, label int, lesson binary")
    # A document that is repeated very often arrives once.
    lessons = lessons.groupBy("doc_id", "hash", "label").agg(F.first("lesson").alias("lesson"))
    model = lessons.repartition(1).mapInPandas(learn, "model binary").collect()
    return pickle.loads(bytes(model[0]["model"])) if model else Share(0.0)


def score(docs: DataFrame, model: ByteNetwork | Share, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` added or replaced."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sent.value.probability(t) for t in texts], dtype="float64")

    return docs.withColumn("score", scored(F.col("text"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
