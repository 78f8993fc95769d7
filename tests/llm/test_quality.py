import random

import numpy as np
import pytest
from corpus import clashing, empty, frame, rows

from sensorlake.llm import quality
from sensorlake.llm.quality import CHUNK, UNIT, WIDTH, ByteNetwork, Share, chunk_starts, fit, lesson, octets, score, train
from sensorlake.llm.toxicity import held_out

LABELS = "doc_id long, quality int, toxic int"


def responses(network, raw):
    """Every filter at every position, from the weights themselves."""
    w = network.weights
    embedded = w["bytes"][raw]
    n = len(raw) - WIDTH + 1
    return sum(embedded[k : k + n] @ w["filters"][k] for k in range(WIDTH))


@pytest.mark.parametrize("size", [0, 1, 200, 256, 257, 700, 5000])
def test_scores_by_the_definition(size):
    """Chunks by units, max-pooled, against windows cut from all responses."""
    network, text = ByteNetwork(), "aé bc" * (size // 5) + "x" * (size % 5)
    raw = octets(text)
    found = responses(network, raw)
    n = len(found)
    first = [s * UNIT for s in chunk_starts(-(-n // UNIT))]
    chunks = np.maximum(np.stack([found[f : f + CHUNK].max(axis=0) for f in first]) + network.weights["offsets"], 0)
    pooled = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    assert np.isclose(network.raw(text), pooled @ network.weights["output"], atol=1e-4)
    assert first[-1] + CHUNK >= n and all(b - a <= CHUNK * 3 // 4 for a, b in zip(first, first[1:]))


def test_gradient_by_differences():
    network = ByteNetwork()
    lessons = [lesson("some text " * k) for k in (3, 60, 200)]
    labels = np.array([1, 0, 1])
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    network.table = network._table()

    def loss():
        z = np.array([network.raw_of_lesson(x) for x in lessons])
        return (np.logaddexp(0, z) - labels * z).mean()

    gradient = network._gradient(lessons, labels)
    rng = np.random.default_rng(1)
    for name, w in network.weights.items():
        for i in rng.choice(w.size, min(w.size, 6), replace=False):
            place = np.unravel_index(i, w.shape)
            w[place] += 1e-5
            network.table = network._table()
            up = loss()
            w[place] -= 2e-5
            network.table = network._table()
            down = loss()
            w[place] += 1e-5
            network.table = network._table()
            assert np.isclose(gradient[name][place], (up - down) / 2e-5, rtol=1e-2, atol=2e-4), name


def test_learns_what_stands_late_in_a_long_text():
    """The one mark that decides may stand in any chunk."""
    rng = random.Random(4)

    def text(good):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(rng.randint(40, 400))]
        if not good:
            words[rng.randrange(len(words))] = "#%#"
        return " ".join(words)

    data = [(text(i % 2), i % 2) for i in range(900)]
    network = train([lesson(t) for t, _ in data[:600]], np.array([y for _, y in data[:600]]))
    assert np.mean([(network.probability(t) >= 0.5) == y for t, y in data[600:]]) > 0.95


def test_given_tables_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = held_out("doc_id", 5, 0)
    network = fit(docs, labels.filter(~out))
    got = score(docs.join(labels, "doc_id").filter(out), network).select("quality", "predicted", "score").collect()
    good = [r["predicted"] for r in got if r["quality"] == 1]
    bad = [r["predicted"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.15
    assert all(0 <= r["score"] <= 1 for r in got)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 40)
    labels = [(i, int("p" in (t or "")), 0) for i, t, *_ in rows()] + [(None, 1, 1), (3, None, None), (10**9, 0, 1), (5, 1, 0)]
    df = clashing(frame(spark), "label", "hash", "score", "predicted", "lesson")
    network = fit(df, clashing(spark.createDataFrame(labels, LABELS), "text"))
    got = score(df, network).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(x) == 1 for x in by.values())


def test_repeated_examples_count_once(spark):
    schema = frame(spark).schema
    one = [(i, f"text {i} " * 9, "en", "s", 1) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], LABELS)
    fits = [fit(spark.createDataFrame(data, schema), labels.unionByName(labels)) for data in (one, one * 3)]
    assert np.array_equal(fits[0].table, fits[1].table)


def test_one_class_or_none(spark):
    df = frame(spark)
    labels = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert score(df, fit(df, labels)).filter("score != 1").count() == 0
    assert score(df, fit(df, labels.limit(0))).filter("score != 0").count() == 0
    assert score(empty(spark), fit(empty(spark), labels)).count() == 0
    assert isinstance(fit(empty(spark), labels), Share)
