import random

import numpy as np
from corpus import clashing, empty, frame, rows

from sensorlake.llm import toxicity
from sensorlake.llm.toxicity import features, fit, held_out, score, train

LABELS = "doc_id long, quality int, toxic int"


def pairs(n, seed):
    """Toxic exactly if an insult and a group's name meet; each alone is not."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rng.randint(0, 60)}" for _ in range(rng.randint(5, 15))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        out.append((" ".join(words), int(insult and group)))
    return out


def accuracy(machine, data):
    return np.mean([(machine.probability(features(t)) >= 0.5) == y for t, y in data])


def test_machine_learns_a_pair():
    data, fresh = pairs(3000, 1), pairs(800, 2)
    machine = train([features(t) for t, _ in data], np.array([y for _, y in data]))
    assert accuracy(machine, fresh) > 0.97


def test_factors_carry_what_single_weights_miss():
    """Both or neither is clean, one of the two is toxic."""
    data = [(t, int(("insult" in t) != ("group" in t))) for t, _ in pairs(4000, 3)]
    fresh = [(t, int(("insult" in t) != ("group" in t))) for t, _ in pairs(800, 4)]
    bins = np.unique(np.concatenate([features("insult group"), *[features(f"w{i}") for i in range(61)]]))
    scores = []
    for factors in (0, 4):
        machine = toxicity.FactorizationMachine(bins, factors)
        machine.fit([features(t) for t, _ in data], np.array([y for _, y in data]), 30, rate=0.3)
        scores.append(accuracy(machine, fresh))
    assert scores[0] < 0.8 < 0.95 < scores[1]


def test_training_keeps_terms_that_are_neutral_alone():
    """The same by train(): neither term has an association of its own."""
    data, fresh = ([(t, int(("insult" in t) != ("group" in t))) for t, _ in pairs(n, s)] for n, s in ((4000, 3), (800, 4)))
    machine = train([features(t) for t, _ in data], np.array([y for _, y in data]))
    assert accuracy(machine, fresh) > 0.95


def test_given_tables_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = held_out("doc_id", 5, 0)
    machine = fit(docs, labels.filter(~out))
    got = score(docs.join(labels, "doc_id").filter(out), machine).select("toxic", "predicted", "score").collect()
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    clean = [r["predicted"] for r in got if r["toxic"] == 0]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.01
    assert all(0 <= r["score"] <= 1 for r in got)


def test_awkward_rows(spark):
    labels = [(i, 1, int("p" in (t or ""))) for i, t, *_ in rows()] + [(None, 1, 1), (3, None, None), (10**9, 0, 1), (5, 1, 0)]
    df = clashing(frame(spark), "toxic", "score", "bins")
    machine = fit(df, clashing(spark.createDataFrame(labels, LABELS), "text"))
    got = score(df, machine).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not (r["text"] or "").strip()}) == 1


def test_one_class_or_none(spark):
    df = frame(spark)
    labels = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert score(df, fit(df, labels)).filter("score < 0.99").count() == 0
    assert score(df, fit(df, labels.limit(0))).filter("score > 0.01").count() == 0
    assert score(empty(spark), fit(empty(spark), labels)).count() == 0


def test_only_the_fold_is_held_out(spark):
    import zlib

    got = spark.range(50).select("id", held_out("id", 5, 0).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)
