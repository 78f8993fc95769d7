import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import clashing, empty, frame, rows

from sensorlake.llm import katz_lm
from sensorlake.llm.katz_lm import HOT, Counts, K, Listed, discounts, score
from sensorlake.llm.toxicity import held_out


class Katz:
    """The model of a few texts, straight from its definition."""

    def __init__(self, texts):
        self.one, self.two, self.context = Counter(), Counter(), Counter()
        for w in texts:
            self.one.update(w)
            self.two.update(zip([None, *w], w))
            self.context.update([None, *w[:-1]])
        by = lambda c: [Counter(c.values())[r] for r in range(K + 2)]
        d1, d2 = discounts(by(self.one)), discounts(by(self.two))
        self.d1, self.d2 = (lambda c: d1[min(c, K)]), (lambda c: d2[min(c, K)])
        self.n = sum(self.one.values())
        self.unknown = sum(map(self.d1, self.one.values())) / self.n
        self.left, self.taken = Counter(), Counter()
        for (u, w), c in self.two.items():
            self.left[u] += self.d2(c)
            self.taken[u] += self.p1(w)

    def p1(self, w):
        return (self.one[w] - self.d1(self.one[w])) / self.n if self.one[w] else self.unknown

    def p2(self, u, w):
        if self.two[u, w]:
            return (self.two[u, w] - self.d2(self.two[u, w])) / self.context[u]
        if self.context[u]:
            return self.left[u] / self.context[u] / (1 - self.taken[u]) * self.p1(w)
        return self.p1(w)


def tokens(t):
    return (t or "").encode().lower().split() + ["end"]


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def expected(data):
    model = Katz([tokens(t) for i, t, *_ in data if not out(i)])
    want = {}
    for i, t, *_ in data:
        w = tokens(t)
        base = sum(math.log10((model.one[x] + 1) / (model.n + len(model.one) + 1)) for x in w)
        full = sum(math.log10(model.p2(u, x)) for u, x in zip([None, *w], w))
        want.setdefault((i, out(i), len(w), sum(model.one[x] > 0 for x in w), model.n), []).append((base, full))
    return want


def agree(scored, want):
    got = {}
    for r in scored.collect():
        got.setdefault(tuple(r)[:5], []).append((r["base_score"], r["score"]))
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(got[k]), sorted(want[k])):
            assert a == pytest.approx(b, rel=1e-9)


@pytest.mark.parametrize("hot", [HOT, 40, 1])
def test_scores_match_the_definition(spark, hot):
    scored = score(clashing(frame(spark), "key", "score", "held_out"), held_out("doc_id", 7, 2), hot)
    agree(scored, expected(rows()))


def hot_texts():
    """A word that is a third of all tokens, a pair that is a sixth."""
    rng = random.Random(9)
    for i in range(300):
        yield i, " ".join(rng.choice(["the", "the same", f"w{int(rng.expovariate(0.05))}"]) for _ in range(rng.randint(0, 60)))


@pytest.mark.parametrize("per_cell", [katz_lm.PER_CELL, 500])
def test_one_word_in_a_third_of_all_tokens(spark, monkeypatch, per_cell):
    monkeypatch.setattr(katz_lm, "PER_CELL", per_cell)
    data = list(hot_texts())
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    agree(score(df, held_out("doc_id", 7, 2), hot=1000), expected(data))


def test_a_hot_word_is_dealt_over_all_cells():
    ids, cells = np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 20
    w = np.full(4000, katz_lm.END)
    counts = lambda words, pairs: Counts(1, 1, 1, (), (), 0.5, words, pairs)
    none = Listed(np.empty(0, np.uint64), np.empty(0, np.int64))
    one = Listed(np.array([katz_lm.END]), np.array([4000]))
    assert not counts(none, none).split(ids, w)[0].any()
    word, pair = counts(one, none).split(ids, w)
    assert word.all() and not pair.any()
    assert np.bincount(katz_lm._cell(katz_lm._pair_ids(ids, w), cells), minlength=cells).max() < 300
    both = Listed(np.sort(katz_lm._pair_ids(ids[:10], w[:10])), np.full(10, 400))
    assert counts(one, both).split(ids, w)[1].sum() == 10 and not counts(none, both).split(ids, w)[1].any()


def test_every_context_sums_to_one():
    rng = random.Random(1)
    model = Katz([[str(int(rng.expovariate(0.1))) for _ in range(rng.randint(1, 60))] + ["end"] for _ in range(80)])
    for u in [None, *model.one, "never seen"]:
        total = sum(model.p2(u, w) for w in model.one) + model.p2(u, "unknown")
        assert total == pytest.approx(1, abs=1e-9)


def test_no_texts(spark):
    assert score(empty(spark), held_out("doc_id", 7, 2)).count() == 0


def test_discounts():
    got = discounts([0, 1000, 300, 150, 90, 60, 40])
    assert all(0 < d < r for r, d in enumerate(got) if r) and got[0] == 0
    assert discounts([0, 0, 0, 5, 0, 0, 0]) == (0.0, 0.5, 0.5, 0.5, 0.5, 0.5)
