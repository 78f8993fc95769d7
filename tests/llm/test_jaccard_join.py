import random

import numpy as np
import pytest
from corpus import awkward_texts, clashing, empty, frame, rows, same

from sensorlake.llm.jaccard_join import band, bands_of, keep_one, near_duplicates, shingle_set, signatures

SCHEMA = "doc_id long, text string"


def brute(docs):
    """(doc_id, n_shingles, component_id) per row."""
    sets = [frozenset(shingle_set(t).tolist()) for _, t, *_ in docs]
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                group[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, *_) in enumerate(docs)]


def chained(seed=3):
    """Chains of gradual edits, in many lengths, and one large group of near
    copies that drift apart."""
    rng = random.Random(seed)
    docs = []
    for length in (4, 5, 6, 7, 8, 9, 11, 14, 18, 25, 40, 60, 100, 200):
        words = [f"v{rng.randint(0, 10**6)}" for _ in range(length)]
        for _ in range(6):
            docs.append(" ".join(words))
            if rng.random() < 0.5:
                words = words[:-1] if rng.random() < 0.5 else [*words, f"v{rng.randint(0, 10**6)}"]
            else:
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 10**6)}"
    words = [f"g{i}" for i in range(90)]
    for i in range(120):
        docs.append(" ".join(words))
        if i % 3 == 2:
            words[rng.randrange(len(words))] = f"h{rng.randint(0, 10**6)}"
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_awkward_rows(spark):
    found = near_duplicates(clashing(frame(spark), "component", "set_id", "n"))
    same(found.select("doc_id", "n_shingles", "component_id").collect(), brute(rows()))


def test_chains_and_large_groups(spark):
    docs = chained()
    found = near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(4))
    want = brute(docs)
    assert len({c for _, _, c in want}) < len(docs) - 60
    same(found.select("doc_id", "n_shingles", "component_id").collect(), want)


def test_empty(spark):
    assert near_duplicates(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = keep_one(frame(spark)).collect()
    data = rows()
    groups = {}
    for r, (_, n, c) in zip(data, brute(data)):
        groups.setdefault((c, r[1]) if c is None else c, []).append(r) if n else None
    wordless = sum(1 for _, n, _ in brute(data) if not n)
    # Two unlinked documents share an id, hence the id of their groups.
    assert len(kept) == len(groups) + wordless + 1
    assert {r["doc_id"] for r in kept if r["text"] and r["text"].strip()} >= {c for c in groups if isinstance(c, int)}


@pytest.mark.parametrize("size", [4, 5, 6, 8, 9, 13, 20, 33, 60, 150, 500])
def test_linked_sets_share_a_signature(size):
    """The pigeonhole guarantee, on pairs at the threshold."""
    rng = np.random.default_rng(size)
    for _ in range(150):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        most = int(2 * len(a) // 9)  # differences allowed at equal sizes
        gone = rng.integers(0, most // 2 + 1)
        new = rng.integers(0, 2**63, min(gone, most - gone) if rng.random() < 0.5 else 0).astype(np.uint64)
        b = np.unique(np.r_[rng.permutation(a)[gone:], new])
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common) and len(np.setxor1d(a, b)):
            assert np.intersect1d(signatures(a)[0], signatures(b)[0]).size


def test_bands_cover_every_partner():
    for n in range(4, 3000, 7):
        own = {b.index for b in bands_of(n)}
        for m in range(max(4, -(-4 * n // 5)), n + 1):
            assert own & {b.index for b in bands_of(m)}
            low = next(b for b in map(band, range(40)) if b.low <= m <= b.high)
            assert low.index in own and (n + m) // 9 < low.need


def test_short_texts_are_one_shingle():
    assert len(shingle_set("a b c")) == 1 and len(shingle_set("A b C")) == 1
    assert (shingle_set("A b C") == shingle_set("a B c")).all() and len(shingle_set(awkward_texts()[2])) == 0
