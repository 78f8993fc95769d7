import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import clashing, empty, frame, rows, same

from sensorlake.llm import spelling
from sensorlake.llm.spelling import corpus_words, variants


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, ratio=5):
    form, out = {}, []
    for w, n in counts.items():
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if close and counts[best] >= ratio * n else None
        out.append((w, n, len(close)))
    for w, n, number in out:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n, number, counts.get(form[w])


def typed(data, least_length=6, least_count=5):
    found = Counter()
    for i, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count and len(w) >= least_length}


def words(seed, number, alphabet="abcé", lengths=(1, 8)):
    rng = random.Random(seed)
    made = {"".join(rng.choices(alphabet, k=rng.randint(*lengths))) for _ in range(number)}
    return {w: rng.choice([1, 2, 5, 30, 200, 5000]) for w in made}


def given(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("most", [16, spelling.MOST])
def test_all_near_words_of_a_dense_vocabulary(spark, monkeypatch, most):
    """With keys of over 16 words dealt out in chunks, and whole."""
    monkeypatch.setattr(spelling, "MOST", most)
    counts = words(3, 500) | words(4, 200, "abcdefghijklmnopqrstuvwxyzÿ", (4, 6)) | {"a" * 3000: 5, "a" * 2999: 40}
    same(variants(given(spark, counts)).collect(), brute(counts))


def test_long_keys_in_blocks(monkeypatch):
    """One key of many rows: blocks of its product give the pairs once."""
    monkeypatch.setattr(spelling, "TILE", 8)
    counts = words(5, 400, "ab", (1, 9))
    w = sorted(counts)
    n = np.array([counts[x] for x in w])
    zero = np.zeros(len(w), np.int64)
    found = Counter()
    for s in range(len(spelling.SETS)):
        for word, number, *_ in spelling.compare(zero, zero > 0, zero, zero + s, n, w):
            found[word] += number
    assert found == {x: k for x in w if (k := sum(near(x, y) for y in w))}


def test_forms_chain_to_the_root(spark):
    counts = {"abcdef": 1, "abcdeg": 5, "abcdhg": 25, "abidhg": 125, "ajidhg": 700, "zzzzzz": 7}
    got = {r["word"]: (r["form"], r["root"]) for r in variants(given(spark, counts)).collect()}
    assert got["abcdef"] == ("abcdeg", "ajidhg") and got["abidhg"] == ("ajidhg", "ajidhg")
    assert got["ajidhg"] == (None, "ajidhg") and got["zzzzzz"] == (None, "zzzzzz")


def test_words_of_texts(spark):
    rng = random.Random(9)
    stock = [f"WÖrd{c}{d}" for c in "abcdef" for d in "xyz×ÿ"] + ["Short", "ÉtÉs-long", "x1yabcdefg"]
    data = [(i, " ".join(rng.choices(stock, k=40)), "en", "s", 1) for i in range(300)] + rows()
    df = clashing(spark.createDataFrame(data, frame(spark).schema), "word", "n", "id", "run")
    counts = typed(data)
    assert len(counts) > 30
    same(corpus_words(df).collect(), counts.items())
    same(variants(corpus_words(df)).collect(), brute(counts))


def test_empty_and_awkward_tables(spark):
    assert variants(corpus_words(empty(spark))).count() == 0
    data = rows()
    same(variants(corpus_words(frame(spark), 1, 1)).collect(), brute(typed(data, 1, 1)))
