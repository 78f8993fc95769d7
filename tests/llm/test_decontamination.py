import random
import re
from collections import Counter
from string import ascii_lowercase, ascii_uppercase

import duckdb
import pandas as pd
import pytest
from corpus import clashing, empty, frame, rows, same, sentence

from pyspark.sql import functions as F

from sensorlake.llm.decontamination import PhraseIndex, ProximityIndex, contamination, near_phrases
from sensorlake.llm.oracle import hits_sql, near_sql

LOWERED = str.maketrans(ascii_uppercase, ascii_lowercase)
ITEMS = "item_id long, text string"


def items():
    rng = random.Random(8)
    texts = [t for _, t, *_ in rows() if t and len(t.split()) > 40]
    out = [(i, " ".join(t.split()[k : k + n]).upper()) for i, (t, k, n) in enumerate(zip(texts, (3, 0, 9, 20, 5), (12, 10, 25, 30, 11)))]
    out += [(20, None), (21, " .,;"), (22, "one"), (23, "x x x"), (24, " ".join(sentence(rng, 15, 9000))), (25, "É é ß")]
    out += [(1, "x " * 12), out[2], (None, " ".join(texts[6].split()[:10])), (30, "w1 w2, w3")]
    return out


def expected(docs, bench):
    con = duckdb.connect()
    con.register("benchmark", pd.DataFrame(bench, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    named = [(n, r[0], r[1]) for n, r in enumerate(docs)]
    con.register("docs", pd.DataFrame(named, columns=["n", "doc_id", "text"]).astype({"doc_id": "Int64"}))
    sql = f"WITH {hits_sql('docs')} SELECT d.doc_id, j.n_words, j.n_hit, j.items FROM docs d JOIN judged j USING (n)"
    return [(a, b, c, tuple(d)) for a, b, c, d in con.execute(sql).fetchall()]


def result(df):
    return [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()]


def test_hits_match_sql(spark):
    bench = clashing(spark.createDataFrame(items(), ITEMS), "term", "window")
    found = contamination(clashing(frame(spark), "n_hit", "items", "words", "pos"), bench).cache()
    same(result(found), expected(rows(), items()))
    assert found.filter("contaminated").count() > 10
    assert found.filter("contaminated != (n_hit > 0)").count() == 0


def test_random_small_vocabulary(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 200))), "en", "s", 1) for i in range(60)]
    bench = [(i, " ".join(rng.choices("abc", k=rng.randint(1, 13)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    same(result(contamination(df, spark.createDataFrame(bench, ITEMS))), expected(docs, bench))


def test_empty_sides(spark):
    bench = spark.createDataFrame(items(), ITEMS)
    assert contamination(empty(spark), bench).count() == 0
    none = contamination(frame(spark), bench.limit(0))
    assert none.filter("contaminated or n_hit > 0 or size(items) > 0").count() == 0 and none.count() == len(rows())


def places(docs, bench, width, slop, missing):
    """Every start of every window, judged by looking at the words around."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWERED))
    texts = [split(t) for _, t, *_ in docs]
    tf = Counter(w for t in texts for w in t)
    held = {}
    for item, t in bench:
        w = split(t)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            held.setdefault(tuple(w[i : i + width]), set()).add("null" if item is None else str(item))
    out = []
    for (doc, *_), t in zip(docs, texts):
        n, items = 0, set()
        for win, owners in held.items():
            spare = missing if len(win) == width else 0
            rare = sorted(range(len(win)), key=lambda i: (tf[win[i]], win[i].encode(), i))[: 1 + spare]
            for s in {p - i for i in rare for p, w in enumerate(t) if w == win[i]}:
                near = [w in t[max(s + i - slop, 0) : max(s + i + slop + 1, 0)] for i, w in enumerate(win)]
                if sum(near) >= len(win) - spare:
                    n, items = n + 1, items | owners
        out.append((doc, n, tuple(sorted(items))))
    return out


def near(df, bench, *rule):
    return [(r["doc_id"], r["n_places"], tuple(r["items"])) for r in near_phrases(df, bench, *rule).collect()]


@pytest.mark.parametrize("rule", [(10, 0, 0), (4, 1, 0), (5, 2, 2)])
def test_places_match_brute_force(spark, rule):
    rng = random.Random(14)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 40))), "en", "s", 1) for i in range(40)]
    docs += [(90, None, "en", "s", 1), (None, "a b c d e", "en", "s", 1), (3, "h g f e d", "en", "s", 1)]
    bench = [(i, " ".join(rng.choices("abcdefghxy", k=rng.randint(1, 11)))) for i in range(20)] + [(None, "a B c"), (50, None)]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), "near", "pos")
    want = places(docs, bench, *rule)
    same(near(df, spark.createDataFrame(bench, ITEMS), *rule), want)
    assert rule[1] == 0 or sum(n > 0 for _, n, _ in want) > 10


def test_places_match_sql(spark):
    con = duckdb.connect()
    con.register("benchmark", pd.DataFrame(items(), columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    named = [(n, r[0], r[1]) for n, r in enumerate(rows())]
    con.register("docs", pd.DataFrame(named, columns=["n", "doc_id", "text"]).astype({"doc_id": "Int64"}))
    sql = f"WITH {near_sql('docs')} SELECT d.doc_id, j.n_places, j.items FROM docs d JOIN judged j USING (n)"
    want = [(a, b, tuple(c)) for a, b, c in con.execute(sql).fetchall()]
    bench = spark.createDataFrame(items(), ITEMS)
    got = near(frame(spark), bench)
    same(got, want)
    # An exact place is a near one.
    exact = {r["doc_id"] for r in contamination(frame(spark), bench).filter("contaminated").collect()}
    assert exact and exact <= {d for d, n, _ in got if n}


def test_exact_rule_is_the_phrase_index(spark):
    index = PhraseIndex(frame(spark), spark.createDataFrame(items(), ITEMS))
    flat = index.matches().select("doc_key", "text_hash", F.explode("matches").alias("m"))
    exact = [(r[0], r[1], r[2]) for r in flat.select("doc_key", "text_hash", "m.start").distinct().collect()]
    other = ProximityIndex(frame(spark), spark.createDataFrame(items(), ITEMS), 10, 0, 0).places()
    same(exact, [tuple(r) for r in other.select("doc_key", "text_hash", "start").distinct().collect()])


def test_near_phrases_and_clean_text(spark):
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [
        (1, phrase),
        (2, phrase.replace("epsilon", "epsilon more")),
        (3, phrase.replace("zeta", "other")),
        (4, phrase.replace("delta epsilon", "epsilon delta")),
        (5, "kappa and " + " w" * 12 + " alpha"),
        (6, "alpha kappa"),
        (7, "single word"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, phrase), (2, "single")], ITEMS)
    assert {d for d, n, _ in near(df, bench) if n} == {1, 2, 3, 4, 7}
    assert near(df, bench.limit(0)) and not any(n for _, n, _ in near(df, bench.limit(0)))
    assert near(df.limit(0), bench) == []
    with pytest.raises(ValueError):
        near_phrases(df, bench, 3, 1, 3)
