import hashlib
import random

from corpus import clashing, empty, frame, rows, same
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import substring_dedup
from sensorlake.llm.substring_dedup import SuffixAutomaton, remove_repeats

SCHEMA = "doc_id long, text string"


def brute(docs, span=50):
    """Row by row: (doc_id, n_words, n_removed, sha256 of the kept words)."""
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t, *_ in docs:
        w = (t or "").encode().split()
        for s in range(len(w) - span + 1):
            k = tuple(w[s : s + span])
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t, *_ in docs:
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - span + 1):
            if first[tuple(w[s : s + span])] < order(i):
                gone.update(range(s, s + span))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def shared_passages(seed=6):
    """Documents that share passages of 40 to 90 words at any place, with edits."""
    rng = random.Random(seed)
    pool = [[f"p{rng.randint(0, 50)}" for _ in range(200)] for _ in range(3)]
    docs = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 4)):
            p, k = rng.choice(pool), rng.randint(0, 110)
            part = p[k : k + rng.randint(40, 90)]
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edit"
            words += [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30))] + part
        docs.append((i * 3, " ".join(words)))
    docs += [(9, "z " * 300), (12, "z " * 60), (13, "y z " * 50)]
    return docs


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_awkward_rows(spark):
    got = remove_repeats(clashing(frame(spark), "spans", "n_words", "at", "gram"), text=False)
    same(got.select(*COLUMNS).collect(), brute(rows()))
    assert remove_repeats(empty(spark)).count() == 0


def test_shared_passages_by_automata_and_by_window(spark, monkeypatch):
    docs = shared_passages()
    want = brute(docs)
    assert sum(r[2] for r in want) > 1000
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    same(remove_repeats(df, text=False).select(*COLUMNS).collect(), want)
    monkeypatch.setattr(substring_dedup, "SHARD", 1)  # every shared gram by window
    same(remove_repeats(df, text=False).select(*COLUMNS).collect(), want)


def test_every_run_of_the_smallest_id_is_judged(spark, monkeypatch):
    """A passage of an earlier document, in other surroundings: twice in one
    document, in two texts of one doc_id, in texts without an id."""
    rng = random.Random(7)
    docs = []
    for i in range(12):
        new = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
        p, around = new(rng.randint(55, 110)), new(45) + ["*"] + new(45)
        held = " ".join(p).join(" ".join(around).split("*"))
        docs.append((10 * i, " ".join(new(45) + p + new(45))))
        docs += [(10 * i + 1, f"{held} {held}"), (10 * i + 2, f"{held} x"), (10 * i + 2, f"y z {held}")]
        q = new(70)
        docs.append((10 * i + 3, " ".join(new(45) + q + new(45))))
        held = " ".join(new(45) + q + new(45))
        docs += [(10 * i + 4, held + " x"), (10 * i + 4, held + " y"), (10 * i + 4, held + " y")]
        r = new(70)
        docs.append((10 * i + 5, " ".join(new(45) + r + new(45))))
        held = " ".join(new(45) + r + new(45))
        docs += [(None, held + " x"), (None, f"{held} {held}")]
    want = brute(docs)
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    same(remove_repeats(df, text=False).select(*COLUMNS).collect(), want)
    monkeypatch.setattr(substring_dedup, "SHARD", 1)
    same(remove_repeats(df, text=False).select(*COLUMNS).collect(), want)


def test_texts_are_cut(spark):
    first = [f"a{i}" for i in range(60)]
    docs = [(1, " ".join(first)), (2, "x  y " + " ".join(first) + " z"), (3, "keeps  its   blanks"), (4, None)]
    got = {r["doc_id"]: r["text"] for r in remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: docs[0][1], 2: "x y z", 3: "keeps  its   blanks", 4: None}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=6), st.lists(st.sampled_from("abcd"), max_size=14), st.integers(1, 5))
def test_automaton_finds_first_holders(sequences, words, span):
    automaton = SuffixAutomaton()
    for number, s in enumerate(sequences):
        automaton.add(s, number)
    want = []
    for k in range(len(words) - span + 1):
        win = words[k : k + span]
        holds = [n for n, s in enumerate(sequences) if any(s[j : j + span] == win for j in range(len(s) - span + 1))]
        want.append(min(holds, default=float("inf")))
    assert automaton.first_holders(words, span) == want
