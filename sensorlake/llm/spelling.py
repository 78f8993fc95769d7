r"""Groups of spelling variants: words one edit apart, the rarer naming the
more frequent as its form.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  Then their letter counts differ by at most one in at most two
letters: the squared distance of the count vectors is 1 (lengths differ by
one) or 2 (equal lengths).  NumPy products of blocks of count vectors, Gram
matrices, give all squared distances within a length block and between
adjacent ones; what is left is verified as an edit.

Blocks are kept small by an exact argument.  The letters fall into ``GROUPS``
groups by code point.  An edit changes the counts of two groups at most, so
the counts of the three others agree: every word is filed once for each three
groups (``SETS``) under a hash of these letters, and only words under one key
are compared.  A pair that meets under several keys counts under the first.
Keys with few words share a product; a key with over ``MOST`` words is dealt
out as pairs of chunks, so that no task holds more than two chunks.

Tasks return, per word, the number of near words found and the best of them;
sums and minima of these are the result.  Forms are followed to their roots
by pointer jumping.

Edge cases: null and empty texts have no words; a null doc_id deletes
nothing (``corpus_words``); repeated rows count as often as they stand; ties of
n go to the smaller word in code-point order; a word with no near word has
n_near 0, no form, and is its own root.  No rows give no rows.  Columns beside
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, ship, shuffle_partitions

GROUPS = 5
SETS = list(combinations(range(GROUPS), GROUPS - 2))
#: For the groups of the one or two letters that an edit changes: the first
#: set that holds neither.
FIRST_SET = np.array([[next(i for i, s in enumerate(SETS) if a not in s and b not in s) for b in range(GROUPS)] for a in range(GROUPS)])
#: Words of keys that share one product.
TILE = 384
#: Words of a key above which it is dealt out in chunks of half as many.
MOST = 8192
#: Code points of word pairs verified at a time.
VERIFY = 1_000_000


# --- words ---------------------------------------------------------------------


def corpus_words(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199) -> DataFrame:
    r"""(word, n): the runs ``[A-Za-zÀ-ÿ]+`` of all texts, A-Z
    lower-cased, of at least so many code points and occurrences.  Where
    ``every`` divides h, the crc32 of ``<doc_id>:<run>``, the run's code point
    h % length is left out: a fixed share of planted misspellings."""
    text = F.translate("text", ascii_uppercase, ascii_lowercase)
    # A run that short has no word, with or without a code point left out.
    runs = F.regexp_extract_all(text, F.lit(rf"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", F.when(h % every == 0, (h % F.char_length("run")).cast("int")).alias("out"))
    left = F.concat(F.expr("substring(run, 1, out)"), F.expr("substring(run, out + 2)"))
    words = rows.select(F.when(F.col("out").isNull(), F.col("run")).otherwise(left).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)
    return counted.filter(F.char_length("word") >= least_length)


# --- keys ------------------------------------------------------------------------


class Words:
    """Code points of a list of words."""

    def __init__(self, words: list[str]):
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length

    def counts(self) -> np.ndarray:
        """Letter counts, one column for each letter that occurs; in floats
        that hold their products exactly."""
        letters, at = np.unique(self.codes, return_inverse=True)
        row = np.repeat(np.arange(len(self.length)), self.length)
        flat = np.bincount(row * len(letters) + at, minlength=len(self.length) * len(letters))
        exact = np.float32 if self.length.max() < 2000 else np.float64
        return flat.reshape(len(self.length), len(letters)).astype(exact)


def keys(words: Words) -> np.ndarray:
    """One key per word and set: a hash of the letters of the set's groups,
    whatever their order."""
    hashed = mix64(words.codes.astype(np.uint64) + np.uint64(1))
    group = words.codes % GROUPS
    sums = np.stack([np.add.reduceat(np.where(group == g, hashed, np.uint64(0)), words.start) for g in range(GROUPS)])
    return np.stack([mix64(sums[list(s)].sum(axis=0, dtype=np.uint64) + np.uint64(i)) for i, s in enumerate(SETS)], axis=1)


_FILED = "key long, set byte, word string, n long"


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        if words:
            found = keys(Words(words))
            at = pa.array(np.repeat(np.arange(len(words)), len(SETS)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.reshape(-1).view(np.int64)),
                    pa.array(np.tile(np.arange(len(SETS)), len(words)), pa.int8()),
                    batch.column("word").take(at),
                    batch.column("n").take(at),
                ],
                names=["key", "set", "word", "n"],
            )


# --- Gram matrices ---------------------------------------------------------------


def _close(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of rows at a squared distance of 1 or 2."""
    gram = a @ b.T
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * gram
    return np.nonzero((square > 0.5) & (square < 2.5))


def _edits(words: Words, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are one edit apart, and the set under which they count."""
    near, counted = np.zeros(len(i), bool), np.zeros(len(i), np.int64)
    i, j = np.where(words.length[i] < words.length[j], j, i), np.where(words.length[i] < words.length[j], i, j)
    kind = words.length[j] * 2 + (words.length[i] - words.length[j])
    order = np.argsort(kind, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(kind[order]) != 0, True]) if len(i) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        size, longer = divmod(int(kind[order[a]]), 2)
        step = max(1, VERIFY // max(size, 1))
        for c in range(a, b, step):
            pick = order[c : min(c + step, b)]
            place = np.arange(size)
            x = words.codes[words.start[i[pick]][:, None] + place]
            y = words.codes[words.start[j[pick]][:, None] + place]
            same = x == y
            first = np.where(same.all(axis=1), size, same.argmin(axis=1))
            at = words.codes[words.start[i[pick]] + np.minimum(first, size + longer - 1)] % GROUPS
            if longer:
                rest = words.codes[words.start[i[pick]][:, None] + place + 1] == y
                near[pick] = (rest | (place < first[:, None])).all(axis=1)
                counted[pick] = FIRST_SET[at, at]
            else:
                near[pick] = (~same).sum(axis=1) == 1
                other = words.codes[words.start[j[pick]] + np.minimum(first, size - 1)] % GROUPS
                counted[pick] = FIRST_SET[at, other]
    return near, counted


_FOUND = "word string, n_near long, best_n long, best string"
_FOUND_SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def compare(key: np.ndarray, cross: np.ndarray, chunk: np.ndarray, set_: np.ndarray, n: np.ndarray, word: list[str]) -> list[tuple]:
    """(word, near words, n and name of the best) for rows that are whole
    keys; where ``cross``, only pairs from different chunks."""
    words = Words(word)
    counts = words.counts()
    order = np.lexsort((words.length, key))
    i_found, j_found = [], []
    for a in range(0, len(order), TILE * 2):
        left = order[a : a + TILE * 2]
        # Rows from here on that share a key, in this or the next length.
        last = left[-1]
        tail = order[a:]
        stop = np.searchsorted(key[tail], key[last], "right") if len(left) == TILE * 2 else len(tail)
        tail = tail[:stop]
        if len(tail) > len(left):
            reach = (key[tail] == key[last]) & (words.length[tail] > words.length[last] + 1)
            tail = tail[~reach]
        for b in range(0, len(tail), TILE * 2):
            right = tail[b : b + TILE * 2]
            p, q = _close(counts[left], counts[right])
            if b == 0:
                p, q = p[p < q], q[p < q]
            i, j = left[p], right[q]
            kept = (key[i] == key[j]) & (np.abs(words.length[i] - words.length[j]) <= 1)
            kept &= ~cross[i] | (chunk[i] != chunk[j])
            i_found.append(i[kept])
            j_found.append(j[kept])
    i, j = np.concatenate(i_found), np.concatenate(j_found)
    near, counted = _edits(words, i, j)
    near &= counted == set_[i]
    i, j = np.r_[i[near], j[near]], np.r_[j[near], i[near]]
    if not len(i):
        return []
    rank = np.empty(len(word), np.int64)
    by_rank = sorted(range(len(word)), key=lambda k: (-n[k], word[k]))
    rank[by_rank] = np.arange(len(word))
    number = np.bincount(i, minlength=len(word))
    best = np.full(len(word), len(word))
    np.minimum.at(best, i, rank[j])
    return [(word[k], int(number[k]), int(n[by_rank[best[k]]]), word[by_rank[best[k]]]) for k in np.flatnonzero(number)]


def _compare_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, part); whole parts go to ``compare`` as tiles
    of about ``TILE`` rows.  A part above 0 compares two chunks."""
    held: list[pa.RecordBatch] = []

    def made(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        get = lambda c: rows.column(c).to_numpy()
        key, part, chunk, set_, n = (get(c) for c in ("key", "part", "chunk", "set", "n"))
        word = rows.column("word").to_pylist()
        first = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(part) != 0)])
        size = np.diff(np.r_[first, len(key)])
        group = np.repeat(np.arange(len(first)), size)
        a = 0
        while a < len(first):
            b = a + 1
            while b < len(first) and first[b] + size[b] - first[a] <= TILE:
                b += 1
            x, y = first[a], first[b - 1] + size[b - 1]
            if (size[a:b] > 1).any():
                found = compare(group[x:y], part[x:y] > 0, chunk[x:y], set_[x:y], n[x:y], word[x:y])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _FOUND_SCHEMA)], schema=_FOUND_SCHEMA)
            a = b

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        key, part = rows.column("key").to_numpy(), rows.column("part").to_numpy()
        # The last part may go on in the next batch.
        open_ = np.flatnonzero((key != key[-1]) | (part != part[-1]))
        if len(open_):
            cut = open_[-1] + 1
            yield from made(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield from made(pa.Table.from_batches(held))


# --- variants ----------------------------------------------------------------------


def _near(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near word."""
    filed = words.mapInArrow(_file, _FILED)
    hot = filed.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > MOST)
    hot = scratch.write(hot.select("key", F.ceil(F.col("rows") * 2 / MOST).alias("k")), "hot")
    rows = filed.join(hot, "key", "left")
    rows = rows.withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("word"), "k"), F.lit(0).cast("long")))
    part = "CASE WHEN j = chunk THEN -1 - j WHEN j > chunk THEN 1 + chunk * k + j ELSE 1 + j * k + chunk END"
    parts = F.expr(f"CASE WHEN k IS NULL THEN array(0L) ELSE transform(sequence(0L, k - 1), j -> {part}) END")
    rows = rows.withColumn("part", F.explode(parts)).select("key", "part", "chunk", "set", "word", "n")
    dealt = rows.repartition(shuffle_partitions(words.sparkSession), "key", "part").sortWithinPartitions("key", "part")
    found = dealt.mapInArrow(_compare_keys, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("best.minus")).alias("best_n"), F.col("best.word").alias("best"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words that have a form (word, form): every round
    goes on to where the place so far has arrived, so paths double.  A form is
    more frequent than its word: there are no circles."""
    at, turn = scratch.write(forms.select("word", F.col("form").alias("root")), "root-0"), 0
    while True:
        hop = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = at.join(hop, "root", "left")
        new = scratch.write(step.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), f"root-{turn + 1}")
        moved = new.filter("moved").limit(1).count()
        scratch.drop(f"root-{turn}")
        at, turn = new.select("word", "root"), turn + 1
        if not moved:
            return at


def variants(counted: DataFrame, ratio: int = 5) -> DataFrame:
    """For every row of ``counted`` (word, n; words distinct): word, form, root,
    n, n_near, form_n.  The form is the near word of the largest n, if that is
    at least ``ratio`` times the word's own; the root is the last of the forms
    that follow on each other."""
    spark = counted.sparkSession
    ship(spark)
    scratch = Scratch(spark, "spelling")
    words = scratch.write(counted.select("word", "n").repartition(shuffle_partitions(spark)), "words")
    near = words.join(_near(words, scratch), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    near = near.select(
        "word",
        F.when(has, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"),
    )
    near = scratch.write(near, "forms")
    roots = _roots(near.filter("form IS NOT NULL"), scratch)
    found = near.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
