r"""Language-model scores by Katz backoff.

Tokens are the words ``[^\x20\x09-\x0D]+`` (A-Z lower-cased) and one end; a
text's first token follows a start mark.  With Good-Turing discounts delta,

    P(w | u) = (c(u, w) - delta2(c(u, w))) / c(u)     if c(u, w) > 0
             = alpha(u) P(w)                          otherwise
    P(w)     = (c(w) - delta1(c(w))) / N              if c(w) > 0

the unknown word gets what the discounts of the single words leave, and
alpha(u) = (sum of u's discounts / c(u)) / (1 - sum of P(w) over u's seen
successors), so every context sums to one exactly.  A context that training
lacks backs off with weight 1.  Counts above ``K`` are discounted like K, so
no context is left without mass to back off with.

The counts live in tables partitioned by the hash of the predicted word:

1. Counting: map tasks send the distinct words and word pairs of a chunk of
   documents with their counts; each cell adds them up and returns its
   counts of counts, from which the discounts follow.
2. Scoring: map tasks send, per cell, the chunk's pairs with the documents
   they stand in.  A cell knows c(w) and c(u, w), hence P(w) and the
   numerators; it returns each document's sums, each context's sums of
   discounts and of P(w), and the pairs that training lacks, which are left
   to back off.
3. log P(w | u) = log numerator - log c(u).  A token's cell knows c(w) and
   charges it as the denominator of the following token; where that one turns
   out to be unseen, joining its context's row replaces the denominator by
   the backoff weight.

A frequent word or pair costs one entry per chunk in counting.  In scoring a
word's cell is split: counting returns the words and pairs that training holds
at least ``HOT`` times, the ``HOT_LIST`` most frequent of each.  Such a word's
pairs are dealt by context and word, such a pair's documents by document as
well, and their cells take c(w) and c(u, w) from the list.  What is left in one
place is no more than the larger of ``HOT`` and 1 / ``HOT_LIST`` of the tokens.

Edge cases: null and empty texts consist of the end alone; a null doc_id is
held out of no fold; repeated rows count as often as they stand and score
alike; without training texts every score is 0.  Columns beside doc_id and
text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_words, mix64, ship, shuffle_partitions, word_ids

K = 5
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Tokens that a map task gathers before it sends them.
CHUNK = 1_000_000
#: Passes over the texts in scoring, each for a part of the cells: the pairs
#: in flight take that part of the disk.
PASSES = 3
#: Tokens per cell, on average.
PER_CELL = 2_000_000
#: Training occurrences from which a word or pair is split over the cells, and
#: how many of each are at most (the list goes to every task).
HOT, HOT_LIST = 250_000, 100_000


@dataclass(frozen=True)
class Listed:
    """A bounded list of ids, ascending, with their counts."""

    ids: np.ndarray
    counts: np.ndarray

    def _at(self, ids: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)

    def holds(self, ids: np.ndarray) -> np.ndarray:
        return self.ids[self._at(ids)] == ids if len(self.ids) else np.zeros(len(ids), bool)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids that the list holds."""
        return self.counts[self._at(ids)]


@dataclass(frozen=True)
class Counts:
    """What scoring needs of the whole training corpus."""

    tokens: int  # N, ends included
    words: int  # V, the end included
    texts: int
    delta1: tuple[float, ...]  # discounts by count, 0 .. K
    delta2: tuple[float, ...]
    unknown: float  # probability of the unknown word
    hot_words: Listed
    hot_pairs: Listed

    def split(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs (u, w) have a split word, and which are split
        themselves."""
        word = self.hot_words.holds(w)
        pair = word.copy()
        pair[word] = self.hot_pairs.holds(_pair_ids(u[word], w[word]))
        return word, pair


def discounts(n: list[int]) -> tuple[float, ...]:
    """Katz's Good-Turing discounts r - r* for counts 0..K, from the counts of
    counts n[0..K+1]; one half where these give none between 0 and r."""
    out = [0.0]
    for r in range(1, K + 1):
        delta = 0.0
        if n[1] and n[r]:
            tail = (K + 1) * n[K + 1] / n[1]
            if tail < 1:
                delta = r * (1 - ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail))
        out.append(delta if 0 < delta < r else 0.5)
    return tuple(out)


def discounted(count: np.ndarray, delta: tuple[float, ...]) -> np.ndarray:
    return np.asarray(delta)[np.minimum(count, K)]


# --- chunks of documents ----------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], training: bool) -> Iterator[list[tuple[int, bool, np.ndarray]]]:
    held, size = [], 0
    for batch in batches:
        for key, out, text in zip(*(batch.column(c).to_pylist() for c in ("key", "held_out", "text"))):
            if training and out:
                continue
            ids = np.r_[START, word_ids(ascii_words(text, lower=True)), END]
            held.append((key, out, ids))
            size += len(ids)
            if size >= CHUNK or len(held) >= 60_000:
                yield held
                held, size = [], 0
    if held:
        yield held


def _cell(ids: np.ndarray, cells: int) -> np.ndarray:
    """Cell of each id; ascending in the id."""
    return ((ids >> np.uint64(40)) * np.uint64(cells) >> np.uint64(24)).astype(np.int64)


def _cuts(sorted_ids: np.ndarray, cells: int) -> np.ndarray:
    return np.searchsorted(_cell(sorted_ids, cells), np.arange(cells + 1))


def _pair_ids(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(u * np.uint64(0x9E3779B97F4A7C15) + w)


def _added(ids: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids with the sums of their counts."""
    ids, counts = np.concatenate(ids), np.concatenate(counts)
    order = np.argsort(ids)
    ids, counts = ids[order], counts[order].astype(np.int64)
    start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[start], np.add.reduceat(counts, start)


def _send_counts(cells: int):
    schema = pa.schema([("cell", pa.int32())] + [(c, pa.binary()) for c in ("word", "words", "pair", "pairs")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, training=True):
            word, words = np.unique(np.concatenate([ids[1:] for _, _, ids in chunk]), return_counts=True)
            pair, pairs = np.unique(
                np.concatenate([_pair_ids(ids[:-1], ids[1:]) for _, _, ids in chunk]), return_counts=True
            )
            a, b = _cuts(word, cells), _cuts(pair, cells)
            rows = [
                {
                    "cell": c,
                    "word": word[a[c] : a[c + 1]].tobytes(),
                    "words": words[a[c] : a[c + 1]].astype(np.uint32).tobytes(),
                    "pair": pair[b[c] : b[c + 1]].tobytes(),
                    "pairs": pairs[b[c] : b[c + 1]].astype(np.uint32).tobytes(),
                }
                for c in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            del rows, word, words, pair, pairs, chunk
            pa.default_memory_pool().release_unused()

    return run


def _counts_of_counts(hot: int):
    """(n, r, number): how many words (n = 1) or pairs (n = 2) of the task's
    cells occur r times (r up to K + 1); r = 0: all of them; r = -1: their
    occurrences; r = -2: the ends; r = -3: the count of the one named by
    ``id``, which occurs at least ``hot`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                cells.setdefault(row["cell"], []).append(row)
        out = []
        for rows in cells.values():
            for n, ids, counts in ((1, "word", "words"), (2, "pair", "pairs")):
                key, c = _added(
                    [np.frombuffer(r[ids], np.uint64) for r in rows],
                    [np.frombuffer(r[counts], np.uint32) for r in rows],
                ) if any(r[ids] for r in rows) else (np.empty(0, np.uint64), np.empty(0, np.int64))
                out += [(n, r, int((c == r).sum()), 0) for r in range(1, K + 2)]
                out += [(n, 0, len(key), 0), (n, -1, int(c.sum()), 0)]
                if n == 1:
                    out.append((n, -2, int(c[key == END].sum()), 0))
                many = c >= hot
                out += [(n, -3, x, i) for x, i in zip(c[many].tolist(), key[many].view(np.int64).tolist())]
        if out:
            arrays = [pa.array(x, pa.int64()) for x in zip(*out)]
            yield pa.RecordBatch.from_arrays(arrays, names=["n", "r", "number", "id"])

    return run


def _listed(found: DataFrame, n: int) -> Listed:
    top = found.filter((F.col("n") == n) & (F.col("r") == -3)).orderBy(F.desc("number"), "id").limit(HOT_LIST).collect()
    ids = np.array([x["id"] for x in top], np.int64).view(np.uint64)
    order = np.argsort(ids)
    return Listed(ids[order], np.array([x["number"] for x in top], np.int64)[order])


def count(docs: DataFrame, cells: int, hot: int, scratch: Scratch) -> Counts:
    sent = docs.mapInArrow(_send_counts(cells), "cell int, word binary, words binary, pair binary, pairs binary")
    found = sent.repartitionById(cells, "cell").mapInArrow(
        _counts_of_counts(hot), "n long, r long, number long, id long"
    )
    found = scratch.write(found, "counts")
    sums = {(x["n"], x["r"]): x["s"] for x in found.groupBy("n", "r").agg(F.sum("number").alias("s")).collect()}
    get = lambda n, r: sums.get((n, r), 0)
    delta1, delta2 = (discounts([get(n, r) for r in range(K + 2)]) for n in (1, 2))
    tokens, words = get(1, -1), get(1, 0)
    rare = sum(get(1, r) for r in range(1, K + 1))
    mass = sum(delta1[r] * get(1, r) for r in range(1, K + 1)) + delta1[K] * (words - rare)
    unknown = mass / tokens if tokens else 1.0
    return Counts(tokens, words, get(1, -2), delta1, delta2, unknown, _listed(found, 1), _listed(found, 2))


# --- scoring ----------------------------------------------------------------

_BLOBS = ("word", "pairs", "u", "places", "doc", "times", "key", "out")


def _send_pairs(cells: int, first: int, last: int, counts: Counts):
    """One row per chunk and cell from ``first`` to before ``last``: words; pairs per word; the pairs' first
    words; documents per pair; document numbers and times; document keys and
    whether they are held out."""
    schema = pa.schema([("cell", pa.int32())] + [(c, pa.binary()) for c in _BLOBS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, training=False):
            keys = np.array([k for k, _, _ in chunk], np.int64)
            out = np.array([o for _, o, _ in chunk], np.uint8)
            doc = np.repeat(np.arange(len(chunk), dtype=np.uint16), [len(ids) - 1 for _, _, ids in chunk])
            u = np.concatenate([ids[:-1] for _, _, ids in chunk])
            w = np.concatenate([ids[1:] for _, _, ids in chunk])
            hot, split = counts.split(u, w)
            deal = w.copy()
            deal[hot] = _pair_ids(u[hot], w[hot])
            deal[split] = mix64(deal[split] + keys[doc[split]].view(np.uint64))
            cell = _cell(deal, cells)
            del deal, hot, split
            mine = (cell >= first) & (cell < last)
            w, u, doc, cell = w[mine], u[mine], doc[mine], cell[mine]
            if not len(w):
                continue
            order = np.lexsort((doc, u, w, cell))
            w, u, doc, cell = w[order], u[order], doc[order], cell[order]
            new_w = np.r_[True, (w[1:] != w[:-1]) | (cell[1:] != cell[:-1])]
            new_u = new_w | np.r_[True, u[1:] != u[:-1]]
            new_d = new_u | np.r_[True, doc[1:] != doc[:-1]]
            place = np.flatnonzero(new_d)  # (w, u, doc) triples
            times = np.diff(np.r_[place, len(w)]).astype(np.uint32)
            doc, new_u, new_w, w, u, cell = doc[place], new_u[place], new_w[place], w[place], u[place], cell[place]
            pair = np.flatnonzero(new_u)
            places = np.diff(np.r_[pair, len(w)]).astype(np.uint32)
            word = np.flatnonzero(new_w[pair])
            pairs = np.diff(np.r_[word, len(pair)]).astype(np.uint32)
            cut = np.searchsorted(cell, np.arange(cells + 1))
            cut_pair = np.searchsorted(pair, cut)
            cut_word = np.searchsorted(word, cut_pair)
            u, w = u[pair], w[pair][word]
            rows = []
            for c in first + np.flatnonzero(np.diff(cut[first : last + 1])):
                used, local = np.unique(doc[cut[c] : cut[c + 1]], return_inverse=True)
                p, q = slice(cut_pair[c], cut_pair[c + 1]), slice(cut_word[c], cut_word[c + 1])
                rows.append(
                    {
                        "cell": c - first,
                        "word": w[q].tobytes(),
                        "pairs": pairs[q].tobytes(),
                        "u": u[p].tobytes(),
                        "places": places[p].tobytes(),
                        "doc": local.astype(np.uint16).tobytes(),
                        "times": times[cut[c] : cut[c + 1]].tobytes(),
                        "key": keys[used].tobytes(),
                        "out": out[used].tobytes(),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            del rows, order, w, u, doc, cell, place, times, places, chunk
            pa.default_memory_pool().release_unused()

    return run


#: Kinds of rows that scoring returns: a document's sums, a context's sums, an
#: unseen pair, a context's sums for one split pair (from every cell that has it).
DOCUMENT, CONTEXT, UNSEEN, SPLIT = 0, 1, 2, 3
_ROW = "kind byte, key long, doc long, a double, b double, known long, tokens long, ends long"


def _score_cells(counts: Counts):
    types = [pa.int8(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in _ROW.split(", ")]

    def table(kind, key, doc=None, a=None, b=None, known=None, tokens=None, ends=None) -> pa.RecordBatch:
        n = len(key)
        filled = [np.full(n, kind)] + [np.zeros(n, np.int64) if x is None else x for x in (key, doc, a, b, known, tokens, ends)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(filled, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {c: [] for c in ("w", "u", "places", "doc", "times", "key", "out")}
        kinds = dict(zip(_BLOBS, ("u8", "u4", "u8", "u4", "u2", "u4", "i8", "u1")))
        docs = 0
        for batch in batches:
            for row in batch.to_pylist():
                got = {c: np.frombuffer(row[c], kinds[c]) for c in _BLOBS}
                got["doc"] = got["doc"].astype(np.uint32) + np.uint32(docs)
                got["w"] = np.repeat(got["word"], got["pairs"])
                docs += len(got["key"])
                for c, held in parts.items():
                    held.append(got[c])
        if not docs:
            return
        w, u, places, doc, times, key, out = (np.concatenate(parts.pop(c)) for c in ("w", "u", "places", "doc", "times", "key", "out"))
        first = np.cumsum(places, dtype=np.int64) - places
        trained = np.add.reduceat(np.where(out[doc] == 0, times, 0).astype(np.int64), first)

        order = np.lexsort((u, w))
        fresh = np.r_[True, (w[order][1:] != w[order][:-1]) | (u[order][1:] != u[order][:-1])]
        start = np.flatnonzero(fresh)
        type_of = np.empty(len(w), np.int64)
        type_of[order] = np.cumsum(fresh) - 1
        type_w, type_u = w[order][start], u[order][start]
        c2 = np.add.reduceat(trained[order], start)
        word_start = np.flatnonzero(np.r_[True, type_w[1:] != type_w[:-1]])
        c1 = np.repeat(np.add.reduceat(c2, word_start), np.diff(np.r_[word_start, len(type_w)]))
        hot, split = counts.split(type_u, type_w)
        c1[hot] = counts.hot_words.of(type_w[hot])
        c2[split] = counts.hot_pairs.of(_pair_ids(type_u[split], type_w[split]))
        del order, fresh, hot

        one = np.where(c1 > 0, (c1 - discounted(c1, counts.delta1)) / max(counts.tokens, 1), counts.unknown)
        log_one = np.log10(one)
        with np.errstate(divide="ignore"):
            log_two = np.log10(np.where(c2 > 0, c2 - discounted(c2, counts.delta2), 1.0))
        is_end = type_w == END
        follow = np.where((c1 > 0) & ~is_end, np.log10(np.maximum(c1, 1)), 0.0)
        follow += np.where(is_end, math.log10(max(counts.texts, 1)), 0.0)
        score = np.where(c2 > 0, log_two, log_one) - follow
        base = np.log10((c1 + 1) / (counts.tokens + counts.words + 1))

        seen = c2 > 0
        whole = seen & ~split
        context, which = np.unique(type_u[whole], return_inverse=True)
        yield table(
            CONTEXT,
            context.view(np.int64),
            a=np.bincount(which, discounted(c2[whole], counts.delta2), len(context)),
            b=np.bincount(which, one[whole], len(context)),
        )
        yield table(
            SPLIT,
            type_u[split].view(np.int64),
            doc=_pair_ids(type_u[split], type_w[split]).view(np.int64),
            a=discounted(c2[split], counts.delta2),
            b=one[split],
        )
        each = np.repeat(type_of, places)
        del w, u, first, trained, type_of, places
        summed = lambda x: np.bincount(doc, x[each] * times, docs)
        yield table(
            DOCUMENT,
            key,
            a=summed(score),
            b=summed(base),
            known=summed((c1 > 0).astype(np.int64)).astype(np.int64),
            tokens=np.bincount(doc, times, docs).astype(np.int64),
            ends=summed(is_end.astype(np.int64)).astype(np.int64),
        )
        new = ~seen[each]
        yield table(UNSEEN, type_u[each[new]].view(np.int64), doc=key[doc[new]], a=times[new].astype(np.float64))

    return run


def score(docs: DataFrame, held_out, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score.  ``held_out`` is a boolean
    column; the model learns from the other rows.  ``hot``: see ``HOT``."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "katz")
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text", "held_out"))
    # About as many tokens; only the number of cells depends on it.
    size = rows.select(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 6 + 2)).first()[0] or 0
    cells = max(math.ceil(size / PER_CELL), min(shuffle_partitions(spark), 6))
    source = rows.select("key", "held_out", "text")

    counts = count(source, cells, hot, scratch)
    scratch.release()
    blobs = "cell int, " + ", ".join(f"{c} binary" for c in _BLOBS)
    parts = []
    for i in range(PASSES):
        first, last = i * cells // PASSES, (i + 1) * cells // PASSES
        if first < last:
            sent = source.mapInArrow(_send_pairs(cells, first, last, counts), blobs).repartitionById(last - first, "cell")
            parts.append(scratch.write(sent.mapInArrow(_score_cells(counts), _ROW), f"found-{i}"))
            del sent
            scratch.release()
    found = reduce(DataFrame.unionByName, parts)

    # alpha(u) c(u): what replaces the numerator and the charged denominator.
    once = found.filter(F.col("kind") == SPLIT).groupBy("key", "doc").agg(F.first("a").alias("a"), F.first("b").alias("b"))
    contexts = found.filter(F.col("kind") == CONTEXT).select("key", "a", "b").unionByName(once.drop("doc"))
    contexts = contexts.groupBy("key").agg(F.sum("a").alias("d"), F.sum("b").alias("t"))
    left = F.greatest(1 - F.col("t"), F.lit(counts.unknown))
    contexts = contexts.select("key", F.log10(F.col("d") / left).alias("weight"))
    unseen = found.filter(F.col("kind") == UNSEEN).select("key", "doc", "a").join(contexts, "key")
    unseen = unseen.select(F.col("doc").alias("key"), (F.col("a") * F.col("weight")).alias("a"))
    zero = [F.lit(0.0).alias("b")] + [F.lit(0).cast("long").alias(c) for c in ("known", "tokens", "ends")]
    sums = found.filter(F.col("kind") == DOCUMENT).select("key", "a", "b", "known", "tokens", "ends")
    sums = sums.unionByName(unseen.select("key", "a", *zero)).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("a", "b", "known", "tokens", "ends")]
    )
    sums = scratch.write(sums, "sums")
    scratch.drop(*[f"found-{i}" for i in range(PASSES)])
    scratch.release()
    # Repeated rows share a key: their sums are that many times one row's.
    return rows.drop("text").join(sums, "key").select(
        "doc_id",
        "held_out",
        F.expr("tokens div ends").alias("n_tokens"),
        F.expr("known div ends").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("b") / F.col("ends")).alias("base_score"),
        (F.col("a") / F.col("ends") if counts.tokens else F.lit(0.0)).alias("score"),
    )
