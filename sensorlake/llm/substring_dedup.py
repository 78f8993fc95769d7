r"""Removal of long word sequences that an earlier document holds.

A window is ``span`` consecutive words.  A word goes if a window that covers
it also starts in a document with a smaller doc_id.

1. Runs.  Each window is represented by its least-hash ``GRAM``-word gram, a
   choice that depends on the window's words alone; consecutive windows with
   the same gram occurrence form a run (13 windows or so).  Equal windows
   therefore lie in runs of the same gram.
2. Equal runs.  Per gram and content of the run, the smallest doc_id holds the
   reference; the same run in any later document is removed whole.
3. Reference shards.  Where a gram has several contents, the distinct contents
   are the reference passages.  They are sharded by gram, each shard's suffix
   automaton holds the smallest doc_id of every state, and the passages are
   streamed through it: the matching statistics give, for every window, the
   first document that holds it; maximal spans of earlier windows are removed.
   A shard holds ``SHARD`` passages (or one gram's), so its automaton stays
   small; a gram with more contents than that is decided window by window, by
   the smallest doc_id per window, which spreads over all tasks.  What is
   found for a passage holds for every run of the same gram and content whose
   doc_id is the smallest one: again in the same document, in another text of
   the same doc_id, or among null ids.
4. Each document is joined with its spans and cut.

So every document meets the shards that can hold its windows and no others,
and work grows with the text that repeats.

Edge cases: null texts have no words; texts shorter than a window lose
nothing; a null doc_id sorts after all others (and null ids do not precede
each other); rows that share doc_id and text are one document; rows that share
only doc_id do not precede each other.  An empty table gives an empty result.
Columns beside doc_id and text are passed through by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID_ORDER, Scratch, ascii_words, gram_ids, mix64, ship, shuffle_partitions, text_hash, word_ids

SPAN = 50
GRAM = 16
#: Passages in one automaton.
SHARD = 2000
KEY = ["doc_id", "text_hash"]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _prefix_hashes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ids times powers of the base, and the inverse powers."""
    n = len(ids)
    power = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE)], dtype=np.uint64)
    return np.r_[np.uint64(0), np.cumsum(ids * power[:n], dtype=np.uint64)], back


def runs_of(words: list[bytes], span: int = SPAN, gram: int = GRAM):
    """(gram hash, first window, windows, content hash) arrays of the runs."""
    ids = word_ids(words)
    grams = gram_ids(ids, gram)
    least = np.lib.stride_tricks.sliding_window_view(grams, span - gram + 1).argmin(axis=1)
    at = least + np.arange(len(least))
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    total, back = _prefix_hashes(ids)
    end = first + count + span - 1
    content = mix64((total[end] - total[first]) * back[first] + (at[first] - first).astype(np.uint64) * np.uint64(2))
    return grams[at[first]], first, count, content


class SuffixAutomaton:
    """Suffix automaton of word sequences.  Sequences are added in ascending
    order of their number; ``first`` is each state's smallest number."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [math.inf]

    def add(self, words: list, number: int) -> None:
        link, first = self.link, self.first
        last = 0
        for w in words:
            last = v = self._extend(last, w)
            while v > 0 and first[v] > number:
                first[v] = number
                v = link[v]

    def _state(self, following: dict, link: int, length: int, first: float) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, w, q: int) -> int:
        """The state of p's strings followed by w, apart from longer ones in q."""
        following, link, length = self.next, self.link, self.length
        if length[q] == length[p] + 1:
            return q
        clone = self._state(dict(following[q]), link[q], length[p] + 1, self.first[q])
        link[q] = clone
        while p >= 0 and following[p].get(w) == q:
            following[p][w] = clone
            p = link[p]
        return clone

    def _extend(self, last: int, w) -> int:
        following, link = self.next, self.link
        q = following[last].get(w)
        if q is not None:
            return self._split(last, w, q)
        new = self._state({}, 0, self.length[last] + 1, math.inf)
        p = last
        while p >= 0:
            q = following[p].get(w)
            if q is not None:
                link[new] = self._split(p, w, q)
                break
            following[p][w] = new
            p = link[p]
        return new

    def first_holders(self, words: list, span: int) -> list[float]:
        """For every window of ``words``, the smallest number of a sequence
        that holds it (inf if none): matching statistics, read off wherever
        they reach ``span``."""
        following, link, length = self.next, self.link, self.length
        out = []
        v = matched = 0
        for i, w in enumerate(words):
            while v and w not in following[v]:
                v = link[v]
                matched = length[v]
            if w in following[v]:
                v = following[v][w]
                matched += 1
            while length[link[v]] >= span if v else False:
                v = link[v]
                matched = length[v]
            if i >= span - 1:
                out.append(self.first[v] if matched >= span else math.inf)
        return out


def spans_of(flags: np.ndarray, start: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal word spans covered by the flagged windows of a run."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1) + start, np.flatnonzero(edge == -1) + start + span - 1


# --- Spark stages -----------------------------------------------------------


def _runs(docs: DataFrame, span: int) -> DataFrame:
    """(gram, content, at, windows, ord, doc_id, text_hash): the runs of all
    documents."""
    names = ["gram", "content", "at", "windows", "ord", "doc_id", "text_hash"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ids, orders, hashes, counts = [], [], [], [], []
            for doc_id, order, text_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ord", "text_hash", "text"))):
                words = ascii_words(text)
                if len(words) >= span:
                    parts.append(runs_of(words, span))
                    ids.append(doc_id)
                    orders.append(order)
                    hashes.append(text_id)
                    counts.append(len(parts[-1][0]))
            if parts:
                gram, at, windows, content = (np.concatenate(x) for x in zip(*parts))
                columns = [gram.view(np.int64), content.view(np.int64), at.astype(np.int32), windows.astype(np.int32)]
                row = np.repeat(np.arange(len(ids)), counts)
                columns += [np.array(orders, np.int64)[row]]
                arrays = [pa.array(c) for c in columns] + [pa.array(ids, pa.int64()).take(pa.array(row))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.array(hashes, np.int64)[row])], names=names)

    order = F.coalesce("doc_id", F.lit(NULL_ID_ORDER)).alias("ord")
    rows = docs.select("doc_id", order, text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(scan, "gram long, content long, at int, windows int, ord long, doc_id long, text_hash long")


def _with_text(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with per-document ``rows`` by key."""
    rows = rows.withColumnsRenamed({c: f"__{c}" for c in KEY})
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__this_hash") == F.col("__text_hash"))
    joined = docs.withColumn("__this_hash", text_hash()).join(rows, same, how)
    return joined.drop("__doc_id", "__text_hash", "__this_hash")


def _passages(docs: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """(gram, content, hot, ord, doc_id, text_hash, at, words): the words of
    the wanted runs."""
    per = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("gram", "content", "hot", "ord", "at", "windows")).alias("runs"))
    found = _with_text(docs.select("doc_id", "text"), per, "inner").select("doc_id", text_hash().alias("text_hash"), "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = ascii_words(row["text"])
                for r in row["runs"]:
                    part = words[r["at"] : r["at"] + r["windows"] + span - 1]
                    out.append({**r, "doc_id": row["doc_id"], "text_hash": row["text_hash"], "words": b" ".join(part)})
            yield pa.RecordBatch.from_pylist(out, schema=PASSAGE)

    return found.mapInArrow(
        cut, "gram long, content long, hot boolean, ord long, at int, doc_id long, text_hash long, words binary"
    )


PASSAGE = pa.schema(
    [("gram", pa.int64()), ("content", pa.int64()), ("hot", pa.bool_()), ("ord", pa.int64()), ("at", pa.int32())]
    + [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("words", pa.binary())]
)


FOUND = "gram long, content long, doc_id long, text_hash long, at int, start int, end int"


def _streamed(passages: DataFrame, span: int) -> DataFrame:
    """The spans of the passages that the shards' automata show to be held by
    earlier documents, as ``FOUND``."""
    dealt = passages.repartition(shuffle_partitions(passages.sparkSession), "gram")
    dealt = dealt.sortWithinPartitions("gram", "content").select("gram", "content", "ord", "at", *KEY, "words")

    def shard(rows: list[tuple]) -> pd.DataFrame:
        rows = sorted(((r[2], r[6].split(), r) for r in {r[1:]: r for r in rows}.values()), key=lambda x: x[0])
        automaton = SuffixAutomaton()
        for order, words, _ in rows:
            automaton.add(words, order)
        out = []
        for order, words, r in rows:
            earlier = np.array(automaton.first_holders(words, span)) < order
            if earlier.any():
                out += [(r[0], r[1], *r[4:6], r[3], s, e) for s, e in zip(*spans_of(earlier, r[3], span))]
        return pd.DataFrame(out, columns=["gram", "content", *KEY, "at", "start", "end"]).astype({"doc_id": "Int64"})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for rows in batches:
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            for r in rows.itertuples(index=False, name=None):
                if len(held) >= SHARD and held[-1][0] != r[0]:
                    yield shard(held)
                    held = []
                held.append((*r[:4], None if r[4] is pd.NA else r[4], *r[5:]))
        if held:
            yield shard(held)

    return dealt.mapInPandas(stream, FOUND)


def _by_window(passages: DataFrame, span: int) -> DataFrame:
    """The same for grams with more contents than a shard holds."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for gram, content, order, at, doc_id, text_id, raw in rows.itertuples(index=False, name=None):
                ids = word_ids(raw.split())
                total, back = _prefix_hashes(ids)
                n = len(ids) - span + 1
                key = mix64((total[span:] - total[:n]) * back[:n]).view(np.int64)
                start = at + np.arange(n)
                found = {"gram": gram, "content": content, "win": key, "ord": order, "doc_id": doc_id, "text_hash": text_id, "at": at}
                yield pd.DataFrame(found | {"start": start}).astype({"doc_id": "Int64"})

    rows = passages.select("gram", "content", "ord", "at", *KEY, "words")
    windows = rows.mapInPandas(
        explode, "gram long, content long, win long, ord long, doc_id long, text_hash long, at int, start int"
    )
    least = windows.groupBy("gram", "win").agg(F.min("ord").alias("least"))
    late = windows.join(least, ["gram", "win"]).filter("ord > least")
    return late.select("gram", "content", *KEY, "at", "start", (F.col("start") + span).alias("end"))


def _again(found: DataFrame, twins: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end) of what was found for a passage, in the
    other runs of its gram and content."""
    offsets = found.select("gram", "content", (F.col("start") - F.col("at")).alias("from"), (F.col("end") - F.col("at")).alias("to"))
    same = twins.distinct().join(offsets.distinct(), ["gram", "content"])
    return same.select(*KEY, (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"))


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_hash, spans) of every document that loses words; spans is
    an array of (start, end) in words."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "substrings")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = scratch.write(_runs(docs, span), "runs")

    contents = runs.groupBy("gram", "content").agg(
        F.min(F.struct("ord", "doc_id", "text_hash", "at", "windows")).alias("rep"), F.count("*").alias("copies")
    )
    contents = scratch.write(contents.select("gram", "content", "rep.*", "copies"), "contents")
    scratch.release()
    # The other runs of a content: later ones go whole, those of the smallest
    # doc_id (twins, which keep their gram) lose what their passage loses.
    held = contents.filter("copies > 1").select("gram", "content", F.struct("ord", *KEY, "at").alias("rep"))
    late, rep = F.col("ord") > F.col("rep.ord"), F.struct("ord", *KEY, "at").eqNullSafe(F.col("rep"))
    others = runs.join(held, ["gram", "content"]).filter(late | ~rep)
    passage = [F.when(~late, F.col(c)).alias(c) for c in ("gram", "content")]
    end = (F.col("at") + F.col("windows") + span - 1).alias("end")
    others = scratch.write(others.select(*passage, *KEY, F.col("at").alias("start"), end), "others")
    whole, twins = others.filter("gram is null").select(*KEY, "start", "end"), others.filter("gram is not null").drop("end")
    scratch.release()

    per = contents.groupBy("gram").agg(F.count("*").alias("n"), F.min("ord").alias("least"), F.max("ord").alias("most"))
    per = per.filter("n > 1 and most > least").select("gram", (F.col("n") > SHARD).alias("hot"))
    passages = scratch.write(_passages(docs, contents.join(per, "gram"), span), "passages")
    scratch.release()
    found = _streamed(passages.filter("not hot"), span).unionByName(_by_window(passages.filter("hot"), span))
    found = scratch.write(found, "found")
    spans = whole.unionByName(found.select(*whole.columns)).unionByName(_again(found, twins))
    out = scratch.write(spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    scratch.drop("runs", "contents", "others", "passages", "found")
    scratch.release()
    return out


def remove_repeats(docs: DataFrame, span: int = SPAN, text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_sha256 (of the kept words, joined
    by one space) and, if ``text`` is set, the text cut: kept words joined by
    one space where words went, unchanged elsewhere.  Without ``text`` the
    text column is dropped."""
    spans = repeated_spans(docs, span)
    added = ["n_words", "n_removed", "kept_sha256"]
    joined = _with_text(docs.drop(*added), spans.withColumnRenamed("spans", "__spans"), "left")

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string" + ", text string" * text)
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in parts:
            out = []
            for raw, found in zip(texts, lists):
                words = ascii_words(raw)
                kept, new = words, raw
                if found is not None and len(found):
                    edge = np.zeros(len(words) + 1, np.int64)
                    for s in found:
                        edge[s["start"]] += 1
                        edge[s["end"]] -= 1
                    stays = np.cumsum(edge[:-1]) == 0
                    kept = [w for w, k in zip(words, stays.tolist()) if k]
                    new = b" ".join(kept).decode("utf-8", "surrogatepass") if text else None
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
                out.append((len(words), len(words) - len(kept), digest, *([new] if text else [])))
            yield pd.DataFrame(out, columns=[*added, *(["text"] if text else [])])

    columns = [c for c in docs.columns if c not in added]
    joined = joined.withColumn("__cut", cut("text", "__spans"))
    new = F.col("__cut.text").alias("text") if text else None
    kept = [(new if c == "text" else F.col(c)) for c in columns if c != "text" or text]
    return joined.select(*kept, *[F.col(f"__cut.{c}").alias(c) for c in added])
