r"""N-gram Jaccard self-join by partitions of the token universe.

A document's set holds its distinct ``k``-word shingles.  Two sets of sizes
a <= b with Jaccard similarity of 4/5 or more differ in at most (a + b) / 9
tokens, and b is at most 5a/4, so in at most high / 4 tokens if a lies in the
size band [low, high].  Tokens are hashed into the band's segments; by the
pigeonhole principle two such sets agree on a segment, or differ by one token
on a segment that is also indexed by its one-deletion neighbourhood.

* Allocation: an exact segment absorbs one difference and costs one signature,
  a deletion segment absorbs two and costs one more per token.  For each band
  the numbers of both that absorb high / 4 + 1 differences (less what empty
  segments and a margin for frequent ones take) at the least expected number
  of signatures are chosen.  A set files under its own band and under the
  bands of its possible smaller partners.
* A set that too many empty segments leave short files once more, with the
  tokens hashed anew, up to ``ROUNDS`` times; the last time it files its empty
  segments too.  Two such sets meet in the first round in which one is not
  short.
* Buckets: sets with a signature in common are candidates.  A bucket of up to
  ``LIMIT`` sets gives its pairs.  Every segment on which a pair disagrees
  costs it a difference, so the number of signatures a linked pair shares has
  a lower bound, which rules most other pairs out.  A larger ("hot") bucket is not needed by a
  set whose other segments still absorb all differences: a pair is missed
  only if both its sets have lost more segments to hot buckets than they can
  spare.  Such sets are checked against the hub of each hot bucket they lie in.
  The sets around a hub that this leaves in different components are then
  compared block by block: the pairs' shared hot signatures are counted by a
  matrix product, and the sets of those are compared that the bound on shared
  signatures and the triangle inequality of the Jaccard distance leave over.
  No bucket is cut and no link is lost.
* Verification compares whole sets, recomputed from the texts.

Equal sets are one node from the start.  Of a chunk's bucket, map tasks send
at most ``LIMIT`` + 1 sets to the bucket's cell; the others, whose bucket is
then known to be hot, are spread over all cells.

Edge cases: a text without words has an empty set, linked with nothing; with
fewer than ``k`` words the whole sequence is the one shingle.  Null ids keep
their rows; a component's id is its smallest non-null doc_id (null if all are
null).  Repeated rows are equal sets.  An empty table gives an empty result.
Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_words, gram_ids, mix64, ship, shuffle_partitions, text_hash, word_ids
from .components import connected_components

K = 5
#: Sets in a bucket that gives all its pairs.
LIMIT = 32
#: Ratio of a size band's ends.
WIDTH = 1.4
#: Times a set files under a band, at most.
ROUNDS = 4
#: Signatures that a map task compares with each other before it sends them.
CHUNK = 2_000_000
#: Signatures that a reduce task gets, on average.
PER_TASK = 4_000_000
#: Cells of the signature space per reduce task.
CELLS = 8
#: A signature: 40 hash bits, 6 of the band, 2 of the round; its cell above.
TAG = 0xFF
#: Pairs that are verified against one hub in one group.
HUB_PAIRS = 256
#: Sets in a block around a hub.
BLOCK = 1024
U = np.uint64


def shingle_set(text: str | None, k: int = K) -> np.ndarray:
    """Sorted 64-bit ids of the distinct shingles."""
    ids = word_ids(ascii_words(text, lower=True))
    return np.unique(gram_ids(ids, min(k, len(ids)))) if len(ids) else ids


def set_id(tokens: np.ndarray) -> int:
    """Fingerprint of a whole set, as a signed 64-bit number."""
    total = mix64(tokens).sum(dtype=np.uint64) + U(len(tokens))
    return int(mix64(np.array([total], np.uint64)).view(np.int64)[0])


@dataclass(frozen=True)
class Band:
    index: int
    low: int
    high: int
    exact: int
    deletion: int

    @property
    def need(self) -> int:
        """Differences to absorb: one more than two linked sets can have."""
        return self.high // 4 + 1


def _capacity(n: int, exact: int, deletion: int) -> tuple[float, float]:
    """Expected differences absorbed for a set of n tokens, and its spread."""
    m = exact + deletion
    none = (1 - 1 / m) ** n
    one = n / m * (1 - 1 / m) ** (n - 1)
    mean = exact * (1 - none) + deletion * (2 - 2 * none - one)
    return mean, math.sqrt(exact * none * (1 - none) + deletion * (4 * none + one))


def allocate(low: int, high: int) -> tuple[int, int]:
    """(exact, deletion) segments of a band at the least expected cost."""
    need, size = high // 4 + 1, (low + high) / 2
    options = []
    for margin in (2.0, 1.0, 0.0):  # small sets leave less room
        for share in (0.0, 0.25, 0.5, 0.75, 1.0):
            m = max(1, math.ceil(need / (1 + share)))
            while m <= 4 * need:
                deletion = round(share * m)
                exact = m - deletion
                mean, spread = _capacity(low, exact, deletion)
                if mean - margin * spread >= 1.02 * need - 0.1:
                    options.append((exact + deletion * (1 + size / m), exact, deletion))
                    break
                m = max(m + 1, int(m * 1.005))
        if options:
            break
    return min(options, default=(0, need, 0))[1:]


@lru_cache(maxsize=None)
def band(index: int) -> Band:
    low = 4 if index == 0 else band(index - 1).high + 1
    high = max(low, math.ceil(low * WIDTH) - 1)
    return Band(index, low, high, *allocate(low, high))


def bands_of(n: int) -> list[Band]:
    """Bands under which a set of n tokens files.  Different sets of fewer than
    four tokens never link."""
    least = max(-(-4 * n // 5), 4)
    out, index = [], 0
    while n >= 4 and band(index).low <= n:
        if band(index).high >= least:
            out.append(band(index))
        index += 1
    return out


def _signed(tokens: np.ndarray, b: Band, turn: int) -> tuple[np.ndarray, int]:
    """Signatures of a set under a band in one round, and how many absorbed
    differences it can spare."""
    m = b.exact + b.deletion
    seg = ((mix64(tokens + U(64 * turn + b.index)) >> U(32)) * U(m) >> U(32)).astype(np.int64)
    value = mix64(tokens ^ U(0xA5A5A5A5A5A5A5A5))
    total = np.zeros(m, np.uint64)
    np.add.at(total, seg, value)
    count = np.bincount(seg, minlength=m)
    place = np.arange(m, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(64 * turn + b.index + 1)
    spare = int((count[: b.exact] > 0).sum() + np.minimum(count[b.exact :], 2).sum()) - b.need
    every = spare < 0 and turn == ROUNDS - 1
    parts = [mix64(total + place) if every else mix64((total + place)[count > 0])]
    if b.deletion:
        last = (seg >= b.exact) & ((count[seg] > 1) | every)
        parts.append(mix64(total[seg[last]] - value[last] + place[seg[last]]))
    out = np.concatenate(parts)
    return (out & ~U(TAG)) | U(b.index % 64 * 4 + turn), spare


def signatures(tokens: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
    """All signatures of a set, and what it can spare by band and round."""
    parts, spare = [np.empty(0, np.uint64)], {}
    for b in bands_of(len(tokens)):
        for turn in range(ROUNDS):
            sigs, left = _signed(tokens, b, turn)
            parts.append(sigs)
            spare[b.index % 64 * 4 + turn] = left
            if left >= 0:
                break
    return np.concatenate(parts), spare


# --- Spark stages -----------------------------------------------------------


def _members(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, set_id, n, spare): one row per row of ``docs``;
    ``spare`` by band and
    round."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets = [shingle_set(t) for t in rows["text"]]
            spare = [signatures(s)[1] for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "text_hash": rows["text_hash"],
                    "set_id": [set_id(s) for s in sets],
                    "n": [len(s) for s in sets],
                    "spare": spare,
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), "text")
    return rows.mapInPandas(scan, "doc_id long, text_hash long, set_id long, n long, spare map<int,int>")


def _sent(sig: np.ndarray, own: np.ndarray, sids: np.ndarray, cells: int) -> pa.RecordBatch:
    """What a map task sends of a chunk, one row per cell of the signature
    space: the distinct (signature, set) rows, sets as numbers into ``sids``.
    Of a bucket that is hot within the chunk, all but LIMIT + 1 rows are spread
    over the cells by set (``spread``: keys and set ids)."""
    cell = ((sig >> U(48)) % U(cells)).astype(np.int64)
    key = cell << 48 | (sig & U(2**48 - 1)).astype(np.int64)
    key, own, start, size = _grouped(key, own)
    nth = np.arange(len(key)) - np.repeat(start, size)
    over = nth > LIMIT
    away = sids[own[over]]
    target = (mix64(away.view(np.uint64)) % U(cells)).astype(np.int64)
    main, number = key[~over], own[~over]
    begin = np.searchsorted(main, np.arange(cells + 1) << 48)
    rows = []
    for c in range(cells):
        part = main[begin[c] : begin[c + 1]]
        used, local = np.unique(number[begin[c] : begin[c + 1]], return_inverse=True)
        mine = target == c
        if len(part) or mine.any():
            rows.append(
                {
                    "cell": c,
                    "high": (part >> 16 & 0xFFFFFFFF).astype(np.uint32).tobytes(),
                    "low": (part & 0xFFFF).astype(np.uint16).tobytes(),
                    "number": local.astype(np.uint16).tobytes(),
                    "sets": sids[used].tobytes(),
                    "spread": np.stack([key[over][mine], away[mine]]).tobytes(),
                }
            )
    return pa.RecordBatch.from_pylist(rows, schema=SENT)


SENT = pa.schema([("cell", pa.int32())] + [(c, pa.binary()) for c in ("high", "low", "number", "sets", "spread")])


def _grouped(sig: np.ndarray, sid: np.ndarray):
    """Distinct rows ordered by sig and set, each bucket's start and size."""
    order = np.lexsort((sid, sig))
    sig, sid = sig[order], sid[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
    sig, sid = sig[fresh], sid[fresh]
    start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.empty(0, np.int64)
    return sig, sid, start, np.diff(np.r_[start, len(sig)])


def _filed(docs: DataFrame, cells: int) -> DataFrame:
    """The signatures of all sets, dealt by cell."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, sids, held = [], [], 0

        def send() -> pa.RecordBatch:
            own = np.repeat(np.arange(len(sigs)), [len(s) for s in sigs])
            # Equal sets of a chunk are one.
            known, first = np.unique(np.array(sids, np.int64), return_inverse=True)
            return _sent(np.concatenate(sigs), first[own], known, cells)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text)
                own = signatures(tokens)[0]
                if len(own):
                    sigs.append(own)
                    sids.append(set_id(tokens))
                    held += len(own)
                if held >= CHUNK or len(sids) >= 60_000:
                    yield send()
                    sigs, sids, held = [], [], 0
        if sids:
            yield send()

    return docs.select("text").mapInArrow(
        scan, "cell int, high binary, low binary, number binary, sets binary, spread binary"
    )


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task's cells: the pairs of the small buckets (hot is false; a, b
    are sets, shared their common signatures with the tag) and the members of
    the hot ones (a is the signature, b the set)."""
    cells: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            c = row["cell"]
            high = np.frombuffer(row["high"], np.uint32).astype(np.int64)
            low = np.frombuffer(row["low"], np.uint16).astype(np.int64)
            sets = np.frombuffer(row["sets"], np.int64)
            number = np.frombuffer(row["number"], np.uint16)
            cells.setdefault(c, []).append((c << 48 | high << 16 | low, sets[number]))
            key, sid = np.frombuffer(row["spread"], np.int64).reshape(2, -1)
            if len(key):
                yield _rows(True, key, sid)
    for parts in cells.values():
        sig, sid, start, size = _grouped(*(np.concatenate(x) for x in zip(*parts)))
        hot = np.repeat(size > LIMIT, size)
        yield _rows(True, sig[hot], sid[hot])
        pairs = [[], [], []]
        for g in np.unique(size[(size > 1) & (size <= LIMIT)]):
            at = start[size == g]
            members = sid[at[:, None] + np.arange(g)]
            i, j = np.triu_indices(g, 1)
            found = (members[:, i], members[:, j], np.repeat((sig[at] & TAG)[:, None], len(i), axis=1))
            for held, new in zip(pairs, found):
                held.append(new.ravel())
        if pairs[0]:
            a, b, tag = (np.concatenate(x) for x in pairs)
            order = np.lexsort((b, a, tag))
            a, b, tag = a[order], b[order], tag[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (tag[1:] != tag[:-1])])
            yield _rows(False, a[first], b[first], tag[first], np.diff(np.r_[first, len(a)]))


def _rows(hot: bool, a: np.ndarray, b: np.ndarray, tag: np.ndarray | None = None, shared: np.ndarray | None = None):
    tag = a & TAG if tag is None else tag
    shared = np.ones(len(a), np.int64) if shared is None else shared
    columns = (np.full(len(a), hot), a, b, tag.astype(np.int32), shared)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hot", "a", "b", "tag", "shared"])


def _by_tag(value, most: int) -> Column:
    """A number of a band, by the tag of its signatures; ``most``: the size of
    the largest set."""
    entries, index = [], 0
    while index < 64 and band(index).low <= max(most, 4):
        for turn in range(ROUNDS):
            entries += [F.lit(index * 4 + turn), F.lit(int(value(band(index))))]
        index += 1
    return F.create_map(*entries)[F.col("tag")]


def _candidates(small: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the small buckets that share enough signatures.  Of the
    segments that a set keeps outside hot buckets (``kept``), a linked pair
    disagrees on (a + b) / 9 at most."""
    shared = small.groupBy("tag", "a", "b").agg(F.sum("shared").alias("shared"))
    side = lambda c: sets.select("tag", F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("kept").alias(f"kept_{c}"))
    pairs = shared.join(side("a"), ["tag", "a"]).join(side("b"), ["tag", "b"])
    pairs = pairs.filter("100 * least(n_a, n_b) >= 80 * greatest(n_a, n_b)")
    return pairs.filter("shared >= greatest(kept_a, kept_b) - (n_a + n_b) div 9").select("a", "b").distinct()


def _with_texts(wanted: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` rows with the text of a document that has their ``set_id``
    (several times if that document is repeated)."""
    rep = members.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"))
    keyed = wanted.join(rep, "set_id").withColumns({"__id": F.col("rep.doc_id"), "__hash": F.col("rep.text_hash")})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    return texts.join(keyed, same).select(*wanted.columns, "text")


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, common, size_a, size_b) of pairs (a, b) of sets.  The text of
    each b travels to its hub a; a hub with many pairs is split."""
    per = pairs.groupBy("a").agg(F.count("*").alias("pairs"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / HUB_PAIRS))
    dealt = pairs.join(per, "a").select("a", "b", part.alias("part"))
    wanted = dealt.select("a", "part", F.col("b").alias("set_id")).unionByName(
        dealt.select("a", "part", F.col("a").alias("set_id")).distinct()
    )
    sent = _with_texts(wanted, members, docs)
    sent = sent.repartition(shuffle_partitions(docs.sparkSession), "a", "part")
    sent = sent.sortWithinPartitions("a", "part", F.col("set_id") != F.col("a"), "set_id")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, tokens, done = None, None, None
        for rows in batches:
            out = []
            for a, part, sid, text in rows[["a", "part", "set_id", "text"]].itertuples(index=False):
                if sid == a:
                    if hub != (a, part):
                        hub, tokens, done = (a, part), shingle_set(text), None
                elif sid != done:  # a repeated document comes twice
                    other, done = shingle_set(text), sid
                    common = len(np.intersect1d(tokens, other, assume_unique=True))
                    out.append((a, sid, common, len(tokens), len(other)))
            yield pd.DataFrame(out, columns=["a", "b", "common", "size_a", "size_b"], dtype="int64")

    return sent.mapInPandas(compare, "a long, b long, common long, size_a long, size_b long")


def linked(checked: DataFrame) -> DataFrame:
    return checked.filter("100 * common >= 80 * (size_a + size_b - common)").select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, component, n_shingles, component_id), one row per row
    of ``docs``; ``component`` is a set of the component, the same for all its
    documents."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "jaccard")
    docs = docs.select("doc_id", "text")
    members = scratch.write(_members(docs), "members")
    total = members.select(F.sum("n")).first()[0] or 0
    tasks = max(shuffle_partitions(spark), math.ceil(0.5 * total / PER_TASK))

    filed = _filed(docs, min(tasks * CELLS, 2**15)).repartition(tasks, "cell")
    found = filed.mapInArrow(_bucketed, "hot boolean, a long, b long, tag int, shared long")
    found = scratch.write(found, "buckets")
    scratch.release()
    most = members.select(F.max("n")).first()[0] or 0

    # What each set has lost to hot buckets, and those that cannot spare it.
    lost = found.filter("hot").groupBy(F.col("b").alias("set_id"), "tag").agg(F.count("*").alias("n_hot"))
    sets = members.dropDuplicates(["set_id"]).select("set_id", "n", F.explode("spare").alias("tag", "spare"))
    sets = sets.join(lost, ["set_id", "tag"], "left").withColumn("n_hot", F.coalesce("n_hot", F.lit(0)))
    deletes = _by_tag(lambda b: b.deletion > 0, most) == 1
    # A deletion segment absorbs two differences, and shares up to all its signatures.
    sets = sets.withColumn("gone", F.col("n_hot") * F.when(deletes, 2).otherwise(1))
    # The differences that its segments absorb, all and outside hot buckets.
    absorbs = F.when(deletes, 0).otherwise(F.col("spare") + _by_tag(lambda b: b.need, most))
    sets = sets.withColumn("absorbs", absorbs).withColumn("kept", F.greatest(F.col("absorbs") - F.col("n_hot"), F.lit(0)))
    sets = scratch.write(sets, "sets")
    pairs = _candidates(found.filter("not hot"), sets)

    # A link between sets of n tokens has n / 4 differences at most.
    short = sets.filter(F.when(deletes, F.col("gone") > F.col("spare")).otherwise(4 * F.col("kept") <= F.col("n")))
    short = short.filter("n_hot > 0").select(F.col("set_id").alias("b"), "tag", "n_hot")
    hot = found.filter("hot").select("a", "b", "tag").join(short, ["b", "tag"])
    # The set with the most hot signatures is the likeliest centre of a group.
    hub = hot.groupBy("a").agg(F.max(F.struct("n_hot", "b"))["b"].alias("hub"))
    hot = scratch.write(hot.join(hub, "a").select("tag", F.col("a").alias("sig"), "hub", F.col("b").alias("set_id")), "hot")
    stars = hot.filter("hub != set_id").select(F.col("hub").alias("a"), F.col("set_id").alias("b"))

    checked = scratch.write(_verified(pairs.unionByName(stars).distinct(), members, docs), "checked")
    labels = connected_components(linked(checked), scratch)
    more = scratch.write(_across(hot, sets, checked, labels, members, docs), "across")
    if more.limit(1).count():
        labels = connected_components(linked(checked).unionByName(more), scratch, "final")

    node = members.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    node = node.withColumn("component", F.coalesce("component", "set_id"))
    least = node.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = node.join(least, "component", "left").select(
        "doc_id",
        "text_hash",
        "component",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    out = scratch.write(out, "result")
    scratch.drop("members", "buckets", "sets", "hot", "checked", "across")
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one of
    the smallest doc_id (null last), then text hash.  Documents without words
    all stay."""
    found = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    kept = found.filter("n_shingles > 0").groupBy("component").agg(first.alias("first"))
    kept = kept.select("first.doc_id", "first.text_hash").unionByName(
        found.filter("n_shingles = 0").select("doc_id", "text_hash").distinct()
    )
    kept = kept.withColumnsRenamed({"doc_id": "__id", "text_hash": "__kept"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__kept"))
    out = docs.withColumn("__hash", text_hash()).join(kept, same, "left_semi")
    # Rows that repeat a document with words are copies of it like any other.
    repeated = found.filter("n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
    if repeated.limit(1).count():
        bare = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        out = out.filter(~bare).dropDuplicates(["doc_id", "__hash"]).unionByName(out.filter(bare))
    return out.drop("__hash")


def _across(
    hot: DataFrame, sets: DataFrame, checked: DataFrame, labels: DataFrame, members: DataFrame, docs: DataFrame
) -> DataFrame:
    """Linked pairs of sets around a hub that the checks so far leave in
    different components.  Whole sets are compared only of pairs that share
    all but (a + b) / 9 of either set's segments (those of hot buckets; a linked
    pair that shares other buckets too is among the checked) and whose
    distances to the hub differ by 1/5 at most."""
    apart = (F.lit(1.0) - F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))).alias("apart")
    to_hub = checked.select(F.col("a").alias("hub"), F.col("b").alias("set_id"), apart)
    sigs = hot.groupBy("set_id", "tag").agg(F.collect_set("sig").alias("sigs"))  # at most a set's own
    rows = hot.select("hub", "tag", "set_id").distinct().join(to_hub, ["hub", "set_id"], "left")
    rows = rows.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "hub", "tag", "set_id", F.coalesce("apart", F.lit(0.0)).alias("apart"), F.coalesce("component", "set_id").alias("component")
    )
    around = rows.groupBy("hub", "tag").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    rows = rows.join(around.filter("x != y").drop("x", "y"), ["hub", "tag"]).join(sigs, ["set_id", "tag"])
    rows = rows.join(sets.select("set_id", "tag", "n", F.col("absorbs").alias("need")), ["set_id", "tag"])
    mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [shingle_set(t).tobytes() for t in part["text"]]
            yield pd.DataFrame({"set_id": part["set_id"], "tokens": found})

    texts = _with_texts(rows.select("set_id").distinct(), members, docs).dropDuplicates(["set_id"])
    rows = rows.join(texts.mapInPandas(tokens, "set_id long, tokens binary"), "set_id")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        column, at = np.unique(np.concatenate(rows["sigs"].to_numpy()), return_inverse=True)
        holds = np.zeros((len(rows), len(column)), np.float32)
        holds[np.repeat(np.arange(len(rows)), [len(x) for x in rows["sigs"]]), at] = 1
        left = np.flatnonzero(rows["mine"] == rows["i"])
        right = np.flatnonzero(rows["mine"] == rows["j"])
        n, need, apart, component, sid = (rows[c].to_numpy() for c in ("n", "need", "apart", "component", "set_id"))
        whole = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        out = []
        for k in left:
            shared = holds[right] @ holds[k]
            may = (shared >= 1) & (shared >= np.maximum(need[k], need[right]) - (n[k] + n[right]) // 9)
            may &= 100 * np.minimum(n[k], n[right]) >= 80 * np.maximum(n[k], n[right])
            may &= (component[k] != component[right]) & (np.abs(apart[k] - apart[right]) <= 0.2 + 1e-9)
            for x in right[may]:
                common = len(np.intersect1d(whole[k], whole[x], assume_unique=True))
                if 100 * common >= 80 * (n[k] + n[x] - common):
                    out.append((min(sid[k], sid[x]), max(sid[k], sid[x])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    rows = rows.select("hub", "tag", "set_id", "apart", "component", "sigs", "tokens", "n", "need", "mine", "i", "j")
    return rows.groupBy("hub", "tag", "i", "j").applyInPandas(compare, "a long, b long").distinct()
