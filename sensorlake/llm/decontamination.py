r"""Benchmark decontamination with a positional inverted index.

1. Windows: every ``width`` consecutive words of a benchmark item (a shorter
   item is one window); equal windows of several items are one.
2. Frequencies: the corpus counts of the windows' terms, in one pass with
   partial sums.  A window with a term the corpus lacks cannot occur.
3. Index: positional postings (doc, term, position) of the terms that searches
   start from, the ``PROBES`` rarest of each window, stored as a table.  A
   posting of a window's rarest term keeps the ``width`` - 1 words on each side.
4. Intersection, from the rarest term on: a posting of the term at offset o
   of a window proposes the window's start at position - o; a start proposed
   by every probe of the window is a candidate.
5. Phrase check of each candidate: the kept neighbours against the window.

Postings are dealt by document and start, so a term that a third of all
documents hold is spread over all tasks.  ``ProximityIndex`` finds windows whose
terms stand near their places instead of exactly there: rarest terms propose,
all terms are looked for among the posting's neighbours.

DataFrame functions only.  What is broadcast is one row per benchmark term or
probe; above ``BROADCAST_ROWS`` rows these joins shuffle.

Edge cases: null texts have no words; an item without words has no window; a
null item_id reads "null" in lists; rows that share doc_id and text get the
same result; rows that share only doc_id are different documents; an empty
table on either side gives rows without hits, or none.  Columns of the input
beside doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

# Characters that part words: all of ASCII but digits and letters.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = "".join(chr(c) for r in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)) for c in range(*r))
PROBES = 2
BROADCAST_ROWS = 2_000_000
#: Identifies a document without nulls: a null id hashes unlike any other.
KEY = ["doc_key", "text_hash"]


def words(text: str = "text") -> Column:
    r"""Lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  One translation
    and a split at single blanks are a tenth of the regular expression's work."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER + _PARTS, _UPPER.lower() + " " * len(_PARTS))
    return F.array_remove(F.split(plain, " "), "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def windows(items: DataFrame, width: int) -> DataFrame:
    """(window, items): the distinct windows as word arrays, with the ids of
    the items that hold them."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words().alias("words"))
    n = F.size("words")
    w = w.filter(n > 0).select(
        "item", "words", F.explode(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).alias("at")
    )
    w = w.select("item", F.slice("words", F.col("at") + 1, width).alias("window"))
    return w.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _key() -> tuple[Column, Column]:
    return F.coalesce("doc_id", F.lit(0)), F.xxhash64(F.coalesce("text", F.lit("")), F.isnull("doc_id"))


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", *[c.alias(k) for k, c in zip(KEY, _key())], *more)


def tokens(docs: DataFrame) -> DataFrame:
    """(doc key, words, pos, term) of every word of every document."""
    held = keyed(docs, words().alias("words")).drop("doc_id")
    return held.select("*", F.posexplode("words").alias("pos", "term"))


class PhraseIndex:
    """Windows, probes and postings of a benchmark over a corpus."""

    def __init__(self, docs: DataFrame, items: DataFrame, width: int = 10):
        self.docs, self.width = docs.select("doc_id", "text"), width
        self.scratch = Scratch(docs.sparkSession, "phrases")
        raw = windows(items.select("item_id", "text"), width)
        self.windows = self.scratch.write(raw.withColumn("window_id", F.monotonically_increasing_id()), "windows")
        self.placed = self.windows.select(
            "window_id", F.size("window").alias("size"), F.posexplode("window").alias("offset", "term")
        )
        self.probes = self.scratch.write(self._probes(), "probes")
        self.n_probes = self.probes.count()
        self.postings = self.scratch.write(self._postings(), "postings")

    def frequencies(self) -> DataFrame:
        """Corpus counts of the benchmark's terms."""
        vocabulary = self.placed.select("term").distinct()
        vocabulary = _small(vocabulary, vocabulary.count())
        return tokens(self.docs).select("term").join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("tf"))

    def _probes(self) -> DataFrame:
        """(window_id, size, offset, term, rank): each window's rarest terms, rank 1
        the rarest.  A term twice in a window probes at both offsets."""
        known = self.placed.join(self.frequencies(), "term", "left")
        per = Window.partitionBy("window_id")
        known = known.withColumn("found", F.min(F.coalesce("tf", F.lit(0))).over(per)).filter("found > 0")
        rank = F.row_number().over(per.orderBy("tf", "term", "offset"))
        return known.withColumn("rank", rank).filter(F.col("rank") <= PROBES).drop("found")

    def _postings(self) -> DataFrame:
        terms = self.probes.groupBy("term").agg(F.min("rank").alias("least"))
        side = self.width - 1
        start = F.greatest(F.col("pos") - side, F.lit(0))
        near = F.slice("words", start + 1, F.col("pos") - start + side + 1)
        found = tokens(self.docs).join(_small(terms, self.n_probes), "term")
        return found.select(*KEY, "term", "pos", F.when(F.col("least") == 1, near).alias("near"))

    def starts(self, rank: int) -> DataFrame:
        """(doc key, window_id, start) proposed by each window's probe of one
        rank; of the first rank also the words from start on (``found``)."""
        probes = self.probes.filter(F.col("rank") == rank).select("window_id", "offset", "size", "term")
        hits = self.postings.join(_small(probes, self.n_probes), "term").filter("pos >= offset")
        start = (F.col("pos") - F.col("offset")).alias("start")
        # At least 1 wherever the filter holds; a planner may evaluate it first.
        place = F.greatest(F.least(F.col("pos"), F.lit(self.width - 1)) - F.col("offset") + 1, F.lit(1))
        found = [F.slice("near", place, F.col("size")).alias("found")] if rank == 1 else []
        return hits.select(*KEY, "window_id", start, *found)

    def candidates(self) -> DataFrame:
        """Starts that every probe of the window proposes."""
        per = self.probes.groupBy("window_id").agg(F.max("rank").alias("probes"))
        held = self.starts(1)
        for rank in range(2, PROBES + 1):
            single = _small(per.filter(F.col("probes") < rank).select("window_id"), self.n_probes)
            both = held.join(self.starts(rank), [*KEY, "window_id", "start"], "left_semi")
            held = both.unionByName(held.join(single, "window_id", "left_semi").select(*both.columns))
        return held

    def matches(self) -> DataFrame:
        """(doc key, matches) of every document with an exact match; a match is
        a (start, end, items), sorted by start."""
        window = _small(self.windows.select("window_id", "window", "items"), self.n_probes)
        exact = self.candidates().join(window, "window_id").filter("found = window")
        place = F.struct("start", (F.col("start") + F.size("window")).alias("end"), "items")
        return exact.groupBy(*KEY).agg(F.sort_array(F.collect_set(place)).alias("matches"))


class ProximityIndex(PhraseIndex):
    """Places where a window's terms stand near each other.

    A place of a window is a start such that each term occurs within ``slop``
    words of start + its offset; of a window of full width, ``missing`` terms
    need not.  The start is where one of the window's 1 + ``missing`` rarest
    terms (corpus count, then term, then offset) stands exactly: of so many,
    one is there.  It may lie before the text's first word.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, width: int = 10, slop: int = 2, missing: int = 1):
        if not 0 <= missing < width or slop < 0:
            raise ValueError("missing must be from 0 to width - 1, slop at least 0")
        self.slop, self.missing = slop, missing
        super().__init__(docs, items, width)

    def _spared(self, size: Column) -> Column:
        return F.when(size == self.width, F.lit(self.missing)).otherwise(0)

    def _probes(self) -> DataFrame:
        """(window_id, offset, term, needed, others): the terms that propose a
        place; how many of the window's have to be near; the other terms among
        the 2 + ``missing`` rarest, of which one has to be near if two are
        needed."""
        known = self.placed.join(self.frequencies(), "term", "left").fillna(0, ["tf"])
        per = Window.partitionBy("window_id")
        rank = F.row_number().over(per.orderBy("tf", "term", "offset"))
        spared = self._spared(F.col("size"))
        known = known.withColumn("rank", rank).filter(F.col("rank") <= 2 + spared)
        others = F.filter(F.collect_list(F.struct("offset", "term")).over(per), lambda o: o["offset"] != F.col("offset"))
        known = known.withColumn("others", others).filter((F.col("rank") <= 1 + spared) & (F.col("tf") > 0))
        return known.select("window_id", "offset", "term", (F.col("size") - spared).alias("needed"), "others")

    def _postings(self) -> DataFrame:
        """Postings with the words that a window's terms can stand among."""
        terms = self.probes.select("term").distinct()
        side = self.width - 1 + self.slop
        start = F.greatest(F.col("pos") - side, F.lit(0))
        near = F.slice("words", start + 1, F.col("pos") - start + side + 1)
        found = tokens(self.docs).join(_small(terms, self.n_probes), "term")
        return found.select(*KEY, "term", "pos", (F.col("pos") - start).alias("place"), near.alias("near"))

    def places(self) -> DataFrame:
        """(doc key, window_id, start, items), each place once."""
        window = _small(self.windows.select("window_id", "window", "items"), self.n_probes)
        hits = self.postings.join(_small(self.probes, self.n_probes), "term")
        first = F.col("place") - F.col("offset")

        def heard(term: Column, i: Column) -> Column:
            low = F.greatest(first + i - self.slop, F.lit(0))
            return F.array_contains(F.slice("near", low + 1, F.greatest(first + i + self.slop + 1 - low, F.lit(0))), term)

        two = (F.col("needed") < 2) | F.exists("others", lambda o: heard(o["term"], o["offset"]))
        n = F.size(F.filter(F.transform("window", heard), lambda x: x))
        enough = hits.filter(two).join(window, "window_id").filter(n >= F.col("needed"))
        found = enough.select(*KEY, "window_id", (F.col("pos") - F.col("offset")).alias("start"), "items")
        return found.dropDuplicates([*KEY, "window_id", "start"])


def covered(matches: Column) -> Column:
    """Words inside the union of sorted (start, end) spans."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, m: F.struct(
        F.greatest(a["end"], m["end"]).alias("end"),
        (a["n"] + F.greatest(m["end"] - F.greatest(a["end"], m["start"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(matches, begin, step, lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per document: doc_id, its key, n_words, n_hit (words inside
    any occurrence of a window), items (ids of the items with occurring
    windows, sorted), contaminated."""
    index = PhraseIndex(docs, items, width)
    found = index.matches().select(
        *KEY,
        covered(F.col("matches")).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.col("matches.items")))).alias("items"),
    )
    found = index.scratch.write(found, "found")
    index.scratch.drop("windows", "probes", "postings")
    every = keyed(docs, F.size(words()).cast("long").alias("n_words"))
    return every.join(found, KEY, "left").select(
        "doc_id",
        *KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    hit = contamination(docs, items, width).filter("contaminated")
    hit = hit.select(*[F.col(c).alias(f"__{c}") for c in KEY]).distinct()
    own, hashed = _key()
    kept = docs.join(hit, (own == F.col("__doc_key")) & (hashed == F.col("__text_hash")), "left_anti")
    return kept.select(*docs.columns)


def near_phrases(docs: DataFrame, items: DataFrame, width: int = 10, slop: int = 2, missing: int = 1) -> DataFrame:
    """One row per document: doc_id, its key, n_places (places of windows, see
    ``ProximityIndex``), items (ids of the items they belong to, sorted)."""
    index = ProximityIndex(docs, items, width, slop, missing)
    found = index.places().groupBy(*KEY).agg(
        F.count("*").alias("n_places"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    found = index.scratch.write(found, "near")
    index.scratch.drop("windows", "probes", "postings")
    return keyed(index.docs).join(found, KEY, "left").select(
        "doc_id",
        *KEY,
        F.coalesce("n_places", F.lit(0)).alias("n_places"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
