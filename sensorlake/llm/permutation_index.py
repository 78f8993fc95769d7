r"""Nearest neighbours by a permutation index.

Every vector is represented by its ``NEAREST`` nearest of ``PIVOTS`` pivots,
in order of nearness.  The distinct vectors are dealt into shards of about
``SHARD``; a shard keeps one inverted file per pivot, holding the vectors that
list the pivot and its rank.  A query walks the files of its own pivots and
adds up, for each vector it meets, the part of Spearman's footrule distance
that shared pivots save (a pivot on ranks i and j of the two lists saves
2 (NEAREST - max(i, j))).  The ``SHARE`` of the shard's vectors with the least
footrule (at least ``LEAST``) are reranked by their cosine, computed in double
precision from the original vectors; the best ``k`` of all shards are the
result, ties to the smaller id.

Pivots are the only fitted part: out of the ``SAMPLE`` first distinct vectors
by a hash of their smallest vec_id.  Queries go to the shards in blocks of
``QUERY_BLOCK``.  A vector that many rows share is one entry with the ``k + 1``
smallest of their ids: equal scores go to the smaller id and a query skips its
own, so no other id of that vector can be in a result.  The ids are cut to
``k + 1`` before the shuffle by vector, and copies take no part of the share.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without a vec_id or vectors of another
length than the most common one (the longer of equally common ones).  Rows
equal in vec_id and vector are one row; a query skips all rows with its own
vec_id.  With fewer than ``k`` candidates all are returned; an empty table
gives an empty result.  Columns beside vec_id and embedding are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship

PIVOTS = 128
NEAREST = 32
SHARD = 8192
SHARE = 0.45
LEAST = 512
SAMPLE = 4096
QUERY_BLOCK = 2048


def valid(embedding: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(
        (F.size(embedding) > 0) & ~F.exists(embedding, bad) & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("embedding") == (length["d"] if length else 0))
    return rows.dropDuplicates(["vec_id", "embedding"])


def matrix(embeddings) -> np.ndarray:
    """Rows scaled by powers of two, which leaves every cosine as it is and
    keeps squares in range."""
    x = np.array([np.asarray(e, np.float64) for e in embeddings])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of each row's nearest pivots, nearest first."""
    near = (x / norms(x)[:, None]) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, : min(NEAREST, len(pivots))]


def pivots_of(rows: DataFrame) -> np.ndarray:
    """Unit vectors of the pivots, from a sample of SAMPLE vectors."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE).select("embedding").collect()
    distinct = list(dict.fromkeys(tuple(r[0]) for r in sample))[:PIVOTS]
    x = matrix(distinct)
    return x / norms(x)[:, None]


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(embedding, vec_id, ids): the distinct vectors with the ``ids`` smallest
    of their ids, ascending; vec_id is the first."""
    least = Window.partitionBy("embedding").orderBy("vec_id")
    held = rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= ids)
    held = held.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return held.select("embedding", F.col("ids")[0].alias("vec_id"), "ids")


def build(rows: DataFrame, pivots: np.ndarray, shards: int) -> DataFrame:
    """The index, one row per shard: its vectors (by smallest id), their ids
    end to end and how many each has, and the pivots' inverted files end to
    end (rows, ranks, ends)."""
    schema = "shard int, ids binary, copies binary, vectors binary, rows binary, ranks binary, ends binary"

    def shard(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        x = matrix(part["embedding"])
        nearest = permutations(x, pivots)
        row = np.repeat(np.arange(len(x), dtype=np.int32), nearest.shape[1])
        rank = np.tile(np.arange(nearest.shape[1], dtype=np.int16), len(x))
        order = np.argsort(nearest.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(nearest.ravel(), minlength=len(pivots)))
        ids, copies = np.concatenate(part["ids"].to_list()).astype(np.int64), part["ids"].map(len).to_numpy(np.int64)
        arrays = (ids, copies, x, row[order], rank[order], ends.astype(np.int64))
        return pd.DataFrame([(key[0], *(a.tobytes() for a in arrays))], columns=[c.split()[0] for c in schema.split(", ")])

    place = F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard")
    return rows.select("vec_id", "ids", "embedding", place).groupBy("shard").applyInPandas(shard, schema)


class Shard:
    """One shard of the index, as ``build`` stored it."""

    def __init__(self, stored: pd.Series, dims: int):
        copies = np.frombuffer(stored["copies"], np.int64)
        self.ids = np.split(np.frombuffer(stored["ids"], np.int64), np.cumsum(copies)[:-1])
        self.first = np.array([i[0] for i in self.ids])
        self.x = np.frombuffer(stored["vectors"], np.float64).reshape(-1, dims)
        self.norm = norms(self.x)
        ends = np.frombuffer(stored["ends"], np.int64)
        self.rows = np.split(np.frombuffer(stored["rows"], np.int32), ends[:-1])
        self.ranks = np.split(np.frombuffer(stored["ranks"], np.int16), ends[:-1])

    def nearest(self, vec_id: int, x: np.ndarray, norm: float, pivots: np.ndarray, k: int) -> list[tuple[int, float]]:
        saved = np.zeros(len(self.ids), np.int16)
        n = len(pivots)
        for rank, pivot in enumerate(pivots):
            saved[self.rows[pivot]] += n - np.maximum(self.ranks[pivot], rank)
        wanted = max(LEAST, math.ceil(SHARE * len(self.ids)))
        # Vectors are in order of id, so equal footrules go to the smaller ids.
        held = np.argsort(-saved, kind="stable")
        # A vector of the query's id alone is no candidate.
        own = np.array([i for i in np.flatnonzero(self.first == vec_id) if len(self.ids[i]) == 1], np.int64)
        held = held[~np.isin(held, own)][:wanted]
        if not len(held):
            return []
        # Row by row, so that equal vectors get equal scores.
        score = (self.x[held] * x).sum(axis=1) / (self.norm[held] * norm)
        # Those that can be among the best k: a vector has an id at least, but
        # vectors of one id and score count once.
        found: set[tuple[float, int]] = set()
        for s in np.unique(score)[::-1]:
            if len(found) >= k:
                break
            found |= {(-float(s), int(i)) for h in held[score == s] for i in self.ids[h] if i != vec_id}
        return [(i, -s) for s, i in sorted(found)[:k]]


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row for
    which ``is_query`` holds."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "permutations")
    rows = scratch.write(clean(vectors), "rows")
    vectors = scratch.write(distinct_vectors(rows, k + 1), "vectors")
    total = vectors.count()
    pivots = pivots_of(vectors) if total else np.zeros((0, 0))
    dims = pivots.shape[1]
    shards = max(1, math.ceil(total / SHARD))
    index = scratch.write(build(vectors, pivots, shards), "index") if total else None
    schema = "query_id long, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    queries = rows.filter(is_query)
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    sent = queries.select("vec_id", "embedding", block, every)
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def look(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            shard, x = Shard(held.iloc[0], dims), matrix(asked["embedding"])
            for vec_id, v, norm, order in zip(asked["vec_id"], x, norms(x), permutations(x, pivots)):
                out += [(vec_id, i, s) for i, s in shard.nearest(vec_id, v, norm, order, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["shard", "block"]
    found = sent.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInPandas(look, schema).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    out = scratch.write(ranked.select("query_id", "rank", "vec_id", "score"), "found")
    scratch.drop("rows", "vectors", "index")
    return out
