"""Helpers shared by the corpus operators: scratch tables, row keys, word ids."""

from __future__ import annotations

import gc

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code as ship  # noqa: F401  (for the operators)
from ..sources.fs import delete, scratch_dir

#: Doc ids that are null sort after every other id.
NULL_ID_ORDER = 2**63 - 1


class Scratch:
    """Intermediate tables in the shared scratch folder.  ``write`` cuts the
    lineage; ``drop`` removes a table that nothing reads any more."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.root = spark, scratch_dir(spark, prefix)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.read(name, df.schema)

    def read(self, name: str, schema=None) -> DataFrame:
        r = self.spark.read
        return (r.schema(schema) if schema is not None else r).parquet(f"{self.root}/{name}")

    def release(self) -> None:
        """Let Spark remove the shuffle files of plans that are done: it does
        so once the driver has collected the plans' objects."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for n in names:
            delete(self.spark, f"{self.root}/{n}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(text: str = "text") -> Column:
    """Tells apart rows that share a doc_id: a row's key is (doc_id, text_hash).
    Rows equal in both are the same document and get the same result."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def ascii_words(text: str | None, lower: bool = False) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text as UTF-8; ``lower`` lower-cases
    A-Z first.  ``bytes.split``/``bytes.lower`` know exactly these characters."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_ids(words: list[bytes]) -> np.ndarray:
    """64-bit ids of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_ids(ids: np.ndarray, n: int) -> np.ndarray:
    """64-bit ids of the n-grams of a sequence of word ids, in order."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for j in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - n + 1 + j])
    return out
