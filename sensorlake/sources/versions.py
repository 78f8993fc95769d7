"""Tables of versioned parts with one atomic commit.

A table is a folder.  Its rows lie in parts, ``data/<key>=<part>/v=<id>`` (or
``data/v=<id>`` for a table without a partition key), which are written once
and never changed.  ``versions/<number>`` lists the parts of one version; the
highest number is the current one.  A writer adds new parts first and then
commits: one rename makes replaced, new and emptied parts visible together.  A
writer that dies before it leaves the table as it was, and parts that no
version lists; its successor uses other ids.

A reader resolves a version when it is made and goes on seeing it, whatever is
committed meanwhile; ``vacuum`` removes what the versions to keep do not list.
One writer at a time: a commit whose number exists already is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import fs

PART_ID = "v"


class CommitConflict(RuntimeError):
    """Another writer has committed the same version."""


@dataclass(frozen=True)
class Version:
    number: int  # 0: nothing committed
    parts: dict[str, str] = field(default_factory=dict)  # part value ("" without a key) -> id

    def paths(self, dest: str, key: str | None, only: list[str] | None = None) -> list[str]:
        names = sorted(self.parts if only is None else set(only) & set(self.parts))
        return [f"{dest}/data/{f'{key}={p}/' if key else ''}{PART_ID}={self.parts[p]}" for p in names]


def current(spark: SparkSession, dest: str) -> Version:
    numbers = [int(n) for n in fs.list_files(spark, f"{dest}/versions") if n.isdigit()]
    return at(spark, dest, max(numbers)) if numbers else Version(0)


def at(spark: SparkSession, dest: str, number: int) -> Version:
    return Version(number, json.loads(fs.read_text(spark, f"{dest}/versions/{number:012d}")))


def commit(spark: SparkSession, dest: str, seen: Version, parts: dict[str, str]) -> Version:
    """Make ``parts`` the version after ``seen``: the one visible step."""
    new = Version(seen.number + 1, parts)
    path = f"{dest}/versions/{new.number:012d}"
    if not fs.put_once(spark, path, json.dumps(parts, sort_keys=True)):
        raise CommitConflict(f"{path} exists: another writer has committed")
    return new


def read(spark: SparkSession, dest: str, key: str | None = None, version: Version | None = None, only: list[str] | None = None, schema=None) -> DataFrame | None:
    """The rows of a version (the current one by default); None if it has no
    parts.  ``only``: parts to read."""
    version = version or current(spark, dest)
    paths = version.paths(dest, key, only)
    if not paths:
        return None
    reader = spark.read.option("basePath", f"{dest}/data")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths).drop(PART_ID)


#: Spark's own Parquet reader of the second kind answers minima, maxima and
#: counts from the files' footers.
_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


@contextmanager
def from_footers(spark: SparkSession) -> Iterator[None]:
    """Tables read and asked within get their aggregates from footers."""
    before = {k: spark.conf.get(k, None) for k in _FOOTERS}
    try:
        for k, v in _FOOTERS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest(spark: SparkSession, dest: str, key: str | None, version: Version, column: str, only: list[str] | None = None):
    """The largest value of a column in the version's parts (or ``only`` some),
    from footers: no data page is read.  None without parts."""
    with from_footers(spark):
        rows = read(spark, dest, key, version, only)
        return None if rows is None else rows.agg(F.max(column)).first()[0]


def write(rows: DataFrame, dest: str, key: str | None = None, sort: tuple[str, ...] = ()) -> tuple[dict[str, str], int]:
    """Add ``rows`` as parts that no version lists yet; returns them and the
    number of rows.

    Rows are rebalanced by the key without sampling them first: a large part
    is split over many writers, small ones share a task.
    """
    spark, new = rows.sparkSession, uuid.uuid4().hex[:16]
    watch = Observation(f"parts_{new}")
    watched = [F.count(F.lit(1)).alias("rows")]
    if key:
        watched += [F.collect_set(key).alias("parts"), F.count_if(F.col(key).isNull()).alias("without")]
    rows = rows.observe(watch, *watched)
    if key:
        rows = rows.hint("rebalance", key)
    rows = rows.withColumn(PART_ID, F.lit(new))
    by = [*([key] if key else []), PART_ID]
    if sort:
        rows = rows.sortWithinPartitions(*by, *sort)
    rows.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(f"{dest}/data")
    got = _observed(watch)
    present = set(got.get("parts", [])) if key else {""}
    written = [d for d in fs.list_dirs(spark, f"{dest}/data") if key and fs.exists(spark, f"{dest}/data/{d}/{PART_ID}={new}")]
    if key and len(written) != len(present) + bool(got.get("without")):
        raise RuntimeError(f"{dest}: {len(written)} parts written, {len(present)} observed")
    if got.get("without"):
        raise ValueError(f"{got['without']} rows without {key}")
    if not key and not got.get("rows"):
        # An empty table is a part without rows: its columns are kept.
        rows.limit(0).drop(PART_ID).write.mode("overwrite").parquet(f"{dest}/data/{PART_ID}={new}")
    return {p: new for p in present}, int(got.get("rows", 0))


def replace(rows: DataFrame, dest: str, key: str | None = None, planned: list[str] | None = None, sort: tuple[str, ...] = ()) -> tuple[Version, int]:
    """Replace parts of the table by ``rows``, and return the new version and
    the rows written.  ``planned``: the parts that are replaced (by default the
    whole table); one without rows goes.  Rows outside of them are an error."""
    seen = current(rows.sparkSession, dest)
    parts, n = write(rows, dest, key, sort)
    if planned is not None and not parts.keys() <= set(planned):
        raise ValueError(f"rows of parts that are not replaced: {sorted(parts.keys() - set(planned))}")
    kept = {} if planned is None else {p: v for p, v in seen.parts.items() if p not in planned}
    return commit(rows.sparkSession, dest, seen, kept | parts), n


def _observed(watch: Observation) -> dict:
    """What a write has observed.  Spark observes nothing where it knows
    beforehand that there are no rows."""
    try:
        return watch.get
    except Py4JJavaError:
        return {}


def vacuum(spark: SparkSession, dest: str, key: str | None = None, keep: int = 2) -> int:
    """Delete parts that none of the last ``keep`` versions lists, and earlier
    versions.  Returns the number of parts deleted.  Not beside a writer: it
    would take the parts of an open commit for leftovers."""
    numbers = sorted(int(n) for n in fs.list_files(spark, f"{dest}/versions") if n.isdigit())
    kept = {p for n in numbers[-keep:] for p in at(spark, dest, n).paths(dest, key)}
    for n in numbers[:-keep]:
        fs.delete(spark, f"{dest}/versions/{n:012d}")
    parts = [f"{dest}/data/{d}" for d in fs.list_dirs(spark, f"{dest}/data")]
    if key:
        parts = [f"{p}/{d}" for p in parts for d in fs.list_dirs(spark, p)]
    gone = [p for p in parts if f"{PART_ID}=" in p and p not in kept]
    for p in gone:
        fs.delete(spark, p)
    return len(gone)
