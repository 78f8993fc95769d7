"""Deduplication and marts that follow a refresh month by month.

The store is one versioned table (``sources.versions``) whose parts are, per
month,

* ``candidates``: the best row of every id within the month;
* ``staged``: the candidates whose id has none in an earlier month.  As the
  order of ``stage_counts`` begins with the date, these months together are
  ``stg_counts``;
* ``daily``: the daily totals per location of the staged rows.

A refresh of some months deduplicates their rows alone.  Only ids that a month
gained or lost (``touched``) can change which row of an id is kept: they are
looked up once in the other months' candidates, by a literal id range that
prunes files and row groups.  A withdrawn row brings back the runner-up, a new
one displaces a later one.  Months that hold a touched id are rebuilt with the
replaced ones; the others' staged rows are not read.  In a month that was not
replaced, the staged rows of all other ids stay as they are.  A refresh that
replaces every stored month has nothing to look up: its candidates alone say
which row is first.  All parts of a refresh become visible in one commit.

Marts merge the stored parts: bounds and daily totals come from ``daily``, the
profile reads the staged months of its window.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import marts, staging
from ..operators.staging import COUNTS_ORDER, keep_first
from ..sources import fs, versions
from ..sources.versions import Version
from .warehouse import Warehouse

PART = "part"
#: More changed ids than this are hashed over the tasks, not sorted.
MANY = 1_000_000
CANDIDATES, STAGED, DAILY = "candidates", "staged", "daily"
ID = "observation_id"


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy_MM")


def months_of(version: Version, kind: str) -> set[str]:
    return {m for k, _, m in (p.partition(".") for p in version.parts) if k == kind}


def read(spark: SparkSession, root: str, kind: str, version: Version, months: set[str] | None = None) -> DataFrame | None:
    """The stored rows of a kind, of all or of some months."""
    stored = months_of(version, kind)
    only = [f"{kind}.{m}" for m in (stored if months is None else stored & months)]
    rows = versions.read(spark, root, PART, version, only)
    return None if rows is None else rows.drop(PART)


def _write(rows: DataFrame, root: str, kind: str, sort: tuple[str, ...]) -> dict[str, str]:
    named = rows.withColumn(PART, F.concat(F.lit(f"{kind}."), month_of(F.col("sensing_date"))))
    return versions.write(named, root, PART, sort)[0]


def _ids(rows: DataFrame | None, spark: SparkSession) -> DataFrame:
    if rows is None:
        return spark.createDataFrame([], f"{ID} long, month string")
    return rows.select(ID, month_of(F.col("sensing_date")).alias("month"))


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    on = a[columns[0]].eqNullSafe(b[columns[0]])
    for c in columns[1:]:
        on &= a[c] == b[c]
    return on


def _first_month(candidates: DataFrame) -> DataFrame:
    """The candidate of each id's first month.  An id has at most one a month,
    so that no id is large here."""
    month = month_of(F.col("sensing_date"))
    first = F.min(month).over(Window.partitionBy(ID))
    return candidates.withColumn("_first", first).filter(month == F.col("_first")).drop("_first")


def _changes(spark: SparkSession, root: str, seen: Version, new: Version, replaced: set[str], scratch: str) -> tuple[list[DataFrame], set[str]]:
    """The staged rows of the months to rebuild, and these months."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    now = read(spark, root, CANDIDATES, new, replaced)
    before = _ids(read(spark, root, CANDIDATES, seen, replaced), spark)
    after = _ids(now, spark)
    both = before.withColumn("was", F.lit(1)).unionByName(after.withColumn("was", F.lit(0)))
    changed = both.groupBy(ID, "month").agg(F.count("*").alias("times")).filter("times = 1")
    touched = kept(changed.select(ID).distinct(), "touched")
    # The candidates of touched ids, wherever they stand.
    others = months_of(new, CANDIDATES) - replaced
    low, high, any_null, n = touched.agg(F.min(ID), F.max(ID), F.count_if(F.col(ID).isNull()) > 0, F.count("*")).first()

    def of_touched(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(touched.hint("shuffle_hash") if n > MANY else touched, _same(rows, touched, ID), how)

    places, moved = [] if now is None else [of_touched(now, "left_semi")], set()
    if others and (low is not None or any_null):
        near = F.col(ID).between(low, high) if low is not None else F.lit(False)
        history = read(spark, root, CANDIDATES, new, others).filter(near | F.col(ID).isNull() if any_null else near)
        elsewhere = kept(of_touched(history, "left_semi"), "elsewhere")
        moved = {r[0] for r in elsewhere.select(month_of(F.col("sensing_date"))).distinct().collect()}
        places.append(elsewhere)
    parts = [_first_month(reduce(DataFrame.unionByName, places))] if places else []
    # Other ids: a replaced month may hold corrected rows, the others stay.
    stood = read(spark, root, STAGED, seen, replaced)
    if now is not None and stood is not None:
        rows = now.withColumn("month", month_of(F.col("sensing_date")))
        ids = of_touched(_ids(stood, spark), "left_anti")
        parts.append(rows.join(ids, _same(rows, ids, ID, "month"), "left_semi").drop("month"))
    standing = read(spark, root, STAGED, seen, moved)
    if standing is not None:
        parts.append(of_touched(standing, "left_anti"))
    return parts, replaced | moved


def refresh(spark: SparkSession, raw: DataFrame, months: list[str], root: str) -> set[str]:
    """Bring the store up to date after ``months`` were replaced; ``raw`` holds
    all their rows.  Returns the months that were rebuilt."""
    seen = versions.current(spark, root)
    replaced = set(months)
    typed = staging.typed_counts(raw)
    typed = typed.filter(month_of(F.col("sensing_date")).isin(sorted(replaced)))
    best = keep_first(
        typed.withColumn("month", month_of(F.col("sensing_date"))), [ID, "month"], [F.asc_nulls_last(c) for c in COUNTS_ORDER]
    )
    written = _write(best.drop("month"), root, CANDIDATES, (ID,))
    gone = {f"{CANDIDATES}.{m}" for m in replaced}
    new = Version(seen.number, {p: v for p, v in seen.parts.items() if p not in gone} | written)

    scratch = fs.scratch_dir(spark, "incremental")
    if months_of(new, CANDIDATES) <= replaced:
        stay, rebuilt = [_first_month(read(spark, root, CANDIDATES, new))] if written else [], replaced
    else:
        stay, rebuilt = _changes(spark, root, seen, new, replaced, scratch)
    staged = _write(reduce(DataFrame.unionByName, stay), root, STAGED, ("sensing_date", ID)) if stay else {}
    gone |= {f"{kind}.{m}" for m in rebuilt for kind in (STAGED, DAILY)}
    final = {p: v for p, v in seen.parts.items() if p not in gone} | written | staged
    fresh = read(spark, root, STAGED, Version(seen.number, staged))
    if fresh is not None:
        final |= _write(marts.daily_totals(marts.hourly_fact(fresh)), root, DAILY, ("sensing_date", "location_id"))
    versions.commit(spark, root, seen, final)
    fs.delete(spark, scratch)
    return rebuilt


def last_date(spark: SparkSession, root: str, version: Version) -> dt.date | None:
    """The latest stored date, from the footers of the newest month (A3)."""
    stored = sorted(months_of(version, STAGED))[-1:]
    return versions.largest(spark, root, PART, version, "sensing_date", [f"{STAGED}.{m}" for m in stored])


def warehouse(spark: SparkSession, root: str, raw_sensors: DataFrame, profile_days: int = 90) -> Warehouse:
    """The models over the store's current version: every reader sees the same
    one.  Bounds and daily totals merge the months' stored totals, the profile
    reads the months of its window."""
    version = versions.current(spark, root)
    staged = read(spark, root, STAGED, version)
    if staged is None:
        raise ValueError(f"nothing stored at {root}")
    daily = read(spark, root, DAILY, version)
    last = last_date(spark, root, version)
    stg_s = staging.stage_sensors(raw_sensors)
    dim = marts.sensor_dim(stg_s, daily)
    since = (last - dt.timedelta(days=profile_days)).strftime("%Y_%m")
    window = read(spark, root, STAGED, version, {m for m in months_of(version, STAGED) if m >= since})
    return Warehouse(
        stg_counts=staged,
        stg_sensors=stg_s,
        fct_hourly_counts=marts.hourly_fact(staged),
        dim_sensors=dim,
        mart_daily_location=marts.named_daily(daily, dim),
        mart_hourly_profile=marts.hourly_profile(marts.hourly_fact(window), dim, profile_days, F.lit(last)),
    )
