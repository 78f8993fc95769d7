"""Incremental month replacement from a landing folder (S1, S10 as a stream).

An export is one unit: its rows lie under ``data/export=<number>/month=...``
and, once they are complete, one manifest row per covered month is added under
``manifests``.  The stream reads manifests only, so a half-written export is
invisible.  Every micro-batch takes the months its manifests name and rebuilds
each from the newest export that covers it, whichever export the batch itself
named: months split over files or batches, several exports at once, replays
and restarts all end in the same table.  A covered month without rows is
withdrawn.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import fs, versions
from ..sources.refresh import PARTITION

MANIFEST = "export long, month string"


def rebuild_months(spark: SparkSession, landing_dir: str, dest: str, months: list[str]) -> None:
    """Replace months of ``dest`` by their newest complete exports, all in one
    commit."""
    manifests = spark.read.schema(MANIFEST).parquet(f"{landing_dir}/manifests")
    newest = manifests.filter(F.col(PARTITION).isin(months)).groupBy(PARTITION).agg(F.max("export").alias("export"))
    plan = newest.collect()  # a row per month
    stored = {r[PARTITION]: f"{landing_dir}/data/export={r['export']}/{PARTITION}={r[PARTITION]}" for r in plan}
    present = {m: p for m, p in stored.items() if fs.exists(spark, p)}
    parts = [spark.read.parquet(p).withColumn(PARTITION, F.lit(m)) for m, p in sorted(present.items())]
    if parts:
        versions.replace(reduce(DataFrame.unionByName, parts), dest, PARTITION, sorted(stored))
    elif stored:
        seen = versions.current(spark, dest)
        versions.commit(spark, dest, seen, {p: v for p, v in seen.parts.items() if p not in stored})


def replace_months(landing_dir: str, dest: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over manifest rows."""

    def apply(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001 (idempotent)
        months = [r[0] for r in batch.select(PARTITION).distinct().collect()]
        if months:
            rebuild_months(batch.sparkSession, landing_dir, dest, months)

    return apply


def start_landing_ingest(
    spark: SparkSession, landing_dir: str, dest: str, checkpoint_location: str, available_now: bool = True
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed
    and stops (``query.awaitTermination()``), otherwise it polls every minute.
    ``checkpoint_location`` is the stream's own folder in shared storage."""
    manifests = spark.readStream.schema(MANIFEST).parquet(f"{landing_dir}/manifests")
    writer = manifests.writeStream.foreachBatch(replace_months(landing_dir, dest))
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def land_months(df: DataFrame, landing_dir: str, withdrawn: tuple[str, ...] = ()) -> int:
    """Land one export, as an upstream exporter would: the months of ``df``,
    complete, and months ``withdrawn`` of all their rows.  Rows need a date.
    Returns the export's number."""
    spark = df.sparkSession
    data = f"{landing_dir}/data"
    number = 1 + max([int(d.split("=")[1]) for d in fs.list_dirs(spark, data) if d.startswith("export=")], default=0)
    dated = F.coalesce(F.date_format("sensing_date", "yyyy_MM"), F.raise_error(F.lit("a row without sensing_date")))
    target = f"{data}/export={number}"
    df.withColumn(PARTITION, dated).hint("rebalance", PARTITION).write.partitionBy(PARTITION).parquet(target)
    months = [d.split("=")[1] for d in fs.list_dirs(spark, target) if d.startswith(f"{PARTITION}=")]
    rows = [(number, m) for m in sorted({*months, *withdrawn})]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{landing_dir}/manifests")
    return number
