"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "labels") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the component is
    its smallest node.  Each round takes every node's smallest neighbouring
    label, then jumps to that label's own label, so long chains halve; a round
    that changes nothing is the last.  Every round is a written table."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.write(both.distinct(), f"{name}-links")
    labels = scratch.write(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node"),
        f"{name}-0",
    )
    turn = 0
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "component", F.least("component", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        step = step.join(jump, "next", "left").select("node", "component", F.least("next", "far").alias("next"))
        turn += 1
        new = scratch.write(step, f"{name}-{turn}")
        changed = new.filter("next != component").limit(1).count()
        scratch.drop(f"{name}-{turn - 1}")
        labels = new.select("node", F.col("next").alias("component"))
        if not changed:
            scratch.drop(f"{name}-links")
            return labels
