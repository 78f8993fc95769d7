r"""Mixing sources to target weights.

Sizes are summed per source (partial sums before the shuffle, so a hot source
costs one row per task).  Targets share a total by weight; a target stops at
``cap`` times its source's size and the excess is shared again by weight until
none is above.  That fixed point needs no iteration: with the sources sorted
by cap/weight, the capped ones are a prefix, and the level of the rest is
(total - capped sizes) / (remaining weights).

A source's repetition rate is target / size.  Each document is emitted
floor(rate) times, plus once more if its draw, a hash of (seed, doc_id, text)
in [0, 1), is below the rate's fraction: reruns agree, and no executor loss
changes the mix.

DataFrame functions only.

Edge cases: a null text has size 0; a null source is a source of its own,
ranked last; a source of size 0 has target 0.  Repeated rows draw alike.  An
empty table gives an empty mix.  Input columns that clash with the added ones
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to which the plan (one row per source) is broadcast; a larger
#: plan is joined by a shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Uniform in [0, 1) from the first 32 bits of an MD5 sum."""
    key = F.concat_ws(
        ":",
        F.lit(seed),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        F.md5(F.coalesce(F.col(text), F.lit(""))),
    )
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mixing_plan(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.  Weights repeat
    over the sources in code-point order, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on: the windows run over the sources, not
    # over the documents.
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (nth + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("ceiling", F.lit(cap) * F.col("source_size"))
    rank = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    full = rank.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # What follows is the total less what precedes: a frame that ends with the
    # last row would be added up anew for every row.
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0))
    per = per.withColumn(
        "level",
        (
            F.lit(share) * F.sum("source_size").over(everything)
            - F.coalesce(F.sum("ceiling").over(full), F.lit(0.0))
        )
        / rest,
    )
    # The first source whose level stays within its ceiling sets the level.
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.struct("rank", "level")))
    per = per.withColumn("rank", F.row_number().over(rank))
    per = per.withColumn("settled", open_level.over(everything))
    capped = F.col("settled").isNull() | (F.col("rank") < F.col("settled.rank"))
    target = F.when(capped, F.col("ceiling")).otherwise(F.col("settled.level") * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target,
    copies (how often the mix emits the document) and taken (words taken)."""
    base = docs.withColumn("size", word_count())
    plan = mixing_plan(base.select("source", "size"), weights, share, cap)
    plan = plan.withColumnRenamed("source", "__source")
    # Both sides of the choice give the same rows; the count costs one pass
    # over the per-source sums.
    if base.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    base = base.drop("source_size", "target", "copies", "taken")
    joined = base.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + F.when(draw(seed) < rate - whole, 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    columns = [c for c in mixed.columns if c != "copy"]
    return mixed.select(*columns, F.explode(numbers).alias("copy"))
