"""The corpus pipeline: documents in, training mixture out.

Each stage applies one corpus operator to all rows of its predecessor's
table, is written as Parquet and reread.  All but the last return the columns
of ``documents``; the last returns a row for every copy of a document that the
mixture takes, numbered by ``copy``.

No SQL expresses the first stages (a fitted classifier, similarity classes),
so the whole is tested stage by stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import decontamination, jaccard_join, mixture, substring_dedup, toxicity
from sensorlake.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.  It learns from
    the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id", 5, 0))
    machine = toxicity.fit(docs, labels)
    return toxicity.score(docs, machine).filter("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that earlier documents hold in runs of
    50; texts that lose words become their remaining words."""
    cut = substring_dedup.remove_repeats(docs)
    length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixture.emit(mixture.mix_sources(docs)).select(*docs.columns, "copy")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixture", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.release()
        if number:
            scratch.drop(STAGES[number - 1][0])
    return docs
