"""The corpus operators as registered queries over the given tables, with
DuckDB SQL where SQL expresses the result."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import katz_lm, merkle, oracle, permutation_index, quality, spelling, toxicity
from .common import table
from .decontamination import contamination, near_phrases
from .html_text import extract
from .jaccard_join import near_duplicates
from .license_scan import scan_licenses
from .mixture import mix_sources
from .substring_dedup import remove_repeats
from .token_counts import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def near_benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches of op3's index."""
    found = near_phrases(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_places",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation_index.search(vectors, F.col("vec_id") % 50 == 0)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, text=False)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.try_element_at("licenses", F.lit(1))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        best["template"].alias("best_template"),
        F.coalesce(best["score"], F.lit(0.0)).alias("best_score"),
        F.array_join("licenses.template", ",").alias("templates"),
    )


def op8_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz_lm.score(docs, toxicity.held_out("doc_id", 7, 2))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out("doc_id", 5, 0)
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~out))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out("doc_id", 5, 0)
    network = quality.fit(docs, table(spark, sf_dir, "labels").filter(~out))
    scored = quality.score(docs, network)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.corpus_words(docs))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "source", "lang", "n_chars", "text")
    docs = table(spark, sf_dir, "documents").select(*names)
    text = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        merkle.tree_of("source").alias("tree"),
        F.col("doc_id").alias("key"),
        merkle.leaf(*names).alias("digest"),
        F.when(tampered, merkle.leaf(*names[:-1], text)).alias("tampered"),
    )
    found = merkle.build(leaves).proofs("tampered")
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_mixture, op3_decontamination, near_benchmark_phrases, op4_permutation_index, op5_html_text, op6_substring_dedup, op7_license_scan, op8_katz_lm, op9_jaccard_join, op10_toxicity, op11_quality, op12_spelling_variants, op13_merkle_manifest)}
SQL = {"op2_mixture": oracle.MIXTURE, "op3_decontamination": oracle.DECONTAMINATION, "near_benchmark_phrases": oracle.NEAR_PHRASES, "op12_spelling_variants": oracle.SPELLING, "op13_merkle_manifest": oracle.MERKLE}
