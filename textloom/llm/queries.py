"""The queries of the corpus operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontamination, line_dedup, ngram_join, packing, quality_classifier, quality_rules, suffix_dedup, toxicity, url_filters, warc
from textloom.llm.common import small_batches
from textloom.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def held_out() -> Column:
    """True for documents whose labels no model may see."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels.filter(~held_out()))
    return toxicity.score(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op7_quality_rules", quality_rules.ORACLE)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules(_table(spark, sf_dir, "documents"))


URL_RULES = url_filters.decode_rules(block=["net/", "example.com/de/"], allow=["example.net/en/", "org/fr/"])


@query("op9_url_filters")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@query("op8_warc", warc.ORACLE)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(_table(spark, sf_dir, "pages"))
    return back.selectExpr("key AS page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ratio = quality_classifier.log_ratio(documents, labels.filter("quality = 1"))
    ranked, limit = quality_classifier.ranked(documents, ratio)
    return ranked.select(F.col("key").alias("doc_id"), "log_weight", "sampling_key", F.coalesce(F.col("sampling_key") >= limit, F.lit(False)).alias("kept"))


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
    )


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), with_gone="gone")
    return kept.select("doc_id", F.size("gone").cast("long").alias("n_removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"))
