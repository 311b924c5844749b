"""From raw documents to packed training sequences: five stages, each by one corpus operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. Each stage's output is
written as Parquet and read again as the next one's input, so a lost executor costs its tasks and no stage is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontamination, line_dedup, ngram_join, packing, quality_classifier
from textloom.llm.common import Scratch, small_batches
from textloom.llm.queries import tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the nine tenths that look most like the labelled good documents; texts without words go."""
    small_batches(spark)
    return quality_classifier.sample(docs, _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete aligned common blocks from later documents; documents that lose all their text go."""
    small_batches(spark)
    kept = line_dedup.dedup(docs, drop_emptied=True)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in kept.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    small_batches(spark)
    return ngram_join.firsts(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of the benchmark, or a shorter item whole, go."""
    small_batches(spark)
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenisation, patience diff and local search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; a stage's tables go once its result is written."""
    docs = _table(spark, sf_dir, "documents")
    with Scratch() as tables:
        for name, stage in STAGES[:-1]:
            docs = tables.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
