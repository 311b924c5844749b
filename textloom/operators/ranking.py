"""Scoring, top-k and capped or diverse selection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources.shared import written


def search(pool: DataFrame, text: str, query: str, confidence: Column, key: str, limit: int = 20) -> DataFrame:
    """Ranked retrieval: 10 per query token found, 2 for the whole phrase, plus the confidence.

    Rows whose score isn't above 1 go; order is by score at four decimals, then key. The plan is one
    projection and a TakeOrderedAndProject, so no row but the best ``limit`` of each partition moves.
    """
    # Whether a token is among the text's tokens is asked of the folded text, without making all tokens of it.
    words = set(re.findall("[a-z0-9]{3,}", _plain(query)))
    hits = sum((F.col("_folded").rlike(f"(?<![a-z0-9]){w}(?![a-z0-9])").cast("int") for w in sorted(words)), F.lit(0))
    phrase = F.when(F.contains("_folded", F.lit(" ".join(_plain(query).split()))), 2).otherwise(0)
    scored = pool.withColumn("_folded", T.fold(F.col(text))).withColumn("score", F.round(hits * 10.0 + phrase + F.coalesce(confidence, F.lit(0.0)), 4)).drop("_folded")
    # Rows of a low score come last, so the filter can wait until after the limit: before it, the score would be computed twice.
    return scored.orderBy(F.desc("score"), key).limit(limit).filter("score > 1")


def _plain(query: str) -> str:
    return query.lower().translate(str.maketrans(T.ACCENTED, T.BASE))


def numbered(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """``name``: each row's number from 1 in the order of its ``by``. A group of any size is many tasks: rows are dealt by ranges, written, numbered within each
    range, and raised by how many rows of the group stand in the ranges before.
    """
    dealt = rows.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id())
    dealt = written(dealt, "numbered")
    counts = dealt.groupBy("_part", by).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n").withColumnRenamed(by, "_by")
    own = dealt.withColumn("_own", F.row_number().over(Window.partitionBy("_part", by).orderBy(*order)))
    joined = own.join(F.broadcast(counts.withColumnRenamed("_part", "_at")), (F.col("_part") == F.col("_at")) & F.col(by).eqNullSafe(F.col("_by")))  # a row per range and group
    return joined.select(*rows.columns, (F.col("_own") + F.col("_before")).alias(name))


def capped(pool: DataFrame, group: str, order: list[Column], cap: int, target: int) -> DataFrame:
    """Best ``target`` rows with at most ``cap`` of a group; if too few, the rest is filled regardless of the cap.

    The best ``target`` rows beyond the cap are within the first ``cap + target`` of their group, so a WindowGroupLimit
    keeps no more of a group before the shuffle.
    """
    ranked = pool.withColumn("in_group", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("in_group") <= cap + target)
    first = ranked.filter(F.col("in_group") <= cap).orderBy(*order).limit(target).withColumn("pass", F.lit(1))
    rest = ranked.filter(F.col("in_group") > cap).orderBy(*order).limit(target).withColumn("pass", F.lit(2))
    return first.unionByName(rest).orderBy("pass", *order).limit(target)
