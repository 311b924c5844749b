"""Retrieval queries over ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import ranking
from textloom.plans.base import query
from textloom.sources.tables import table

#: Fold and tokens in DuckDB.
FOLD = "trim(regexp_replace(strip_accents(lower({0})), '\\s+', ' ', 'g'))"
TOKENS = "list_distinct(regexp_extract_all(" + FOLD + ", '[a-z0-9]{{3,}}'))"
PHRASE = "thing ation the"


@query(
    "search_topk",
    f"""
    WITH q AS (SELECT d.doc_id, {FOLD.format('d.text')} AS f, {TOKENS.format('d.text')} AS t, coalesce(l.quality, 0) * 0.5 AS c
               FROM documents d LEFT JOIN labels l USING (doc_id)),
    s AS (SELECT doc_id, 10.0 * len(list_intersect(t, ['thing', 'ation', 'the'])) + CASE WHEN contains(f, '{PHRASE}') THEN 2 ELSE 0 END + c AS score FROM q)
    SELECT doc_id, round(CAST(score AS DOUBLE), 4) AS score FROM s WHERE score > 1 ORDER BY round(score, 4) DESC, doc_id LIMIT 20
    """,
    "K01 F01 F04",
)
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    pool = table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id", "left")
    return ranking.search(pool, "text", PHRASE, F.col("quality") * 0.5, "doc_id").select("doc_id", "score")
