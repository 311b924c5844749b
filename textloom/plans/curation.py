"""Reference resolution, ownership, coverage, compaction and reuse of finished work."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.plans.base import query
from textloom.sources.tables import table


@query("resolved_ranges", """
WITH r AS (SELECT conv_id, max(turn) + 1 AS a, greatest(max(turn) - 2, 0) AS b FROM conversations GROUP BY conv_id), e AS (SELECT conv_id, unnest(range(a, b - 1, -1)) AS turn FROM r)
SELECT e.conv_id, e.turn, coalesce(c.role, 'missing') AS role FROM e LEFT JOIN conversations c ON c.conv_id = e.conv_id AND c.turn = e.turn
""", "S11")
def resolved_ranges(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    ranges = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("a"), F.greatest(F.max("turn") - 2, F.lit(0)).alias("b"))
    listed = ranges.select("conv_id", F.explode(F.sequence("a", "b")).alias("turn"))  # counts down where a > b
    return listed.join(turns, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("role", F.lit("missing")).alias("role"))


@query("shard_owner", """
WITH c AS (SELECT event_id, event_id // 500 AS shard FROM events WHERE value > 5 UNION ALL SELECT event_id, event_id // 500 - 1 FROM events WHERE value > 5 AND event_id % 500 < 20 AND event_id >= 500),
k AS (SELECT user_id, event_type, min(event_id) AS anchor FROM events GROUP BY 1, 2)
SELECT user_id, event_type, anchor, CASE WHEN count(shard) = 1 THEN min(shard) END AS shard, CASE count(shard) WHEN 0 THEN 'none' WHEN 1 THEN 'owned' ELSE 'many' END AS status FROM k LEFT JOIN c ON c.event_id = anchor GROUP BY 1, 2, 3
""", "J10")
def shard_owner(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    own = F.floor(F.col("event_id") / 500).cast("long")
    shared = (F.col("event_id") % 500 < 20) & (F.col("event_id") >= 500)
    cores = events.filter("value > 5").select(F.col("event_id").alias("anchor"), F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))).alias("shard"))
    candidates = events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("anchor"))
    owned = candidates.join(cores, "anchor", "left").groupBy("user_id", "event_type", "anchor").agg(F.count("shard").alias("n"), F.min("shard").alias("least"))
    status = F.when(F.col("n") == 0, "none").when(F.col("n") == 1, "owned").otherwise("many")
    return owned.select("user_id", "event_type", "anchor", F.when(F.col("n") == 1, F.col("least")).alias("shard"), status.alias("status"))


@query("calibration_coverage", """
WITH t AS (SELECT source, doc_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1),
c AS (SELECT DISTINCT doc_id, lang FROM documents JOIN labels USING (doc_id) WHERE quality = 1 OR n_chars > 1000)
SELECT source, count(*) AS n_targets, count(c.doc_id) AS n_covered, coalesce(array_to_string(list_sort(list_distinct(list(c.lang) FILTER (c.lang IS NOT NULL))), ','), '') AS candidates, count(*) = count(c.doc_id) AS passed FROM t LEFT JOIN c USING (doc_id) GROUP BY source
""", "J13")
def calibration_coverage(spark, sf_dir):
    judged = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    candidates = judged.filter("quality = 1 OR n_chars > 1000").select("doc_id", "lang").distinct().withColumn("hit", F.lit(1))
    met = judged.filter("toxic = 1").select("doc_id", "source").join(candidates, "doc_id", "left")
    grouped = met.groupBy("source").agg(F.count(F.lit(1)).alias("n_targets"), F.count("hit").alias("n_covered"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("candidates"))
    return grouped.withColumn("passed", F.col("n_targets") == F.col("n_covered"))


@query("default_elision", """
WITH x AS (SELECT d.doc_id, lang || '/' || coalesce(CAST(quality AS VARCHAR), 'none') AS reason FROM documents d LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 0) = 0),
n AS (SELECT reason, count(*) AS n, min(doc_id) AS first FROM x GROUP BY 1), o AS (SELECT reason FROM n ORDER BY n DESC, reason LIMIT 1), i AS (SELECT reason, row_number() OVER (ORDER BY first, reason) - 1 AS reason_index FROM n WHERE reason NOT IN (SELECT reason FROM o))
SELECT doc_id, reason, reason_index FROM x JOIN i USING (reason)
""", "S12")
def default_elision(spark, sf_dir):
    """Rows that are not implied: neither captured (quality 1) nor of the most frequent reason; reasons are numbered as first seen.

    Reasons are a language and a label value, so their dictionary is small whatever the number of documents.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    reason = F.concat_ws("/", "lang", F.coalesce(F.col("quality").cast("string"), F.lit("none")))
    rows = docs.filter(F.coalesce("quality", F.lit(0)) == 0).select("doc_id", reason.alias("reason"))
    counts = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    default = counts.orderBy(F.desc("n"), "reason").limit(1).select("reason")
    numbers = counts.join(F.broadcast(default), "reason", "left_anti").select("reason", (F.row_number().over(Window.orderBy("first", "reason")) - 1).cast("long").alias("reason_index"))
    return rows.join(numbers, "reason").select("doc_id", "reason", "reason_index")


@query("reused_units", """
WITH u AS (SELECT doc_id, source, sha256(text) AS media, lang AS config FROM documents), r AS (SELECT DISTINCT media, config FROM u JOIN labels USING (doc_id))
SELECT source, count(r.media) AS hits, count(*) - count(r.media) AS misses FROM u LEFT JOIN r USING (media, config) GROUP BY source
""", "T02 T03")
def reused_units(spark, sf_dir):
    """A unit of work is a hit if a finished one (here: a labelled document) has the same content hash and configuration."""
    units = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("media"), F.col("lang").alias("config"))
    receipts = units.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("media", "config").distinct().withColumn("done", F.lit(1))
    found = units.join(receipts, ["media", "config"], "left")
    return found.groupBy("source").agg(F.count("done").alias("hits"), (F.count(F.lit(1)) - F.count("done")).alias("misses"))


@query("reference_collisions", """
SELECT url, count(*) AS n, count(DISTINCT sha256(html)) AS versions, count(DISTINCT sha256(html)) > 1 AS collides, min(page_id) AS retained FROM pages GROUP BY url
""", "S15")
def reference_collisions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").groupBy("url", F.sha2("html", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("page_id"))
    grouped = pages.groupBy("url").agg(F.sum("n").alias("n"), F.count("digest").alias("versions"), F.min("page_id").alias("retained"))
    return grouped.withColumn("collides", F.col("versions") > 1)
