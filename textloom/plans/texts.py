"""Text projections, statistics, deduplication, ranking and audits over ``documents``, ``labels``, ``pages`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import sqltext as S
from textloom.functions import text as T
from textloom.operators import dedupe, joins, ranking, sequences
from textloom.plans.base import query
from textloom.sources.shared import written
from textloom.sources.tables import table

#: Signal names and patterns; a parameter of the signal queries.
SIGNALS = (("number", "[0-9]"), ("mail", "[a-z0-9._]+@[a-z0-9.]+"), ("url", "https?://"), ("pipe", "\\|"), ("licen", "licen[cs]e"), ("question", "\\?"), ("shout", "[A-Z]{4,}"))
SIGNAL_ORDER = ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in SIGNALS)
WEIGHTS = {"number": 2, "mail": 4, "url": 3, "pipe": 1, "licen": 3, "question": 1, "shout": 2}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def signals(text: str):
    named = F.array(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in SIGNALS])
    return F.filter(named, lambda x: x.isNotNull())


@query("text_projection", f"""
SELECT doc_id, {S.slug('text')} AS slug, CASE WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 70 THEN regexp_replace(left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 70), '\\s\\S*$', '') || '...' ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END AS excerpt,
       CASE WHEN instr({S.fold('text')}, ' in ') >= 25 THEN left({S.fold('text')}, instr({S.fold('text')}, ' in ') - 1) ELSE {S.fold('text')} END AS thesis, len({S.tokens('text')}) AS n_tokens
FROM documents
""", "F01 F02 F03 F04 F14 F15")
def text_projection(spark, sf_dir):
    return projected(_docs(spark, sf_dir), F.col("text"))


def projected(docs: DataFrame, title: Column) -> DataFrame:
    folded = T.fold(F.col("text"))
    at = F.instr(folded, " in ")
    thesis = F.when(at >= 25, F.left(folded, at - 1)).otherwise(folded)
    return docs.select("doc_id", T.slug(title).alias("slug"), T.excerpt(F.col("text"), 70).alias("excerpt"), thesis.alias("thesis"), F.size(T.tokens(F.col("text"))).cast("long").alias("n_tokens"))


@query("token_df", f"""
SELECT t AS token, count(*) AS docs FROM (SELECT unnest({S.tokens('text')}) AS t FROM documents) GROUP BY t HAVING count(*) >= 20
""", "F04 G02")
def token_df(spark, sf_dir):
    each = _docs(spark, sf_dir).select(F.explode(T.tokens(F.col("text"))).alias("token"))
    return each.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).filter("docs >= 20")


@query("title_distribution", f"""
WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, {S.fold("split_part(text, chr(10), 1)")} AS k FROM documents)
SELECT k AS title_key, arg_min(title, doc_id) AS title, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent, count(*) > 1 AS repeated FROM t GROUP BY k
""", "G01 G03 G17")
def title_distribution(spark, sf_dir):
    title = F.element_at(F.split("text", "\n"), 1)
    rows = _docs(spark, sf_dir).select("doc_id", title.alias("title"), T.fold(title).alias("title_key"))
    grouped = rows.groupBy("title_key").agg(F.min_by("title", "doc_id").alias("title"), F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return grouped.crossJoin(F.broadcast(total)).select("title_key", "title", "n", F.round(F.col("n") * 100.0 / F.col("total"), 2).alias("percent"), (F.col("n") > 1).alias("repeated"))


@query("exact_duplicate_groups", f"""
SELECT doc_id, sha256({S.fold('text')}) AS digest, count(*) OVER (PARTITION BY sha256({S.fold('text')})) AS n, min(doc_id) OVER (PARTITION BY sha256({S.fold('text')})) AS retained FROM documents QUALIFY n > 1
""", "J14 G17 F24 S13")
def exact_duplicate_groups(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.sha2(T.fold(F.col("text")), 256).alias("digest"))
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("retained")).filter("n > 1")
    return rows.join(groups, "digest").select("doc_id", "digest", "n", "retained")


@query("best_per_key", f"""
WITH r AS (SELECT d.doc_id, {S.slug('left(text, 80)', 80)} AS key, coalesce(quality, 0) AS quality, n_chars, row_number() OVER (PARTITION BY {S.slug('left(text, 80)', 80)} ORDER BY coalesce(quality, 0) DESC, n_chars DESC, d.doc_id) AS rn, count(*) OVER (PARTITION BY {S.slug('left(text, 80)', 80)}) - 1 AS dropped FROM documents d LEFT JOIN labels USING (doc_id))
SELECT key, doc_id, quality, dropped FROM r WHERE rn = 1
""", "S01 S02 S03 S07 S08")
def best_per_key(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("key", T.slug(F.left("text", F.lit(80)), 80)).withColumn("quality", F.coalesce("quality", F.lit(0)))
    return dedupe.best_per_key(rows, ["key"], [F.desc("quality"), F.desc("n_chars")], "doc_id").select("key", "doc_id", "quality", "dropped")


@query("jaccard_pairs", f"""
WITH s AS (SELECT doc_id, {S.tokens('text')} AS t FROM documents)
SELECT a.doc_id AS a, b.doc_id AS b, round({S.jaccard('a.t', 'b.t')}, 6) AS similarity FROM s a JOIN s b ON a.doc_id < b.doc_id WHERE len(a.t) > 0 AND least(len(a.t), len(b.t)) >= 0.86 * greatest(len(a.t), len(b.t)) AND {S.jaccard('a.t', 'b.t')} >= 0.86
""", "S04")
def jaccard_pairs(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", T.tokens(F.col("text")).alias("tokens"))
    return dedupe.similar_pairs(rows, "doc_id", "tokens", 0.86).withColumn("similarity", F.round("similarity", 6))


@query("leader_clusters", None, "S06")
def leader_clusters(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", T.tokens(F.col("text")).alias("tokens"))
    return dedupe.leader_clusters(rows, "doc_id", "tokens", 0.62)


@query("mmr_pack", None, "K02 K03")
def mmr_pack(spark, sf_dir):
    thesis = T.slug(F.split("text", "\n")[0], 40)
    docs = written(_docs(spark, sf_dir).select("doc_id", "lang", "source", T.tokens(F.col("text")).alias("tokens"), thesis.alias("thesis")), "tokens")
    terms = T.tokens(F.lit("thing ation the of and in stra"))
    scored = docs.withColumn("relevance", F.size(F.array_intersect("tokens", terms)) * 3.0 + F.least(F.size("tokens") / 400.0, F.lit(1.0))).filter("relevance > 1")
    rows = scored.select("lang", "doc_id", "relevance", "tokens", "source", "thesis")
    return dedupe.diverse_top(rows, "lang", "doc_id", "relevance", "tokens", "source", 12, 0.3, 3, "thesis")


@query("strategy_score", f"""
WITH s AS (SELECT d.doc_id, 8 * CASE WHEN lang = 'en' THEN 1 ELSE 0 END + 5 * (CASE WHEN contains({S.fold('text')}, 'ation') THEN 1 ELSE 0 END + CASE WHEN contains({S.fold('text')}, 'stra') THEN 1 ELSE 0 END) + 3 * len(list_intersect({S.tokens('text')}, ['the', 'thing', 'and'])) + 0.5 * coalesce(quality, 0) AS score FROM documents d LEFT JOIN labels USING (doc_id))
SELECT doc_id, round(score, 4) AS score FROM s WHERE score > 0 ORDER BY round(score, 4) DESC, doc_id LIMIT 50
""", "K02")
def strategy_score(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    folded = T.fold(F.col("text"))
    words = sum((F.contains(folded, F.lit(w)).cast("int") for w in ("ation", "stra")), F.lit(0))
    hits = F.size(F.array_intersect(T.tokens(F.col("text")), F.array(*map(F.lit, ("the", "thing", "and")))))
    score = F.when(F.col("lang") == "en", 8).otherwise(0) + words * 5 + hits * 3 + F.coalesce(F.col("quality") * 0.5, F.lit(0.0))
    # Rows of no score come last, so the filter can wait until after the limit: before it, the score would be computed twice.
    return rows.select("doc_id", F.round(score, 4).alias("score")).orderBy(F.desc("score"), "doc_id").limit(50).filter("score > 0")


@query("cap_per_cluster", """
WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS in_group FROM documents),
p AS (SELECT *, 1 AS pass FROM (SELECT * FROM r WHERE in_group <= 3 ORDER BY n_chars DESC, doc_id LIMIT 40) UNION ALL SELECT *, 2 FROM (SELECT * FROM r WHERE in_group > 3 ORDER BY n_chars DESC, doc_id LIMIT 40))
SELECT doc_id, source, in_group, pass FROM p ORDER BY pass, n_chars DESC, doc_id LIMIT 40
""", "K04")
def cap_per_cluster(spark, sf_dir):
    return ranking.capped(_docs(spark, sf_dir).select("doc_id", "source", "n_chars"), "source", [F.desc("n_chars"), F.col("doc_id")], 3, 40).select("doc_id", "source", "in_group", "pass")


@query("hash_sample", """
SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS digest FROM documents ORDER BY digest LIMIT 50
""")
def hash_sample(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("digest")).orderBy("digest").limit(50)


@query("systematic_sample", """
WITH n AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang FROM n WHERE n <= 9 OR list_contains([CAST(round_even(k * (n - 1) / 8.0, 0) AS BIGINT) for k in range(9)], i)
""", "W23 W24")
def systematic_sample(spark, sf_dir):
    return sequences.systematic_sample(_docs(spark, sf_dir).select("doc_id", "lang"), ["doc_id"], 9, ["lang"])


@query("signals_inventory", f"""
WITH s AS (SELECT doc_id, list_filter([{SIGNAL_ORDER}], lambda x: x IS NOT NULL) AS s FROM documents)
SELECT doc_id, array_to_string(s, ',') AS signals, len(s) AS n FROM s WHERE len(s) > 0
""", "P07 P08 P09 P10 P13")
def signals_inventory(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", signals("text").alias("s")).filter(F.size("s") > 0)
    return rows.select("doc_id", F.array_join("s", ",").alias("signals"), F.size("s").cast("long").alias("n"))


RISK_SQL = " + ".join(f"CASE WHEN list_contains(s, '{n}') THEN {w} ELSE 0 END" for n, w in WEIGHTS.items())


@query("risk_tier", f"""
WITH s AS (SELECT doc_id, list_filter([{SIGNAL_ORDER}], lambda x: x IS NOT NULL) AS s FROM documents), r AS (SELECT doc_id, {RISK_SQL} AS risk, s FROM s)
SELECT doc_id, CAST(risk AS BIGINT) AS risk, CASE WHEN risk >= 8 THEN 'high' WHEN risk >= 4 THEN 'medium' ELSE 'low' END AS tier, CASE WHEN list_contains(s, 'mail') THEN 'contact' WHEN list_contains(s, 'licen') THEN 'legal' WHEN list_contains(s, 'number') THEN 'evidence' ELSE 'prose' END AS unit_type FROM r
""", "C13 C14 C15 K12 L02")
def risk_tier(spark, sf_dir):
    s = F.col("s")
    risk = sum((F.array_contains(s, n).cast("int") * w for n, w in WEIGHTS.items()), F.lit(0))
    kind = F.when(F.array_contains(s, "mail"), "contact").when(F.array_contains(s, "licen"), "legal").when(F.array_contains(s, "number"), "evidence").otherwise("prose")
    rows = _docs(spark, sf_dir).select("doc_id", signals("text").alias("s")).select("doc_id", risk.cast("long").alias("risk"), kind.alias("unit_type"))
    return rows.withColumn("tier", F.when(F.col("risk") >= 8, "high").when(F.col("risk") >= 4, "medium").otherwise("low"))


RUBRIC = """
SELECT d.doc_id, least(25, greatest(0, CASE WHEN quality = 1 THEN 25 WHEN quality = 0 THEN 12 ELSE 14 END - CASE WHEN n_chars < 200 THEN 4 ELSE 0 END + CASE WHEN contains(text, chr(10)) THEN 2 ELSE 0 END)) AS evidence,
       least(25, 10 + CASE WHEN n_chars >= 900 THEN 5 ELSE 0 END + CASE WHEN regexp_matches(text, '[0-9]') THEN 5 ELSE 0 END + CASE WHEN n_chars >= 3000 THEN 5 ELSE 0 END) AS specificity, CASE lang WHEN 'en' THEN 20 WHEN 'de' THEN 15 ELSE 10 END AS applicability FROM documents d LEFT JOIN labels USING (doc_id)
"""


def rubric(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    evidence = F.when(F.col("quality") == 1, 25).when(F.col("quality") == 0, 12).otherwise(14) - (F.col("n_chars") < 200).cast("int") * 4 + F.contains("text", F.lit("\n")).cast("int") * 2
    specific = F.lit(10) + (F.col("n_chars") >= 900).cast("int") * 5 + F.col("text").rlike("[0-9]").cast("int") * 5 + (F.col("n_chars") >= 3000).cast("int") * 5
    applies = F.when(F.col("lang") == "en", 20).when(F.col("lang") == "de", 15).otherwise(10)
    return rows.select("doc_id", F.least(F.lit(25), F.greatest(F.lit(0), evidence)).alias("evidence"), F.least(F.lit(25), specific).alias("specificity"), applies.alias("applicability"))


@query("rubric_score", f"SELECT doc_id, evidence, specificity, applicability, evidence + specificity + applicability AS score FROM ({RUBRIC})", "C07 C08 C09 C10")
def rubric_score(spark, sf_dir):
    return rubric(spark, sf_dir).withColumn("score", F.col("evidence") + F.col("specificity") + F.col("applicability"))


@query("score_histogram", f"""
WITH s AS (SELECT least(9, greatest(0, CAST(floor((evidence + specificity + applicability) / 10.0) AS INTEGER))) AS b FROM ({RUBRIC}))
SELECT CAST(g.b AS INTEGER) AS bucket, count(s.b) AS n FROM (SELECT unnest(range(10)) AS b) g LEFT JOIN s ON s.b = g.b GROUP BY g.b
""", "G08 G09")
def score_histogram(spark, sf_dir):
    score = F.col("evidence") + F.col("specificity") + F.col("applicability")
    counts = rubric(spark, sf_dir).select(F.least(F.lit(9), F.greatest(F.lit(0), F.floor(score / 10.0))).cast("int").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
    return spark.range(10).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").select("bucket", F.coalesce("c", F.lit(0)).alias("n"))


@query("numeric_mentions", r"""
WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '[$€£]\s?[0-9][0-9.,]*|[0-9][0-9.,]*\s?%|[0-9]+x\b|[0-9][0-9.,]*')) AS raw FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(raw, '[$€£]') THEN 'currency' WHEN contains(raw, '%') THEN 'percent' WHEN contains(raw, 'x') THEN 'ratio' ELSE 'bare' END AS kind, count(*) AS n, min(raw) AS least FROM m GROUP BY 1, 2
""", "F16")
def numeric_mentions(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit(r"[$€£]\s?[0-9][0-9.,]*|[0-9][0-9.,]*\s?%|[0-9]+x\b|[0-9][0-9.,]*"), 0)
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(found).alias("raw"))
    kind = F.when(F.col("raw").rlike("[$€£]"), "currency").when(F.contains("raw", F.lit("%")), "percent").when(F.contains("raw", F.lit("x")), "ratio").otherwise("bare")
    return rows.groupBy("doc_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("least"))


@query("audit_violations", """
WITH r AS (SELECT d.doc_id, text, n_chars, quality, toxic, count(*) OVER (PARTITION BY text) AS copies FROM documents d LEFT JOIN labels USING (doc_id))
SELECT doc_id, unnest(list_filter([CASE WHEN trim(text) = '' THEN 'empty_text' END, CASE WHEN n_chars <> length(text) THEN 'length_mismatch' END, CASE WHEN copies > 1 THEN 'duplicate_text' END, CASE WHEN quality IS NULL THEN 'missing_label' END, CASE WHEN toxic = 1 AND quality = 1 THEN 'toxic_but_good' END], lambda x: x IS NOT NULL)) AS rule FROM r
""", "V01 V04 V05 V06 L12")
def audit_violations(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    copies = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    rows = rows.withColumn("digest", F.sha2("text", 256)).join(copies, "digest", "left")
    checks = {"empty_text": F.trim("text") == "", "length_mismatch": F.col("n_chars") != F.length("text"), "duplicate_text": F.col("copies").isNotNull(), "missing_label": F.col("quality").isNull(), "toxic_but_good": (F.col("toxic") == 1) & (F.col("quality") == 1)}
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    return rows.select("doc_id", F.explode(failed).alias("rule"))


@query("evidence_traceability", """
WITH e AS (SELECT item_id, text AS quote, item_id * 7 AS doc_id FROM benchmark)
SELECT item_id, e.doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing_segment' ELSE 'quote_mismatch' END AS problem FROM e LEFT JOIN documents d USING (doc_id) WHERE d.doc_id IS NULL OR NOT contains(d.text, quote)
""", "J06 J07 L13")
def evidence_traceability(spark, sf_dir):
    evidence = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"), (F.col("item_id") * 7).alias("doc_id"))
    return joins.traceability(evidence, _docs(spark, sf_dir), "doc_id", "quote", "text").select("item_id", "doc_id", "problem")


CITATION = """
SELECT d.doc_id, source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 0 THEN 'low_score' WHEN lang = 'en' THEN 'on_tag' WHEN toxic = 0 THEN 'reviewed_cross_tag' ELSE 'weak_cross_tag' END AS class FROM documents d LEFT JOIN labels l USING (doc_id)
"""


@query("citation_classes", f"SELECT source, class, count(*) AS n FROM ({CITATION}) GROUP BY GROUPING SETS ((source, class), (class))", "J04 G12 G13")
def citation_classes(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").withColumn("found", F.lit(True)), "doc_id", "left")
    kind = F.when(F.col("found").isNull(), "missing").when(F.col("quality") == 0, "low_score").when(F.col("lang") == "en", "on_tag").when(F.col("toxic") == 0, "reviewed_cross_tag").otherwise("weak_cross_tag")
    rows = rows.select("source", kind.alias("class"))
    return rows.groupingSets([["source", "class"], ["class"]], "source", "class").agg(F.count(F.lit(1)).alias("n"))


@query("category_queue", f"""
WITH c AS (SELECT doc_id, n_chars, CASE WHEN contains({S.fold('text')}, 'licen') THEN 1 WHEN contains({S.fold('text')}, 'thing') THEN 2 WHEN contains({S.fold('text')}, 'ation') THEN 3 ELSE 9 END AS category FROM documents)
SELECT doc_id, category, row_number() OVER (PARTITION BY category ORDER BY nullif(n_chars, 0) NULLS LAST, doc_id) AS queue_rank FROM c
""", "K07 K08")
def category_queue(spark, sf_dir):
    folded = T.fold(F.col("text"))
    category = F.when(F.contains(folded, F.lit("licen")), 1).when(F.contains(folded, F.lit("thing")), 2).when(F.contains(folded, F.lit("ation")), 3).otherwise(9)
    rows = _docs(spark, sf_dir).select("doc_id", category.alias("category"), F.coalesce(F.nullif("n_chars", F.lit(0)), F.lit(2**62)).alias("length"))
    return ranking.numbered(rows, "category", ["length", "doc_id"], "queue_rank").select("doc_id", "category", "queue_rank")


@query("html_blocks", r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text, len(regexp_extract_all(html, '<p>')) AS n_blocks, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages
""", "F13")
def html_blocks(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.strip_html(F.col("html")).alias("text"), F.size(F.regexp_extract_all("html", F.lit("<p>"), 0)).cast("long").alias("n_blocks"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("url_ids", r"""
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host, regexp_extract(url, '/([a-z]{2})/', 1) AS lang, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS key FROM pages
""")
def url_ids(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)).alias("host"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"), F.regexp_extract("url", "/([0-9]+)", 1).try_cast("long").alias("key"))


@query("blind_scores", """
WITH u AS (SELECT doc_id, 'quality' AS criterion, quality AS value FROM labels UNION ALL SELECT doc_id, 'safety', 1 - toxic FROM labels), s AS (SELECT source, criterion, sum(value) AS wins, count(*) AS n FROM u JOIN documents USING (doc_id) GROUP BY 1, 2)
SELECT source, criterion, CAST(wins AS BIGINT) AS wins, n, CASE WHEN 2 * wins > n THEN 'win' WHEN 2 * wins = n THEN 'tie' ELSE 'loss' END AS outcome FROM s
""", "G11 G10")
def blind_scores(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", (1 - F.col("toxic")).alias("safety"))
    judged = labels.unpivot("doc_id", ["quality", "safety"], "criterion", "value").join(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id")
    grouped = judged.groupBy("source", "criterion").agg(F.sum("value").alias("wins"), F.count(F.lit(1)).alias("n"))
    return grouped.withColumn("outcome", F.when(F.col("wins") * 2 > F.col("n"), "win").when(F.col("wins") * 2 == F.col("n"), "tie").otherwise("loss"))


@query("coverage_status", """
SELECT source, count(*) AS expected, count(l.doc_id) AS labelled, round(count(l.doc_id) / CAST(count(*) AS DOUBLE), 6) AS coverage, count(l.doc_id) = count(*) AS complete, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) > 0 AS has_toxic FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source
""", "G05 G06 G07 G15 G20 J01 J02 SRC06 SRC07")
def coverage_status(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "source").join(table(spark, sf_dir, "labels").withColumn("found", F.lit(1)), "doc_id", "left")
    grouped = rows.groupBy("source").agg(F.count(F.lit(1)).alias("expected"), F.count("found").alias("labelled"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("has_toxic"))
    return grouped.withColumn("coverage", F.round(F.col("labelled") / F.col("expected"), 6)).withColumn("complete", F.col("labelled") == F.col("expected"))
