"""Filtered search, terms, rules, risks and reports, over ``documents``, ``conversations`` and ``part``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import sqltext as S
from textloom.functions import text as T
from textloom.operators import rules as R
from textloom.plans.base import query
from textloom.sources.tables import table


def folded_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", T.fold(F.col("text")).alias("t"))


TURNS = f"t AS (SELECT conv_id, turn, role, {S.fold('text')} AS t FROM conversations)"
PARTS = "SELECT p_partkey, p_name, p_brand, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice / 2500 END AS confidence, p_size, [p_type, split_part(p_name, ' ', 1)] AS themes, ['tag ' || p_size % 4, 'process-' || split_part(p_name, ' ', 2)] AS tags FROM part"


@query("filtered_search", f"""
WITH p AS ({PARTS})
SELECT p_partkey, round(10 * ((contains(p_name, 'red')) :: INT + (contains(p_name, 'ring')) :: INT) + CASE WHEN contains(p_name, 'red ring') THEN 2 ELSE 0 END + coalesce(confidence, 0), 4) AS score FROM p
WHERE len(list_filter(themes, lambda x: contains({S.fold('x')}, 'econom') OR contains({S.fold('x')}, 'r'))) > 0 AND len(list_filter(themes, lambda x: contains({S.fold('x')}, 'r'))) > 0 AND list_has_any(['process-tag-1', 'process-ring'], list_transform(tags, lambda x: CASE WHEN starts_with({S.slug('x')}, 'process-') THEN {S.slug('x')} ELSE 'process-' || {S.slug('x')} END))
  AND contains({S.fold("p_partkey || ' ' || p_brand")}, 'brand') AND coalesce(confidence, 0) >= 0.2 AND round(10 * ((contains(p_name, 'red')) :: INT + (contains(p_name, 'ring')) :: INT) + CASE WHEN contains(p_name, 'red ring') THEN 2 ELSE 0 END + coalesce(confidence, 0), 4) > 1
ORDER BY score DESC, p_partkey LIMIT 40
""", "P01 P02 P03 K01")
def filtered_search(spark, sf_dir):
    """Parts as records: a search for "red ring" under every kind of filter."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") / 2500).alias("confidence"),
        F.array("p_type", F.split("p_name", " ")[0]).alias("themes"), F.array(F.concat(F.lit("tag "), (F.col("p_size") % 4).cast("string")), F.concat(F.lit("process-"), F.split("p_name", " ")[1])).alias("tags"),
    )
    filters = R.Filters(contains={"themes": "R"}, within=(["p_partkey", "p_brand"], "Brand"), tags=["tag 1; ring"], least={"confidence": 0.2})
    name = T.fold(F.col("p_name"))
    hits = F.size(F.array_intersect(T.tokens(F.col("p_name")), F.array(F.lit("red"), F.lit("ring"))))
    score = hits * 10 + F.when(F.contains(name, F.lit("red ring")), 2).otherwise(0) + F.coalesce("confidence", F.lit(0.0))
    found = rows.filter(R.passes(filters)).select("p_partkey", F.round(score, 4).alias("score")).filter("score > 1")
    return found.orderBy(F.desc("score"), "p_partkey").limit(40)


@query("fixture_ids", "SELECT lower(c_name) LIKE 'customer#00000001%' AS fixture, count(*) AS n FROM customer GROUP BY 1", "P04 SRC05")
def fixture_ids(spark, sf_dir):
    """Customers whose name starts with the prefix, whatever its case, play fixtures."""
    mark = F.startswith(F.lower("c_name"), F.lit("Customer#00000001".lower()))
    return table(spark, sf_dir, "customer").groupBy(mark.alias("fixture")).agg(F.count(F.lit(1)).alias("n"))


#: Terms and their synonyms, folded.
TERMS = {"process-and": ("and", "und", "et"), "process-of": ("of", "de", "von"), "process-the": ("the", "le", "der", "the the"), "process-in": ("in", "en")}
#: RE2 has no look-around, so the oracle pads the text and asks for a bound on both sides.
PLACE = {s: f"CASE WHEN regexp_matches(' ' || t || ' ', '[^a-z0-9]{s}[^a-z0-9]') THEN length(regexp_extract(' ' || t || ' ', '(?s)^(.*?)[^a-z0-9]{s}[^a-z0-9]', 1)) END" for some in TERMS.values() for s in some}
MATCHES = ", ".join("{'n': -len(list_filter([" + ", ".join(PLACE[s] for s in some) + "], lambda x: x IS NOT NULL)), 'at': list_min([" + ", ".join(PLACE[s] for s in some) + f"]), 'term': '{t}'}}" for t, some in TERMS.items())
TAGGED = f"g AS (SELECT conv_id, turn, role, t, list_transform(list_sort(list_filter([{MATCHES}], lambda x: x.n < 0)), lambda x: x.term) AS found FROM t), k AS (SELECT conv_id, turn, role, t, list_concat(CASE WHEN turn % 3 = 0 THEN ['process-of'] ELSE [] END, list_filter(found, lambda x: turn % 3 <> 0 OR x <> 'process-of'))[1:3] AS tags FROM g)"


def tagged(spark, sf_dir):
    existing = F.when(F.col("turn") % 3 == 0, F.array(F.lit("process-of"), F.lit("unknown")))
    return folded_turns(spark, sf_dir).withColumn("tags", R.matched_tags(F.col("t"), TERMS, existing, 3))


@query("term_tags", f"WITH {TURNS}, {TAGGED} SELECT conv_id, turn, array_to_string(tags, ',') AS tags, coalesce({PLACE['de']}, -1) AS at_de FROM k", "K10 P06")
def term_tags(spark, sf_dir):
    return tagged(spark, sf_dir).select("conv_id", "turn", F.array_join("tags", ",").alias("tags"), F.coalesce(R.position(F.col("t"), "de"), F.lit(-1)).cast("long").alias("at_de"))


#: Themes and the stages of the funnel they belong to.
THEMES = {"offers": ("tion", "ung"), "traffic": ("ment", "heit"), "copy": ("ly",)}
THEME_SQL = ", ".join(f"CASE WHEN {' OR '.join(f"contains(t, '{s}')" for s in some)} THEN '{n}' END" for n, some in THEMES.items())


@query("classified", f"""
WITH {TURNS}, {TAGGED}, c AS (SELECT *, list_filter([{THEME_SQL}], lambda x: x IS NOT NULL) AS th, length(t) % 100 / 100.0 AS confidence FROM k)
SELECT conv_id, turn, CASE WHEN len(th) = 0 THEN 'estrategias' ELSE array_to_string(th, ',') END AS themes, CASE WHEN turn % 6 = 5 THEN 'manual' WHEN turn % 4 = 0 OR role = 'user' THEN 'asset' ELSE 'transcript' END AS source_kind,
  CASE WHEN confidence >= 0.75 THEN 'approved' ELSE 'pending' END AS review_status, len(tags) = 0 AS in_queue FROM c
""", "C01 C02 C03 P05")
def classified(spark, sf_dir):
    rows = tagged(spark, sf_dir).withColumn("th", R.substring_terms(F.col("t"), THEMES))
    asset = F.when(F.col("turn") % 4 == 0, "a-1").otherwise("")
    evidence = F.array(F.struct(F.lit(None).cast("string").alias("asset_id")), F.struct(F.when(F.col("role") == "user", "a-2").alias("asset_id")))
    kind = R.source_kind(F.when(F.col("turn") % 6 == 5, "manual"), asset, evidence)
    status = F.when(F.length("t") % 100 / 100.0 >= 0.75, "approved").otherwise("pending")
    themes = F.when(F.size("th") == 0, "estrategias").otherwise(F.array_join("th", ","))
    return rows.select("conv_id", "turn", themes.alias("themes"), kind.alias("source_kind"), status.alias("review_status"), (F.size("tags") == 0).alias("in_queue"))


RULES = (R.Rule("ending", ("tion", "ment", "ung", "heit"), ("tion", "ung"), 10), R.Rule("joint", ("and", "und", "thand"), weight=9), R.Rule("rare", ("zzzz",)))
RULE_SQL = " UNION ALL ".join(
    f"SELECT conv_id, turn, '{r.name}' AS rule, {' + '.join(f"CAST(contains(t, '{k}') AS INT)" for k in r.keywords)} AS score, {r.weight} AS weight FROM t WHERE {' OR '.join(f"contains(t, '{a}')" for a in r.anchors or r.keywords[:1])}" for r in RULES
)


@query("rule_scores", f"""
WITH {TURNS}, h AS ({RULE_SQL})
SELECT conv_id, turn, rule, score, score * weight AS weighted, CASE WHEN score * weight >= 28 THEN 'strong' ELSE 'moderate' END AS strength, CAST(CASE WHEN score * weight >= 28 THEN 0.82 ELSE 0.76 END AS DOUBLE) AS confidence FROM h WHERE score > 0
""", "C04 C05 K09")
def rule_scores(spark, sf_dir):
    return R.scored(folded_turns(spark, sf_dir), "t", RULES).drop("role", "t")


RISKY = ("tion", "ung")


@query("claim_risk", f"""
WITH {TURNS}, r AS (SELECT conv_id, turn, contains(t, 'tion') OR contains(t, 'ung') AS has, CASE turn % 4 WHEN 0 THEN 'weak' WHEN 1 THEN 'strong' ELSE '' END AS how, CASE turn % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE 'medium' END AS cur FROM t)
SELECT conv_id, turn, CASE WHEN how = 'weak' THEN CASE WHEN has THEN 'high' ELSE 'medium' END WHEN has AND how <> 'strong' THEN CASE WHEN cur = 'high' THEN 'high' ELSE 'medium' END WHEN cur = 'high' AND how = 'strong' THEN 'medium' ELSE cur END AS risk,
  CASE WHEN turn % 5 = 0 THEN concat('title of ', conv_id) ELSE 'given' END AS title FROM r
""", "C11 C12")
def claim_risk(spark, sf_dir):
    strength = F.when(F.col("turn") % 4 == 0, "Weak").when(F.col("turn") % 4 == 1, "STRONG")
    current = F.when(F.col("turn") % 3 == 0, "High ").when(F.col("turn") % 3 == 1, "low").otherwise("who knows")
    title = F.coalesce(F.nullif(F.when(F.col("turn") % 5 == 0, "").otherwise("given"), F.lit("")), F.concat(F.lit("title of "), "conv_id"))
    return folded_turns(spark, sf_dir).select("conv_id", "turn", R.claim_risk(current, F.col("t"), strength, RISKY).alias("risk"), title.alias("title"))


CRITERIA = {"clarity": ("the", "der", "le"), "proof": ("tion", "ung", "ment"), "offer": ("and", "und", "que"), "action": ("in", "en", "st"), "voice": ("ou", "au", "ei"), "depth": ("thing", "keit", "eaux"), "reach": ("of", "de", "von")}
HITS = ", ".join(f"{' + '.join(f"CAST(contains(t, '{k}') AS INT)" for k in some)} AS {c}" for c, some in CRITERIA.items())
GRADES = " + ".join(f"CASE WHEN {c} >= 3 THEN 5 WHEN {c} = 2 THEN 4 WHEN {c} = 1 THEN 3 ELSE 1 END" for c in CRITERIA)


@query("keyword_report", f"""
WITH {TURNS}, h AS (SELECT conv_id, turn, {HITS} FROM t), g AS (SELECT conv_id, turn, {GRADES} AS total FROM h)
SELECT conv_id, turn, total, CASE WHEN total >= 28 THEN 'pass' WHEN total >= 22 THEN 'needs_revision' ELSE 'fail' END AS decision, CASE WHEN (total >= 28) = (turn % 2 = 0) THEN 'agrees' ELSE 'differs' END AS legacy FROM g
""", "C16 C17")
def keyword_report(spark, sf_dir):
    total = sum((R.presence_score(F.col("t"), some) for some in CRITERIA.values()), F.lit(0))
    rows = folded_turns(spark, sf_dir).select("conv_id", "turn", total.alias("total")).withColumn("decision", R.decision(F.col("total"), 28, 22))
    return rows.withColumn("legacy", F.when((F.col("decision") == "pass") == (F.col("turn") % 2 == 0), "agrees").otherwise("differs"))


GROUPS = {"hooks": "contains(t, 'tion')", "proofs": "contains(t, 'ung') OR contains(t, 'ment')", "offers": "length(t) > 200", "questions": "contains(t, '?') OR length(t) < 40"}


@query("pack_groups", f"""
WITH {TURNS}, g AS ({' UNION ALL '.join(f"SELECT '{n}' AS list, conv_id, turn FROM t WHERE {c}" for n, c in GROUPS.items())}), r AS (SELECT *, row_number() OVER (PARTITION BY list, conv_id ORDER BY turn) AS place FROM g)
SELECT list, conv_id, turn, place FROM r WHERE place <= 3
""", "C18")
def pack_groups(spark, sf_dir):
    """A row may be routed into several lists; each list takes three turns of a conversation."""
    lists = F.filter(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in GROUPS.items()]), lambda x: x.isNotNull())
    each = folded_turns(spark, sf_dir).select("conv_id", "turn", F.explode(lists).alias("list"))
    return each.withColumn("place", F.row_number().over(Window.partitionBy("list", "conv_id").orderBy("turn"))).filter("place <= 3")


@query("extracted_terms", f"""
WITH {TURNS}, x AS (SELECT conv_id, turn, list_concat(regexp_extract_all(t || ' ' || turn || ',5% ' || turn, '[0-9]+(?:[.,][0-9]+)?%?'), list_filter(['tion', 'ung', 'thing'], lambda w: contains(t, w))) AS terms, list_filter([CASE WHEN contains(t, 'tion') THEN 'offers' END, CASE WHEN contains(t, 'ung') THEN 'traffic' END], lambda x: x IS NOT NULL) AS th FROM t)
SELECT conv_id, turn, array_to_string(list_sort(list_distinct(terms)), '|') AS terms, CASE WHEN len(th) > 0 THEN array_to_string(th, ',') ELSE 'business_model' END AS themes, CAST(0.62 AS DOUBLE) AS confidence FROM x
""", "C20 C06")
def extracted_terms(spark, sf_dir):
    numbered = F.concat_ws(" ", "t", F.concat(F.col("turn").cast("string"), F.lit(",5%")), F.col("turn").cast("string"))
    terms = F.concat(F.regexp_extract_all(numbered, F.lit(r"[0-9]+(?:[.,][0-9]+)?%?"), 0), R.substring_terms(F.col("t"), {w: (w,) for w in ("tion", "ung", "thing")}))
    themes = R.substring_terms(F.col("t"), {"offers": ("tion",), "traffic": ("ung",)})
    return folded_turns(spark, sf_dir).select("conv_id", "turn", F.array_join(F.array_sort(F.array_distinct(terms)), "|").alias("terms"), F.when(F.size(themes) > 0, F.array_join(themes, ",")).otherwise("business_model").alias("themes"), F.lit(0.62).alias("confidence"))


MENTION = {"pdf": "tion", "template": "ung|keit", "course": "eaux"}
VETO, HINT, PUBLIC, ACTION, CONTEXT = "thing", "le", "heit", "the|der|la", "and|und"
ACTIONABLE = {k: f"regexp_matches(t, '{p}') AND NOT regexp_matches(t, '{VETO}') AND CASE WHEN role = 'system' THEN regexp_matches(t, '{HINT}') ELSE regexp_matches(t, '{PUBLIC}') OR (regexp_matches(t, '{ACTION}') AND (regexp_matches(t, '{CONTEXT}') OR {'true' if k == 'pdf' else 'false'})) END" for k, p in MENTION.items()}


@query("asset_mentions", f"""
WITH {TURNS}, m AS ({' UNION ALL '.join(f"SELECT conv_id, turn, '{k}' AS type FROM t WHERE {c}" for k, c in ACTIONABLE.items())}), f AS (SELECT conv_id, type, min(turn) AS turn FROM m GROUP BY 1, 2)
SELECT *, printf('%d-asset-%04d', conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, type)) AS asset_id FROM f
""", "P11 S09")
def asset_mentions(spark, sf_dir):
    rows = folded_turns(spark, sf_dir).withColumn("source", F.when(F.col("role") == "system", "description").otherwise("transcript"))
    tests = {k: R.actionable(F.col("t"), F.col("source"), k, p, VETO, HINT, PUBLIC, ACTION, CONTEXT) for k, p in MENTION.items()}
    found = R.first_mentions(rows, "conv_id", "turn", tests)
    return found.select("conv_id", "type", "turn", F.format_string("%d-asset-%04d", "conv_id", "number").alias("asset_id"))
