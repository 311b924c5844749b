"""Values, identifiers, numbers and status texts, over rows made from ``part``, ``orders``, ``events``, ``pages``, ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import sqltext as S
from textloom.functions import text as T
from textloom.functions import values as V
from textloom.plans.base import query
from textloom.sources.tables import table


def unique(items: str) -> str:
    """SQL: the items of a list once each, in order."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


@query("filter_values", f"""
WITH p AS (SELECT p_partkey, [concat(p_name, ',', p_type, '; ', p_name, ' ,!'), CASE WHEN p_size % 3 = 0 THEN concat('process-', p_brand) END] AS v FROM part),
s AS (SELECT p_partkey, list_transform(list_filter(flatten(list_transform(v, lambda x: regexp_split_to_array(coalesce(x, ''), '[,;]'))), lambda x: trim(x) <> ''), lambda x: {S.slug('x')}) AS s FROM p),
t AS (SELECT p_partkey, list_transform(s, lambda x: CASE WHEN starts_with(x, 'process-') THEN x ELSE 'process-' || x END) AS t FROM s)
SELECT p_partkey, array_to_string({unique('t')}, '|') AS tags FROM t
""", "F07")
def filter_values(spark, sf_dir):
    """The ``!`` of every first value has no letters and so becomes ``process-item``."""
    values = F.array(F.concat("p_name", F.lit(","), "p_type", F.lit("; "), "p_name", F.lit(" ,!")), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("process-"), "p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(V.filter_values(values), "|").alias("tags"))


FOLDED = f"list_transform(v, lambda x: {S.fold('x')})"


@query("unique_values", f"""
WITH p AS (SELECT p_partkey, list_concat([p_name, upper(p_name), '', p_type, ' ' || p_name], CASE WHEN p_size % 2 = 0 THEN [p_brand] ELSE [] END) AS v FROM part), f AS (SELECT p_partkey, v, {FOLDED} AS k FROM p)
SELECT p_partkey, array_to_string(list_filter(v, lambda x, i: k[i] <> '' AND list_position(k, k[i]) = i), '|') AS kept FROM f
""", "F05 F06")
def unique_values(spark, sf_dir):
    listed = V.as_list(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")))
    values = F.concat(F.array("p_name", F.upper("p_name"), F.lit(""), "p_type", F.concat(F.lit(" "), "p_name")), listed)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(T.unique_by_fold(values), "|").alias("kept"))


@query("searchable_text", """
SELECT p_partkey, concat_ws(' ', p_name, nullif(CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END, ''), array_to_string([p_type, CAST(p_size AS VARCHAR)], ' '), CASE WHEN p_size % 3 > 0 THEN array_to_string([upper(p_name), p_type], ' ') END) AS words,
  CASE WHEN p_size % 3 > 0 THEN upper(p_name) END AS first_quote FROM part
""", "F08 F09")
def searchable_text(spark, sf_dir):
    evidence = F.when(F.col("p_size") % 3 > 0, F.array(F.struct(F.upper("p_name").alias("quote")), F.struct(F.col("p_type").alias("quote")))).otherwise(F.array().cast("array<struct<quote:string>>"))
    rows = table(spark, sf_dir, "part").withColumn("evidence", evidence)
    brand = F.when(F.col("p_size") % 4 == 0, "").otherwise(F.col("p_brand"))
    words = V.searchable([F.col("p_name"), brand], [F.array("p_type", F.col("p_size").cast("string"))], F.col("evidence"))
    return rows.select("p_partkey", words.alias("words"), F.get("evidence", F.lit(0))["quote"].alias("first_quote"))


@query("ascii_text", r"""
SELECT doc_id, md5(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS digest, length(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS n FROM documents
""", "F10")
def ascii_text(spark, sf_dir):
    bare = V.ascii_only(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(bare).alias("digest"), F.length(bare).cast("long").alias("n"))


@query("timecodes", """
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN conv_id * 60 + turn WHEN 1 THEN conv_id * 3600 + turn * 60 + length(text) % 60 WHEN 2 THEN NULL ELSE turn END AS seconds FROM conversations
""", "F12")
def timecodes(spark, sf_dir):
    code = (
        F.when(F.col("turn") % 4 == 0, F.format_string("%d:%02d", "conv_id", "turn"))
        .when(F.col("turn") % 4 == 1, F.format_string("%d:%02d:%02d", F.col("conv_id"), F.col("turn"), F.length("text") % 60))
        .when(F.col("turn") % 4 == 2, F.format_string("%d:x", "turn"))
        .otherwise(F.col("turn").cast("string"))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.base60(code).cast("long").alias("seconds"))


#: Ways to write an order's number, by its key; %s stands for its parts.
FORMS = ("'R$ ' || t || '.' || h || ',50'", "t || '.' || h", "t || ' ' || h || ' un'", "t || ',' || h || ' mil'", "t || 'k'", "t || ' milhoes'", "'caiu ' || t || ',3 4 %'", "'Sem numero É ' || chr(CAST(97 + o_orderkey % 3 AS INTEGER))", "t || '.5'")
FORMED = f"CASE o_orderkey % {len(FORMS)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(FORMS)) + " END"
TORN = r"(\d+)[,.](\d+)\s+(\d+)\s*%"


def formed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(1 + o_custkey % 900 as string) AS t", "lpad(cast(o_orderkey % 1000 as string), 3, '0') AS h")
    return rows.selectExpr("o_orderkey", f"{FORMED} AS raw")


@query("numeric_cores", rf"""
WITH r AS (SELECT o_orderkey, CAST(1 + o_custkey % 900 AS VARCHAR) AS t, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS h FROM orders), f AS (SELECT o_orderkey, {FORMED} AS raw FROM r),
p AS (SELECT o_orderkey, raw, {S.fold_ascii('raw')} AS bare, trim(replace({S.fold_ascii('raw')}, 'r$', '')) AS plain FROM f),
m AS (SELECT *, regexp_extract(' ' || plain || ' ', '[^a-z](k|mil|milhao|milhoes)[^a-z0-9]', 1) AS mag, trim(regexp_extract(plain, '\d[\d.\s]*(?:,\d+)?')) AS tok FROM p),
n AS (SELECT *, CASE WHEN contains(tok, ',') THEN replace(replace(replace(tok, '.', ''), ' ', ''), ',', '.') WHEN regexp_full_match(tok, '\d{{1,3}}(?:[.\s]\d{{3}})+') THEN replace(replace(tok, '.', ''), ' ', '') ELSE replace(tok, ' ', '') END AS num FROM m),
c AS (SELECT o_orderkey, raw, CASE WHEN regexp_matches(bare, '{TORN}') THEN regexp_extract(bare, '{TORN}', 1) || '.' || regexp_extract(bare, '{TORN}', 2) || regexp_extract(bare, '{TORN}', 3) WHEN tok = '' THEN plain WHEN mag <> '' THEN num || ':' || mag ELSE num END AS core FROM n)
SELECT o_orderkey, raw, core, TRY_CAST(split_part(core, ':', 1) AS DOUBLE) * CASE split_part(core, ':', 2) WHEN 'k' THEN 1000 WHEN 'mil' THEN 1000 WHEN 'milhao' THEN 1000000 WHEN 'milhoes' THEN 1000000 ELSE 1 END AS value FROM c
""", "F17")
def numeric_cores(spark, sf_dir):
    rows = formed(spark, sf_dir).withColumn("core", V.numeric_core(F.col("raw")))
    return rows.withColumn("value", V.core_value(F.col("core")))


#: A sentence for each order, by its key: written numbers with and without units, and figures.
SENTENCE = "CASE o_orderkey % 4 WHEN 0 THEN 'foram dez dias e Duas semanas, nada mais' WHEN 1 THEN concat('subiu ', o_custkey % 90, ',5% em 3 meses e vinte anos') WHEN 2 THEN concat('R$ ', o_custkey % 90, '.000 por mil leads ou dois') ELSE 'nenhum aqui, umas semanas' END"


@query("numbers_in_text", rf"""
WITH s AS (SELECT o_orderkey, {SENTENCE} AS s FROM orders), w AS (SELECT o_orderkey, 'word_unit' AS grammar, regexp_extract_all(s, '{V.WORD_WITH_UNIT}') AS found FROM s UNION ALL SELECT o_orderkey, 'number', regexp_extract_all(s, '{V.NUMBER_OR_WORD}') FROM s)
SELECT o_orderkey, grammar, printf('NUM-%04d-%02d', o_orderkey, i) AS id, found[i] AS raw FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM w)
""", "F18 F19")
def numbers_in_text(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{SENTENCE} AS s")
    each = [rows.select("o_orderkey", F.lit(name).alias("grammar"), F.posexplode(F.regexp_extract_all("s", F.lit(p), 0)).alias("i", "raw")) for name, p in (("word_unit", V.WORD_WITH_UNIT), ("number", V.NUMBER_OR_WORD))]
    return each[0].unionByName(each[1]).select("o_orderkey", "grammar", F.format_string("NUM-%04d-%02d", F.col("o_orderkey"), F.col("i") + 1).alias("id"), "raw")


CITES = "concat('ver ep', o_custkey, '-tr-insight-', o_orderkey % 7, ' e a-b_c-v2-', o_orderkey % 11, CASE WHEN o_orderkey % 3 = 0 THEN concat('; Insight_ID = x-', o_custkey % 5) ELSE ' sem mais' END, ' ep', o_custkey, '-tr-insight-', o_orderkey % 7, '.')"


@query("cited_ids", rf"""
WITH t AS (SELECT o_orderkey, {CITES} AS t FROM orders)
SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(t, '[A-Za-z0-9_-]+-(?:tr-insight|v2)-\d+'), regexp_extract_all(t, '(?i)insight_id\s*[:=]\s*([A-Za-z0-9_-]+)', 1)))), ',') AS ids FROM t
""", "F22")
def cited_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{CITES} AS t").select("o_orderkey", F.array_join(V.cited_ids(F.col("t")), ",").alias("ids"))


STOPS = ("eauxtion", "thand", "keitung")


@query("description_lines", f"""
WITH d AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i % 3 = 0 THEN x WHEN i % 7 = 0 THEN '- http://x' ELSE '-- ' || x END) AS l FROM documents),
l AS (SELECT doc_id, list_filter(list_transform(l, lambda x: trim(x)), lambda x: x <> '') AS l FROM d),
s AS (SELECT doc_id, l, coalesce(list_position(list_transform(l, lambda x: {' OR '.join(f"contains({S.fold('x')}, '{s}')" for s in STOPS)}), true), 0) AS stop FROM l),
k AS (SELECT doc_id, list_filter(list_transform(list_filter(CASE WHEN stop > 0 THEN l[1:stop - 1] ELSE l END, lambda x: starts_with(x, '-')), lambda x: trim(regexp_replace(x, '^-+', ''))), lambda x: x <> '' AND NOT starts_with(x, 'http')) AS k FROM s)
SELECT doc_id, CAST(len(k) AS BIGINT) AS n, md5(array_to_string(k, chr(10))) AS digest FROM k
""", "F27")
def description_lines(spark, sf_dir):
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when((i + 1) % 3 == 0, x).when((i + 1) % 7 == 0, "- http://x").otherwise(F.concat(F.lit("-- "), x)))
    kept = table(spark, sf_dir, "documents").select("doc_id", V.bullet_lines(F.array_join(lines, "\n"), STOPS).alias("k"))
    return kept.select("doc_id", F.size("k").cast("long").alias("n"), F.md5(F.array_join("k", "\n")).alias("digest"))


SELECTOR = "7, 0012,Customer#000000020, 500-x,,1003"


@query("chunk_selector", """
WITH c AS (SELECT c_custkey, c_name, CAST(c_custkey + 1 AS VARCHAR) AS n, concat(c_nationkey, '-', CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE 'y' END) AS stem FROM customer)
SELECT c_custkey, list_has_any([c_name, n, lpad(n, CAST(greatest(3, length(n)) AS INTEGER), '0'), stem], ['7', '007', '12', '012', 'Customer#000000020', '500-x', '1003']) AS selected FROM c
""", "F28")
def chunk_selector(spark, sf_dir):
    file = F.concat(F.lit("/data/chunk_"), "c_nationkey", F.lit("-"), F.when(F.col("c_custkey") % 2 == 0, "x").otherwise("y"), F.lit(".json"))
    return table(spark, sf_dir, "customer").select("c_custkey", V.selected(SELECTOR, F.col("c_name"), F.col("c_custkey"), file).alias("selected"))


PATHS = "CASE page_id % 6 WHEN 0 THEN concat('C:\\srv\\raw\\tube\\', page_id, '.json') WHEN 1 THEN concat('/home/x/processed/', page_id, '/a.JSON') WHEN 2 THEN concat('/mnt/store/', page_id, '/logs/b.csv') WHEN 3 THEN concat('/mnt/other/', page_id) WHEN 4 THEN concat('raw/', page_id, '/../../../etc') ELSE concat('exports/./', page_id, '/../c.md') END"
REBASED = "CASE page_id % 6 WHEN 0 THEN concat('/d/raw/tube/', page_id, '.json') WHEN 1 THEN concat('/d/processed/', page_id, '/a.JSON') WHEN 2 THEN concat('/d/', page_id, '/logs/b.csv') WHEN 5 THEN '/d/exports/c.md' END"


@query("rebased_paths", f"""
WITH p AS (SELECT page_id, {REBASED} AS path FROM pages)
SELECT page_id, path, CASE WHEN page_id % 6 = 0 THEN 'hls' WHEN page_id % 6 = 4 THEN 'raw' ELSE 'podcast' END AS origin, coalesce(page_id % 6 = 1 OR page_id % 6 = 5, false) AS publishable FROM p
""", "F31 F32 P15")
def rebased_paths(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(PATHS.replace("\\", "\\\\")).alias("from"))
    path = V.rebased(F.col("from"), "/d", "store", ("input", "raw", "processed", "exports", "logs", "cache"))
    relative = F.regexp_replace("path", "^/d/", "")
    kept = V.publishable(relative, (".json", ".md"), ("raw", "cache"))
    return rows.withColumn("path", path).select("page_id", "path", V.by_prefix(F.col("from"), {"C:": "hls", "raw/": "raw"}, "podcast").alias("origin"), F.coalesce(kept, F.lit(False)).alias("publishable"))


BROKEN = ", ".join(f"'{w}'" for w in T.BROKEN_WORDS)
DAMAGED = "CASE WHEN turn % 5 = 2 THEN text || ' sem edio' WHEN turn % 5 = 3 THEN 'plain words only' ELSE text END"


@query("encoding_status", rf"""
WITH t AS (SELECT conv_id, turn, {DAMAGED} AS text, role FROM conversations), u AS (SELECT conv_id, turn, 'text' AS field, text AS value FROM t UNION ALL SELECT conv_id, turn, 'role', role FROM t)
SELECT conv_id, turn, field, CASE WHEN len(list_intersect(regexp_extract_all(lower(value), '[\p{{L}}\p{{N}}_]+'), [{BROKEN}])) > 0 THEN 'fail' WHEN NOT regexp_matches(regexp_replace(value, '[\x00-\x7F]', '', 'g'), '\p{{L}}') THEN 'needs_revision' ELSE 'pass' END AS status FROM u
""", "P14 V02")
def encoding_status(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"{DAMAGED} AS text", "role")
    return rows.unpivot(["conv_id", "turn"], ["text", "role"], "field", "value").select("conv_id", "turn", "field", V.encoding_status(F.col("value")).alias("status"))


#: Labels and needles in order; the first that fits counts.
ERRORS = (("tool_path", ("exec format", "wrong path")), ("caption_empty", ("no segments", "coverage too low")), ("timeout", ("timed out", "timeout")), ("file_missing", ("is missing", "no such file")))
MESSAGE = "CASE event_id % 6 WHEN 0 THEN 'Read TIMED OUT; file is missing' WHEN 1 THEN concat('No such file: ', event_id) WHEN 2 THEN 'coverage too low after timeout' WHEN 3 THEN 'Exec Format error' WHEN 4 THEN '' ELSE event_type END"


@query("error_classes", f"""
SELECT event_type, CASE event_id % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'file_missing' WHEN 2 THEN 'caption_empty' WHEN 3 THEN 'tool_path' ELSE 'unclassified' END AS class, count(*) AS n FROM events GROUP BY 1, 2
""", "P18")
def error_classes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_type", f"{MESSAGE} AS message")
    return rows.groupBy("event_type", V.first_class(F.col("message"), ERRORS).alias("class")).agg(F.count(F.lit(1)).alias("n"))
