"""Parsing of captured texts and normalisation of what they hold. Captures are written from the driver's tables first, then parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.plans.base import query
from textloom.sources import parsers
from textloom.sources.tables import table


@query("timed_text", """
SELECT conv_id, turn, turn * 2.5 AS start, 1.0 + length(role) / 4.0 AS duration, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM conversations WHERE length(trim(text)) > 0
""", "SRC09")
def timed_text(spark, sf_dir):
    one_line = F.regexp_replace("text", r"\s+", " ")
    escaped = F.replace(F.replace(one_line, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.format_string('<transcript><text start="%s" dur="%s">%s</text></transcript>', (F.col("turn") * 2.5).cast("string"), (1 + F.length("role") / 4).cast("string"), escaped)
    turns = table(spark, sf_dir, "conversations").filter(F.length(F.trim("text")) > 0).select("conv_id", "turn", xml.alias("xml"))
    return parsers.timed_text(turns, "xml", "conv_id", "turn")


@query("playlist_variant", """
WITH v AS (SELECT conv_id, 'v' || turn || '.m3u8' AS url, CAST(100 + length(text) AS BIGINT) AS bandwidth, CAST(240 * (turn % 4 + 1) AS BIGINT) AS height FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY bandwidth, url) AS k FROM v WHERE height <= 720)
SELECT conv_id, url, bandwidth, height FROM r WHERE k = 1
""", "SRC26")
def playlist_variant(spark, sf_dir):
    stream = F.concat(F.lit("#EXT-X-STREAM-INF:AVERAGE-BANDWIDTH="), 100 + F.length("text"), F.lit(",RESOLUTION=1x"), 240 * (F.col("turn") % 4 + 1))
    playlist = F.concat_ws("\n", F.lit("#EXTM3U"), stream, F.concat(F.lit("v"), "turn", F.lit(".m3u8")))
    turns = table(spark, sf_dir, "conversations").select("conv_id", playlist.alias("playlist"))
    return parsers.lightest(parsers.variants(turns, "playlist", "conv_id"), "conv_id", 720)


@query("embedded_json", """
SELECT page_id, '{"u":{"v":"' || replace(replace(url, '\\', '\\\\'), '"', '\\"') || '"},"w":"}{\\""}' AS found FROM pages WHERE url IS NOT NULL
""", "SRC15")
def embedded_json(spark, sf_dir):
    quoted = F.replace(F.replace("url", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    script = F.concat(F.lit('<p>{</p><script>var state = {"u":{"v":"'), quoted, F.lit('"},"w":"}{\\""}; go({});</script>'), F.coalesce("html", F.lit("")))
    pages = table(spark, sf_dir, "pages").filter("url IS NOT NULL")
    return pages.select("page_id", parsers.balanced_json(script, "var state").alias("found"))


@query("mojibake_repair", """
SELECT doc_id, sha256(text) AS repaired_sha256, sha256(text) AS plain_sha256 FROM documents WHERE text IS NOT NULL
""", "F11")
def mojibake_repair(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", F.sha2(T.repair(misread), 256).alias("repaired_sha256"), F.sha2(T.repair(F.col("text")), 256).alias("plain_sha256"))


@query("number_values", r"""
WITH n AS (SELECT doc_id, unnest(regexp_extract_all(text, '[$]?[0-9]{1,9}(?:-[0-9]{1,9})?%?')) AS raw FROM documents),
p AS (SELECT doc_id, raw, regexp_extract(raw, '^[$]?([0-9]+)', 1) AS a, regexp_extract(raw, '-([0-9]+)', 1) AS b, CASE WHEN right(raw, 1) = '%' THEN 'percent' WHEN left(raw, 1) = '$' THEN 'currency' ELSE 'count' END AS unit_kind FROM n)
SELECT doc_id, raw, unit_kind, CASE WHEN b <> '' THEN 'baseline' ELSE 'value' END AS role, CAST(a AS BIGINT) AS value FROM p
UNION ALL SELECT doc_id, raw, unit_kind, 'result', CAST(b AS BIGINT) FROM p WHERE b <> ''
""", "F29")
def number_values(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[$]?[0-9]{1,9}(?:-[0-9]{1,9})?%?"), F.lit(0))).alias("raw"))
    unit = F.when(F.col("raw").endswith("%"), "percent").when(F.col("raw").startswith("$"), "currency").otherwise("count")
    low, high = F.regexp_extract("raw", r"^[$]?([0-9]+)", 1).cast("long"), F.regexp_extract("raw", r"-([0-9]+)", 1)

    def part(role: str, value):
        return F.struct(F.lit(role).alias("role"), value.alias("value"))

    parts = F.when(high != "", F.array(part("baseline", low), part("result", high.cast("long")))).otherwise(F.array(part("value", low)))
    return found.select("doc_id", "raw", unit.alias("unit_kind"), F.explode(parts).alias("p")).select("doc_id", "raw", "unit_kind", "p.role", "p.value")


#: Names and their themes; a parameter.
THEMES = {"en": "germanic", "de": "germanic", "fr": "romance", "es": "romance"}


@query("canonical_themes", """
WITH d AS (SELECT doc_id, [lang, source, lang] AS names, CASE WHEN lang IN ('en', 'de') THEN 'germanic' WHEN lang IN ('fr', 'es') THEN 'romance' ELSE 'other' END AS themes,
  lang NOT IN ('en', 'de', 'fr', 'es') AS odd, lang, source FROM documents)
SELECT doc_id, themes, concat_ws('|', CASE WHEN odd THEN lang END, CASE WHEN odd AND source = lang THEN NULL ELSE source END) AS rest FROM d
""", "F30")
def canonical_themes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", T.canonical(F.array("lang", "source", "lang"), THEMES, "other").alias("c"))
    return docs.select("doc_id", F.array_join("c.themes", "|").alias("themes"), F.array_join("c.rest", "|").alias("rest"))


@query("dossier_rows", """
SELECT conv_id, 'ok' AS state, CAST(turn AS VARCHAR) AS clean_index, role FROM conversations
""", "SRC04")
def dossier_rows(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    block = F.to_json(F.struct(F.lit("transcript_block").alias("record_type"), F.array(F.array(F.col("turn").cast("string"), "role")).alias("value")))
    head = turns.select("conv_id").distinct().select("conv_id", F.lit(-1).alias("number"), F.lit('{"record_type":"header","columns":["clean_index","role"]}').alias("line"))
    body = head.unionByName(turns.select("conv_id", F.col("turn").alias("number"), block.alias("line")))
    sums = body.groupBy("conv_id").agg(F.max("number").alias("top"), F.count(F.lit(1)).alias("count"), parsers.dossier_checksum(F.col("number"), F.col("line")).alias("checksum"))
    foot = sums.select("conv_id", (F.col("top") + 1).alias("number"), F.to_json(F.struct(F.lit("footer").alias("record_type"), "count", "checksum")).alias("line"))
    states, rows = parsers.dossiers(body.unionByName(foot), "conv_id", "number", "line")
    return rows.join(states, "conv_id").select("conv_id", "state", F.col("row")["clean_index"].alias("clean_index"), F.col("row")["role"].alias("role"))


@query("blinded_text", r"""
SELECT item_id, 'a [source-ref]' || chr(10) || '## Kept' || chr(10) || trim(text, ' ' || chr(10) || chr(9)) AS blinded FROM benchmark WHERE text IS NOT NULL AND NOT regexp_matches(text, '## |ins-[0-9]') AND length(trim(text)) > 0
""", "F23")
def blinded_text(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").filter("text IS NOT NULL AND NOT text RLIKE '## |ins-[0-9]' AND length(trim(text)) > 0")
    markdown = F.concat(F.lit("a ins-12\n## Source  Trace:\nx\n### y\n## Kept\n"), F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("\n## Evidence\nz"))
    return items.select("item_id", parsers.without_sections(markdown, ["source trace", "evidence"], "ins-[0-9]+").alias("blinded"))


@query("broken_words", f"""
SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(text || ' Vdeo, xedio nvel vdeo'), '[\\p{{L}}\\p{{N}}_]+')), lambda x: x IN {T.BROKEN_WORDS})), '|') AS broken FROM documents WHERE text IS NOT NULL
""", "F20")
def broken_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", F.array_join(T.broken_words(F.concat("text", F.lit(" Vdeo, xedio nvel vdeo"))), "|").alias("broken"))


@query("artefact_contexts", """
WITH a AS (SELECT item_id, replace(replace(text, '?', ''), chr(65533), '') AS a FROM benchmark WHERE text IS NOT NULL), t AS (SELECT item_id, length(a) AS n, a || ' vid?o ' || a || chr(65533) AS t FROM a),
c AS (SELECT item_id, 'orphan_question_mark' AS kind, substr(t, greatest(n + 3 - 40, 0) + 1, n + 46 - greatest(n + 3 - 40, 0)) AS x FROM t UNION ALL SELECT item_id, 'replacement_character', substr(t, greatest(length(t) - 41, 0) + 1) FROM t)
SELECT item_id, kind, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS excerpt FROM c
""", "F21")
def artefact_contexts(spark, sf_dir):
    plain = F.replace(F.replace("text", F.lit("?"), F.lit("")), F.lit("�"), F.lit(""))
    items = table(spark, sf_dir, "benchmark").filter("text IS NOT NULL")
    found = items.select("item_id", F.explode(T.artefact_contexts(F.concat(plain, F.lit(" vid?o "), plain, F.lit("�")))).alias("c"))
    return found.select("item_id", "c.kind", "c.excerpt")
