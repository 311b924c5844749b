"""Files, captions, logs, assets and sinks: written from the driver's tables into the shared folder or a column, and read back."""

from __future__ import annotations

import io
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.plans.base import query
from textloom.sources import assets, files
from textloom.sources.shared import shared_dir
from textloom.sources.tables import table


def place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("json_documents", """
SELECT 'nation' AS kind, n_nationkey AS id, n_name AS name, false AS broken FROM nation UNION ALL SELECT 'region', r_regionkey, r_name, false FROM region UNION ALL SELECT 'region', NULL, NULL, true
""", "SRC01")
def json_documents(spark, sf_dir):
    """A JSON file for each region and nation, one of them broken, by two patterns."""
    folder = place(spark, "documents")
    for name, letter in (("region", "r"), ("nation", "n")):
        rows = table(spark, sf_dir, name).select(F.col(f"{letter}_{name}key").cast("long").alias("id"), F.col(f"{letter}_name").alias("name"))
        rows.repartition(40, "id").write.option("maxRecordsPerFile", 1).json(f"{folder}/{name}")
    spark.range(1).select(F.lit('{"id": 7, "name": ').alias("x")).write.mode("append").text(f"{folder}/region")
    read = files.json_documents(spark, [f"{folder}/region/part-*", f"{folder}/nation/part-*"], "id LONG, name STRING")
    kind = F.regexp_extract("source_file", r"/(region|nation)/part-", 1)
    return read.select(kind.alias("kind"), "id", "name", F.col("corrupt").isNotNull().alias("broken"))


@query("latest_documents", """
SELECT c_custkey, max(o_orderkey) AS version FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'Fixture-' || o_custkey WHEN o_orderkey % 10 = 1 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS c_custkey FROM orders) WHERE NOT starts_with(lower(c_custkey), 'fixture') AND c_custkey <> '' GROUP BY 1
""", "SRC05 SRC03 SNK03")
def latest_documents(spark, sf_dir):
    """Orders as JSON lines with blank lines between; the last of a customer wins, fixtures and rows without a key go."""
    key = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("Fixture-"), "o_custkey")).when(F.col("o_orderkey") % 10 == 1, "").otherwise(F.col("o_custkey").cast("string"))
    lines = table(spark, sf_dir, "orders").select(F.concat(F.to_json(F.struct(key.alias("c_custkey"), F.col("o_orderkey").alias("version"))), F.lit("\n")).alias("line"))
    lines.write.text(path := place(spark, "lines"))
    return files.latest_per_key(files.json_lines(spark, path, "c_custkey STRING, version LONG"), "c_custkey", "version")


@query("csv_queue", """
SELECT o_orderkey, o_orderpriority AS note, row_number() OVER (ORDER BY CASE WHEN o_custkey % 3 = 0 THEN 1000000000 ELSE o_custkey END, o_orderkey) AS place FROM orders ORDER BY place LIMIT 200
""", "SRC02")
def csv_queue(spark, sf_dir):
    """All orders as a catalogue in CSV files that start with a byte order mark; its first 200 entries by a priority that may be no number."""
    priority = F.when(F.col("o_custkey") % 3 == 0, "soon").otherwise(F.col("o_custkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("\ufefforder"), priority.alias("priority"), F.col("o_orderpriority").alias("note"))
    rows.write.option("header", True).csv(path := place(spark, "queue"))
    read = files.csv_rows(spark, path, ["order", "priority", "note"]).withColumn("order", F.col("order").cast("long"))
    order = files.by_priority(read, "priority", "order")
    first = read.orderBy(*order).limit(200)
    return first.select(F.col("order").alias("o_orderkey"), "note", F.row_number().over(Window.orderBy(*order)).alias("place"))


@query("caption_events", """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS index, CAST(turn * 1.5 AS DOUBLE) AS start, CAST(CASE WHEN turn % 2 = 0 THEN 1.25 END AS DOUBLE) AS duration, trim(text || ' x') AS text FROM conversations QUALIFY turn % 5 <> 3
""", "SRC08")
def caption_events(spark, sf_dir):
    """A conversation's turns as caption JSON; every fifth event is blank."""
    segs = F.when(F.col("turn") % 5 == 3, F.array(F.struct(F.lit("  ").alias("utf8")))).otherwise(F.array(F.struct(F.col("text").alias("utf8")), F.struct(F.lit(" x").alias("utf8"))))
    event = F.struct("turn", (F.col("turn") * 1500).cast("double").alias("tStartMs"), F.when(F.col("turn") % 2 == 0, 1250.0).alias("dDurationMs"), segs.alias("segs"))
    payload = F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(event)), lambda e: e.dropFields("turn")).alias("events")))
    captures = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(payload.alias("payload"))
    return assets.caption_events(captures, "payload", "conv_id")


@query("caption_track", """
WITH r AS (SELECT user_id, event_id, event_type, CASE WHEN starts_with(event_type, 'pu') THEN 0 WHEN event_type = 'error' OR starts_with(event_type, 'error') THEN 1 ELSE 2 END AS r FROM events)
SELECT user_id, arg_min(event_id, r * 1000000000000 + event_id) AS event_id FROM r GROUP BY user_id
""", "SRC10")
def caption_track(spark, sf_dir):
    return assets.preferred_track(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type", ["PU-BR", "error"]).select("user_id", "event_id")


@query("log_segments", """
WITH l AS (SELECT conv_id, turn * 60 + 5 AS start, text FROM conversations WHERE turn < 6 AND length(trim(text)) > 0)
SELECT conv_id, start, lead(start) OVER (PARTITION BY conv_id ORDER BY start) - start AS duration, trim(text) AS text FROM (SELECT conv_id, start, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM l)
""", "SRC11")
def log_segments(spark, sf_dir):
    """A log for each conversation: a head, the marker, a time line and two text lines a turn, and a tail after turn 5 that is no part of it."""
    one_line = F.trim(F.regexp_replace("text", r"\s+", " "))
    said = F.when(F.col("turn") < 6, F.array(F.format_string("  %d:05", "turn"), F.concat(F.lit("  "), one_line), F.lit("  and more of it"))).otherwise(F.array(F.concat(F.lit("- after "), "turn"), F.lit("  9:59"), F.lit("  no")))
    rows = table(spark, sf_dir, "conversations").filter(F.length(F.trim("text")) > 0).select("conv_id", F.posexplode(said).alias("k", "line"), "turn")
    head = table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", F.posexplode(F.array(F.lit("  0:07"), F.lit("  not yet"), F.lit("Transcript:"))).alias("k", "line"), F.lit(-1).cast("long").alias("turn"))
    lines = head.unionByName(rows).select("conv_id", (F.col("turn") * 10 + F.col("k")).alias("n"), "line")
    return assets.log_segments(lines, "conv_id", "n", "line", r"^Transcript:", r"^\S", r"^\d+:\d\d$")


@query("whole_captures", """
WITH s AS (SELECT conv_id, turn, CAST(CASE WHEN conv_id % 3 = 0 AND turn = 2 THEN 1 ELSE turn * 4 END AS DOUBLE) AS start, text FROM conversations WHERE turn % 4 <> 1 AND length(trim(text)) > 0),
o AS (SELECT *, lag(start) OVER (PARTITION BY conv_id ORDER BY turn) > start AS back, lead(start) OVER (PARTITION BY conv_id ORDER BY turn) - start AS duration FROM s)
SELECT conv_id, start, duration, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM o WHERE conv_id NOT IN (SELECT conv_id FROM o WHERE back)
""", "SRC12")
def whole_captures(spark, sf_dir):
    start = F.when(F.col("turn") % 4 != 1, F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 2), 1).otherwise(F.col("turn") * 4)).cast("double")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", start.alias("start"), "text")
    return assets.whole_captures(rows, "conv_id", "turn", "start", "text")


@query("foreign_segments", """
WITH s AS (SELECT conv_id, turn, CAST((20 - turn) * 5 AS DOUBLE) AS start, CASE WHEN turn % 2 = 0 THEN 2.5 ELSE 0.0 END AS duration, trim(text) AS text FROM conversations WHERE length(trim(text)) > 0)
SELECT conv_id, CAST(row_number() OVER w - 1 AS INTEGER) AS index, start, CASE WHEN duration <= 0 THEN coalesce(greatest(lead(start) OVER w - start, 0), duration) ELSE duration END AS duration, text FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY start, turn)
""", "SRC13")
def foreign_segments(spark, sf_dir):
    """Turns back to front, their starts given in three ways."""
    at = (20 - F.col("turn")) * 5
    rows = table(spark, sf_dir, "conversations").filter("turn <= 20").select(
        "conv_id", "turn", F.when(F.col("turn") % 3 == 0, at.cast("double")).alias("start_seconds"), F.when(F.col("turn") % 3 == 1, at.cast("double")).alias("start"),
        F.format_string("%d:%02d", F.floor(at / 60), at % 60).alias("timestamp"), F.when(F.col("turn") % 2 == 0, 2.5).otherwise(-1.0).alias("duration"), "text",
    )
    return assets.foreign_segments(rows, "conv_id", "turn")


URLS = ("lpad(CAST(page_id AS STRING), 11, '-')", "concat('https://short.tv/', page_id, '/x')", "concat('http://www.Tube.com/watch?a=1&v=w', page_id, '&t=3#f')", "concat('https://tube.com/shorts/s', page_id, '/')", "concat('https://tube.com/about/', page_id)", "'no url at all'")


@query("video_ids", """
SELECT page_id, CASE page_id % 6 WHEN 0 THEN lpad(CAST(page_id AS VARCHAR), 11, '-') WHEN 1 THEN CAST(page_id AS VARCHAR) WHEN 2 THEN 'w' || page_id WHEN 3 THEN 's' || page_id END AS id FROM pages
""", "SRC14")
def video_ids(spark, sf_dir):
    url = F.expr("CASE page_id % 6 " + " ".join(f"WHEN {i} THEN {u}" for i, u in enumerate(URLS)) + " END")
    return table(spark, sf_dir, "pages").select("page_id", assets.video_id(url, "short.tv", "tube.com").alias("id"))


@query("nested_records", """
WITH r AS (SELECT conv_id, turn, CAST(turn % 3 AS VARCHAR) AS id, CASE WHEN turn >= 3 THEN role END AS title FROM conversations), g AS (SELECT conv_id, id, min(turn) AS t, arg_min(title, turn) FILTER (title IS NOT NULL) AS title, 'next-' || conv_id AS token FROM r GROUP BY conv_id, id)
SELECT conv_id, id, title, token FROM g
""", "SRC16")
def nested_records(spark, sf_dir):
    """Turns as objects of a nested payload with repeated ids; titles are missing at first."""
    item = F.struct("turn", F.struct(F.struct(F.col("turn") % 3, F.when(F.col("turn") >= 3, F.col("role")).alias("title")).alias("card")).alias("row"))
    inner = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(F.struct(F.struct(x["row"]["card"]["col1"].alias("id"), x["row"]["card"]["title"].alias("title")).alias("card")).alias("row")))
    payload = F.to_json(F.struct(F.struct(inner.alias("items")).alias("contents"), F.struct(F.concat(F.lit("next-"), "conv_id").alias("token")).alias("more")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(payload.alias("payload"))
    found = assets.nested_records(rows, "payload", "id", ["title"], "token", "conv_id").withColumn("token", F.col("tokens")[0])
    merged = assets.merged_records(found, "conv_id", ["title", "token"])
    return merged.select("conv_id", "id", "title", "token")


TITLED = "list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i % 5 = 1 THEN concat('# ', x) WHEN i % 4 = 0 THEN ' ' ELSE x END)"


@query("text_blocks", f"""
WITH d AS (SELECT doc_id, {TITLED} AS l FROM documents), e AS (SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM d), x AS (SELECT doc_id, i, trim(raw) AS x FROM e),
m AS (SELECT doc_id, i, x, starts_with(x, '#') AS t, sum(CASE WHEN x = '' OR starts_with(x, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS block, max(CASE WHEN starts_with(x, '#') THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS ti FROM x),
b AS (SELECT doc_id, block, min(ti) AS ti, trim(regexp_replace(regexp_replace(string_agg(x, chr(10) ORDER BY i), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM m WHERE x <> '' AND NOT t GROUP BY 1, 2),
n AS (SELECT b.doc_id, b.block, nullif(trim(regexp_replace(m.x, '^#+', '')), '') AS section_title, text FROM b LEFT JOIN m ON m.doc_id = b.doc_id AND m.i = b.ti WHERE text <> ''),
a AS (SELECT doc_id, 0 AS block, NULL AS section_title, trim(regexp_replace(array_to_string(l, ' '), '\\s+', ' ', 'g')) AS text FROM d WHERE doc_id NOT IN (SELECT doc_id FROM n))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block) - 1 AS INTEGER) AS index, section_title, md5(text) AS digest FROM (SELECT * FROM n UNION ALL SELECT * FROM a WHERE text <> '')
""", "SRC19")
def text_blocks(spark, sf_dir):
    """Documents with some lines made titles and some blank."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when((i + 1) % 5 == 1, F.concat(F.lit("# "), x)).when((i + 1) % 4 == 0, " ").otherwise(x))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    return assets.text_blocks(docs, "doc_id", "text").select("doc_id", "index", "section_title", F.md5("text").alias("digest"))


@query("csv_segments", """
WITH r AS (SELECT c_nationkey, c_custkey, concat('name: ', c_name, '; segment: ', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END) AS text, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1 AS row FROM customer)
SELECT c_nationkey, CAST(row - 2 AS INTEGER) AS index, concat('CSV row ', row) AS section_title, concat('A', row, ':B', row) AS locator, trim(text) AS text FROM r
""", "SRC20")
def csv_segments(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"))
    return assets.csv_segments(rows, "c_nationkey", "c_custkey", ["name", "segment"])


def office_files(turns):
    """A document, a sheet, slides, or something else, for each conversation."""

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        conv, texts = int(frame["conv_id"].iloc[0]), [escape(" ".join(x.split())) for x in frame.sort_values("turn")["text"]]
        parts: dict[str, str] = {}
        if conv % 4 == 0:
            body = "".join(f"<p><pPr><pStyle val='Heading1'/></pPr><r><t>Part {i}</t></r></p><p><r><t>{x}</t></r></p><p/>" for i, x in enumerate(texts))
            parts["word/document.xml"] = f"<document><body>{body}<tbl><tr><tc><p><r><t>a</t></r></p></tc><tc><p><r><t>b</t></r></p></tc></tr></tbl></body></document>"
        elif conv % 4 == 1:
            parts["xl/workbook.xml"] = "<workbook><sheets><sheet name='S'/></sheets></workbook>"
            parts["xl/sharedStrings.xml"] = "<sst>" + "".join(f"<si><t>{x}</t></si>" for x in texts) + "</sst>"
            parts["xl/worksheets/sheet1.xml"] = "<worksheet><sheetData>" + "".join(f"<row r='{i + 1}'><c r='A{i + 1}' t='s'><v>{i}</v></c><c r='C{i + 1}'><v>{i}</v></c></row><row r='{i + 900}'/>" for i in range(len(texts))) + "</sheetData></worksheet>"
        elif conv % 4 == 2:
            parts |= {f"ppt/slides/slide{i + 1}.xml": f"<sld><p><r><t>{x}</t></r></p></sld>" for i, x in enumerate(texts)}
        else:
            parts["x"] = "y"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, x in parts.items():
                z.writestr(name, x)
        return pd.DataFrame([(conv, f"f{conv}{('.docx', '.xlsx', '.pptx', '.pdf')[conv % 4]}", out.getvalue())], columns=["conv_id", "name", "content"])

    return turns.select("conv_id", "turn", "text").groupBy("conv_id").applyInPandas(make, "conv_id long, name string, content binary")


@query("office_segments", """
WITH t AS (SELECT conv_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS i FROM conversations WHERE length(trim(text)) > 0)
SELECT conv_id, i AS index, CASE conv_id % 4 WHEN 0 THEN concat('Part ', i) WHEN 1 THEN 'S' ELSE concat('Slide ', i + 1) END AS section_title, CASE conv_id % 4 WHEN 1 THEN concat('A', i + 1, ':C', i + 1) WHEN 2 THEN CAST(i + 1 AS VARCHAR) END AS locator, CASE WHEN conv_id % 4 = 1 THEN concat('A: ', text, '; C: ', i) ELSE text END AS text, false AS failed FROM t WHERE conv_id % 4 <> 3
UNION ALL SELECT conv_id, CAST(max(i) + 1 AS INTEGER), 'Table 1', NULL, 'a | b', false FROM t WHERE conv_id % 4 = 0 GROUP BY 1 UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS INTEGER), NULL, NULL, NULL, true FROM t WHERE conv_id % 4 = 3
""", "SRC18 SRC22 SRC23 SRC24")
def office_segments(spark, sf_dir):
    found = assets.office_segments(office_files(table(spark, sf_dir, "conversations")), "conv_id", "name", "content")
    return found.select("conv_id", "index", "section_title", "locator", "text", F.col("error").isNotNull().alias("failed"))


@query("registered_files", """
SELECT page_id, concat(page_id, '-asset-', left(sha256(coalesce(html, '')), 12)) AS asset_id, CASE page_id % 3 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' ELSE 'other' END AS asset_type, sha256(coalesce(html, '')) AS sha256, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS bytes FROM pages
""", "SRC25")
def registered_files(spark, sf_dir):
    name = F.concat(F.lit("a/b."), F.when(F.col("page_id") % 3 == 0, "HTML").when(F.col("page_id") % 3 == 1, "pdf").otherwise("bin"))
    rows = table(spark, sf_dir, "pages").select("page_id", name.alias("name"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    return assets.registered(rows, "page_id", "name", "content", {".html": "html", ".pdf": "pdf"})


@query("flat_export", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, concat(c_mktsegment, '|', c_nationkey) AS tags, concat('a=', c_nationkey, '; b=', CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END) AS info, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'say "hi", ' || c_name END AS note, CAST(NULL AS VARCHAR) AS absent FROM customer
""", "SNK01")
def flat_export(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("tags"), F.struct(F.col("c_nationkey").alias("a"), F.when(F.col("c_custkey") % 2 == 0, "x").alias("b")).alias("info"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit('say "hi", '), "c_name")).alias("note"),
    )
    names = ["c_custkey", "tags", "info", "note", "absent"]
    files.write_csv(rows, path := place(spark, "export"), names)
    return files.csv_rows(spark, path, names)


@query("json_export", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS c_name, c_nationkey FROM customer
""", "SNK02")
def json_export(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"), "c_nationkey")
    files.write_json(rows, path := place(spark, "json"))
    return files.json_lines(spark, path, "c_custkey LONG, c_name STRING, c_nationkey INT")


@query("published_snapshot", "SELECT 2 AS files, true AS same_hash, CAST(0 AS BIGINT) AS problems, CAST(1 AS BIGINT) AS after_change", "SNK04")
def published_snapshot(spark, sf_dir):
    """Two exports published twice over an older snapshot, a file of a suffix that isn't allowed left out; then one file is changed in place."""
    source, out = place(spark, "source"), place(spark, "published")
    for name in ("region", "nation"):
        table(spark, sf_dir, name).coalesce(1).write.json(f"{source}/{name}")
    table(spark, sf_dir, "region").selectExpr("r_name").coalesce(1).write.text(f"{source}/notes")
    hashes = [files.publish(spark, source, out, [".json"]) for _ in range(2)]
    expected, actual = files.manifest(spark, source, [".json"]), files.manifest(spark, out, [".json"])
    changed = actual.withColumn("sha256", F.when(F.startswith("path", F.lit("region")), F.lit("0")).otherwise(F.col("sha256")))
    counts = actual.agg(F.count(F.lit(1)).cast("int").alias("files")).crossJoin(files.differences(expected, actual).agg(F.count(F.lit(1)).alias("problems"))).crossJoin(files.differences(expected, changed).agg(F.count(F.lit(1)).alias("after_change")))
    return counts.withColumn("same_hash", F.lit(hashes[0] == hashes[1] == files.manifest_hash(actual)))


@query("source_summaries", """
WITH t AS (SELECT d.source, lang, quality, d.doc_id, n_chars FROM documents d LEFT JOIN labels USING (doc_id)), c AS (SELECT source, lang, count(*) AS n FROM t GROUP BY 1, 2), l AS (SELECT source, string_agg(concat(lang, ' (', n, ')'), ', ' ORDER BY n DESC, lang) AS langs FROM c GROUP BY 1),
k AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY quality DESC NULLS LAST, n_chars DESC, doc_id) AS r FROM t), o AS (SELECT source, string_agg(concat('- document ', doc_id), chr(10) ORDER BY r) AS top FROM k WHERE r <= 10 GROUP BY 1), p AS (SELECT source, count(*) AS n, count(*) FILTER (quality IS NULL) AS pending FROM t GROUP BY 1)
SELECT source, concat('# ', source, chr(10), 'Documents: ', n, chr(10), 'Languages: ', langs, chr(10), top, chr(10), 'Pending: ', pending) AS report FROM p JOIN l USING (source) JOIN o USING (source)
""", "SNK06 G03")
def source_summaries(spark, sf_dir):
    """A report in Markdown for each source: languages by count, ten documents by quality and length, and how many are unlabelled."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    langs = rows.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).groupBy("source")
    langs = langs.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "lang", "n"))), lambda x: F.concat(x["lang"], F.lit(" ("), x["n"], F.lit(")"))), ", ").alias("langs"))
    best = Window.partitionBy("source").orderBy(F.desc_nulls_last("quality"), F.desc("n_chars"), "doc_id")
    top = rows.withColumn("r", F.row_number().over(best)).filter("r <= 10").groupBy("source").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "doc_id"))), lambda x: F.concat(F.lit("- document "), x["doc_id"])), "\n").alias("top"))
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("pending"))
    report = F.concat_ws("\n", F.concat(F.lit("# "), "source"), F.concat(F.lit("Documents: "), "n"), F.concat(F.lit("Languages: "), "langs"), "top", F.concat(F.lit("Pending: "), "pending"))
    return counts.join(langs, "source").join(top, "source").select("source", report.alias("report"))
