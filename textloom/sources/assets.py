"""Assets as text segments: captions, logs, text blocks, CSV rows and zipped office documents; video ids and records in nested JSON."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T

CAPTIONS = "events ARRAY<STRUCT<tStartMs: DOUBLE, dDurationMs: DOUBLE, segs: ARRAY<STRUCT<utf8: STRING>>>>"
SEGMENTS = "section_title string, locator string, text string"


def caption_events(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    """(keep, index, start, duration, text) of the events of caption JSON that have text; the index counts all events."""
    each = rows.select(*keep, F.posexplode(F.from_json(payload, CAPTIONS)["events"]).alias("index", "e"))
    text = F.trim(F.array_join(F.transform(F.coalesce("e.segs", F.array().cast("array<struct<utf8:string>>")), lambda s: F.coalesce(s["utf8"], F.lit(""))), ""))
    seconds = lambda c: F.bround(F.col(c) / 1000, 3)
    return each.select(*keep, "index", F.coalesce(seconds("e.tStartMs"), F.lit(0.0)).alias("start"), seconds("e.dDurationMs").alias("duration"), text.alias("text")).filter("text != ''")


def preferred_track(tracks: DataFrame, by: str, position: str, language: str, preferred: Sequence[str]) -> DataFrame:
    """The track of each key whose language is, or begins with the first part of, the earliest preferred one; else the first track."""
    low = F.lower(F.coalesce(language, F.lit("")))
    rank = F.lit(len(preferred))
    for i, p in reversed(list(enumerate(preferred))):
        rank = F.when((low == p.lower()) | F.startswith(low, F.lit(p.lower().split("-")[0])), i).otherwise(rank)
    best = F.min_by(F.struct("*"), F.struct(F.when(rank < len(preferred), rank).otherwise(len(preferred)), position))
    return tracks.groupBy(by).agg(best.alias("t")).select("t.*")


def log_segments(rows: DataFrame, by: str, order: str, line: str, marker: str, stop: str, stamp: str) -> DataFrame:
    """(by, start, duration, text): text lines after the ``marker`` and before the next ``stop`` line, each with the timestamp line before it; a second text line of one timestamp goes."""
    w = Window.partitionBy(by).orderBy(order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.select(by, order, F.trim(line).alias("x"), F.col(line).alias("raw"))
    marked = marked.withColumn("began", F.max(F.col("raw").rlike(marker)).over(so_far)).withColumn("ended", F.max(F.col("began") & F.col("raw").rlike(stop) & ~F.col("raw").rlike(marker)).over(so_far))
    inside = marked.filter("began AND NOT ended").filter(~F.col("raw").rlike(marker) & (F.col("x") != ""))
    stamped = inside.withColumn("at", F.when(F.col("x").rlike(stamp), T.base60(F.col("x")))).withColumn("number", F.count("at").over(so_far)).withColumn("start", F.last("at", ignorenulls=True).over(so_far))
    first = stamped.filter("at IS NULL AND start IS NOT NULL").groupBy(by, "number").agg(F.min_by(F.struct("start", "x"), order).alias("s"))
    return first.select(by, F.col("s.start").alias("start"), (F.lead("s.start").over(Window.partitionBy(by).orderBy("number")) - F.col("s.start")).alias("duration"), F.col("s.x").alias("text"))


def whole_captures(rows: DataFrame, by: str, order: str, start: str, text: str) -> DataFrame:
    """(by, start, duration, text) of captures whose starts never go backwards; one that does voids its whole capture. Rows without a start or text go first."""
    w = Window.partitionBy(by).orderBy(order)
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    kept = rows.select(by, order, F.col(start).alias("start"), flat.alias("text")).filter("start IS NOT NULL AND text != ''")
    kept = kept.withColumn("back", F.coalesce(F.col("start") < F.lag("start").over(w), F.lit(False))).withColumn("duration", F.lead("start").over(w) - F.col("start"))
    sound = kept.groupBy(by).agg(F.max("back").alias("void")).filter("NOT void").select(by)
    return kept.join(sound, by, "left_semi").select(by, "start", "duration", "text")


def foreign_segments(rows: DataFrame, by: str, position: str) -> DataFrame:
    """(by, index, start, duration, text) of transcripts of other tools: columns start_seconds, start, timestamp, duration, text. Sorted by start; what has no positive duration lasts until the next start."""
    start = F.bround(F.coalesce(F.col("start_seconds"), F.col("start"), T.base60(F.col("timestamp")).cast("double")), 3)
    given = F.bround(F.greatest(F.coalesce("duration", F.lit(0.0)), F.lit(0.0)), 3)
    kept = rows.select(by, position, start.alias("start"), given.alias("duration"), F.trim("text").alias("text")).filter("text != ''")
    w = Window.partitionBy(by).orderBy("start", position)
    after = F.bround(F.greatest(F.lead("start").over(w) - F.col("start"), F.lit(0.0)), 3)
    return kept.select(by, (F.row_number().over(w) - 1).alias("index"), "start", F.when((F.col("duration") <= 0) & after.isNotNull(), after).otherwise(F.col("duration")).alias("duration"), "text")


def video_id(url: Column, short_host: str, host: str) -> Column:
    """The id in a bare id, a short link, or a watch, shorts, live or embed link of ``host``; null otherwise."""
    value = F.trim(url)
    at, path = F.lower(F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*?)/*(?:[?#]|$)", 1)
    query = F.regexp_extract(value, r"\?(?:[^#]*&)?v=([^&#]+)", 1)
    placed = F.regexp_extract(path, r"^(?:shorts|live|embed)/([^/]+)", 1)
    found = F.when(F.contains(at, F.lit(short_host)) & (path != ""), F.split(path, "/")[0]).when(F.contains(at, F.lit(host)), F.coalesce(F.nullif(query, F.lit("")), F.nullif(placed, F.lit(""))))
    return F.when(value.rlike("^[A-Za-z0-9_-]{11}$"), value).otherwise(found)


def nested_records(rows: DataFrame, payload: str, key: str, fields: Sequence[str], token: str, *keep: str) -> DataFrame:
    """(keep, position, id, fields, tokens): every object with ``key`` anywhere in a JSON payload, in its order, and the payload's ``token`` values. Depth is beyond a schema, so this runs in Arrow batches."""

    @F.pandas_udf("struct<records array<struct<id string, values array<string>>>, tokens array<string>>")
    def walk(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                records, tokens, todo = [], [], []
                try:
                    todo = [json.loads(text)] if text else []
                except ValueError:
                    pass
                while todo:
                    x = todo.pop()
                    if isinstance(x, dict):
                        if key in x and not isinstance(x[key], (dict, list)):
                            records.append({"id": str(x[key]), "values": [None if x.get(f) is None else str(x[f]) for f in fields]})
                        if isinstance(x.get(token), str):
                            tokens.append(x[token])
                        todo += reversed(list(x.values()))
                    elif isinstance(x, list):
                        todo += reversed(x)
                out.append((records, tokens))
            yield pd.DataFrame(out, columns=["records", "tokens"])

    found = rows.select(*keep, walk(F.col(payload)).alias("f"))
    each = found.select(*keep, "f.tokens", F.posexplode("f.records").alias("position", "r"))
    return each.select(*keep, "position", F.col("r.id").alias("id"), *[F.col("r.values")[i].alias(f) for i, f in enumerate(fields)], "tokens")


def merged_records(records: DataFrame, by: str, fields: Sequence[str]) -> DataFrame:
    """One row per key and id: its first position, and of each field the first value that isn't null."""
    return records.groupBy(by, "id").agg(F.min("position").alias("position"), *[F.min_by(f, F.when(F.col(f).isNotNull(), F.col("position"))).alias(f) for f in fields])


def text_blocks(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, index, section_title, text): blocks of lines between blank lines; a line that starts with # ends a block and titles what follows. Text of titles alone is one block."""
    each = rows.select(key, F.posexplode(F.split(text, r"\r?\n", -1)).alias("line", "x")).withColumn("x", F.trim("x"))
    w = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    titles = F.when(F.startswith("x", F.lit("#")), F.struct(F.nullif(F.trim(F.regexp_replace("x", "^#+", "")), F.lit("")).alias("t")))
    marked = each.withColumn("title", F.last(titles, ignorenulls=True).over(w)["t"]).withColumn("block", F.sum(((F.col("x") == "") | F.startswith("x", F.lit("#"))).cast("int")).over(w))
    content = marked.filter((F.col("x") != "") & ~F.startswith("x", F.lit("#")))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "x"))), lambda s: s["x"]), "\n")
    blocks = content.groupBy(key, "block").agg(F.first("title").alias("section_title"), T.strip_html(joined).alias("text")).filter("text != ''")
    alone = rows.join(blocks.select(key).distinct(), key, "left_anti").select(key, F.lit(0).cast("long").alias("block"), F.lit(None).cast("string").alias("section_title"), T.strip_html(F.col(text)).alias("text")).filter("text != ''")
    order = Window.partitionBy(key).orderBy("block")
    return blocks.unionByName(alone).select(key, (F.row_number().over(order) - 1).alias("index"), "section_title", "text")


def csv_segments(rows: DataFrame, key: str, position: str, names: Sequence[str]) -> DataFrame:
    """(key, index, section_title, locator, text): each CSV row as ``header: value`` pairs; rows are counted from 2, below the header."""
    text = T.strip_html(F.concat_ws("; ", *[F.concat(F.lit(f"{n}: "), F.coalesce(F.col(n).cast("string"), F.lit(""))) for n in names]))
    number = F.row_number().over(Window.partitionBy(key).orderBy(position)) + 1
    last = chr(ord("A") + max(len(names) - 1, 0))
    made = rows.select(key, number.alias("row"), text.alias("text")).filter("text != ''")
    index = F.row_number().over(Window.partitionBy(key).orderBy("row")) - 1
    return made.select(key, index.alias("index"), F.format_string("CSV row %d", "row").alias("section_title"), F.format_string(f"A%d:{last}%d", "row", "row").alias("locator"), "text")


def _tag(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def _texts(node: ElementTree.Element, tag: str = "t") -> str:
    return "".join(x.text or "" for x in node.iter() if _tag(x) == tag)


def docx_segments(file: zipfile.ZipFile) -> Iterator[tuple[str | None, str | None, str]]:
    """Runs of paragraphs between blank ones, under the last heading; then one segment per table."""
    body = next(x for x in ElementTree.fromstring(file.read("word/document.xml")) if _tag(x) == "body")
    title, run, tables = None, [], []
    for part in [*body, None]:
        kind = None if part is None else _tag(part)
        if kind == "tbl":
            rows = [" | ".join(" ".join(filter(None, (_texts(p) for p in cell.iter() if _tag(p) == "p"))) for cell in row if _tag(cell) == "tc") for row in part if _tag(row) == "tr"]
            tables.append("\n".join(rows))
            continue
        if kind not in ("p", None):
            continue
        text = "" if part is None else _texts(part).strip()
        style = "" if part is None else next((str(v) for s in part.iter() if _tag(s) == "pStyle" for v in s.attrib.values()), "")
        heading = re.match(r"(?i)heading|t[ií]tulo", style)
        if run and (not text or heading):
            yield title, None, "\n".join(run)
            run = []
        if heading:
            title = text or title
        elif text:
            run.append(text)
    for i, text in enumerate(tables, 1):
        if text.strip(" |\n"):
            yield f"Table {i}", None, text


def xlsx_segments(file: zipfile.ZipFile) -> Iterator[tuple[str | None, str | None, str]]:
    """Sheet rows that aren't empty, as ``A: value`` pairs."""
    shared = [_texts(x) for x in ElementTree.fromstring(file.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in file.namelist() else []
    sheets = [x.attrib["name"] for x in ElementTree.fromstring(file.read("xl/workbook.xml")).iter() if _tag(x) == "sheet"]
    for n, sheet in enumerate(sheets, 1):
        for row in (x for x in ElementTree.fromstring(file.read(f"xl/worksheets/sheet{n}.xml")).iter() if _tag(x) == "row"):
            cells = []
            for c in row:
                value = _texts(c) if c.attrib.get("t") == "inlineStr" else _texts(c, "v")
                value = shared[int(value)] if c.attrib.get("t") == "s" and value else value
                if value.strip():
                    cells.append((re.match("[A-Z]+", c.attrib["r"])[0], value.strip()))
            if cells:
                yield sheet, f"{cells[0][0]}{row.attrib['r']}:{cells[-1][0]}{row.attrib['r']}", "; ".join(f"{a}: {v}" for a, v in cells)


def pptx_segments(file: zipfile.ZipFile) -> Iterator[tuple[str | None, str | None, str]]:
    """The text of each slide that has some."""
    slides = sorted((int(m[1]), name) for name in file.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", name)))
    for n, name in slides:
        lines = [t for p in ElementTree.fromstring(file.read(name)).iter() if _tag(p) == "p" and (t := _texts(p).strip())]
        if lines:
            yield f"Slide {n}", str(n), "\n".join(lines)


OFFICE = {".docx": docx_segments, ".xlsx": xlsx_segments, ".pptx": pptx_segments}


def office_segments(rows: DataFrame, key: str, name: str, content: str) -> DataFrame:
    """(key, index, section_title, locator, text, error) of zipped office documents by suffix. One that can't be read, or of another kind, is one row with an ``error``."""
    kind = rows.schema[key].dataType.simpleString()

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, file, raw in zip(frame[key], frame[name], frame[content], strict=True):
                suffix = file[file.rfind(".") :].lower() if "." in (file or "") else ""
                try:
                    if suffix not in OFFICE:
                        raise ValueError(f"unsupported: {suffix or file}")
                    found = list(OFFICE[suffix](zipfile.ZipFile(io.BytesIO(raw))))
                    out += [(k, i, *s, None) for i, s in enumerate(found)]
                except (ValueError, KeyError, StopIteration, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    out.append((k, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, "index", "section_title", "locator", "text", "error"]).astype({"index": "Int32"})

    return rows.select(key, name, content).mapInPandas(parse, f"{key} {kind}, index int, {SEGMENTS}, error string")


def registered(rows: DataFrame, owner: str, name: str, content: str, types: Mapping[str, str]) -> DataFrame:
    """(owner, asset_id, asset_type, sha256, bytes) of files, named by their content: ``{owner}-asset-{first 12 of the hash}``."""
    sha, suffix = F.sha2(content, 256), F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1))
    kind = F.lit("other")
    for s, t in types.items():
        kind = F.when(suffix == s, t).otherwise(kind)
    return rows.select(owner, F.concat(F.col(owner).cast("string"), F.lit("-asset-"), F.left(sha, F.lit(12))).alias("asset_id"), kind.alias("asset_type"), sha.alias("sha256"), F.octet_length(content).cast("long").alias("bytes"))
