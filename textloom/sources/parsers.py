"""Parsers of captured text: timed-text XML, HLS master playlists, and JSON inside of scripts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMED_TEXT = "text ARRAY<STRUCT<_VALUE: STRING, _start: DOUBLE, _dur: DOUBLE>>"


def timed_text(df: DataFrame, xml: str, *keep: str) -> DataFrame:
    """(keep, start, duration, text) for each ``<text start dur>`` of an XML document; documents that can't be parsed or have none give no rows."""
    rows = df.select(*keep, F.explode(F.from_xml(xml, TIMED_TEXT, {"mode": "PERMISSIVE"})["text"]).alias("t"))
    return rows.select(*keep, F.col("t._start").alias("start"), F.col("t._dur").alias("duration"), F.col("t._VALUE").alias("text"))


def variants(df: DataFrame, playlist: str, *keep: str) -> DataFrame:
    """(keep, url, bandwidth, height) for each variant of a master playlist: a stream line and the line after it. Attributes that are missing are null."""
    lines = F.split(playlist, r"\r?\n")
    pairs = F.filter(F.arrays_zip(lines.alias("info"), F.slice(lines, 2, F.size(lines)).alias("url")), lambda x: x["info"].startswith("#EXT-X-STREAM-INF:") & x["url"].isNotNull())
    rows = df.select(*keep, F.explode(pairs).alias("v"))

    def number(pattern: str) -> Column:
        return F.nullif(F.regexp_extract("v.info", pattern, 1), F.lit("")).cast("long")

    return rows.select(*keep, F.col("v.url").alias("url"), number(r"AVERAGE-BANDWIDTH=(\d+)").alias("bandwidth"), number(r"RESOLUTION=\d+x(\d+)").alias("height"))


def lightest(found: DataFrame, key: str, max_height: int) -> DataFrame:
    """The variant of least bandwidth of each ``key`` among those no higher than ``max_height``; ties go to the least url."""
    fit = found.filter(F.col("height") <= max_height)
    return fit.groupBy(key).agg(F.min(F.struct("bandwidth", "url", "height")).alias("v")).select(key, "v.url", "v.bandwidth", "v.height")


def _balanced(text: str | None, marker: str) -> str | None:
    at = -1 if text is None else text.find(marker)
    start = -1 if at < 0 else text.find("{", at + len(marker))
    depth, quoted, i = 0, False, start
    while 0 <= i < len(text or ""):
        c = text[i]
        if quoted:
            i += c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[start : i + 1]
        i += 1
    return None


def balanced_json(text: Column, marker: str) -> Column:
    """The first object in braces after ``marker``, heeding strings and escapes; null without one that closes. Nesting is beyond regular patterns, so this runs in Arrow batches."""

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: _balanced(x, marker))

    return cut(text)


def dossier_checksum(number: Column, line: Column) -> Column:
    """What a footer states of the lines before it: a sum over numbered lines, which needs no order."""
    return F.sum(F.crc32(F.concat_ws(":", number.cast("string"), line)))


def dossiers(lines: DataFrame, key: str, number: str, line: str) -> tuple[DataFrame, DataFrame]:
    """Dossiers of typed JSON lines: a header first with the column names, a footer last with count and checksum, blocks of positional rows between.

    Gives (key, state) with state ok, no_header, no_footer, count or checksum, and (key, row) with the rows of blocks as maps from column to text.
    Fields that a row lacks are null. Lines that aren't JSON have no type.
    """
    record = F.from_json(line, "record_type string, columns array<string>, value string, count long, checksum long")
    rows = lines.select(key, F.col(number).alias("number"), F.col(line).alias("line"), record.alias("r"))
    last = F.col("r.record_type").eqNullSafe("footer")
    body = F.when(~last, F.lit(1))
    sums = rows.groupBy(key).agg(
        F.min_by("r.record_type", "number").alias("first"),
        F.max_by("r.record_type", "number").alias("last"),
        F.max_by("r.count", "number").alias("count"),
        F.max_by("r.checksum", "number").alias("checksum"),
        F.count(body).alias("n"),
        dossier_checksum(F.col("number"), F.when(~last, F.col("line"))).alias("all"),
        F.coalesce(F.sum(F.when(last, F.crc32(F.concat_ws(":", F.col("number").cast("string"))))), F.lit(0)).alias("of_footer"),
    )
    state = (
        F.when(~F.col("first").eqNullSafe("header"), "no_header").when(~F.col("last").eqNullSafe("footer"), "no_footer")
        .when(~F.col("count").eqNullSafe(F.col("n")), "count").when(~F.col("checksum").eqNullSafe(F.col("all") - F.col("of_footer")), "checksum").otherwise("ok")
    )
    columns = rows.filter("r.record_type = 'header'").groupBy(key).agg(F.min_by("r.columns", "number").alias("names"))
    blocks = rows.filter("r.record_type = 'transcript_block'").select(key, F.explode(F.from_json("r.value", "array<array<string>>")).alias("cells"))
    padded = F.transform("names", lambda name, i: F.try_element_at("cells", i + 1))
    return sums.select(key, state.alias("state")), blocks.join(columns, key).select(key, F.map_from_arrays("names", padded).alias("row"))


def without_sections(text: Column, headings: list[str], masked: str) -> Column:
    """Markdown without the ``## `` sections whose heading is listed, white space at the ends, and with what matches ``masked`` replaced by ``[source-ref]``."""
    heading = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(x, r"(?s)^#+\s*|\n.*$", "")), "[^a-z0-9 ]+", ""), " +", " "))
    sections = F.filter(F.split(text, r"(?m)(?<=\n)(?=## )"), lambda x: ~(x.startswith("## ") & heading(x).isin(headings)))
    return F.regexp_replace(F.regexp_replace(F.array_join(sections, ""), masked, "[source-ref]"), r"^\s+|\s+$", "")
