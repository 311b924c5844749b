"""Quality rules: per-document features, and lines that too many documents of one host share.

All of it is DataFrame work inside the JVM, in three steps: features row by row with array functions; one row per document and
distinct normalised line, counted by host and line hash (counts combine before the shuffle, so a hot line or host is
no hot task); and the lines above the limit joined back to the documents that hold them. ``rules`` judges documents by what is left of them,
``clean`` returns the documents that are kept without their common lines.

Defined results: null or empty text has no words, zero features and fails the base rules; documents without a host count as
one host of their own; repeated lines of one document count once in document counts, and are removed wherever they
occur; rows of one key, text and host are one document and share one fate, rows of one key with other texts are documents of their own, and a null key
is a key like others; an empty table gives an empty result; of other columns ``clean`` keeps all, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def n_repeat_words(w: Column, window: int = 3) -> Column:
    """Words inside runs of ``window`` words that occur at least twice; ``w`` is an array of words.

    Runs are hashes of their words' hashes, sorted with their positions, so that equal ones stand side by side. Each position found covers its words up to the next one.
    """

    def found(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(s, i + 1)["h"] == x["h"])))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        ahead = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(window)), F.lit(window)))
        return F.aggregate(ahead, F.lit(0), lambda n, x: n + x)

    def runs(h: Column) -> Column:
        run = h
        for k in range(1, window):
            run = F.zip_with(run, F.slice(h, k + 1, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))
        return F.transform(F.slice(run, 1, F.greatest(F.size(h) - (window - 1), F.lit(0))), lambda x, i: F.struct(x.alias("h"), i.alias("i")))

    hashed = _let(F.transform(w, lambda x: F.xxhash64(x)), runs)
    return F.when(F.size(w) <= window, 0).otherwise(_let(_let(F.sort_array(hashed), found), covered))


def n_dup_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(_without(x, SPACES)) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def normal_line(line: Column) -> Column:
    """A line as it is compared across documents: lower case, digits as 0, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), f"{SPACE}+", " "))


def normal_lines(text: Column) -> Column:
    """``normal_line`` of each line, empty ones left out; the text is rewritten once, not line by line."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.filter(F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def _documents(documents: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(id, key, text, host); ``id`` tells documents of one host apart by key and text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.struct(F.col(key).alias("k"), F.xxhash64(whole).alias("t")).alias("id"), F.col(key).alias("key"), whole.alias("text"), F.col(host).alias("host"))


def _line_id(line: Column) -> list[Column]:
    """Two hashes that name a normalised line."""
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.reverse(line)).alias("g")]


def common_lines(docs: DataFrame, max_docs_per_line: int) -> DataFrame:
    """(id, host, chars, lines) of the documents (id, text, host) that hold lines of more than so many documents of their host: how many characters these have, and their hashes."""
    each = docs.select("id", "host", F.explode(normal_lines(F.col("text"))).alias("line"))
    each = each.select("id", "host", *_line_id(F.col("line")), F.length(_without(F.col("line"), SPACES)).alias("chars"))
    each = each.groupBy("id", "host", "h", "g").agg(F.sum("chars").alias("chars"))
    # A line has characters, so the second test holds for all; with it both uses of ``each`` need the same columns and share one shuffle.
    common = each.groupBy("host", "h", "g").agg(F.count(F.lit(1)).alias("n"), F.min("chars").alias("least")).filter((F.col("n") > max_docs_per_line) & (F.col("least") > 0))
    common = common.select(F.col("host").alias("at"), F.col("h").alias("ch"), F.col("g").alias("cg"))
    same = (F.col("h") == F.col("ch")) & (F.col("g") == F.col("cg")) & F.col("host").eqNullSafe(F.col("at"))
    found = each.join(common, same).groupBy("id", "host").agg(F.sum("chars").alias("chars"), F.collect_list(F.struct("h", "g")).alias("lines"))
    # Rows repeated whole have counted their lines together.
    copies = docs.groupBy("id", "host").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(F.col("id").alias("of"), F.col("host").alias("at"), "copies")
    told = found.join(copies, (F.col("id") == F.col("of")) & F.col("host").eqNullSafe(F.col("at")), "left")
    return told.select("id", "host", (F.col("chars") / F.coalesce("copies", F.lit(1))).cast("long").alias("chars"), "lines")


def rules(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_docs_per_line: int = 100,
    max_removed_percent: int = 50,
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_common_chars, kept).

    A line is common if more than ``max_docs_per_line`` distinct documents of the host hold it. A document that fails the
    base rules, or of whose non-space characters more than ``max_removed_percent`` stand in common lines, is not kept.
    """
    docs = _documents(documents, key, text, host)
    bare = _without(F.col("text"), SPACES)
    base = docs.select(
        "id",
        "host",
        words(F.col("text")).alias("w"),
        F.length(bare).alias("word_chars"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS))).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
    ).select("id", "host", F.size("w").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", n_repeat_words(F.col("w")).alias("n_repeat_words"))
    removed = common_lines(docs, max_docs_per_line).select(F.col("id").alias("of"), F.col("host").alias("at"), F.col("chars").alias("n_common_chars"))

    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    gone = F.coalesce("n_common_chars", F.lit(0))
    return base.join(removed, (F.col("id") == F.col("of")) & F.col("host").eqNullSafe(F.col("at")), "left").select(
        F.col("id.k").alias(key),
        *[F.col(c).cast("long") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        gone.cast("long").alias("n_common_chars"),
        (~failed & (gone * 100 <= F.col("word_chars") * max_removed_percent)).alias("kept"),
    )


def clean(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_docs_per_line: int = 100,
    max_removed_percent: int = 50,
) -> DataFrame:
    """The documents that ``rules`` keeps, without their common lines, with their columns."""
    names = documents.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    docs = _documents(documents, key, text, host)
    gone = common_lines(docs, max_docs_per_line).select(F.col("id").alias("of"), F.col("host").alias("at"), "chars", "lines")
    # The columns of the input move inside a struct, apart from this operator's own names.
    held = documents.select(row.alias("row")).select("row", *[F.col(f"row.c{names.index(c)}").alias(n) for c, n in ((key, "k"), (text, "raw"), (host, "host"))])
    held = held.select("row", "raw", "host", F.struct("k", F.xxhash64(F.coalesce("raw", F.lit(""))).alias("t")).alias("id"), words(F.coalesce("raw", F.lit(""))).alias("w"))
    repeated = n_repeat_words(F.col("w"))
    held = held.filter((F.size("w") >= min_words) & (repeated * 100 <= F.size("w") * max_repeat_percent)).drop("w")
    told = held.join(gone, (F.col("id") == F.col("of")) & F.col("host").eqNullSafe(F.col("at")), "left")
    told = told.filter(F.coalesce("chars", F.lit(0)) * 100 <= F.length(_without(F.col("raw"), SPACES)) * max_removed_percent)
    stays = F.filter(F.split("raw", "\n", -1), lambda x: ~F.array_contains(F.col("lines"), F.struct(*_line_id(normal_line(x)))))
    left = F.when(F.col("lines").isNull(), F.col("raw")).otherwise(F.array_join(stays, "\n"))
    return told.select(*[(left if c == text else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)])


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM g),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM t WHERE n > 1) GROUP BY rid),
f AS (SELECT w.rid, w.doc_id, len(w.w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
e AS (SELECT rid, doc_id, text, source, trim(regexp_replace(regexp_replace(lower(unnest(string_split(text, chr(10)))), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM d),
c AS (SELECT source, line FROM (SELECT DISTINCT doc_id, md5(text) AS t, source, line FROM e WHERE line <> '') GROUP BY source, line HAVING count(*) > 100),
m AS (SELECT rid, sum(length(replace(line, ' ', ''))) AS n FROM e JOIN c USING (line) WHERE e.source IS NOT DISTINCT FROM c.source GROUP BY rid)
SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(coalesce(m.n, 0) AS BIGINT) AS n_common_chars, NOT base_failed AND coalesce(m.n, 0) * 100 <= word_chars * 50 AS kept
FROM b LEFT JOIN m USING (rid)
"""
