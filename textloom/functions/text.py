"""Column builders for text: folding, slugs, tokens and set similarity. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The precomposed Latin letters that decompose, and their base letters.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñç"
BASE = "aaaaaaeeeeiiiiooooouuuuyync"


def fold(text: Column) -> Column:
    """Lower-case, drop accents, collapse white space and trim; null stays null."""
    return F.trim(F.regexp_replace(fold_ascii(text), r"\s+", " "))


def fold_ascii(text: Column) -> Column:
    """Lower-case and drop accents, leaving white space as it is."""
    return F.translate(F.lower(text), ACCENTED, BASE)


def slug(text: Column, max_length: int = 120) -> Column:
    """Hyphenated slug of at most ``max_length`` characters; ``item`` if nothing is left."""
    runs = F.regexp_replace(fold(text), "[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(runs, "^-+|-+$", "")
    cut = F.regexp_replace(F.left(trimmed, F.lit(max_length)), "-+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("item"))


def tokens(text: Column, min_length: int = 3) -> Column:
    """Distinct ``[a-z0-9]`` runs of the folded text, of at least ``min_length`` characters."""
    return F.array_distinct(F.regexp_extract_all(fold(text), F.lit(f"[a-z0-9]{{{min_length},}}"), 0))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def unique_by_fold(values: Column) -> Column:
    """First original of each folded value, in order; empty values go."""
    folded = F.transform(values, fold)
    return F.filter(values, lambda x, i: (fold(x) != "") & (F.array_position(folded, fold(x)) == i + 1))


def excerpt(text: Column, limit: int) -> Column:
    """Collapse white space; if longer than ``limit``, cut back to the last space and add an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > limit, F.concat(F.regexp_replace(F.left(flat, F.lit(limit)), r"\s\S*$", ""), F.lit("..."))).otherwise(flat)


def base60(text: Column) -> Column:
    """Seconds of a ``H:MM:SS`` or ``M:SS`` timecode; null if a part isn't a number."""
    parts = F.transform(F.split(text, ":"), lambda x: x.try_cast("int"))
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc * 60 + x)


def strip_html(text: Column) -> Column:
    """Text of markup: tags go, the five common entities are decoded, white space collapses."""
    bare = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def repair(text: Column) -> Column:
    """Undo one reading of UTF-8 as Latin-1, where the text holds its marks, fits in Latin-1, and is valid UTF-8 once undone; else the text as it is."""
    undone = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(text.rlike("[\u00c2\u00c3]") & text.rlike("^[\\x00-\\xff]*$"), F.coalesce(undone, text)).otherwise(text)


def canonical(names: Column, aliases: dict[str, str], default: str, most: int = 4) -> Column:
    """struct(themes, rest): the first ``most`` distinct themes that ``aliases`` gives for the names, in order, ``default`` if none; and the distinct names without one."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    known = F.array_distinct(F.filter(F.transform(names, lambda x: F.try_element_at(table, x)), lambda x: x.isNotNull()))
    rest = F.array_distinct(F.filter(names, lambda x: x.isNotNull() & F.try_element_at(table, x).isNull()))
    return F.struct(F.when(F.size(known) > 0, F.slice(known, 1, most)).otherwise(F.array(F.lit(default))).alias("themes"), rest.alias("rest"))


# Words that lost their accented letters, and the pattern of a question mark where a letter was.
BROKEN_WORDS = ("anotaes", "cdigo", "comeou", "contedo", "contm", "difcil", "edio", "fcil", "histrias", "lanamento", "mtodo", "negcio", "nvel", "possvel", "seleo", "variaao", "varivel", "vdeo", "vocs")
ORPHAN_MARK = r"[A-Za-z]\?+[a-z]|[A-Za-z]\?+(?![\\\s\"'\)\]\.,;:!A-Z]|$)"


def broken_words(text: Column) -> Column:
    """The distinct ``BROKEN_WORDS`` that stand as whole words in the text, in lower case and sorted; none for null."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.array_sort(F.array_intersect(words, F.array(*map(F.lit, BROKEN_WORDS))))


def artefact_contexts(text: Column, window: int = 40) -> Column:
    """struct(kind, excerpt) of each orphan question mark, then of each replacement character, with ``window`` characters on both sides and single spaces. Contexts may overlap, which extraction by patterns can't give, so this runs in Arrow batches."""
    kinds = (("orphan_question_mark", re.compile(ORPHAN_MARK, re.ASCII)), ("replacement_character", re.compile("\ufffd")))

    @F.pandas_udf("array<struct<kind string, excerpt string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.fillna("").map(lambda x: [{"kind": k, "excerpt": " ".join(x[max(m.start() - window, 0) : m.end() + window].split())} for k, p in kinds for m in p.finditer(x)])

    return find(text)
