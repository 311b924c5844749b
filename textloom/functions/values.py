"""Column builders for filter values, identifiers, number grammars, paths and status texts. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

UPPER = T.ACCENTED.replace("ÿ", "").upper() + "Ÿ"
UPPER_BASE = T.BASE[: T.ACCENTED.index("ÿ")].upper() + T.BASE[T.ACCENTED.index("ÿ") + 1 :].upper() + "Y"
# Written numbers and units of the two number grammars, and magnitudes of a number's core.
NUMBER_WORDS = "um|uma|dois|duas|tr[eê]s|quatro|cinco|seis|sete|oito|nove|dez|onze|doze|treze|quatorze|catorze|quinze|dezesseis|dezessete|dezoito|dezenove|vinte|trinta|quarenta|cinquenta|sessenta|setenta|oitenta|noventa|cem|cento|mil"
UNITS = "segundos?|minutos?|horas?|dias?|semanas?|mes(?:es)?|anos?|vendas?|leads?|alunos?|clientes?|pessoas?"
WORD_WITH_UNIT = rf"(?i)\b(?:{NUMBER_WORDS})\s+(?:{UNITS})\b"
MAGNITUDES = {"k": 1e3, "mil": 1e3, "milhao": 1e6, "milhoes": 1e6}
NUMBER_OR_WORD = (
    r"(?i)(?:R\$\s*)?\d+(?:[.,]\d+)*(?:\s*%|\s*x|\s*vezes|\s*dias?|\s*meses?|\s*anos?)?"
    r"|\b(?:dois|duas|tr[eê]s|quatro|cinco|seis|sete|oito|nove|dez|onze|doze|treze|catorze|quatorze|quinze|vinte|trinta|quarenta|cinquenta|cem|cento|mil|milh[aã]o|milh[oõ]es|bilh[aã]o|bilh[oõ]es)\b"
)


def ascii_only(text: Column) -> Column:
    """Accents go from letters of either case, and so does whatever is not ASCII then; case and white space stay."""
    return F.regexp_replace(F.translate(text, T.ACCENTED + UPPER, T.BASE + UPPER_BASE), r"[^\x00-\x7F]", "")


def as_list(value: Column) -> Column:
    """No list for null, a list of one for a scalar."""
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(F.array(value))


def filter_values(values: Column, prefix: str = "process-") -> Column:
    """The values' parts between commas and semicolons, as slugs with ``prefix``, each once and in order."""
    parts = F.flatten(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.split(F.coalesce(v, F.lit("")), "[,;]")))
    slugs = F.transform(F.filter(parts, lambda x: F.trim(x) != ""), lambda x: T.slug(x))
    return F.array_distinct(F.transform(slugs, lambda s: F.when(F.startswith(s, F.lit(prefix)), s).otherwise(F.concat(F.lit(prefix), s))))


def searchable(fields: Sequence[Column], lists: Sequence[Column] = (), quotes: Column | None = None) -> Column:
    """The fields that aren't empty, then the lists' values, then the evidence's quotes, with spaces between."""
    parts = [F.nullif(f, F.lit("")) for f in fields] + [F.nullif(F.array_join(x, " "), F.lit("")) for x in lists]
    if quotes is not None:
        parts.append(F.nullif(F.array_join(F.transform(quotes, lambda e: e["quote"]), " "), F.lit("")))
    return F.concat_ws(" ", *parts)


def numeric_core(raw: Column) -> Column:
    """A number as it is compared: decimal point, no thousands marks, ``:`` and the magnitude word if one follows; text without a number as it is, folded.

    A percentage whose decimals were torn apart (``12,3 4 %``) is put together again.
    """
    bare = T.fold_ascii(raw)
    torn = r"(\d+)[,.](\d+)\s+(\d+)\s*%"
    plain = F.trim(F.replace(bare, F.lit("r$"), F.lit("")))
    magnitude = F.regexp_extract(plain, r"((?<=\d)k\b|\b(?:k|mil|milhao|milhoes)\b)", 1)
    token = F.trim(F.regexp_extract(plain, r"\d[\d.\s]*(?:,\d+)?", 0))
    joined = F.replace(token, F.lit(" "), F.lit(""))
    number = (
        F.when(F.contains(token, F.lit(",")), F.replace(F.replace(joined, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(token.rlike(r"^\d{1,3}(\.\d{3})+$") | (F.contains(token, F.lit(" ")) & token.rlike(r"^\d{1,3}([.\s]\d{3})+$")), F.replace(joined, F.lit("."), F.lit("")))
        .otherwise(joined)
    )
    core = F.when(token == "", plain).when(magnitude != "", F.concat(number, F.lit(":"), magnitude)).otherwise(number)
    return F.when(bare.rlike(torn), F.concat(F.regexp_extract(bare, torn, 1), F.lit("."), F.regexp_extract(bare, torn, 2), F.regexp_extract(bare, torn, 3))).otherwise(core)


def core_value(core: Column) -> Column:
    """The number that a core stands for; null for text."""
    factor = reduce(lambda acc, m: F.when(F.endswith(core, F.lit(f":{m}")), MAGNITUDES[m]).otherwise(acc), MAGNITUDES, F.lit(1.0))
    return F.regexp_replace(core, ":.*$", "").try_cast("double") * factor


def cited_ids(text: Column) -> Column:
    """The distinct ids that a text cites, sorted: those of the known forms, and what stands after ``insight_id`` and a colon or equals sign."""
    forms = F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_-]+-(?:tr-insight|v2)-\d+"), 0)
    named = F.regexp_extract_all(text, F.lit(r"(?i)insight_id\s*[:=]\s*([A-Za-z0-9_-]+)"), 1)
    return F.array_sort(F.array_union(forms, named))


def bullet_lines(text: Column, stops: Sequence[str]) -> Column:
    """What stands after the dash of dashed lines, up to the first line that holds a stop marker; links go."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    stop = F.array_position(F.transform(lines, lambda x: reduce(lambda a, b: a | b, (F.contains(T.fold(x), F.lit(s)) for s in stops))), True)
    kept = F.when(stop > 0, F.slice(lines, F.lit(1), (stop - 1).cast("int"))).otherwise(lines)
    dashed = F.transform(F.filter(kept, lambda x: F.startswith(x, F.lit("-"))), lambda x: F.trim(F.regexp_replace(x, "^-+", "")))
    return F.filter(dashed, lambda x: (x != "") & ~F.startswith(x, F.lit("http")))


def selector_values(selector: str) -> list[str]:
    """What a list like ``1,003,name`` selects: names, and numbers with and without leading zeros."""
    out: list[str] = []
    for item in filter(None, map(str.strip, selector.split(","))):
        out += [f"{int(item):03d}", str(int(item))] if item.isdecimal() else [item]
    return list(dict.fromkeys(out))


def selected(selector: str, chunk_id: Column, index: Column, file: Column) -> Column:
    """Whether a chunk is selected by its id, its number from 1 (also with three digits), or its file's stem; an empty selector selects all."""
    wanted = selector_values(selector)
    if not wanted:
        return F.lit(True)
    number = (index + 1).cast("string")
    stem = F.replace(F.regexp_replace(F.regexp_replace(file, r"^.*[/\\]", ""), r"\.[^.]*$", ""), F.lit("chunk_"), F.lit(""))
    names = F.array(chunk_id, number, F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number), stem)
    return F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, wanted))), F.lit(False))


def rebased(path: Column, root: str, marker: str, anchors: Sequence[str]) -> Column:
    """A path of another machine under ``root``: what follows ``marker``, or else from the first of ``anchors`` on; null if neither is in it or if it leads out of the root."""
    parts = F.filter(F.split(path, r"[/\\]"), lambda x: (x != "") & (x != "."))
    at_marker = F.array_position(parts, marker)
    at_anchor = F.array_position(F.transform(parts, lambda x: x.isin(*anchors)), True)
    start = F.when(at_marker > 0, at_marker + 1).when(at_anchor > 0, at_anchor)
    rest = F.slice(parts, F.coalesce(start, F.lit(1)).cast("int"), F.greatest(F.size(parts), F.lit(1)))
    depth = F.aggregate(
        rest,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")),
        lambda a, x: F.struct((a["at"] + F.when(x == "..", -1).otherwise(1)).alias("at"), F.least(a["least"], a["at"] + F.when(x == "..", -1).otherwise(1)).alias("least")),
    )
    kept = F.aggregate(rest, F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, x)))
    return F.when(start.isNotNull() & (F.size(rest) > 0) & (depth["least"] >= 0), F.concat_ws("/", F.lit(root), F.array_join(kept, "/")))


def by_prefix(value: Column, origins: Mapping[str, str], default: str) -> Column:
    """The origin of the first prefix that a value starts with."""
    return reduce(lambda acc, p: F.when(F.startswith(value, F.lit(p)), origins[p]).otherwise(acc), reversed(list(origins)), F.lit(default))


def publishable(path: Column, suffixes: Sequence[str], excluded: Sequence[str]) -> Column:
    """Whether a relative path has one of the suffixes, an allowed top folder, and no part that starts with a dot."""
    suffix = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    return (path != "") & suffix.isin(*suffixes) & ~F.split(path, "/")[0].isin(*excluded) & ~path.rlike(r"(^|/)\.")


def encoding_status(text: Column) -> Column:
    """``fail`` where words that lost their accents stand, ``needs_revision`` where no letter beyond ASCII does, else ``pass``."""
    return F.when(F.size(T.broken_words(text)) > 0, "fail").when(~text.rlike(r"[\p{L}&&[^\x00-\x7F]]"), "needs_revision").otherwise("pass")


def first_class(message: Column, needles: Sequence[tuple[str, Sequence[str]]], default: str = "unclassified") -> Column:
    """The label of the first entry of which a needle is in the lower-cased message."""
    low = F.lower(message)
    found = F.lit(default)
    for label, some in reversed(needles):
        found = F.when(reduce(lambda a, b: a | b, (F.contains(low, F.lit(n)) for n in some)), label).otherwise(found)
    return found
