"""Filters, term matching, rule scores and classification by lexicons that are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import values as V

BEFORE, AFTER = r"(?<![a-z0-9])", r"(?![a-z0-9])"


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


@dataclass(frozen=True)
class Filters:
    """Optional filters, all of which a record has to pass; what is None or empty filters nothing. Text is compared folded."""

    contains: Mapping[str, str] = field(default_factory=dict)
    equals: Mapping[str, str] = field(default_factory=dict)
    within: tuple[Sequence[str], str] | None = None
    tags: Sequence[str] = ()
    tag_mode: str = "any"
    least: Mapping[str, float] = field(default_factory=dict)


def folded(value: str) -> Column:
    return T.fold(F.lit(value))


def contains_value(values: Column, expected: str) -> Column:
    """Whether an element of a list holds the expected text."""
    return F.exists(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.contains(T.fold(x), folded(expected)))


def matches_tags(tags: Column, expected: Sequence[str], mode: str = "any") -> Column:
    """``any``: a tag of both lists; ``all``: every expected one. No expected tag: true."""
    wanted, own = V.filter_values(F.array(*map(F.lit, expected)).cast("array<string>")), V.filter_values(tags)
    held = F.size(F.array_except(wanted, own)) == 0 if mode == "all" else F.arrays_overlap(wanted, own)
    return F.when(F.size(wanted) == 0, True).otherwise(held)


def passes(filters: Filters, tags: str = "tags") -> Column:
    """The conjunction of the filters; numbers that are missing or no numbers count as 0."""
    tests = [contains_value(F.col(c), v) for c, v in filters.contains.items() if v]
    tests += [F.coalesce(T.fold(F.col(c)) == folded(v), F.lit(False)) for c, v in filters.equals.items() if v]
    if filters.within:
        columns, part = filters.within
        tests.append(F.contains(T.fold(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), folded(part)))
    if filters.tags:
        tests.append(matches_tags(F.col(tags), filters.tags, filters.tag_mode))
    tests += [F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) >= v for c, v in filters.least.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def position(text: Column, term: str) -> Column:
    """0-based place of a term that stands between word bounds in a folded text; null if it doesn't."""
    pattern = f"{BEFORE}{_quoted(term)}{AFTER}"
    return F.when(text.rlike(pattern), F.length(F.regexp_extract(text, f"^(?s)(.*?){pattern}", 1)))


def _quoted(term: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)


def substring_terms(text: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """The terms of which the name or a synonym is anywhere in a folded text, in the terms' order."""
    return F.filter(F.array(*[F.when(any_of([F.contains(text, F.lit(s)) for s in some]), F.lit(t)) for t, some in terms.items()]), lambda x: x.isNotNull())


def matched_tags(text: Column, terms: Mapping[str, Sequence[str]], existing: Column | None = None, most: int = 4) -> Column:
    """Existing tags that the terms know, then the terms found between word bounds: more synonyms first, then the earlier, then by name; ``most`` in all."""
    found = []
    for term, some in terms.items():
        places = F.filter(F.array(*[position(text, s) for s in some]), lambda x: x.isNotNull())
        found.append(F.when(F.size(places) > 0, F.struct((-F.size(places)).alias("n"), F.array_min(places).alias("at"), F.lit(term).alias("term"))))
    ranked = F.transform(F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull())), lambda x: x["term"])
    if existing is not None:
        known = F.filter(F.coalesce(existing, F.array().cast("array<string>")), lambda x: x.isin(*terms))
        ranked = F.array_union(known, ranked)
    return F.slice(ranked, 1, most)


@dataclass(frozen=True)
class Rule:
    """Keywords, of which an anchor (the first keyword by default) has to be there; ``weight`` times the score is a hit's strength."""

    name: str
    keywords: Sequence[str]
    anchors: Sequence[str] = ()
    weight: int = 1


def score_rule(text: Column, rule: Rule) -> Column:
    """The number of keywords in a folded text, 0 without an anchor."""
    anchored = any_of([F.contains(text, F.lit(a)) for a in rule.anchors or rule.keywords[:1]])
    return F.when(anchored, sum((F.contains(text, F.lit(k)).cast("int") for k in rule.keywords), F.lit(0))).otherwise(0)


def scored(rows: DataFrame, text: str, rules: Sequence[Rule], strong: int = 28) -> DataFrame:
    """One row per row and rule that hits, with ``rule``, ``score``, ``weighted``, ``strength`` and ``confidence``. ``text`` is folded."""
    hits = F.array(*[F.struct(F.lit(r.name).alias("rule"), score_rule(F.col(text), r).alias("score"), F.lit(r.weight).alias("weight")) for r in rules])
    each = rows.withColumn("_hit", F.explode(F.filter(hits, lambda h: h["score"] > 0)))
    weighted = F.col("_hit.score") * F.col("_hit.weight")
    return each.select("*", "_hit.rule", "_hit.score", weighted.alias("weighted"), F.when(weighted >= strong, "strong").otherwise("moderate").alias("strength"), F.when(weighted >= strong, 0.82).otherwise(0.76).alias("confidence")).drop("_hit")


def claim_risk(current: Column, text: Column, strength: Column, risky: Sequence[str]) -> Column:
    """A claim's risk, reviewed by its evidence's strength and the risky terms in its folded text; an unknown risk counts as medium."""
    now = F.when(T.fold(current).isin("low", "medium", "high"), T.fold(current)).otherwise("medium")
    has, how = any_of([F.contains(text, F.lit(t)) for t in risky]), F.coalesce(T.fold(strength), F.lit(""))
    return (
        F.when(how == "weak", F.when(has, "high").otherwise("medium"))
        .when(has & (how != "strong"), F.when(now == "high", "high").otherwise("medium"))
        .when((now == "high") & (how == "strong"), "medium")
        .otherwise(now)
    )


def source_kind(kind: Column, asset: Column, evidence: Column) -> Column:
    """The kind that is given; else ``asset`` if the record or any of its evidence names one, else ``transcript``."""
    return F.when(F.nullif(kind, F.lit("")).isNotNull(), kind).when(F.nullif(asset, F.lit("")).isNotNull() | F.exists(evidence, lambda e: F.coalesce(e["asset_id"], F.lit("")) != ""), "asset").otherwise("transcript")


def presence_score(text: Column, keywords: Sequence[str]) -> Column:
    """5 for three keywords of a criterion in a folded text, 4 for two, 3 for one, 1 for none."""
    hits = sum((F.contains(text, F.lit(k)).cast("int") for k in keywords), F.lit(0))
    return F.when(hits >= 3, 5).when(hits == 2, 4).when(hits == 1, 3).otherwise(1)


def decision(total: Column, good: int, fair: int) -> Column:
    return F.when(total >= good, "pass").when(total >= fair, "needs_revision").otherwise("fail")


def actionable(text: Column, source: Column, kind: str, pattern: str, veto: str, hint: str, public: str, action: str, context: str) -> Column:
    """Whether a mention of an asset can be acted on: no negative phrase; in descriptions a link with a hint; in transcripts a public link, or an action with a context or a file-like type."""
    named = text.rlike(pattern) & ~text.rlike(veto)
    spoken = text.rlike(public) | (text.rlike(action) & (text.rlike(context) | F.lit(kind in ("pdf", "spreadsheet", "slides"))))
    return named & F.when(source == "description", text.rlike(hint)).otherwise(spoken)


def first_mentions(rows: DataFrame, document: str, place: str, tests: Mapping[str, Column]) -> DataFrame:
    """(document, type, place, number): the first row of each document and type whose test holds, numbered by place and type within the document."""
    from pyspark.sql import Window

    kinds = F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())
    first = rows.select(document, place, F.explode(kinds).alias("type")).groupBy(document, "type").agg(F.min(place).alias(place))
    return first.withColumn("number", F.row_number().over(Window.partitionBy(document).orderBy(place, "type")))
