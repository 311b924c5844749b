"""Ledgers, inventories, numbers and matches held against what they refer to: each check gives rows of errors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textloom.functions import text as T
from textloom.sources.shared import written


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def violations(rows: DataFrame, keys: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """(keys, error): one row per row and check that holds; a check that is null doesn't."""
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    return rows.select(*keys, F.explode(failed).alias("error"))


def ledger_errors(ledger: DataFrame, candidates: DataFrame, expected: DataFrame, codes: Sequence[str]) -> DataFrame:
    """(segment, error) of a ledger (segment, disposition, destinations, reason, code, reference): expected segments it leaves out or repeats, others it brings, and entries
    with an unknown disposition, no or unknown destination, no reason, an unknown exclusion code or a duplicate of nothing."""
    known = candidates.select(F.col("candidate").alias("d")).distinct()
    entry = ledger.withColumn("entry", F.monotonically_increasing_id())
    dangling = entry.select("segment", F.explode("destinations").alias("d")).join(known, "d", "left_anti").select("segment", F.lit("dangling candidate").alias("error")).distinct()
    pointed = entry.filter("code = 'duplicate_of'").select("segment", F.col("reference").alias("d"))
    lost = pointed.filter("d IS NOT NULL").join(known, "d", "left_anti").unionByName(pointed.filter("d IS NULL").select("d", "segment")).select("segment", F.lit("duplicate reference missing").alias("error"))
    captured = F.col("disposition").isin("captured", "merged")
    own = violations(
        ledger,
        ["segment"],
        {
            "invalid disposition": ~F.coalesce(captured | (F.col("disposition") == "excluded"), F.lit(False)),
            "missing destination": captured & (F.size("destinations") == 0),
            "missing reason": F.trim(F.coalesce("reason", F.lit(""))) == "",
            "invalid exclusion category": (F.col("disposition") == "excluded") & ~F.coalesce(F.col("code").isin(*codes), F.lit(False)),
        },
    )
    counted = ledger.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    both = expected.select("segment", F.lit(True).alias("wanted")).distinct().join(counted, "segment", "full")
    cover = violations(both, ["segment"], {"not covered": F.col("n").isNull(), "not a signal": F.col("wanted").isNull(), "covered twice": F.col("n") > 1})
    return cover.unionByName(own).unionByName(dangling).unionByName(lost).distinct()


def inventory_errors(required: DataFrame, given: DataFrame, atoms: DataFrame) -> DataFrame:
    """(inventory, error) of dispositions (inventory, position, status, atoms, reason) against the ids required; of several for one id the first is judged."""
    first = given.groupBy("inventory").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("status", "atoms", "reason"), "position").alias("g"))
    both = required.select("inventory", F.lit(True).alias("wanted")).distinct().join(first, "inventory", "full")
    lost = both.select("inventory", F.explode("g.atoms").alias("atom")).join(atoms.select("atom").distinct(), "atom", "left_anti").select("inventory").distinct().withColumn("lost", F.lit(True))
    judged = both.join(lost, "inventory", "left")
    known, status = F.col("wanted") & F.col("g").isNotNull(), F.coalesce("g.status", F.lit(""))
    captured = status.isin("captured", "merged")
    return violations(
        judged,
        ["inventory"],
        {
            "missing": F.col("g").isNull(),
            "duplicate": F.col("n") > 1,
            "unknown": F.col("wanted").isNull(),
            "invalid status": known & ~captured & (status != "excluded"),
            "references missing atom": known & captured & ((F.coalesce(F.size("g.atoms"), F.lit(0)) <= 0) | F.coalesce("lost", F.lit(False))),
            "needs a reason": known & (status == "excluded") & (F.trim(F.coalesce("g.reason", F.lit(""))) == ""),
        },
    )


def number_checks(kinds: Sequence[str], roles: Sequence[str], statuses: Sequence[str], evidence: Column) -> dict[str, Column]:
    """Checks of number records (raw, value, min_value, max_value, unit_kind, role, value_status, literal): enums, order, raw text in the evidence, and literal against structured value."""
    same = F.abs(F.col("literal") - F.col("value")) <= F.greatest(F.lit(1e-9), F.abs("value") * 1e-9)
    return {
        "invalid unit_kind": ~F.coalesce(F.col("unit_kind").isin(*kinds), F.lit(False)),
        "invalid role": ~F.coalesce(F.col("role").isin(*roles), F.lit(False)),
        "invalid value_status": ~F.coalesce(F.col("value_status").isin(*statuses), F.lit(False)),
        "min_value exceeds max_value": F.col("min_value") > F.col("max_value"),
        "raw absent from evidence": ~F.contains(evidence, F.trim("raw")) & ~F.contains(T.fold_ascii(evidence), T.fold(F.col("raw"))),
        "value does not match raw literal": F.col("literal").isNotNull() & F.col("value").isNotNull() & ~same,
    }


def occurrence_match(mentions: DataFrame, records: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """(by, occurrence, mention, record): the k-th mention of each key with its k-th record, in order; what is left over on either side has null for the other."""
    w = Window.partitionBy(*by).orderBy(order)
    a = mentions.select(*by, F.col(order).alias("mention"), F.row_number().over(w).alias("occurrence"))
    b = records.select(*by, F.col(order).alias("record"), F.row_number().over(w).alias("occurrence"))
    return a.join(b, [*by, "occurrence"], "full")


def best_match(left: DataFrame, right: DataFrame, fine: Sequence[str], coarse: Sequence[str], key: str, tokens: str, position: str) -> DataFrame:
    """(key, match, similarity): for each row of ``left`` the most alike of ``right`` with equal ``fine`` columns, or, if there are none, with equal ``coarse`` ones; the first of equals."""
    one = left.select(F.col(key).alias("k"), *fine, F.col(tokens).alias("t"))
    two = right.select(F.col(key).alias("match"), *fine, F.col(tokens).alias("u"), F.col(position).alias("at"))
    near = one.join(two, list(fine))
    rest = one.join(two.select(*fine).distinct(), list(fine), "left_anti")
    far = rest.join(two.drop(*[c for c in fine if c not in coarse]), list(coarse))
    found = near.select("k", "t", "match", "u", "at").unionByName(far.select("k", "t", "match", "u", "at"))
    scored = found.withColumn("similarity", T.jaccard(F.col("t"), F.col("u")))
    best = scored.groupBy("k").agg(F.min_by(F.struct("match", "similarity"), F.struct((-F.col("similarity")).alias("s"), "at")).alias("m"))
    return best.select(F.col("k").alias(key), "m.match", F.round("m.similarity", 3).alias("similarity"))


def weighted_matches(approved: DataFrame, reduced: DataFrame, by: str, most: int = 4) -> DataFrame:
    """(by, a, b, score): of each approved row (by, a, evidence, tokens) the best rows b by 0.75 of the evidence's Jaccard similarity and 0.25 of the tokens', where above 0."""
    x = approved.select(by, "a", F.col("evidence").alias("ea"), F.col("tokens").alias("ta"))
    y = reduced.select(by, "b", F.col("evidence").alias("eb"), F.col("tokens").alias("tb"))

    def share(p: str, q: str) -> Column:
        return F.size(F.array_intersect(p, q)) / F.greatest(F.lit(1), F.size(F.array_union(p, q)))

    scored = x.join(y, by).select(by, "a", "b", (share("ea", "eb") * 0.75 + share("ta", "tb") * 0.25).alias("score")).filter("score > 0")
    w = Window.partitionBy(by, "a").orderBy(F.desc("score"), "b")
    return scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def nearest_literals(numbers: DataFrame, segments: DataFrame, by: str, tokens: Column) -> DataFrame:
    """(by, candidate, raw, segment, action): numbers (by, candidate, center, raw, held) whose literal the evidence doesn't hold get the nearest segment (by, index, text) that does, the lower of two; the others are removed.

    A literal's own token is the join key, so only segments that may hold it are looked at.
    """
    open_ = numbers.filter("NOT held")
    each = segments.select(by, "index", "text", F.explode(F.array_distinct(tokens)).alias("raw"))
    met = open_.join(each, [by, "raw"]).groupBy(by, "candidate", "raw").agg(F.min_by("index", F.struct(F.abs(F.col("index") - F.col("center")).alias("d"), "index")).alias("segment"))
    out = open_.select(by, "candidate", "raw").join(met, [by, "candidate", "raw"], "left")
    return out.withColumn("action", F.when(F.col("segment").isNull(), "removed").otherwise("added"))


def contained_pairs(sets: DataFrame, related: DataFrame, by: str) -> DataFrame:
    """(by, a, b): a's minimal evidence is within all of b's, both of one ``by``, and they aren't related. ``sets``: (by, id, minimal, every); ``related``: (a, b) either way round."""
    one = sets.filter(F.size("minimal") > 0).select(by, F.col("id").alias("a"), F.size("minimal").alias("n"), F.explode("minimal").alias("e"))
    two = sets.select(by, F.col("id").alias("b"), F.explode("every").alias("e"))
    met = one.join(two, [by, "e"]).filter("a != b").groupBy(by, "a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n")).filter("shared = n")
    both = related.select("a", "b").unionByName(related.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return met.select(by, "a", "b").join(both, ["a", "b"], "left_anti")


def word_shares(rows: DataFrame, by: str, key: str, words: str, least: int, related: DataFrame) -> DataFrame:
    """(by, a, b, shared): pairs a < b of one ``by`` that share at least so many words and aren't related (a, b)."""
    each = rows.select(by, F.col(key).alias("k"), F.explode(F.array_distinct(words)).alias("w"))
    x, y = each.withColumnRenamed("k", "a"), each.withColumnRenamed("k", "b")
    met = x.join(y, [by, "w"]).filter("a < b").groupBy(by, "a", "b").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= least)
    return met.join(related.select("a", "b"), ["a", "b"], "left_anti")


def phase_spans(events: DataFrame, by: str, at: str, phase: str, action: str) -> DataFrame:
    """(by, phase, started, ended, state) from start, end and interrupt events: a span lasts until the next event that ends, interrupts or starts anything, as a new start completes what is open; the last may run still.

    Ends and interrupts of phases that aren't open are no events here.
    """
    w = Window.partitionBy(by).orderBy(at)
    marked = events.withColumn("open", F.lag(F.when(F.col(action) == "start", F.col(phase))).over(w))
    sound = marked.filter((F.col(action) == "start") | (F.col("open") == F.col(phase)))
    nxt = sound.withColumns({"ended": F.lead(at).over(w), "by_action": F.lead(action).over(w)})
    state = F.when(F.col("ended").isNull(), "running").when(F.col("by_action") == "interrupt", "interrupted").otherwise("completed")
    return nxt.filter(F.col(action) == "start").select(by, phase, F.col(at).alias("started"), "ended", state.alias("state"))


def live_status(valid: Column, known: Column, prior: Column, provider: Column, resumable: Sequence[str]) -> Column:
    """The state of a resumable task: completed if its result is valid; without metadata that is what it waits for; a running route waits for itself again; a resumable or final state stays; else direct, or by hand where the provider says it is missing."""
    routes = {"running_direct": "pending_direct", "running_ui": "pending_ui", "running_browser": "pending_chrome", "running_asr": "pending_asr"}
    status = F.when(valid, "completed").when(~known, "pending_metadata")
    for running, pending in routes.items():
        status = status.when(prior == running, pending)
    return status.when(prior.isin(*resumable), prior).when(F.startswith(provider, F.lit("missing:")), "pending_ui").otherwise("pending_direct")


def noise_flags(quotes: DataFrame, keys: Sequence[str], owner: str, text: str, patterns: Mapping[str, str], titles: DataFrame, least: int) -> DataFrame:
    """(keys, flag): the patterns that a folded quote matches, and ``other_title`` where it holds a title (other, title) of at least ``least`` characters that isn't its owner's.

    A quote's grams of ``least`` characters meet the first ones of titles by equality, so titles are never tried one by one. Grams stay in their task unless a table of bits
    (8 MB at most) has both bits of their hash, as it has for all starts of titles and hardly any other. Equal titles are one row: they need only an owner that isn't the quote's.
    """
    flags = violations(quotes, keys, {n: F.col(text).rlike(p) for n, p in patterns.items()}).withColumnRenamed("error", "flag")
    own = titles.filter(F.length("title") >= least).groupBy("title").agg(F.min("other").alias("first"), F.max("other").alias("last"))
    starts = own.select("title", "first", "last", F.left("title", F.lit(least)).alias("_start"))
    long = written(_grams(starts, "_start", least, None).drop("_start"), "titles")
    room = 1 << min(26, max(16, (64 * long.count()).bit_length()))
    bits = np.zeros(room >> 3, np.uint8)
    for part in (0, 32):
        set_ = long.select((F.shiftright("g", part).bitwiseAND(F.lit(room - 1))).cast("int").alias("at")).distinct().toArrow().column("at").to_numpy()
        np.bitwise_or.at(bits, set_ >> 3, np.uint8(1) << (set_ & 7).astype(np.uint8))
    each = _grams(quotes.filter(F.length(text) >= least).select(*keys, F.col(owner).alias("_owner"), F.col(text).alias("_text")), "_text", least, bits)
    others = (F.col("_owner") != F.col("first")) | (F.col("_owner") != F.col("last"))
    named = each.join(long, "g").filter(others & F.contains("_text", F.col("title"))).select(*keys, F.lit("other_title").alias("flag")).distinct()
    return flags.unionByName(named)


def _grams(rows: DataFrame, text: str, n: int, bits: np.ndarray | None) -> DataFrame:
    """``rows`` with ``g``, the hash of a gram of ``n`` characters of ``text``: a row for each distinct one, of those only whose two bits are in ``bits`` if that is given."""
    schema = StructType([*rows.schema, StructField("g", LongType())])
    place = rows.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column(place).to_pylist()):
                c = np.frombuffer((value or "").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
                if len(c) < n:
                    continue
                g = mix(np.lib.stride_tricks.sliding_window_view(c, n) @ power)
                if bits is not None:
                    for part in (0, 32):
                        b = (g >> np.uint64(part)) & np.uint64(len(bits) * 8 - 1)
                        g = g[(bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                g = np.unique(g)
                at.append(np.full(len(g), i))
                found.append(g)
            if at:
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(np.concatenate(at), pa.int64())).columns, pa.array(np.concatenate(found).view(np.int64))], schema.names)

    return rows.mapInArrow(cut, schema)


def material_number(layer: Column, candidate_type: Column, signals: Column, kind: Column, core: Column, claimed: Column, numeric_types: Sequence[str]) -> Column:
    """Whether a number matters: in minimal evidence if its kind is explicit or the candidate's type is numeric; in support if that type is numeric and the segment signals
    both a number and a proposition; and wherever its core is among those that the claim mentions."""
    numeric = candidate_type.isin(*numeric_types)
    proposition = F.arrays_overlap(signals, F.array(F.lit("comparison"), F.lit("experiment"), F.lit("test_result")))
    own = ((layer == "minimal") & ((kind != "bare") | numeric)) | ((layer == "support") & numeric & F.array_contains(signals, "number") & proposition)
    return own | F.array_contains(claimed, core)
