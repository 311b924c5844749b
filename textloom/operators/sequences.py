"""Ordered rows: cleaning, islands, sessions, sliding and hopping windows, samples; and greedy packing, which no window can express."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators import ranking


def clean_segments(rows: DataFrame, by: str, order: str, start: str, valid: Column) -> DataFrame:
    """Rows with ``reason`` (null if kept) and, for kept rows, dense ``clean_index`` and ``duration`` to the next kept start.

    A row is invalid by ``valid`` or goes backwards: it starts before the latest valid start so far. Kept starts never fall, so
    the latest kept start is the running maximum of the valid ones, and one window does for the sequential rule.
    """
    ahead = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumn("_ok", F.coalesce(valid, F.lit(False)))
    marked = marked.withColumn("_high", F.max(F.when(F.col("_ok"), F.col(start))).over(ahead))
    marked = marked.withColumn("reason", F.when(~F.col("_ok"), "invalid").when(F.col(start) < F.col("_high"), "backwards"))
    kept = Window.partitionBy(by, F.col("reason").isNull()).orderBy(order)
    marked = marked.withColumn("clean_index", F.when(F.col("reason").isNull(), F.row_number().over(kept) - 1))
    return marked.withColumn("duration", F.when(F.col("reason").isNull(), F.lead(start).over(kept) - F.col(start))).drop("_ok", "_high")


def islands(rows: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """(by, lo, hi, n): runs of consecutive values of ``index``."""
    order = Window.partitionBy(*by).orderBy(index)
    return rows.withColumn("_run", F.col(index) - F.row_number().over(order)).groupBy(*by, "_run").agg(F.min(index).alias("lo"), F.max(index).alias("hi"), F.count(F.lit(1)).alias("n")).drop("_run")


def sessions(rows: DataFrame, by: Sequence[str], at: str, gap: float) -> DataFrame:
    """``session``, counted from 1 within the key: a new one begins where ``at`` is more than ``gap`` after the row before."""
    order = Window.partitionBy(*by).orderBy(at)
    begins = (F.col(at) - F.lag(at).over(order) > gap) | F.lag(at).over(order).isNull()
    return rows.withColumn("session", F.sum(begins.cast("int")).over(order.rangeBetween(Window.unboundedPreceding, 0)))


def sliding(rows: DataFrame, index: str, size: int, stride: int) -> DataFrame:
    """``window`` ids of the sliding row windows that hold each row: window w has the rows from w * stride on, ``size`` of them."""
    low = F.greatest(F.lit(0), F.ceil((F.col(index) - size + 1) / stride))
    return rows.withColumn("window", F.explode(F.sequence(low, F.floor(F.col(index) / stride))))


def hopping(spans: DataFrame, duration: str, size: int, overlap: int) -> DataFrame:
    """(columns, window, start, end, clip_start, clip_end): nominal windows over [0, duration) and their overlapping reading spans."""
    made = spans.withColumn("window", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(duration) / size) - 1, F.lit(0)))))
    end = F.least((F.col("window") + 1) * size, F.col(duration))
    return made.withColumn("start", F.col("window") * size).withColumn("end", end).withColumn("clip_start", F.greatest(F.col("start") - overlap, F.lit(0))).withColumn("clip_end", F.least(F.col("end") + overlap, F.col(duration)))


def systematic_sample(rows: DataFrame, order: Sequence[str], k: int, by: Sequence[str] = ()) -> DataFrame:
    """Evenly spaced ``k`` rows of each key, ends included; halves round to even. With fewer rows, all of them."""
    key = F.struct(*by) if by else F.lit(0)
    numbered = ranking.numbered(rows.withColumn("_key", F.xxhash64(key)), "_key", list(order), "_i").withColumn("_i", F.col("_i") - 1)
    sizes = rows.withColumn("_key", F.xxhash64(key)).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    numbered = numbered.join(sizes, "_key").drop("_key")
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(k - 1, 1)), 0).cast("int"))
    return numbered.filter((F.col("_n") <= k) | F.array_contains(picks, F.col("_i"))).drop("_i", "_n")


def greedy_chunks(rows: DataFrame, by: str, order: str, length: str, max_chars: int, cost: int, start: str | None = None, max_span: float = 0.0) -> DataFrame:
    """``chunk`` per row: a new one begins where the characters plus ``cost`` a row would exceed ``max_chars``, or ``max_span`` after its first start.

    Where a chunk begins depends on where the last one did, so each key's rows go through one ordered pass; a key is one document or conversation.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", chunk int"

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        chunk, used, first, out = 0, 0, None, []
        starts = group[start] if start else [None] * len(group)
        for n, at in zip(group[length], starts, strict=True):
            over = used and (used + n + cost > max_chars or (start is not None and at - first >= max_span))
            if over:
                chunk, used = chunk + 1, 0
            if not used:
                first = at
            used += n + cost
            out.append(chunk)
        return group.assign(chunk=pd.Series(out, index=group.index, dtype="int32"))

    return rows.groupBy(by).applyInPandas(walk, schema)


def units(rows: DataFrame, by: str, order: str, *, start: str, duration: str, chars: str, opens: str, topics: str, roles: str, max_rows: int = 6, max_chars: int = 900, max_gap: float = 6.0) -> DataFrame:
    """``unit`` per row, counted from 1 within the key. ``topics`` and ``roles`` are bit sets of cues, ``opens`` says that a row opens a new thought.

    A unit ends before a row that would make it too long in rows or characters, that starts too long after the row before ended, that brings a role
    which the unit hasn't, or that opens a new thought on cues, roles included, of which a unit of two rows and more has others only.
    Gaps are found by window functions first, so that only the rows between two gaps pass through one ordered walk.
    """
    key = Window.partitionBy(by).orderBy(order)
    gap = F.col(start) - F.lag(F.col(start) + F.col(duration)).over(key) > max_gap
    stretched = rows.withColumn("_stretch", F.sum(F.coalesce(gap, F.lit(False)).cast("int")).over(key.rowsBetween(Window.unboundedPreceding, 0)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stretched.schema) + ", _begins int"

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        n = used = topic = role = 0
        begins = []
        for length, opening, t, r in zip(*(group[c].fillna(0) for c in (chars, opens, topics, roles)), strict=True):
            cues, had = int(t) | int(r) << 32, topic | role << 32
            turned = n >= 2 and opening and cues and had and not cues & had
            new = not n or n >= max_rows or used + length > max_chars or turned or (r and r != role)
            if new:
                n = used = topic = role = 0
            n, used, topic, role = n + 1, used + length, topic | int(t), role | int(r)
            begins.append(int(bool(new)))
        return group.assign(_begins=pd.Series(begins, index=group.index, dtype="int32"))

    walked = stretched.groupBy(by, "_stretch").applyInPandas(walk, schema)
    return walked.withColumn("unit", F.sum("_begins").over(key.rowsBetween(Window.unboundedPreceding, 0))).drop("_stretch", "_begins")


def refreshed(previous: DataFrame, source: DataFrame, key: str, version: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The derived table anew: what ``build`` makes of ``source`` with (stamp, version, reused), built only for keys whose source or version changed.

    A key's stamp is a sum of row hashes, so order doesn't count; keys that left the source go. ``previous`` has the columns of the result.
    """
    stamps = source.groupBy(key).agg(F.sum(F.xxhash64(*sorted(source.columns)).cast("decimal(38,0)")).cast("string").alias("stamp"))
    kept = previous.filter(F.col("version") == version).join(stamps, [key, "stamp"], "left_semi").withColumn("reused", F.lit(True))
    stale = stamps.join(kept.select(key, "stamp").distinct(), [key, "stamp"], "left_anti")
    built = build(source.join(stale.select(key), key, "left_semi")).join(stale, key).withColumns({"version": F.lit(version), "reused": F.lit(False)})
    return built.unionByName(kept.select(*built.columns))


def kept_surfaces(rows: DataFrame, by: str, category: str, order: str, lineage: str, members: str, overlap: float = 0.3) -> DataFrame:
    """(by, order, kept): in order, a row is dropped if its lineage was seen, or if a kept row of its category has at least ``overlap`` of the smaller of both ``members``.

    What is kept depends on what was kept before, so each key's rows go through one ordered pass; a key is one document.
    """
    typed = {f.name: f.dataType.simpleString() for f in rows.schema}

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        seen, kept, out = set(), [], []
        for k, c, line, own in group.sort_values(order, kind="stable")[[order, category, lineage, members]].itertuples(index=False):
            own = set(own)
            near = any(c == d and own and other and len(own & other) / min(len(own), len(other)) >= overlap for d, other in kept)
            ok = line not in seen and not near
            if ok:
                seen.add(line)
                kept.append((c, own))
            out.append((group[by].iloc[0], k, ok))
        return pd.DataFrame(out, columns=[by, order, "kept"])

    return rows.select(by, category, order, lineage, members).groupBy(by).applyInPandas(walk, f"{by} {typed[by]}, {order} {typed[order]}, kept boolean")


def merged_closures(rows: DataFrame, by: str, kind: str, order: str, risk: str, members: str, overlap: float = 0.6) -> DataFrame:
    """(by, order, into): by falling risk, then order, a row is merged into the first row of its kind that stands and shares at least ``overlap`` of the smaller of both member sets, which takes its members; else it stands."""
    typed = {f.name: f.dataType.simpleString() for f in rows.schema}

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        standing: list[tuple[object, object, set]] = []
        out = []
        for k, c, own in group.sort_values([risk, order], ascending=[False, True], kind="stable")[[order, kind, members]].itertuples(index=False):
            own = set(own)
            into = next((s for s in standing if s[1] == c and own and s[2] and len(own & s[2]) / min(len(own), len(s[2])) >= overlap), None)
            if into:
                into[2].update(own)
            else:
                standing.append((k, c, own))
            out.append((group[by].iloc[0], k, into[0] if into else k))
        return pd.DataFrame(out, columns=[by, order, "into"])

    return rows.select(by, kind, order, risk, members).groupBy(by).applyInPandas(walk, f"{by} {typed[by]}, {order} {typed[order]}, into {typed[order]}")


def chapter_parts(rows: DataFrame, chapters: DataFrame, by: str, at: str, length: str, max_chars: int, cost: int = 64) -> DataFrame:
    """Rows with ``chapter``, the title of the chapter (by, starts, title) that they are in, and ``part``, counted from 1 within it: parts are packed greedily up to ``max_chars``, ``cost`` a row.

    Of several chapters that start at once the least title counts; rows before the first chapter have none, and are parts of their own.
    """
    from textloom.operators import joins

    first = chapters.groupBy(by, F.col("starts").alias(at)).agg(F.min(F.struct("title")).alias("_t")).withColumn("_c", F.struct(F.col(at).alias("starts"), F.col("_t.title").alias("title")))
    placed = joins.asof(rows, first.select(by, at, "_c"), [by], at, "_c")
    key = F.xxhash64(by, F.coalesce(F.col("_c.starts").cast("string"), F.lit("")))
    packed = greedy_chunks(placed.withColumn("_key", key).withColumn("chapter", F.col("_c.title")).drop("_c"), "_key", at, length, max_chars, cost)
    return packed.withColumn("part", F.col("chunk") + 1).drop("_key", "chunk")
