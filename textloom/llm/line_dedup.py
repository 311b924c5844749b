"""Line dedup by pairwise alignment: documents that share lines are aligned by patience diff, and common blocks leave the later one.

Documents are ordered by key. Each line that several documents hold leads back to the first of them, so that a line of n documents
makes n - 1 pairs, not n squared, and copies in any number cost no more than their size. A document is paired along each of its
shared lines, however rare or frequent. Only lines that
several documents hold are shipped for alignment. A matched block leaves the later document if it has at least
``min_block_chars`` characters. What is removed is judged on the input, and the first document with a line always keeps it.

Hot lines and hot first documents are join keys of inner sort-merge joins, which the adaptive planner splits; counts and minima combine
before the shuffle. The result needs no group larger than the lines of one document.

Defined results: null and empty texts have no lines; blank lines are never compared nor removed; lines are compared without
trailing white space, by 64-bit hash; rows with the same key and text share one fate, rows with the same key and other texts
are ordered by text hash; a null key comes first; an empty table gives an empty result; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import written


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), rising in both: common ends, then unique common lines in longest order, and the same between them."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        in_a, in_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        at_a = {x: i for i, x in enumerate(a[alo:ahi], alo) if in_a[x] == 1}
        pairs = [(at_a[x], j) for j, x in enumerate(b[blo:bhi], blo) if in_b[x] == 1 and x in at_a]
        chain = rising(pairs)
        last_a, last_b = alo, blo
        for i, j in chain:
            todo.append((last_a, i, last_b, j))
            out.append((i, j))
            last_a, last_b = i + 1, j + 1
        if chain:
            todo.append((last_a, ahi, last_b, bhi))
    return sorted(out, key=lambda p: p[1])


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of ``pairs`` whose first members rise."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for k, (i, _) in enumerate(pairs):
        n = bisect_left(ends, i)
        before[k] = at[n - 1] if n else -1
        if n == len(ends):
            ends.append(i)
            at.append(k)
        else:
            ends[n], at[n] = i, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def common_blocks(a: tuple[list[int], list[int]], b: tuple[list[int], list[int], list[int], list[int]], min_chars: int) -> list[int]:
    """Lines of b in aligned blocks of at least ``min_chars``. a: hashes and places; b: hashes, places, line numbers and characters."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a[0], b[0]), (-1, -1)]:
        here = (a[1][i], b[1][j]) if i >= 0 else (-9, -9)
        if here != (last[0] + 1, last[1] + 1):
            if sum(b[3][k] for k in block) >= min_chars:
                out += [b[2][k] for k in block]
            block = []
        block.append(j)
        last = here
    return out


def _identity(key: str, text: str) -> Column:
    return F.struct(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))


def removals(documents: DataFrame, key: str = "doc_id", text: str = "text", min_block_chars: int = 30) -> DataFrame:
    """(id, gone): the numbers of the lines to be removed of each document that loses any; ``id`` is a struct of key and text hash."""
    lines = F.filter(
        F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("line"), F.rtrim(F.regexp_replace(x, r"\s+$", "")).alias("x"))),
        lambda s: s["x"] != "",
    )
    each = documents.select(_identity(key, text).alias("id"), F.posexplode(lines).alias("place", "l"))
    each = written(each.select("id", "place", F.col("l.line").alias("line"), F.xxhash64("l.x").alias("h"), F.length("l.x").alias("chars")).distinct(), "lines")
    first = each.select("h", "id").distinct().groupBy("h").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("docs")).filter("docs > 1").drop("docs")
    shared = written(each.join(first, "h"), "shared")
    pairs = shared.filter("first < id").select("id", "first").distinct()
    spelled = shared.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "line", "h", "chars"))).alias("s"))
    spelled = spelled.select("id", *[F.col("s").getField(c).alias(c) for c in ("h", "place", "line", "chars")])
    of_first = spelled.select(F.col("id").alias("first"), F.col("h").alias("ah"), F.col("place").alias("ap"))
    kind = documents.schema[key].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ah, ap, bh, bp, bl, bc = (c.to_pylist() for c in part.columns[1:])
                gone = [common_blocks((x[0], x[1]), x[2:], min_block_chars) for x in zip(ah, ap, bh, bp, bl, bc, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(gone, pa.list_(pa.int32()))], ["id", "gone"])

    both = pairs.join(of_first, "first").join(spelled, "id").select("id", "ah", "ap", "h", "place", "line", "chars")
    gone = both.mapInArrow(align, f"id struct<k: {kind}, t: bigint>, gone array<int>").filter(F.size("gone") > 0)
    return gone.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def without_lines(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines of the given numbers."""
    out = []
    for lo in range(0, len(texts), 1000):
        for text, lines in zip(texts.slice(lo, 1000).to_pylist(), gone.slice(lo, 1000).to_pylist(), strict=True):
            if lines:
                drop = set(lines)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
            out.append(text)
    return pa.array(out, pa.string())


def dedup(documents: DataFrame, key: str = "doc_id", text: str = "text", drop_emptied: bool = False, with_gone: str | None = None, **how) -> DataFrame:
    """The documents without their removed lines, with their columns; with ``drop_emptied`` those left blank by it go too. ``with_gone`` names a column of line numbers to add."""
    gone = removals(documents, key, text, **how)
    names = documents.columns
    joined = documents.select(_identity(key, text).alias("id"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")).join(gone, "id", "left")
    joined = joined.withColumn("text", F.arrow_udf(without_lines, "string")(F.col(f"row.c{names.index(text)}"), F.col("gone")))
    if drop_emptied:
        joined = joined.filter(F.col("gone").isNull() | F.col("text").rlike(r"\S"))
    columns = [(F.col("text") if c == text else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)]
    return joined.select(*columns, *([F.coalesce("gone", F.array().cast("array<int>")).alias(with_gone)] if with_gone else []))
