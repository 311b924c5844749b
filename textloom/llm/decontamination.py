"""Benchmark decontamination: word suffix arrays of the training text, searched for every suffix of the test items.

A shard is a slice of about two megabytes of training text. Its words become ranks among the test words (a word that no item has
ends every match, and is one rank of its own), its suffixes that start with a test word are sorted by prefix doubling, and the
suffixes of all items are looked up at once by binary search, word by word, until their range is empty. The last range of a
suffix holds its longest verbatim matches and their places; the range at window length holds the occurrences of its window.

Test items are the stated query set. They are read in blocks of about ``block_bytes`` of text, and driver and tasks hold one block at a time, whatever the
size of the benchmark. Each block after the first is searched in a pass of its own over the training text, whose few documents with matches are
written; the pass of the first block takes these up. Training text is read where it lies and, with one block, never shuffled.

Defined results: null or blank texts have no words, items or hits; items without words never occur; repeated items count once by
item id; matches never cross documents; an empty table on either side gives no hits; ``clean`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ALNUM, Words, slices, text_bytes, written

FOUND = "struct<n_words: bigint, spans: array<struct<s: bigint, e: bigint>>, items: array<string>, longest: bigint>"


@dataclass(frozen=True)
class TestBlock:
    """Items of one block: sorted hashes of their words; ranks of the words end to end; and suffixes by start, end of item and window length (0: no window starts here)."""

    vocabulary: np.ndarray
    ranks: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    window: np.ndarray
    window_id: np.ndarray
    items_of: list[list[str]]

    __test__ = False


def test_block(items: list[tuple[object, str | None]], window: int) -> TestBlock:
    """Index the items (id, text): their suffixes, and for each distinct window the ids of the items that have it."""
    data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
    words = Words(data, offsets, ALNUM, lower=True)
    vocabulary, ranks = np.unique(words.hashes(), return_inverse=True)
    counts = words.counts() if len(items) else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    start = np.arange(len(words))
    stop = ends[words.row] if len(words) else start
    length = np.where(stop - start >= window, window, np.where((counts[words.row] < window) & (start == ends[words.row] - counts[words.row]), counts[words.row], 0)) if len(words) else start
    names, items_of = {}, []
    window_id = np.full(len(words), -1)
    for i in np.flatnonzero(length):
        key = ranks[i : i + length[i]].tobytes()
        if key not in names:
            names[key] = len(items_of)
            items_of.append([])
        else:
            length[i] = -length[i]  # the window is looked up once
        window_id[i] = names[key]
        items_of[names[key]].append(str(items[words.row[i]][0]))
    return TestBlock(vocabulary, ranks.astype(np.int64), start, stop, np.maximum(length, 0), window_id, [sorted(set(x)) for x in items_of])


test_block.__test__ = False


def suffix_array(ranks: np.ndarray, row: np.ndarray, unknown: int, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a known word, in order of their first ``depth`` words at least, each cut at its row's end or its first unknown word."""
    n = len(ranks)
    bits = max(1, int(unknown + 1).bit_length())
    per = max(1, 62 // bits)
    level = np.where(ranks == unknown, 0, ranks + 1).astype(np.int64)
    last = np.concatenate((row[1:] != row[:-1], [True])) if n else np.zeros(0, bool)
    # A suffix ends after an unknown word or the last word of its row: what follows counts as 0.
    closed = last | (level == 0)
    key, alive, at = level.copy(), ~closed, level
    for k in range(1, per):
        at = np.concatenate((level[k:], np.zeros(min(k, n), np.int64)))
        key = (key << bits) | np.where(alive, at, 0)
        alive = alive & ~np.concatenate((closed[k:], np.ones(min(k, n), bool)))
    order = np.argsort(key)
    rank = np.zeros(n, np.int64)
    reach = per
    new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if n else np.zeros(0, bool)
    rank[order] = np.cumsum(new)
    # alive says whether the first ``reach`` words are all there, so that the suffix goes on after them.
    while reach < depth:
        size = np.bincount(rank, minlength=n + 2)
        open_ = np.flatnonzero((size[rank] > 1) & alive)
        if not len(open_):
            break
        follow = np.where(open_ + reach < n, rank[np.minimum(open_ + reach, n - 1)], 0)
        o = np.lexsort((follow, rank[open_]))
        sub, f = open_[o], follow[o]
        base = rank[sub]
        fresh = np.concatenate(([True], base[1:] != base[:-1]))
        step = np.concatenate(([True], (base[1:] != base[:-1]) | (f[1:] != f[:-1])))
        # Ranks leave gaps the size of their groups: the first of a group keeps its rank plus what stands closed before it.
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(sub)), 0))
        groups = np.cumsum(step)
        offset = groups - groups[first]
        spread = np.zeros(n + 2, np.int64)
        inner = np.zeros(n + 2, np.int64)
        np.maximum.at(inner, base, offset + 1)
        spread[1:] = np.cumsum(np.maximum(inner, 1) * (size > 0))[:-1]
        fresh_rank = spread[rank] + 1
        fresh_rank[sub] += offset
        further = np.concatenate((alive[reach:], np.zeros(min(reach, n), bool)))
        rank, alive, reach = fresh_rank, alive & further, reach * 2
    order = np.argsort(rank, kind="stable")
    return order[level[order] > 0]


def _bounds(words_at: Callable[[np.ndarray], np.ndarray], lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within sorted ranges [lo, hi), the sub-ranges equal to ``want``; all ranges are searched at once."""
    out = []
    for strict in (False, True):
        a, b = lo.copy(), hi.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            value = words_at(np.where(open_, mid, 0))
            right = open_ & ((value <= want) if strict else (value < want))
            a, b = np.where(right, mid + 1, a), np.where(open_ & ~right, mid, b)
        out.append(a)
    return out[0], out[1]


def search(ranks: np.ndarray, row: np.ndarray, block: TestBlock, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, length, window id) of each occurrence of a window; ``longest`` gets each row's longest match of a suffix that starts with a window."""
    none = np.zeros(0, np.int64)
    if not len(ranks) or not len(block.start):
        return none, none, none
    depth = int((block.stop - block.start).max())
    order = suffix_array(ranks, row, len(block.vocabulary), depth)
    if not len(order):
        return none, none, none
    row_end = np.concatenate((np.flatnonzero(row[1:] != row[:-1]) + 1, [len(row)]))
    stop = row_end[np.searchsorted(row_end, order, "right")]
    active = np.arange(len(block.start))
    lo, hi = np.zeros(len(active), np.int64), np.full(len(active), len(order))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def places(which: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = hi - lo
        return np.repeat(which, n), order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]

    for d in range(depth):
        go = block.start[active] + d < block.stop[active]
        self_done = active[~go], lo[~go], hi[~go]
        active, lo, hi = active[go], lo[go], hi[go]
        want = block.ranks[block.start[active] + d]

        def words_at(i: np.ndarray, d: int = d) -> np.ndarray:
            p = order[i] + d
            inside = p < stop[i]
            value = np.where(inside, ranks[np.minimum(p, len(ranks) - 1)], -1)
            return np.where(value == len(block.vocabulary), -1, value)

        a, b = _bounds(words_at, lo, hi, want)
        some = a < b
        for which, x, y in (self_done, (active[~some], lo[~some], hi[~some])):
            deep = block.window_id[which] >= 0
            deep &= d >= np.where(deep, np.abs(block.window[which]) + (block.window[which] == 0), 1)
            if deep.any():
                _, p = places(which[deep], x[deep], y[deep])
                np.maximum.at(longest, row[p], d)
        active, lo, hi = active[some], a[some], b[some]
        here = block.window[active] == d + 1
        if here.any():
            which, p = places(active[here], lo[here], hi[here])
            found.append((p, np.full(len(p), d + 1), block.window_id[which]))
        if not len(active):
            break
    else:
        deep = block.window_id[active] >= 0
        _, p = places(active[deep], lo[deep], hi[deep])
        np.maximum.at(longest, row[p], depth)
    if not found:
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def matches(column: pa.Array, block: TestBlock) -> pa.Array:
    """For each text its words, the spans of words that windows cover, the items whose windows occur, and the longest match."""
    data, offsets = text_bytes(column)
    n_words, longest = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    spans: list[list[dict]] = [[] for _ in range(len(column))]
    items: list[list[str]] = [[] for _ in range(len(column))]
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM, lower=True)
        n_words[lo:hi] = words.counts()
        hashes = words.hashes()
        ranks = np.searchsorted(block.vocabulary, hashes)
        known = ranks < len(block.vocabulary)
        known[known] = block.vocabulary[ranks[known]] == hashes[known]
        ranks[~known] = len(block.vocabulary)
        position, length, window = search(ranks, words.row, block, longest[lo:hi])
        if not len(position):
            continue
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, position, 1)
        np.add.at(edge, position + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        change = np.concatenate((words.row[1:] != words.row[:-1], [True]))
        first = np.flatnonzero(covered & np.concatenate(([True], ~covered[:-1] | change[:-1])))
        last = np.flatnonzero(covered & (np.concatenate((~covered[1:], [True])) | change))
        begin = np.concatenate(([0], np.cumsum(words.counts())))
        for s, e in zip(first.tolist(), last.tolist(), strict=True):
            r = int(words.row[s])
            spans[lo + r].append({"s": s - int(begin[r]), "e": e + 1 - int(begin[r])})
        for r, w in set(zip(words.row[position].tolist(), window.tolist(), strict=True)):
            items[lo + r] += block.items_of[w]
    return pa.array([{"n_words": n, "spans": s, "items": sorted(set(i)), "longest": m} for n, s, i, m in zip(n_words.tolist(), spans, items, longest.tolist(), strict=True)])


def finders(benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = 10, block_bytes: int = 1 << 20) -> Iterator[Callable[[Column], Column]]:
    """One function per block of test items, made when it is asked for; each makes a column of what ``matches`` finds in a text column."""
    items = benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for b in range(blocks):
        block = test_block([tuple(r) for r in items.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b).collect()], window)

        def make(column: Column, block: TestBlock = block) -> Column:
            @F.arrow_udf(FOUND)
            def apply(texts: pa.Array) -> pa.Array:
                return matches(texts, block)

            return apply(column)

        yield make


def _id(key: str, text: str) -> Column:
    """Names a document for joins; rows of one key and text have one fate."""
    return F.struct(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))


def _hits(documents: DataFrame, further: Iterator[Callable[[Column], Column]], key: str, text: str) -> DataFrame | None:
    """(id, spans, items, longest) of the documents with matches in any of the blocks; None for no block."""
    found = None
    for f in further:
        each = documents.select(_id(key, text).alias("id"), f(F.col(text)).alias("r")).select("id", "r.spans", "r.items", "r.longest")
        each = written(each.filter("longest > 0 OR size(items) > 0").dropDuplicates(["id"]), "hits")
        found = each if found is None else found.unionByName(each)
    if found is None:
        return None
    return found.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"), F.max("longest").alias("more_longest"))


def _covered(spans: Column) -> Column:
    """Words that the spans cover, overlaps once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(F.sort_array(spans), start, lambda a, x: F.struct((a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], x["e"]).alias("end")))["n"]


def find(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = 10, **how) -> DataFrame:
    """(key, n_words, n_hit, items, longest, spans) for each document."""
    made = finders(benchmark, window=window, **how)
    first = next(made)
    more = _hits(documents, made, key, text)
    rows = documents.select(F.col(key).alias("key"), _id(key, text).alias("id"), first(F.col(text)).alias("r")).select("key", "id", "r.*")
    if more is not None:
        none = {c: F.array().cast(rows.schema[c].dataType) for c in ("spans", "items")}
        rows = rows.join(more, "id", "left").select(
            "key",
            "n_words",
            *[F.concat(c, F.coalesce(f"more_{c}", none[c])).alias(c) for c in none],
            F.greatest("longest", "more_longest").alias("longest"),
        )
    return rows.select(F.col("key").alias(key), "n_words", _covered(F.col("spans")).alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"), "longest", "spans")


def clean(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = 10, **how) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns."""
    made = finders(benchmark, window=window, **how)
    kept = documents.filter(F.size(next(made)(F.col(text))["items"]) == 0)
    more = _hits(documents, made, key, text)
    if more is None:
        return kept
    names = documents.columns
    held = kept.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row"), _id(key, text).alias("id"))
    return held.join(more.filter(F.size("more_items") > 0).select("id"), "id", "left_anti").select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
