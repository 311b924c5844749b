"""Suffix-array dedup over a run-length index: every byte inside a string of ``length`` bytes that starts anywhere else too.

1. Each string of ``length`` bytes is named by the least hash of its grams (``GRAMS[0]`` bytes each). Neighbouring strings of one name make a stretch, so
   texts fall into stretches of some 600 bytes, and equal strings get equal names wherever they stand. Stretches move as numbers: name and content hash.
2. A name seen once is unique, unless its stretch is periodic; a name with one content seen several times is repeated whole. Names with several contents are looked into:
   each different content is cut out of one document and sent, once, to the shard of its name.
3. A shard builds a run-length index of its contents: the runs of the Burrows-Wheeler transform, where each run's places go one byte further back, and, sampled at both
   ends of each run, the common prefixes with the neighbours there. Matching statistics of all contents against all others are streamed backwards through
   the runs alone: inside a run a common prefix grows by one byte a step, at a run's end it is the sample. Strings whose longest match reaches ``length`` are repeated.
4. Contents of a name that weigh more than a shard (a frequent passage in many settings) are cut again by the next, longer grams, of which strings that reach far out of
   the passage share none. What is still too heavy for a shard under the longest grams is a few strings a content; these are hashed and counted, which combines
   before the shuffle and has no hot key. No step drops anything, and every task is bounded.
5. Repeated strings go back to the documents that hold their stretches, and their bytes are removed there.

Defined results: null counts as empty; texts shorter than ``length`` keep all; matches never cross documents; rows repeated whole repeat each other; a null key is a
key like others; an empty table gives an empty result; other columns of the input are ignored. Strings are compared by hashes of 128 bits (name and content) or byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import common
from textloom.llm.common import mix, slices, text_bytes, written

#: Bytes of the grams that name strings: first of all of them, then of those of names too heavy for a shard.
GRAMS = (32, 384)
END = 0xFF  # no byte of UTF-8
#: Most bytes that one walk through the index goes back; longer contents are walked in parts.
WALK = 1024
_U = np.uint64
STRETCH = "start int, windows int, name long, content long, inner boolean"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at each position."""
    power, inverse = common._power(len(data) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(common._BYTE_KEYS[data]) * power[:-1])))
    return mix((total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1] + _U(gram))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.concatenate((values, np.full(-len(values) % width, ~_U(0))))
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, name, content, inner) of the stretches of each row; ``inner`` tells that a stretch may repeat within itself."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int64, np.int64, bool))
    if len(data) < length:
        return none
    grams = gram_hashes(data, gram)
    name = sliding_least(grams, length - gram + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[: len(name)] == row[length - 1 :]
    first = inside & np.concatenate(([True], (name[1:] != name[:-1]) | (row[1 : len(name)] != row[: len(name) - 1]) | ~inside[:-1]))
    start = np.flatnonzero(first)
    if not len(start):
        return none
    # A stretch ends before the next one or with the last whole window of its row.
    last = offsets[row[start] + 1] - length
    windows = np.minimum(np.concatenate((start[1:], [len(name)])), last + 1) - start
    power, inverse = common._power(len(data) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(common._BYTE_KEYS[data]) * power[:-1])))
    end = start + windows - 1 + length
    # A content is told by its last window, and by the gram and place of each window before it, mixed one by one: sums of powers alone cancel out over long texts of
    # two alternating blocks. A stretch has at least one window, so every second sum is that of a stretch.
    place = np.arange(start[0], len(name)) - np.repeat(start, np.diff(np.append(start, len(name))))
    each = np.append(mix(grams[start[0] : len(name)] + place.astype(_U) * common._BASE), _U(0))
    spelled = np.add.reduceat(each, np.column_stack((start, start + windows)).ravel() - start[0])[::2]
    content = mix((total[end] - total[end - length]) * inverse[end - length] + mix(spelled + windows.astype(_U)))
    # If a window starts with its least gram and the next keeps the name, that gram comes again in the stretch; a stretch that repeats in itself has such a window.
    goes_on = np.flatnonzero((grams[: len(name) - 1] == name[:-1]) & (name[1:] == name[:-1]) & inside[:-1] & inside[1:] & (row[1 : len(name)] == row[: len(name) - 1]))
    inner = np.zeros(len(start), bool)
    inner[np.searchsorted(start, goes_on, "right") - 1] = True
    return row[start], (start - offsets[row[start]]).astype(np.int32), windows.astype(np.int32), name[start].view(np.int64), content.view(np.int64), inner


@dataclass(frozen=True)
class RunIndex:
    """Runs of the Burrows-Wheeler transform, and samples at both ends of each.

    ``start`` is the first place of each run, with the number of places at the end, and ``byte`` its byte. One byte further back the run's places stand in a row from place
    ``back`` on; ``above`` and ``below`` are the common prefixes there of its first place with the one before and of its last with the one after.
    ``entry`` has the place of some text positions, and their common prefixes with the places before and after: where walks begin.
    """

    byte: np.ndarray
    start: np.ndarray
    back: np.ndarray
    above: np.ndarray
    below: np.ndarray
    entry: np.ndarray


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``text``, which ends with END and has no two END in a row, in order, by prefix doubling from eight bytes on; places once alone in their group are not sorted again."""
    n = len(text)
    key = eight(text)
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, at, 0))
    alone = head & np.concatenate((head[1:], [True]))
    todo, reach = order[~alone], 8
    while len(todo):
        group = rank[todo]
        # The text's end counts as more than any byte, as in ``eight``: steps back by one byte must keep the order.
        follow = np.where(todo + reach < n, rank[np.minimum(todo + reach, n - 1)], n)
        o = np.argsort(group * (n + 2) + follow)
        todo, group, follow = todo[o], group[o], follow[o]
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new = new_group | np.concatenate(([True], follow[1:] != follow[:-1]))
        k = np.arange(len(todo))
        rank[todo] = group + np.maximum.accumulate(np.where(new, k, 0)) - np.maximum.accumulate(np.where(new_group, k, 0))
        todo = todo[~(new & np.concatenate((new[1:], [True])))]
        reach *= 2
    out = np.empty(n, np.int64)
    out[rank] = at
    return out


def eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; END after the end."""
    padded = np.concatenate((text, np.full(7, END, np.uint8)))
    key = np.zeros(len(text), _U)
    for k in range(8):
        key = (key << _U(8)) | padded[k : k + len(text)]
    return key


def common_prefix(text: np.ndarray, key: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at p and q share, pair by pair."""
    n, out = len(text), np.zeros(len(p), np.int64)
    active = np.arange(len(p))
    while len(active):
        a, b = p[active] + out[active], q[active] + out[active]
        inside = np.maximum(a, b) < n
        active, a, b = active[inside], a[inside], b[inside]
        differ = key[a] ^ key[b]
        same = differ == 0
        part = differ[~same]
        lead = np.zeros(len(part), np.int64)
        for k in range(1, 8):
            lead += (part >> _U(64 - 8 * k)) == 0
        out[active[~same]] += lead
        active = active[same]
        out[active] += 8
    return np.minimum(out, n - np.maximum(p, q))


def run_index(text: np.ndarray, entries: np.ndarray) -> RunIndex:
    """Index of ``text``, with walks to begin at the positions ``entries``. The suffix order and common prefixes that it is built from are dropped again."""
    n, order, key = len(text), suffix_order(text), eight(text)

    def with_next(place: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at ``place`` and the next one; 0 before the first and after the last."""
        out, inside = np.zeros(len(place), np.int64), (place >= 0) & (place < n - 1)
        out[inside] = common_prefix(text, key, order[place[inside]], order[place[inside] + 1])
        return out

    before = np.where(order > 0, text[order - 1].astype(np.int16), 256)
    start = np.concatenate(([0], np.flatnonzero(before[1:] != before[:-1]) + 1))
    byte, run = before[start], np.diff(np.append(start, n))
    by_byte = np.argsort(byte, kind="stable")
    back = np.empty(len(run), np.int64)
    back[by_byte] = np.cumsum(run[by_byte]) - run[by_byte]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    place = rank[entries]
    return RunIndex(byte, np.append(start, n), back, with_next(back - 1), with_next(back + run - 1), np.array([place, with_next(place - 1), with_next(place)]))


def walked(index: RunIndex, steps: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(step, walks, whether the longest match with any other suffix has ``length``), byte by byte back from each entry, all walks at once."""
    walks = np.argsort(-steps, kind="stable")
    ends = steps[walks]
    place, above, below = (x[walks] for x in index.entry)
    for step in range(1, int(ends[0]) + 1 if len(ends) else 1):
        n = np.searchsorted(-ends, -step, "right")
        place, above, below = place[:n], above[:n], below[:n]
        run = np.searchsorted(index.start, place, "right") - 1
        above = np.where(place == index.start[run], index.above[run], above + 1)
        below = np.where(place == index.start[run + 1] - 1, index.below[run], below + 1)
        place = index.back[run] + place - index.start[run]
        yield step, walks[:n], np.maximum(above, below) >= length


def repeated_windows(contents: list[bytes], length: int, walk: int = WALK) -> list[np.ndarray]:
    """For each content, which of its windows start elsewhere too, in it or in another one."""
    text = np.frombuffer(b"".join(c + bytes([END]) for c in contents), np.uint8)
    ends = np.cumsum([len(c) + 1 for c in contents]) - 1
    firsts = np.concatenate(([0], ends[:-1] + 1))
    entries = np.concatenate([np.arange(e, f, -walk) if e > f else np.array([e]) for f, e in zip(firsts.tolist(), ends.tolist(), strict=True)])
    bounds = np.maximum(entries - walk, firsts[np.searchsorted(firsts, entries, "right") - 1])
    long = np.zeros(len(text), bool)
    for step, walks, yes in walked(run_index(text, entries), entries - bounds, length):
        long[entries[walks] - step] = yes
    return [long[f : max(f, e - length + 1)] for f, e in zip(firsts.tolist(), ends.tolist(), strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _id_of(key: str, text: str):
    return F.struct(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))


def repeats(rows: DataFrame, length: int, grams: tuple[int, ...], shard_bytes: int) -> DataFrame:
    """(id, lo, hi): the strings of ``length`` bytes that start from byte lo and before byte hi of the rows (id, raw) and start elsewhere too. Rows of one id are equal."""
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                row, *numbers = stretches(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], length, grams[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + lo)), *map(pa.array, numbers)], ["id", "start", "windows", "name", "content", "inner"])

    pieces = written(rows.mapInArrow(cut, f"id {id_type}, {STRETCH}"), "stretches")
    seen = pieces.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("least"), F.max("content").alias("most"), F.max("inner").alias("inner")).filter("n > 1 OR inner")
    again = written(pieces.join(seen.select("name", ((F.col("least") == F.col("most")) & (F.col("n") > 1)).alias("one")), "name").drop("inner"), "again")
    stretch = [F.col("start").alias("lo"), (F.col("start") + F.col("windows")).alias("hi")]
    whole = again.filter("one").select("id", *stretch)

    several = again.filter("NOT one")
    contents = several.groupBy("name", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "start", "windows")).alias("at"))
    weights = contents.groupBy("name").agg((F.sum("at.windows") + F.count(F.lit(1)) * (length - 1)).alias("bytes"))
    contents = written(contents.join(weights, "name").select("name", "content", "n", "at.*", (F.col("bytes") > shard_bytes).alias("heavy")), "contents")
    wanted = contents.groupBy("id").agg(F.collect_list(F.struct("start", "windows", "name", "content", "heavy")).alias("w"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                out = []
                for value, many in zip(batch.column(0).slice(lo, 64), batch.column(1).slice(lo, 64).to_pylist(), strict=True):
                    raw = memoryview(value.as_buffer())
                    out += [(w["name"], w["content"], w["heavy"], bytes(raw[w["start"] : w["start"] + w["windows"] - 1 + length])) for w in many]
                    if sum(len(x[3]) for x in out[-len(many) :]) > 1 << 20:
                        yield spelled_batch(out)
                        out = []
                if out:
                    yield spelled_batch(out)

    def spelled_batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["name", "content", "heavy", "raw"])

    texts = rows.join(wanted, "id").select("raw", "w").mapInArrow(spell, "name long, content long, heavy boolean, raw binary")
    spelled = written(texts, "spelled")
    total = {r.heavy: r.total for r in spelled.groupBy("heavy").agg(F.sum(F.octet_length("raw")).alias("total")).collect()}
    shards = max(1, -(-total.get(False, 0) // shard_bytes))

    def match(table: pa.Table) -> pa.Table:
        table = table.group_by(["name", "content"]).aggregate([("raw", "min")])  # rows repeated whole give their contents twice
        found = [_runs(x) for x in repeated_windows([x.as_py() for x in table.column("raw_min").combine_chunks()], length)]
        lists = [pa.array([r[k].astype(np.int32) for r in found], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.table({"name": table.column("name"), "content": table.column("content"), "lo": lists[0], "hi": lists[1]})

    light = spelled.filter("NOT heavy").select(F.pmod(F.xxhash64("name"), F.lit(shards)).alias("shard"), "name", "content", "raw")
    found = light.groupBy("shard").applyInArrow(match, "name long, content long, lo array<int>, hi array<int>").filter(F.size("lo") > 0)
    found = found.select("name", "content", F.explode(F.arrays_zip("lo", "hi")).alias("z")).select("name", "content", "z.lo", "z.hi")
    if True in total:
        heavy = written(spelled.filter("heavy").dropDuplicates(["name", "content"]).select(F.struct("name", "content").alias("id"), "raw"), "heavy")
        further = repeats(heavy, length, grams[1:], shard_bytes) if grams[1:] else counted(heavy, length)
        found = found.unionByName(further.select("id.*", "lo", "hi"))

    repeated = several.join(contents.filter("n > 1").select("name", "content"), ["name", "content"], "left_semi").select("id", *stretch)
    single = contents.filter("n = 1").select("name", "content", "id", "start")
    partly = single.join(found, ["name", "content"]).select("id", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return whole.unionByName(repeated).unionByName(partly)


def counted(rows: DataFrame, length: int) -> DataFrame:
    """As ``repeats``, by hashes of all strings of ``length`` bytes, for rows of distinct ids; a row for each run of neighbours."""
    id_type = rows.schema["id"].dataType.simpleString()

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                own = offsets[lo : hi + 1] - offsets[lo]
                h = gram_hashes(data[offsets[lo] : offsets[hi]], length) if own[-1] >= length else np.zeros(0, _U)
                row = np.searchsorted(own, np.arange(len(h)), "right") - 1
                inside = np.arange(len(h)) + length <= own[row + 1]
                row, start, h = row[inside], np.flatnonzero(inside), h[inside]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + lo)), pa.array((start - own[row]).astype(np.int32)), pa.array(h.view(np.int64))], ["id", "lo", "h"])

    each = written(rows.mapInArrow(strings, f"id {id_type}, lo int, h long"), "strings")
    twice = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    # Neighbouring strings make one row, as many rows as a content has runs: a passage of many settings would else be a row for each string and setting from here on.
    at = each.join(twice, "h").groupBy("id").agg(F.sort_array(F.collect_list("lo")).alias("at"))
    starts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1))
    lasts = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1))
    runs = at.select("id", starts.alias("lo"), lasts.alias("last")).select("id", F.explode(F.arrays_zip("lo", "last")).alias("z"))
    return runs.select("id", "z.lo", (F.col("z.last") + 1).alias("hi"))


def removed(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, shard_bytes: int = 1 << 20, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """(id, spans): the byte spans (s, e) to be removed, in any order and overlapping, of documents that lose any; ``id`` is a struct of key and text hash."""
    rows = documents.select(_id_of(key, text).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("raw"))
    # Grams are shorter than the strings that they name.
    found = repeats(rows, length, tuple(g for g in grams if g < length) or (1,), shard_bytes)
    return found.groupBy("id").agg(F.collect_list(F.struct(F.col("lo").alias("s"), (F.col("hi") - 1 + length).alias("e"))).alias("spans"))


CUT = "struct<n_bytes: bigint, n_removed: bigint, spans: array<struct<s: bigint, e: bigint>>, sha256: string, kept: binary>"


def without(texts: pa.Array, spans: pa.Array, with_kept: bool = False) -> pa.Array:
    """For each text its bytes, the bytes removed, the maximal removed spans, and the SHA-256 of what is left, and what is left itself if asked for."""
    out = []
    for lo in range(0, len(texts), 500):
        for value, many in zip(texts.slice(lo, 500), spans.slice(lo, 500).to_pylist(), strict=True):
            raw = memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")
            merged: list[list[int]] = []
            for s, e in sorted((x["s"], x["e"]) for x in many or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            digest, at, kept = hashlib.sha256(), 0, []
            for s, e in [*merged, [len(raw), len(raw)]]:
                digest.update(raw[at:s])
                if with_kept:
                    kept.append(bytes(raw[at:s]))
                at = e
            out.append({"n_bytes": len(raw), "n_removed": sum(e - s for s, e in merged), "spans": [{"s": s, "e": e} for s, e in merged], "sha256": digest.hexdigest(), "kept": b"".join(kept) if with_kept else None})
    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), ("sha256", pa.string()), ("kept", pa.binary())])
    return pa.array(out, kind)


def dedup(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, with_kept: bool = False, **how) -> DataFrame:
    """(key, n_bytes, n_removed, spans, sha256, kept) per document; ``kept``, the remaining bytes, is null unless asked for."""
    gone = removed(documents, key, text, length, **how)
    rows = documents.select(F.col(key).alias("key"), _id_of(key, text).alias("id"), F.col(text).alias("text")).join(gone, "id", "left")

    def apply(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return without(texts, spans, with_kept)

    return rows.select(F.col("key").alias(key), F.arrow_udf(apply, CUT)(F.col("text"), F.col("spans")).alias("r")).select(key, "r.*")
