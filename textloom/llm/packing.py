"""Best-fit packing of token sequences, improved by swap-based local search.

Texts are tokenised where they lie and only numbers leave the tasks. Documents longer than a sequence are cut into full pieces and one
shorter first piece. Full pieces are sequences of their own; the shorter ones are dealt by hash into blocks of about
``block_pieces``, each packed by one task: best fit by falling length, then exchanges of one for one, two for one or moves between
underfull bins that raise the sum of squared fills, until bins empty or nothing helps. A block leaves about one underfull bin more than packing all
at once would, so the loss is about 1 / ``block_pieces`` whatever the size of the corpus, and no group is hot.

Defined results: null and empty texts are one piece, the end token alone; repeated rows are packed each; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import bisect
import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import slices, text_bytes, written

#: Below this code point the two libraries are tested to give the same ids.
PLAIN_LIMIT = 0x250


@cache
def encoder(tokenizer_path: str, fast: bool = True) -> Callable[[str], np.ndarray]:
    """Ids of a text by the byte-level BPE of a ``tokenizers`` file, without special tokens added.

    With ``fast``, texts of Latin letters go through ``tiktoken`` with the same vocabulary and merges, which gives the
    same ids several times faster; texts with other letters or an added token's name in them go through ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_path)

    def by_tokenizers(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    with open(tokenizer_path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    if not fast or spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return by_tokenizers
    import tiktoken

    # Byte-level vocabularies write each byte as a printable character: printable ones as themselves, the others from 256 on, in order.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    quick = tiktoken.Encoding(base64.b16encode(tokenizer_path.encode()[-20:]).decode(), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if (text.isascii() or max(text) < chr(PLAIN_LIMIT)) and not any(t in text for t in added):
            return np.asarray(quick.encode_to_numpy(text, disallowed_special=()), np.uint32)
        return by_tokenizers(text)

    return encode


def pieces(documents: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2, most: int = 1024, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each piece of each document."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                row, out, ids_out = [], [], []
                for i in range(lo, hi):
                    ids = np.append(encode(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")), np.uint32(end_id)).astype("<u4")
                    first = (len(ids) - 1) % most + 1
                    bounds = [0, *range(first, len(ids) + 1, most)]
                    for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                        row.append(i)
                        out.append((n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                        if with_ids:
                            ids_out.append(ids[a:b].astype(np.int64))
                numbers = np.array(out, np.int64).T
                columns = [batch.column(0).take(pa.array(row)), pa.array(numbers[0].astype(np.int32)), *map(pa.array, numbers[1:])]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids_out, pa.list_(pa.int64()))] if with_ids else []), names)

    names = ["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Items put, by falling length, each into the fullest bin that holds it. Bins by free room: one bit of a number each."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    has = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = has >> size
        if fits:
            room = size + ((fits & -fits).bit_length() - 1)
            b = by_room[room].pop()
            if not by_room[room]:
                has &= ~(1 << room)
        else:
            room, b = most, len(bins)
            bins.append([])
        bins[b].append(i)
        by_room[room - size].append(b)
        has |= 1 << (room - size)
    return bins


def _subsets(items: list[int], lengths: np.ndarray) -> list[tuple[int, ...]]:
    """Each piece and each pair of pieces that a bin can give, equal lengths once: a bin of at most ``most`` tokens has at most about sqrt(2 * most) lengths, however many pieces."""
    alike: dict[int, list[int]] = {}
    for i in items:
        alike.setdefault(int(lengths[i]), []).append(i)
    first = [same[:2] for same in alike.values()]
    pairs = [(a[0], b[0]) for k, a in enumerate(first) for b in first[k + 1 :]]
    return [(a[0],) for a in first] + pairs + [(a[0], a[1]) for a in first if len(a) > 1]


def local_search(bins: list[list[int]], lengths: np.ndarray, most: int) -> list[list[int]]:
    """Exchange pieces between underfull bins while that raises the sum of squared fills; bins that empty go.

    In each round every underfull bin, from the emptiest on, gives one or two pieces to the fuller bin where that raises the
    sum most, for none, one or two pieces of it (two for two excepted). A bin takes part in one exchange a round. The sum rises with every exchange, so the rounds come to an end of themselves.
    """
    bins = [list(b) for b in bins]
    while True:
        fill = [int(lengths[b].sum()) if b else 0 for b in bins]
        under = sorted((i for i, f in enumerate(fill) if 0 < f < most), key=lambda i: fill[i])
        if len(under) < 2:
            break
        entries = [(fill[i], i, ()) for i in under] + [(fill[i], i, s) for i in under for s in _subsets(bins[i], lengths)]
        out = np.array([sum(int(lengths[x]) for x in s) for _, _, s in entries])
        full = np.array([f for f, _, _ in entries])
        pair = np.array([len(s) == 2 for _, _, s in entries])
        owner = np.array([i for _, i, _ in entries])
        # Sorted by what may come in, so that only entries with room for a given length are looked at.
        order = np.argsort(out + most - full, kind="stable")
        out, full, pair, owner, entries = out[order], full[order], pair[order], owner[order], [entries[k] for k in order]
        takes = (out + most - full).tolist()
        touched, changed = np.zeros(len(bins), bool), False
        for src in under:
            if touched[src]:
                continue
            best, what = 0, None
            for give in _subsets(bins[src], lengths):
                size = int(sum(lengths[x] for x in give))
                at = bisect.bisect_left(takes, size)
                up = size - out[at:]
                gain = 2 * up * (full[at:] - fill[src] + up)
                ok = (up > 0) & (full[at:] >= fill[src]) & ~touched[owner[at:]] & (owner[at:] != src)
                if len(give) == 2:
                    ok &= ~pair[at:]
                gain = np.where(ok, gain, 0)
                k = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, what = int(gain[k]), (give, at + k)
            if what:
                give, k = what
                dst, back = int(owner[k]), entries[k][2]
                bins[src] = [x for x in bins[src] if x not in give] + list(back)
                bins[dst] = [x for x in bins[dst] if x not in back] + list(give)
                touched[src] = touched[dst] = changed = True
        if not changed:
            break
    return [b for b in bins if b]


def pack_block(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for n, items in enumerate(local_search(best_fit(lengths, most), lengths, most)):
        where[items] = n
        offset[items] = np.concatenate(([0], np.cumsum(lengths[items])[:-1]))
    return where, offset


def pack(documents: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2, most: int = 1024, block_pieces: int = 8_000, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids], sequence_id, offset) for each piece."""
    cut = written(pieces(documents, tokenizer_path, key, text, end_id, most, with_ids), "pieces")
    short = cut.filter(F.col("length") < most)
    blocks = max(1, round(short.count() / block_pieces))
    short = short.withColumn("block", F.pmod(F.xxhash64("key", "piece"), F.lit(blocks)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"

    def place(block: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "piece"], kind="stable").drop(columns="block")
        where, offset = pack_block(rows["length"].to_numpy(), most)
        return rows.assign(sequence_id=(int(block[0]) << 32) + where, offset=offset)

    packed = short.groupBy("block").applyInPandas(place, schema)
    # Full pieces are sequences of their own; their numbers start above those of all blocks.
    alone = cut.filter(F.col("length") == most).select("*", (F.monotonically_increasing_id() + F.lit(1 << 60)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).withColumnRenamed("key", key)
