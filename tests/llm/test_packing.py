"""Packing: the same ids as the tokenizer's own library, whole and gapless sequences, few of them."""

import random
import zlib
from collections import defaultdict

import numpy as np

from textloom.llm import packing, queries

SF = "/root/testdata/sf0.01"
PATH = queries.tokenizer_path()


def test_fast_ids_are_those_of_tokenizers():
    fast, slow = packing.encoder(PATH), packing.encoder(PATH, fast=False)
    texts = ["", "a", " ", "\n\n\n  x", "it's we'LL I'M 'd", "<|endoftext|>", "a<|endoftext|>b", "日本語 text", "x" * 5000, "  \t\r\n \x0b\x0c", "é", "12 345½ ²x"]
    texts += [form.format(chr(c)) for c in range(packing.PLAIN_LIMIT) for form in ("{0}", "a{0}b", " {0} ", "1{0}{0}{0}2", "x {0}y", "  {0}", "'{0}")]
    rnd = random.Random(1)
    texts += ["".join(chr(rnd.choice([rnd.randrange(packing.PLAIN_LIMIT), 32, 97, 10, 9, 39, 115])) for _ in range(60)) for _ in range(3000)]
    for t in texts:
        assert fast(t).tolist() == slow(t).tolist(), repr(t)


def test_search_only_helps():
    rng = np.random.default_rng(3)
    for lengths in (rng.integers(1, 100, 500), rng.integers(30, 60, 400), rng.integers(1, 3, 300), np.array([50, 50]), np.array([], int)):
        first = packing.best_fit(lengths, 100)
        then = packing.local_search(first, lengths, 100)
        for bins in (first, then):
            assert sorted(x for b in bins for x in b) == list(range(len(lengths)))
            assert all(lengths[b].sum() <= 100 for b in bins)
        square = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
        assert square(then) >= square(first) and len(then) <= len(first)
    worse = packing.local_search([[0], [1], [2], [3]], np.array([60, 50, 40, 50]), 100)
    assert len(worse) == 2


def fewest(lengths, most):
    """Fewest bins, by trying every way to place the pieces one by one."""
    best = len(lengths)

    def place(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(lengths):
            best = len(fills)
            return
        for k in range(len(fills)):
            if fills[k] + lengths[i] <= most and fills[k] not in fills[:k]:
                place(i + 1, [*fills[:k], fills[k] + lengths[i], *fills[k + 1 :]])
        place(i + 1, [*fills, lengths[i]])

    place(0, [])
    return best


def test_small_cases_against_the_optimum():
    rng = np.random.default_rng(7)
    over = 0
    for _ in range(120):
        lengths = rng.integers(1, rng.choice([30, 60, 100]) + 1, rng.integers(1, 10))
        where, offset = packing.pack_block(lengths, 100)
        for b in set(where.tolist()):
            own = sorted(zip(offset[where == b].tolist(), lengths[where == b].tolist(), strict=True))
            assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 100
        least = fewest(sorted(lengths.tolist(), reverse=True), 100)
        assert least <= where.max() + 1 <= least + 1
        over += where.max() + 1 - least
    assert over <= 3


def check(rows, texts, most=1024):
    slow = packing.encoder(PATH, fast=False)
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= most
    for key, text in texts:
        ids = np.append(slow(text or ""), np.uint32(2)).astype("<u4")
        own = sorted(docs[key], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // most)
        assert all(r.length == most for r in own[1:])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own) and sum(r.length for r in own) == len(ids)
    return len(bins), sum(x[1] for b in bins.values() for x in b)


def test_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    packed = queries.op5_packing(spark, SF)
    assert dict(packed.dtypes)["piece"] == "int"
    n, total = check(packed.collect(), texts)
    assert n <= -(-total // 1024) * 1.02 + 1


def test_awkward(spark):
    texts = [(1, None), (2, ""), (3, "word " * 20_000), (4, "é日"), (5, "a" * 1022)]
    df = spark.createDataFrame([(*t, 0) for t in texts], "doc_id long, text string, length int")
    check(packing.pack(df, PATH).collect(), texts)
    assert packing.pack(df.limit(0), PATH).collect() == []
    again = packing.pack(df.union(df), PATH, with_ids=True).collect()
    assert len(again) == 2 * len(packing.pack(df, PATH).collect()) and all(len(r.ids) == r.length for r in again)
