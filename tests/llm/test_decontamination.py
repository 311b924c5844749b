"""Decontamination against brute force."""

import random
import re

import duckdb
import numpy as np

from textloom.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    windows = {}
    for key, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(key))
    out = []
    for key, text in docs:
        w, hit, got = words(text), set(), set()
        for i in range(len(w)):
            for n in {len(x) for x in windows}:
                if i + n <= len(w) and (found := windows.get(tuple(w[i : i + n]))):
                    hit |= set(range(i, i + n))
                    got |= found
        out.append((key, len(w), len(hit), sorted(got)))
    return sorted(out, key=repr)


def run(spark, docs, items, window, **how):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, key int")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in dc.find(d, b, window=window, **how).collect()), key=repr)


def test_random_small_alphabet(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abC") for _ in range(n))
    docs = [(i, text(rnd.randrange(40))) for i in range(60)] + [(60, None), (61, ""), (62, "a-" * 300), (62, "a-" * 300), (63, "éa É zz " * 30)]
    items = [(i, text(rnd.randrange(12))) for i in range(12)] + [(3, "b b b b b"), (20, None), (21, "a a"), (22, "éa É zz éa"), (100, "Éa")]
    want = brute(docs, items, 5)
    assert run(spark, docs, items, 5) == want
    assert run(spark, docs, items, 5, block_bytes=200) == want
    assert run(spark, docs, [], 5) == sorted([(k, n, 0, []) for k, n, *_ in want], key=repr)
    assert run(spark, [], items, 5) == []
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for how in ({}, {"block_bytes": 200}):
        kept = sorted(r.doc_id for r in dc.clean(d, spark.createDataFrame(items, "item_id long, text string"), window=5, **how).collect())
        assert kept == sorted(k for k, _, n, _ in want if n == 0)


def test_suffix_array_order():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n, unknown = int(rng.integers(0, 60)), 3
        ranks, row = rng.integers(0, 4, n), np.sort(rng.integers(0, 4, n))

        def suffix(i, ranks=ranks, row=row, n=n):
            out = []
            while i < n and ranks[i] != unknown:
                out.append(int(ranks[i]))
                i += 1
                if i < n and row[i] != row[i - 1]:
                    break
            return out

        got = [suffix(int(i)) for i in dc.suffix_array(ranks, row, unknown, 80)]
        assert got == sorted(suffix(i) for i in range(n) if ranks[i] != unknown)


def test_longest(spark):
    d = spark.createDataFrame([(1, "x " + "p q r s t u v " + "z"), (2, "q r s t"), (3, "p q r y")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "p q r s t u v w")], "item_id long, text string")
    assert {r.doc_id: r.longest for r in dc.find(d, b, window=3).collect()} == {1: 7, 2: 4, 3: 3}


def test_table(spark):
    con, sf = duckdb.connect(), "/root/testdata/sf0.01"
    docs = con.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    items = con.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    want = brute(docs, items, 10)
    assert run(spark, docs, items, 10) == want and sum(r[2] for r in want) > 0
