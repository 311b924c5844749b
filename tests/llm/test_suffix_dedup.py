"""Suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from textloom.llm import queries, suffix_dedup

SF = "/root/testdata/sf0.01"


def brute(rows, length):
    raws = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(hash(r[i : i + length]) for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for k, r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[hash(r[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]])
        out.append((k, len(r), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length, **how):
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, start int, name string")
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.sha256) for r in suffix_dedup.dedup(df, length=length, **how).collect()), key=repr)


def test_run_index():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 1), (9, 1), (50, 2), (200, 2), (300, 4), (64, 1), (500, 3)):
        text = np.append(rng.integers(97, 97 + letters, n), suffix_dedup.END).astype(np.uint8)
        n += 1
        raw = text.tobytes()
        key = [raw[i:] for i in range(n)]
        assert suffix_dedup.suffix_order(text).tolist() == sorted(range(n), key=lambda i: key[i])
        index = suffix_dedup.run_index(text, np.array([n - 1]))
        order = sorted(range(n), key=lambda i: key[i])
        assert b"".join(bytes([b]) * (e - s) for b, s, e in zip(index.byte, index.start[:-1], index.start[1:], strict=True) if b < 256) == bytes(raw[i - 1] for i in order if i)

        def share(a, b):
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            return k

        want = [max((share(key[i], key[j]) for j in range(n) if j != i), default=0) for i in range(n - 1)]
        for length in {1, 2, *want}:
            got = {n - 1 - step: bool(yes[0]) for step, _, yes in suffix_dedup.walked(index, np.array([n - 1]), length)}
            assert [got[i] for i in range(n - 1)] == [x >= length for x in want]


def test_repeated_windows():
    rnd = random.Random(3)
    for _ in range(60):
        contents = [b"".join(rnd.choice([b"ab", b"abcab", b"c", b"xyz"]) for _ in range(rnd.randrange(1, 25))) for _ in range(rnd.randrange(1, 6))]
        for length, walk in ((4, 1024), (6, 3), (9, 7)):
            seen = Counter(c[i : i + length] for c in contents for i in range(len(c) - length + 1))
            want = [[seen[c[i : i + length]] > 1 for i in range(len(c) - length + 1)] for c in contents]
            assert [x.tolist() for x in suffix_dedup.repeated_windows(contents, length, walk)] == want


def corpus(rnd):
    block = lambda n: "".join(rnd.choice("abcdefg hé") for _ in range(n))
    shared = [block(rnd.randrange(40, 400)) for _ in range(8)]
    rows = [(i, "".join(rnd.choice([block(rnd.randrange(90)), rnd.choice(shared)]) for _ in range(rnd.randrange(6)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "a" * 3000), (203, "ab" * 500), (204, "ab" * 60), (205, rows[5][1]), (205, rows[5][1]), (None, rows[9][1]), (206, "é" * 100), (207, "x" * 63), (208, "x" * 64), (209, "q" * 65)]
    return rows + [(300 + i, block(40) + shared[0][:90] + block(40)) for i in range(30)]


def test_brute(spark):
    rows = corpus(random.Random(7))
    want = brute(rows, 64)
    assert sum(r[2] for r in want) > 5000
    assert run(spark, rows, 64) == want
    assert run(spark, rows, 64, shard_bytes=2000) == want
    assert run(spark, rows, 64, shard_bytes=200, grams=(8, 32, 60)) == want
    assert run(spark, rows[:0], 64) == []


def test_kept_bytes(spark):
    text = "é" * 40 + "".join(chr(97 + i % 26) * (i % 7) for i in range(60))
    df = spark.createDataFrame([(1, text), (2, text + "tail")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup(df, length=50, with_kept=True).collect()}
    assert got == {1: b"", 2: b"tail"}


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_dedup(spark, SF).collect())
    assert got == sorted(brute(rows, 400)) and sum(r[2] for r in got) > 0


def test_counted_gives_runs(spark):
    """A row for each run of strings that start elsewhere too, and not for each string."""
    rnd = random.Random(12)
    junk = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    one, two = junk(90).encode(), junk(50).encode()
    rows = [(k, junk(30).encode() + bytes([128 + k]) + one + bytes([128 + k]) + junk(30 + k).encode() + bytes([128 + k]) + (two if k % 2 else junk(50).encode()) + bytes([128 + k])) for k in range(20)]
    rows += [(20, b"short"), (21, b"q" * 60)]
    got = sorted(map(tuple, suffix_dedup.counted(spark.createDataFrame(rows, "id long, raw binary"), 40).collect()))
    assert got == sorted([(k, 31, 82) for k in range(20)] + [(k, 153 + k, 164 + k) for k in range(1, 20, 2)] + [(21, 0, 21)])


def test_contents_of_two_blocks(spark):
    """Texts of two alternating blocks, as in the Thue-Morse sequence, cancel out in sums of powers modulo 2^64: they are not equal to their complements."""
    rnd = random.Random(3)
    junk = lambda n: "".join(rnd.choice("cdefgh") for _ in range(n))
    for zero, one in (("a", "b"), (junk(64), junk(64))):
        bits = "01"
        while len(bits) < 1024 // min(4, len(zero)):
            bits += bits.translate(str.maketrans("01", "10"))
        for k in range(4):
            before, after = junk(200), junk(200)
            rows = [(i, before + "".join(zero if b == c else one for b in bits) + after) for i, c in enumerate("01")]
            raws = [r[1].encode() for r in rows]
            found = [suffix_dedup.stretches(np.frombuffer(r, np.uint8), np.array([0, len(r)]), 400, 32) for r in raws]
            spelled = {(c, n): r[s : s + n + 399] for r, x in zip(raws, found, strict=True) for s, n, c in zip(x[1].tolist(), x[2].tolist(), x[4].tolist(), strict=True)}
            assert all(spelled[c, n] == r[s : s + n + 399] for r, x in zip(raws, found, strict=True) for s, n, c in zip(x[1].tolist(), x[2].tolist(), x[4].tolist(), strict=True))
            if k == 0:
                assert run(spark, rows, 400) == brute(rows, 400)
