"""The n-gram Jaccard join against brute force."""

import random
import re

import numpy as np

from textloom.llm import ngram_join, queries

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in by[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(find(i), []).append(k)
    return sorted(((k, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, name string, size int")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()), key=repr)


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return words


def test_brute(spark):
    rnd = random.Random(11)
    base = [[f"w{rnd.randrange(400)}" for _ in range(rnd.choice([6, 20, 60, 200]))] for _ in range(25)]
    rows = [(i * 7 % 1000 + 1000 * (i // 1000), " ".join(edited(rnd, rnd.choice(base), rnd.randrange(7)))) for i in range(400)]
    line = " ".join(f"common{i}" for i in range(14))
    rows += [(2000 + i, line + " " + " ".join(f"u{i}x{j}" for j in range(rnd.randrange(3, 40)))) for i in range(120)]
    rows += [(3000 + i, " ".join(edited(rnd, base[0] * 2 + base[1] * 2 + base[2], i % 3))) for i in range(80)]
    rows += [(5000, None), (5001, ""), (5002, " \t"), (5003, "A b"), (5004, "a  B"), (5005, "a b c"), (5006, rows[0][1]), (5006, rows[0][1]), (None, rows[0][1]), (None, "just by itself here now ok"), (5007, "x y " * 9000)]
    rnd.shuffle(rows)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_order_of_shingles_does_not_matter(spark, monkeypatch):
    rnd = random.Random(2)
    line = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rnd, line, rnd.randrange(5)) + [f"z{i % 9}"] * 3)) for i in range(150)]
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", 0)
    assert run(spark, rows) == brute(rows)


def test_firsts(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "q r s t u v"), (9, ""), (8, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, later int")
    got = ngram_join.firsts(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [1, 2, 8, 9]


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.op3_ngram_join(spark, SF).collect()) == sorted(brute(rows))


def brute_links(rows):
    """(key, other different sets that are alike) of each row."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    found = {s: sum(s != o and 100 * len(s & o) >= 80 * len(s | o) for o in set(sets) - {frozenset()}) for s in set(sets)}
    return sorted(((k, found[s]) for (k, _), s in zip(rows, sets, strict=True)), key=repr)


def test_links_within_components(spark):
    rnd = random.Random(6)
    base = [[f"v{b}x{i}" for i in range(100)] for b in range(6)]
    rows = [(1, " ".join(base[0])), (2, " ".join(base[0][:-1])), (3, " ".join(base[0][:-2])), (4, " ".join(base[0]))]
    rows += [(10 + i, " ".join(edited(rnd, base[1 + i % 5], i % 4))) for i in range(150)] + [(900, None), (901, "short one")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_links) for r in ngram_join.join(df).collect()), key=repr)
    assert [n for k, n in got if k in (1, 2, 3, 4)] == [2, 2, 2, 2]
    assert got == brute_links(rows)


def test_links_in_blocks(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"v{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rnd, base, i % 5))) for i in range(60)] + [(100, " ".join(base))]
    within = ngram_join.within_stars
    monkeypatch.setattr(ngram_join, "within_stars", lambda star, members: within(star, members, block_members=7))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=repr) == brute_links(rows)


def test_dense_group_makes_no_rows_of_pairs(spark, monkeypatch):
    """Near copies, many of them not alike with the first: tables of pairs stay far smaller than the group's links."""
    rnd = random.Random(21)
    base = [f"v{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rnd, base, 1 + rnd.randrange(3)))) for i in range(240)]
    tables, written = [], ngram_join.written

    def counted(df, name):
        out = written(df, name)
        tables.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=repr) == brute_links(rows)
    assert sum(n for _, n in brute_links(rows)) > 10_000
    assert max(k for name, k in tables if name in ("met", "pairs", "links")) < len(rows), tables


def test_stars_of_several_components(spark, monkeypatch):
    """Sets that are close to one leader, but alike with each other only in parts of the star."""
    rnd = random.Random(4)
    base = [f"v{i}" for i in range(120)]
    kinds = [base[:80] + [f"k{k}x{i}" for i in range(40)] for k in range(3)]
    rows = [(i, " ".join(edited(rnd, (base, *kinds)[i % 4], i // 4 % 3))) for i in range(100)] + [(200, " ".join(base[::-1]))]
    rows = [(900 - k, t) for k, t in rows]
    within = ngram_join.within_stars
    monkeypatch.setattr(ngram_join, "within_stars", lambda star, members: within(star, members, block_members=9))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert sorted((r.doc_id, r.n_links) for r in got) == brute_links(rows)


def test_reached():
    rnd = np.random.default_rng(5)
    for n, m, same in [(1, 1, True), (7, 7, True), (30, 30, True), (5, 9, False), (40, 25, False)] * 6:
        yes = rnd.random((n, m)) < 0.8 / max(n, m)
        if same:
            yes |= yes.T
            np.fill_diagonal(yes, False)
        root = list(range(n if same else n + m))
        for i, j in zip(*np.nonzero(yes), strict=True):
            a, b = root[i], root[j if same else n + j]
            root = [min(a, b) if r in (a, b) else r for r in root]
        linked = yes.any(axis=1) if same else np.concatenate((yes.any(axis=1), yes.any(axis=0)))
        assert ngram_join.reached(yes, same).tolist() == [r if some else -1 for r, some in zip(root, linked, strict=True)]
