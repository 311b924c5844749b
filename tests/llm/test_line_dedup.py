"""Line dedup: patience diff, and whole results against brute force."""

import random
from collections import defaultdict

from textloom.llm import line_dedup, queries

SF = "/root/testdata/sf0.01"


def patience(a, b):
    """Patience diff written apart from the library's: recursive, with a quadratic longest chain; of chains of one length, the one whose every member is the last that fits."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in patience(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return patience(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    pairs = [(a.index(x), j) for j, x in enumerate(b) if b.count(x) == 1 and a.count(x) == 1]
    size = []
    for k, (i, _) in enumerate(pairs):
        size.append(1 + max((size[h] for h in range(k) if pairs[h][0] < i), default=0))
    chain, want, end = [], max(size, default=0), len(pairs)
    while want:
        end = max(k for k in range(end) if size[k] == want)
        chain.insert(0, pairs[end])
        want -= 1
    if not chain:
        return []
    out, last = [], (0, 0)
    for i, j in [*chain, (len(a), len(b))]:
        out += [(last[0] + x, last[1] + y) for x, y in patience(a[last[0] : i], b[last[1] : j])]
        out += [(i, j)] if i < len(a) else []
        last = (i + 1, j + 1)
    return out


def brute(rows, min_chars=30):
    """Texts after removal, in the order of ``rows`` (key, text), for distinct keys: each document against the first holder of every line that it shares."""
    split = {k: [(n, x.rstrip()) for n, x in enumerate((t or "").split("\n")) if x.strip()] for k, t in rows}
    holders = defaultdict(set)
    for k, ls in split.items():
        for _, x in ls:
            holders[x].add(k)
    out = []
    for k, t in rows:
        gone = set()
        for first in {min(holders[x]) for _, x in split[k]} - {k}:
            a, b = [x for _, x in split[first]], [x for _, x in split[k]]
            keep_a = [i for i, x in enumerate(a) if len(holders[x]) > 1]
            keep_b = [i for i, x in enumerate(b) if len(holders[x]) > 1]
            pairs = [(keep_a[i], keep_b[j]) for i, j in patience([a[i] for i in keep_a], [b[j] for j in keep_b])]
            runs = []
            for i, j in pairs:
                if runs and runs[-1][-1] == (i - 1, j - 1):
                    runs[-1].append((i, j))
                else:
                    runs.append([(i, j)])
            gone |= {split[k][j][0] for r in runs if sum(len(b[j]) for _, j in r) >= min_chars for _, j in r}
        out.append((k, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)))
    return out


def test_patience():
    assert line_dedup.patience([1, 2, 3, 4], [1, 3, 4, 5]) == [(0, 0), (2, 1), (3, 2)]
    assert line_dedup.patience([1, 2, 1, 2], [2, 1, 2]) == [(1, 0), (2, 1), (3, 2)]
    assert line_dedup.patience([], [1]) == []
    rnd = random.Random(4)
    for _ in range(300):
        a, b = [[rnd.randrange(9) for _ in range(rnd.randrange(14))] for _ in range(2)]
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert line_dedup.patience(a, a) == [(i, i) for i in range(len(a))]
        assert pairs == patience(a, b)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, gone int, id string")
    got = line_dedup.dedup(df, **how)
    assert got.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)


def test_brute(spark):
    rnd = random.Random(9)
    pool = [f"Line {i} with some length" * rnd.choice([0, 1, 2]) or "short" for i in range(25)] + ["", "  ", "x"]
    rows = [(i, "\n".join(rnd.choice(pool) + rnd.choice(["", " ", "\t"]) for _ in range(rnd.randrange(12)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "solo é line that nobody else has got at all")] + [(100 + i, rows[7][1]) for i in range(40)]
    assert run(spark, rows) == sorted(brute(rows), key=repr)
    assert run(spark, []) == []


def test_repeated_rows_and_copies(spark):
    text = "a line that is long enough to count\nand another one of these lines\n\nlast"
    got = run(spark, [(2, text), (2, text), (5, text), (None, "only here is this line of text found")])
    assert got == sorted([(2, text), (2, text), (5, ""), (None, "only here is this line of text found")], key=repr)
    assert sorted(k for k, _ in run(spark, [(2, text), (5, text), (6, "")], drop_emptied=True)) == [2, 6]


def test_frequent_lines_lead_to_their_first(spark):
    passage = "a passage that more than twenty documents hold\nand its second line, as frequent as the first"
    quote = "a quote that only two documents share with each other"
    rows = [(i, f"{passage}\nown text of number {i}") for i in range(30)] + [(50, quote), (60, f"{quote}\n{passage}\nown text of number 60")]
    got = dict(run(spark, rows))
    assert got[0] == rows[0][1] and got[60] == "own text of number 60"
    assert sorted(got.items()) == sorted(brute(rows))


def test_licence_block_and_rare_line(spark):
    """A block that many documents hold leaves each later one, also one that shares a rarer line with another document."""
    block = "\n".join(f"licence line {i} as it stands in very many files" for i in range(5))
    rows = [(i, f"own words of file {i}\n{block}") for i in range(31)] + [(100, "a rare line that two files share, and only two"), (101, f"{block}\na rare line that two files share, and only two\nrest of 101")]
    got = dict(run(spark, rows))
    assert got[0] == rows[0][1] and got[29] == "own words of file 29" and got[101] == "rest of 101"


def test_table_by_every_shared_line(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    assert run(spark, rows) == sorted(want, key=repr) and sum(a != b for a, b in zip(rows, want, strict=True)) > 0
    assert queries.op4_line_dedup(spark, SF).filter("n_removed_lines > 0").count() == sum(a != b for a, b in zip(rows, want, strict=True))
