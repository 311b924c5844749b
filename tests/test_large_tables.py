"""What larger tables hold and the given ones do not: queries against their SQL on small tables of such rows."""

import random
from pathlib import Path

import numpy as np

from oracle import same

from textloom.llm import packing, warc
from textloom.operators import dedupe
from textloom.plans.catalog import REGISTRY
from textloom.sources.shared import shared_dir


def held(spark, tmp_path, name, **tables):
    """Rows of a query on tables (rows, schema), which are its SQL's too."""
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    q = REGISTRY.entries[name]
    return same(spark, q.build, q.sql, str(tmp_path))


TURNS = "conv_id long, turn long, role string, text string"


def test_cited_context(spark, tmp_path):
    # Both given ids of (800, 2) are doc-5600; texts cite a given id again and others, or are null.
    turns = [(800, 2, "user", "x"), (1, 0, "user", "again doc-7 and doc-3"), (3, 1, "user", None), (3, 1, "user", None)]
    documents = [(5600, "a", "web", "en"), (7, "b", None, "en"), (21, "c", "web", "en"), (21, "d", "web", "fr"), (21, "e", "book", "fr")]
    assert held(spark, tmp_path, "cited_context", conversations=(turns, TURNS), documents=(documents, "doc_id long, text string, source string, lang string")) == 6


def test_similar_in_blocks(spark):
    """Blocks, tiles and shared columns lose and repeat no pair."""
    rnd = random.Random(3)
    base = [[f"w{min(rnd.randrange(400), rnd.randrange(400))}" for _ in range(20)] for _ in range(12)]
    rows = [(i, sorted({w if rnd.random() > 0.3 else f"e{rnd.randrange(300)}" for w in rnd.choice(base)}), i % 3) for i in range(300)] + [(300, [], 0), (301, ["q"], 1), (302, ["q"], 2)]
    df = spark.createDataFrame(rows, "id long, t array<string>, n long")
    alike = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x and y else 0.0
    want = sorted((a, b, s) for a, x, n in rows for b, y, m in rows if a < b and (s := alike(x, y)) >= (0.36 if n == m else 0.52))
    for block, dims, tile in ((32_768, 2048, 1024), (40, 64, 16), (1000, 16, 1024)):
        assert sorted(tuple(r) for r in dedupe.similar_in_blocks(df, "id", "t", 0.52, "n", 0.36, block, dims, tile).collect()) == want


def test_no_rows_of_candidates(spark, tmp_path):
    """Sets that share frequent tokens and little else: what is shuffled are sets, and not pairs of them, whose number is quadratic."""
    rows = [(c, 0, "user", " ".join(f"w{(c * 7 + k * k) % 90:02d}x" for k in range(12)) + f" u{c:03d}x") for c in range(400)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    plan = REGISTRY.builders()["dedupe_queue"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join" not in plan


def test_vector_neighbours(spark, tmp_path):
    """Copies, a null vector and a null query; the plan has matrix products and no join of queries with vectors."""
    rnd = random.Random(4)
    rows = [(i, None if i in (100, 77) else [1.0, 2.0, 3.0] if i % 4 == 1 else [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(1500)]
    assert held(spark, tmp_path, "vector_neighbours", embeddings=(rows, "vec_id long, embedding array<float>")) == 150
    plan = REGISTRY.builders()["vector_neighbours"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_noisy_quotes(spark, tmp_path):
    """A title that many conversations share, with letters beyond ASCII and beyond 16 bits; texts leave their task only for titles they may hold."""
    title = "\U0001f600 éß begin " + "a title that is long enough to count for all"
    rows = [(c, t, "user", title if t == 0 and c % 3 else f"own {c} " * 9 if t == 0 else f"of {c}? {title[: 20 + 4 * c]} www" if t == 1 else None if t == 3 else "short") for c in range(60) for t in range(4)]
    held(spark, tmp_path, "noisy_quotes", conversations=(rows, TURNS))
    plan = REGISTRY.builders()["noisy_quotes"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate explode(array_distinct" not in plan


def test_pairs_of_full_bins():
    """A bin of more than twelve pieces gives two of them away where no single one would do."""
    lengths = np.array([*[6] * 14, 11, 85])
    bins = packing.local_search([list(range(14)), [14, 15]], lengths, 100)
    assert sorted(int(lengths[b].sum()) for b in bins) == [83, 97]


def test_archives_go_once_read(spark):
    """A round trip leaves its table of records and not the archives beside it."""
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.glob("warc-*"))
    back = warc.round_trip(spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, html string"))
    assert set(folder.glob("warc-*")) == before and back.count() == 1


def test_similar_pairs_move_few_tokens(spark, monkeypatch):
    """Copies, sizes just alike enough, signatures of several lengths, fewer bits or none: all pairs of brute force, and no row for each token of each set."""
    rnd = random.Random(9)
    base = [[f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((5, 30, 90, 300)))] for _ in range(25)]
    rows = [(i, sorted({w if rnd.random() > 0.12 else f"e{rnd.randrange(40)}" for w in rnd.choice(base)})) for i in range(220)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(12)] + [(2000, []), (2001, [f"x{k}" for k in range(50)]), (2002, [f"x{k}" for k in range(31)]), (2003, ["x7"])]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    sets = [(k, frozenset(t)) for k, t in rows]
    want = {c: sorted((a, b, s) for a, x in sets for b, y in sets if a < b and x and y and (s := len(x & y) / len(x | y)) >= c) for c in (0.62, 0.86)}
    assert (2001, 2002, 0.62) in want[0.62]
    for c, most in ((0.86, 32 << 20), (0.62, 32 << 20), (0.62, 20_000), (0.62, 0)):
        monkeypatch.setattr(dedupe.signatures, "__defaults__", (most,))
        got = dedupe.similar_pairs(df, "id", "t", c)
        assert sorted(tuple(r) for r in got.collect()) == want[c]
    seen, write = [], dedupe.written
    monkeypatch.setattr(dedupe, "written", lambda d, name, **how: seen.append((name, d._jdf.queryExecution().optimizedPlan().toString())) or write(d, name, **how))
    dedupe.similar_pairs(df, "id", "t", 0.86).count()
    assert seen and not any("Generate" in plan or "Window" in plan for _, plan in seen)


def shuffled(spark):
    """Bytes that all stages so far have shuffled."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def near_copies(n):
    """Sets of 300 tokens, of which any two differ in a few."""
    return [(i, [f"w{k}" for k in range(297)] + [f"e{i * 31 + k}" for k in range(3)]) for i in range(n)]


def test_leaders_of_a_group_move_sets_once(spark, monkeypatch):
    """A group of near copies, all alike: its sets do not move once for each of its pairs."""
    df = spark.createDataFrame(near_copies(300), "id long, t array<string>")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = shuffled(spark)
    try:
        assert {r.leader for r in dedupe.leader_clusters(df, "id", "t", 0.62).collect()} == {0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert shuffled(spark) - before < 4 << 20


def test_pairs_are_pruned_in_any_number_of_slices(spark, monkeypatch):
    """Sets that share their rarest tokens and are not alike: signatures prune them even where those of all sets are more than a task holds."""
    rnd = random.Random(2)
    rows = [(i, [f"g{i % 5}x{k}" for k in range(10)] + [f"w{k}" for k in sorted(rnd.sample(range(120), 60))]) for i in range(300)]
    rows += [(300 + i, rows[i][1][:-1]) for i in range(0, 300, 60)]
    monkeypatch.setattr(dedupe.signatures, "__defaults__", (0,))
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.glob("met-*"))
    got = dedupe.similar_pairs(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t", 0.86)
    assert sorted((r.a, r.b) for r in got.collect()) == [(i, 300 + i) for i in range(0, 300, 60)]
    (met,) = set(folder.glob("met-*")) - before
    assert spark.read.parquet(str(met)).count() < 500
