"""Order-dependent operators against plain mirrors."""

import random

from textloom.operators import dedupe, graphs, ranking


def mirror_leaders(rows, threshold):
    leaders, out = [], {}
    for key, words in sorted(rows):
        scored = [(len(set(words) & w) / len(set(words) | w), -k, k) for k, w in leaders if words and w]
        best = max((s for s in scored if s[0] >= threshold), default=None)
        out[key] = best[2] if best else key
        if not best:
            leaders.append((key, set(words)))
    return out


def test_leaders(spark):
    rnd = random.Random(5)
    rows = [(1, ["a", "b", "c"]), (2, ["a", "b", "d"]), (3, ["q"]), (4, ["q"]), (5, ["q"]), (6, [])]
    base = [[f"w{rnd.randrange(60)}" for _ in range(12)] for _ in range(8)]
    rows += [(10 + i, sorted({w if rnd.random() > 0.15 else f"e{rnd.randrange(9)}" for w in rnd.choice(base)})) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    for threshold in (0.5, 0.62):
        assert {r.id: r.leader for r in dedupe.leader_clusters(df, "id", "tokens", threshold).collect()} == mirror_leaders(rows, threshold)


def test_leaders_of_copies(spark):
    """A copy may have a nearer leader than its first row had; copies of one set are no links."""
    rows = [(1, list("abcdefgh")), (2, list("abcdefgi")), (3, list("abcdefgik")), (4, list("bcdefgikl")), *[(k, list("abcdefgi")) for k in (6, 7)], (8, list("cdefgiklm"))]
    rows += [(5, list("cdefgikl")), *[(9 + k, list("bcdefgik")) for k in range(40)], *[(60 + k, list("defgiklm")) for k in range(40)]]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    members, alike = dedupe.similar_classes(df, "id", "tokens", 0.62)
    assert alike.count() <= 9 * 8 / 2
    for threshold in (0.62, 0.8):
        assert {r.id: r.leader for r in dedupe.leader_clusters(df, "id", "tokens", threshold).collect()} == mirror_leaders(rows, threshold)


def test_leader_query_on_a_table(spark):
    from textloom.plans.catalog import REGISTRY

    sf = "/root/testdata/sf0.001"
    tokens = {r.doc_id: r.t for r in spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "array_distinct(regexp_extract_all(trim(regexp_replace(translate(lower(text), 'àáâãäåèéêëìíîïòóôõöùúûüýÿñç', 'aaaaaaeeeeiiiiooooouuuuyync'), '\\\\s+', ' ')), '[a-z0-9]{3,}', 0)) AS t").collect()}
    got = {r.doc_id: r.leader for r in REGISTRY.builders()["leader_clusters"](spark, sf).collect()}
    assert got == mirror_leaders(list(tokens.items()), 0.62)


def mirror_diverse(rows, k, weight, per_cap, theses=True):
    """Picks of one group of (key, relevance, tokens, cap, thesis), whole."""
    pool, picked = [(*r[:2], set(r[2]), *r[3:]) for r in rows], []
    top = max(r[1] for r in rows)
    while pool and len(picked) < k:
        free = [p for p in pool if sum(q[3] == p[3] for q in picked) < per_cap and not (theses and len(picked) < min(10, k) and any(q[4] == p[4] for q in picked))]
        if not free:
            break
        near = lambda p: max((len(p[2] & q[2]) / len(p[2] | q[2]) if p[2] and q[2] else 0.0 for q in picked), default=0.0)
        best = max(free, key=lambda p: ((1 - weight) * p[1] / top - weight * near(p), p[1], -near(p), p[0]))
        picked.append(best)
        pool.remove(best)
    return [p[0] for p in picked]


def test_diverse(spark):
    rows = [("g", 1, 9.0, ["a", "b"], "s"), ("g", 2, 9.0, ["a", "b"], "s"), ("g", 3, 5.0, ["c"], "t"), ("g", 4, 8.0, ["a", "b"], "s"), ("g", 5, 1.0, ["d"], "s")]
    df = spark.createDataFrame(rows, "g string, id long, rel double, tokens array<string>, source string")
    picks = lambda **how: [r.id for r in dedupe.diverse(df, "g", "id", "rel", "tokens", "source", **how).orderBy("pick").collect()]
    assert picks(k=2, weight=0.8, per_cap=3) == [2, 3]  # ties go to the larger key; a near copy is passed over
    assert picks(k=4, weight=0.0, per_cap=2) == [2, 1, 3]


def test_caps_hold_over_the_whole_list_and_theses_among_the_first_ten(spark):
    rows = [("g", i, 100.0 - i, [f"t{i}"], "s" if i < 20 else f"o{i}", f"h{i % 4 if i < 40 else i}") for i in range(60)]
    df = spark.createDataFrame(rows, "g string, id long, rel double, tokens array<string>, source string, thesis string")
    got = [r.id for r in dedupe.diverse(df, "g", "id", "rel", "tokens", "source", 15, 0.2, 3, "thesis").orderBy("pick").collect()]
    assert got == mirror_diverse([r[1:] for r in rows], 15, 0.2, 3)
    assert sum(i < 20 for i in got) == 3 and len({rows[i][5] for i in got[:10]}) == 10 and len({rows[i][5] for i in got}) < 15


def test_pools_grow_until_the_picks_stand(spark):
    rnd = random.Random(9)
    rows = [("a", i, 50.0, ["same", "words"], "s", "h") for i in range(300)] + [("a", 300 + i, 20.0 - i / 9, [f"w{rnd.randrange(40)}" for _ in range(5)], f"s{i % 30}", f"h{i}") for i in range(120)]
    rows += [("b", i, rnd.random() * 9, [f"w{rnd.randrange(30)}" for _ in range(4)], f"s{i % 5}", f"h{i % 50}") for i in range(200)]
    rows = [(g, i, r, sorted(set(t)), s, h) for g, i, r, t, s, h in rows]
    df = spark.createDataFrame(rows, "g string, id long, rel double, tokens array<string>, source string, thesis string")
    got = {}
    for r in dedupe.diverse_top(df, "g", "id", "rel", "tokens", "source", 12, 0.5, 3, "thesis", pool=8).orderBy("pick").collect():
        got.setdefault(r.g, []).append(r.id)
    assert got == {g: mirror_diverse([r[1:] for r in rows if r[0] == g], 12, 0.5, 3) for g in ("a", "b")}


def test_descendants_at_any_depth(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(30)], "child long, parent long")
    got = graphs.descendants(edges).collect()
    assert len(got) == 465 and all(r.depth == r.node - r.ancestor for r in got)
    turning = graphs.descendants(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "child long, parent long")).collect()
    assert len(turning) == 12 and {(r.ancestor, r.node): r.depth for r in turning}[(1, 1)] == 3


def test_cycles(spark):
    parents = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 3), (5, None), (6, 5), (7, 7), (8, 9), (9, 10), (10, 8), (11, 99)], "node long, parent long")
    assert {r.node for r in graphs.on_cycles(parents).collect()} == {1, 2, 7, 8, 9, 10}


def test_numbers_across_ranges(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["x", "x", "x", "y", None]), rnd.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(7)
    want = {}
    for g in ("x", "y", None):
        for n, r in enumerate(sorted((r[1:] for r in rows if r[0] == g)), 1):
            want[r[1]] = n
    assert {r.id: r.n for r in ranking.numbered(df, "g", ["v", "id"], "n").collect()} == want


def test_surfaces_and_closures(spark):
    from textloom.operators import sequences

    rnd = random.Random(4)
    rows = [(d, i, rnd.randrange(2), rnd.randrange(6), rnd.randrange(4), sorted(rnd.sample(range(9), rnd.randrange(1, 5)))) for d in range(5) for i in range(20)]
    df = spark.createDataFrame(rows, "d long, i long, kind int, lineage int, risk int, members array<int>")
    kept, into = {}, {}
    for d in range(5):
        own = [r for r in rows if r[0] == d]
        stay = []
        for r in own:
            clash = any(s[3] == r[3] for s in stay) or any(s[2] == r[2] and len(set(s[5]) & set(r[5])) >= 0.3 * min(len(s[5]), len(r[5])) for s in stay)
            kept[d, r[1]] = not clash
            stay += [] if clash else [r]
        stand = []
        for r in sorted(own, key=lambda r: (-r[4], r[1])):
            hit = [s for s in stand if s[1] == r[2] and len(s[2] & set(r[5])) >= 0.6 * min(len(s[2]), len(r[5]))]
            into[d, r[1]] = hit[0][0] if hit else r[1]
            if hit:
                hit[0][2].update(r[5])
            else:
                stand.append((r[1], r[2], set(r[5])))
    assert {(r.d, r.i): r.kept for r in sequences.kept_surfaces(df, "d", "kind", "i", "lineage", "members").collect()} == kept
    assert {(r.d, r.i): r.into for r in sequences.merged_closures(df, "d", "kind", "i", "risk", "members").collect()} == into
    assert 0 < sum(kept.values()) < 100 and any(k[1] != v for k, v in into.items())
