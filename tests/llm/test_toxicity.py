"""Toxicity: held-out accuracy, features against brute force, awkward texts."""

import math
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SF  # noqa: E402

from textloom.llm import queries, toxicity  # noqa: E402
from textloom.llm.common import text_bytes  # noqa: E402


def test_features_are_those_of_each_text_alone():
    texts = ["", None, "ab", "ÀÉß 𝄞𝄞𝄞", "abcabc", "x" * 40, "ABCABC"]
    row, bucket = toxicity.features(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        alone = toxicity.features(*text_bytes(pa.array([t])))[1]
        assert sorted(bucket[row == i]) == sorted(alone)
        grams = {(t or "").lower()[k : k + n] for n in toxicity.ORDERS for k in range(len(t or "") - n + 1)}
        assert len(alone) == len(grams)
    assert list(bucket[row == 4]) == list(bucket[row == 6])


def bucket_of(gram):
    """The bucket of one n-gram, by plain whole numbers."""
    x = sum(ord(c) * int(k) for c, k in zip(gram, toxicity._KEYS, strict=False)) + len(gram)
    x %= 2**64
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor % 2**64
    return (x ^ (x >> 31)) >> (64 - toxicity.BITS)


def grams_of(text):
    """Buckets of a text's distinct n-grams."""
    low = (text or "").lower()
    return {bucket_of(low[k : k + n]) for n in toxicity.ORDERS for k in range(len(low) - n + 1)}


def brute_fit(sets, labels, smooth=1.0, least_ratio=1.0, least_docs=4, l2=0.1, steps=300):
    """The model in plain loops: log-count ratios, then full gradients of the weighted logistic loss with Adam."""
    size = 1 << toxicity.BITS
    seen = {b for s in sets for b in s}
    p = {b: smooth + sum(y == 1 and b in s for s, y in zip(sets, labels, strict=True)) for b in seen}
    q = {b: smooth + sum(y == 0 and b in s for s, y in zip(sets, labels, strict=True)) for b in seen}
    rest = (size - len(seen)) * smooth
    ratio = {b: math.log(p[b] / (sum(p.values()) + rest)) - math.log(q[b] / (sum(q.values()) + rest)) for b in seen}
    used = sorted(b for b in seen if abs(ratio[b]) >= least_ratio and p[b] + q[b] - 2 * smooth >= least_docs)
    w, m, v = dict.fromkeys(used, 0.0), dict.fromkeys(used, 0.0), dict.fromkeys(used, 0.0)
    b0 = m0 = v0 = 0.0
    n1, n = sum(labels), len(labels)
    for t in range(1, steps + 1):
        z = [b0 + sum(ratio[b] * w[b] for b in s if b in w) / math.sqrt(len(s)) for s in sets]
        err = [(1 / (1 + math.exp(-x)) - y) * (0.5 / n1 if y else 0.5 / (n - n1)) for x, y in zip(z, labels, strict=True)]
        step = lambda m, v: 0.05 * (m / (1 - 0.9**t)) / (math.sqrt(v / (1 - 0.999**t)) + 1e-8)  # noqa: E731, B023
        for b in used:
            g = sum(e * ratio[b] / math.sqrt(len(s)) for e, s in zip(err, sets, strict=True) if b in s) + l2 * w[b] / n
            m[b], v[b] = 0.9 * m[b] + 0.1 * g, 0.999 * v[b] + 0.001 * g * g
            w[b] -= step(m[b], v[b])
        m0, v0 = 0.9 * m0 + 0.1 * sum(err), 0.999 * v0 + 0.001 * sum(err) ** 2
        b0 -= step(m0, v0)
    return {b: w[b] * ratio[b] for b in used}, b0


def test_fit_and_scores_match_brute_force(spark):
    bad, fine = ["you vile rat", "vile Vile filth", "rat filth rat"], ["a calm day", "the calm sea", "day by the sea"]
    rows = [(i, f"{bad[i % 3]} {i % 2}" if i % 4 == 0 else f"{fine[i % 3]} {i % 5}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [int(i % 4 == 0) for i, _ in rows]
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for (i, _), y in zip(rows, labels, strict=True)], "doc_id long, toxic int"))
    sets = [grams_of(t) for _, t in rows]
    weights, intercept = brute_fit(sets, labels)
    assert abs(model.intercept - intercept) < 1e-6
    assert {int(b) for b in np.flatnonzero(model.weights)} == {b for b, x in weights.items() if x} and all(abs(model.weights[b] - x) < 1e-5 for b, x in weights.items())
    texts = [*rows, (100, None), (101, ""), (102, "vile"), (103, "the calm rat ÀÉ")]
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for key, text in texts:
        found = grams_of(text)
        want = 1 / (1 + math.exp(-(intercept + sum(weights.get(b, 0) for b in found) / math.sqrt(max(len(found), 1)))))
        assert abs(got[key][0] - want) < 1e-5 and got[key][1] == (want >= 0.3)


def test_query_rows(spark):
    got = queries.op1_toxicity(spark, SF).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in got) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_several_labels_of_one_key(spark):
    docs = spark.createDataFrame([(i, "foul word" if i < 8 else "kind word") for i in range(16)], "doc_id long, text string")
    told = [(i, int(i < 8)) for i in range(16)]
    both = toxicity.train(docs, spark.createDataFrame([*told, (0, 0), (0, 1)], "doc_id long, toxic int"))
    sets = [grams_of("foul word" if i < 8 else "kind word") for i, _ in [*told, (0, 0)]]
    weights, intercept = brute_fit(sets, [y for _, y in told] + [0])
    assert abs(both.intercept - intercept) < 1e-6 and all(abs(both.weights[b] - x) < 1e-5 for b, x in weights.items())


def test_held_out(spark):
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").toPandas()
    rank = got.score.rank()
    n1, n0 = (got.toxic == 1).sum(), (got.toxic == 0).sum()
    assert (rank[got.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.93
    sure = got.score >= 0.5
    assert (got.toxic[sure] == 1).mean() > 0.95 and sure.sum() > 0.5 * n1
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_awkward(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a", 1), (4, "bad " * 100_000, 1), (4, "bad " * 100_000, 1)], "doc_id long, text string, label int")
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, none).collect()] == [0.5] * 5
    docs = docs.unionByName(spark.createDataFrame([(i, 'bad day' if i % 2 else 'good day', 0) for i in range(10, 30)], docs.schema))
    labels = spark.createDataFrame([(4, 1), (3, 0), (2, 0), (9, None)] + [(i, i % 2) for i in range(10, 30)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[4] > 0.5 and all(0 <= s <= 1 for s in got.values()) and got[1] == got[2]
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert np.isfinite(model.weights).all()
    assert queries.op1_toxicity(spark, SF).count() == 1000
