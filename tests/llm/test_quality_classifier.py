"""Importance resampling: model and limit against brute force, labels told apart, awkward tables."""

import math
import random
from collections import Counter

import pyarrow as pa

from textloom.llm import quality_classifier as qc
from textloom.llm import queries
from textloom.llm.common import PLAIN, Words, grams, text_bytes

SF = "/root/testdata/sf0.01"


def buckets(text):
    data, offsets = text_bytes(pa.array([text]))
    w = Words(data, offsets, PLAIN, True)
    one = w.hashes()
    return [int(h) >> 50 for h in (*one, *grams(one, w.row, 2)[0])]


def test_ratio_and_weights(spark):
    texts = ["", None, " ", "a b", "a b a b c", "x y z " * 200, "ü É", "a b"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    ratio = qc.log_ratio(docs, spark.createDataFrame([(3,), (4,), (4,), (77,)], "doc_id long"))
    raw, target = Counter(), Counter()
    for i, t in enumerate(texts):
        raw.update(buckets(t))
        target.update(buckets(t) if i in (3, 4) else [])
    n, m, size = sum(raw.values()), sum(target.values()), 1 << qc.BITS
    for b in [*raw, 5]:
        assert abs(ratio[b] - math.log((target[b] + 1) / (m + size)) + math.log((raw[b] + 1) / (n + size))) < 1e-4
    got = qc.weights(pa.array(texts), ratio).to_pylist()
    assert got[:3] == [None] * 3 and got[3] == got[7]
    assert abs(got[4] - sum(ratio[b] for b in buckets(texts[4])) / 9) < 1e-5
    kept = qc.sample(docs, docs.filter("doc_id = 3").select("doc_id"), keep=1.0)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert qc.sample(docs.limit(0), docs.select("doc_id")).collect() == []


def test_kth_largest(spark):
    rnd = random.Random(1)
    values = [rnd.choice([1.5, rnd.gauss(0, 1)]) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 2, 1499, 2999, 3000):
        assert qc.kth_largest(df, k, buckets=16, few=10) == want[k - 1]
    assert qc.kth_largest(df, 3001) is None and qc.kth_largest(df.limit(0), 1) is None


def test_query_matches_brute_force(spark):
    """Counts, ratios, weights and the selection of the whole table in plain Python; noise by Spark's hash, as no library has it."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    each = {k: buckets(t) for k, t in rows}
    raw, target = Counter(), Counter()
    for k, found in each.items():
        raw.update(found)
        target.update(found if k in good else [])
    n, m, size = sum(raw.values()), sum(target.values()), 1 << qc.BITS
    ratio = {b: math.log((target[b] + 1) / (m + size)) - math.log((raw[b] + 1) / (n + size)) for b in range(size)}
    noise = {r.k: r.h for r in spark.createDataFrame([(k,) for k, _ in rows], "k long").selectExpr("k", "xxhash64(cast(k as string), 1) AS h").collect()}
    uniform = lambda h: (((h % 2**64) >> 11) + 0.5) / 2**53
    keys = {k: sum(ratio[b] for b in found) / len(found) / 0.02 - math.log(-math.log(uniform(noise[k]))) for k, found in each.items() if found}
    kept = set(sorted(keys, key=keys.get, reverse=True)[: round(0.9 * len(keys))])
    got = queries.op10_quality_classifier(spark, SF).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.kept} == kept
    assert all(abs(r.sampling_key - keys[r.doc_id]) < 1e-2 for r in got if r.doc_id in keys)


def test_tells_labels_apart(spark):
    got = queries.op10_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert got.kept[got.quality == 1].mean() > 0.98 and got.kept[got.quality == 0].mean() < 0.5
