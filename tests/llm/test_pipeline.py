"""The pipeline's stages: columns, decisions and whole results against brute force, stage by stage."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import test_decontamination  # noqa: E402
import test_line_dedup  # noqa: E402
import test_ngram_join  # noqa: E402
import test_packing  # noqa: E402

import corpus_pipeline  # noqa: E402
from textloom.llm.common import written  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    before, out = rows(docs), []
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        if name == "packing":
            test_packing.check(docs.collect(), before)
            break
        assert docs.columns == names
        after = rows(docs)
        if name == "quality_classifier":
            gone = {k for k, _ in before} - {k for k, _ in after}
            assert 0.08 < len(gone) / len(before) < 0.12 and sum(labels.get(k) == 1 for k in gone) <= 3
        elif name == "line_dedup":
            want = [(k, t) for (k, t), (_, old) in zip(test_line_dedup.brute(before), before, strict=True) if t.strip() or t == old]
            assert sorted(after) == sorted(want) and len(want) < len(before)
        elif name == "ngram_join":
            first = {k for k, _, c in test_ngram_join.brute(before) if k == c}
            assert sorted(k for k, _ in after) == sorted(k for k, _ in before if k in first)
        elif name == "decontamination":
            want = [k for k, _, hit, _ in test_decontamination.brute(before, items, 10) if not hit]
            assert sorted(k for k, _ in after) == sorted(want) and len(want) < len(before)
        before, out = after, [*out, len(after)]
    assert out == sorted(out, reverse=True)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 500


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_scratch_removes_its_own_tables_only(spark):
    from textloom.llm.common import Scratch

    other = written(spark.range(3), "other")
    with Scratch() as tables:
        first = tables.settle(written(spark.range(5), "inner"), "first")
        second = tables.settle(first.filter("id > 1"), "second")
        assert len(tables.paths) == 1
    assert other.count() == 3 and second.count() == 3
    files = {p.rpartition("/")[0] for p in second.inputFiles()}
    assert {f.rpartition("/")[2] for f in files} == {tables.paths[0].rpartition("/")[2]}
