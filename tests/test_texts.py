"""Text projections against a plain mirror."""

import re

from textloom.plans.catalog import REGISTRY


def mirror(text):
    plain = " ".join(text.split())
    folded = plain.lower()
    at = folded.find(" in ") + 1
    slug = re.sub("[^a-z0-9]+", "-", folded).strip("-")[:120].rstrip("-") or "item"
    excerpt = re.sub(r"\s\S*$", "", plain[:70]) + "..." if len(plain) > 70 else plain
    return slug, excerpt, folded[: at - 1] if at >= 25 else folded, len(set(re.findall("[a-z0-9]{3,}", folded)))


def test_projection_of_whole_texts(spark, tmp_path):
    texts = ["Short text", "--- " * 80 + "Title behind two hundred characters", "Some words that stand in a long text " + "word and number 12345 " * 400, "one two three"]
    rows = [(i, t, None if i == 3 else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY.builders()["text_projection"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(i, *mirror(t)) for i, t in enumerate(texts)]
