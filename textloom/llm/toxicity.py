"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Fitting takes labelled documents up to ``max_rows`` (those with the least hash of their key; a bound, not a property of the
data) and so bounds what is broadcast, collected and held by the driver. Features are the distinct hashed n-grams of a text, each
scaled by log((p + a) / |p|) - log((q + a) / |q|), p and q being counts of the positive and negative documents that hold it; the
log-likelihood ratios weight a logistic regression. Scoring reads every whole text once, in bounded slices, without a shuffle.

Defined results: null and empty texts have no features and score by the intercept alone; a text shorter than an n-gram has only
the shorter ones; repeated rows score alike; without labels of both kinds every score is the share of positives (0.5 without labels); of
a key with several labels each row counts; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import mix, slices, text_bytes

ORDERS = (4, 5, 6)
BITS = 18
_FOLD = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, range(0x250))], np.uint32)
_KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


@dataclass(frozen=True)
class Model:
    """Weight of each hashed n-gram, and intercept."""

    weights: np.ndarray
    intercept: float


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of UTF-8 bytes, and the rows' offsets among them."""
    text = data.tobytes()
    points = np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) == len(data):
        starts = offsets
    else:
        begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        if begins[-1] != len(points):  # broken UTF-8: place each row by itself
            begins = None
        starts = begins[offsets] if begins is not None else np.cumsum([0] + [len(text[a:b].decode("utf-8", "surrogateescape")) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    return np.where(points < len(_FOLD), _FOLD[np.minimum(points, len(_FOLD) - 1)], points), starts


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of the n-grams of each row, sorted."""
    points, starts = characters(data, offsets)
    row = np.repeat(np.arange(len(starts) - 1, dtype=np.uint64), np.diff(starts)) << np.uint64(BITS)
    sums, found = np.zeros(len(points), np.uint64), []
    for n in range(1, max(ORDERS) + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        sums = sums[:m] + points[n - 1 :].astype(np.uint64) * _KEYS[n - 1]
        if n in ORDERS:
            whole = row[:m] == row[n - 1 :]
            found.append(row[:m][whole] | (mix(sums[whole] + np.uint64(n)) >> np.uint64(64 - BITS)))
    keys = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)


def fit(sizes: np.ndarray, bucket: np.ndarray, labels: np.ndarray, smooth: float = 1.0, least_ratio: float = 1.0, least_docs: int = 4, l2: float = 0.1, steps: int = 300) -> Model:
    """Log-count ratios of the features, ``bucket`` holding ``sizes[i]`` of them for row i, then logistic regression on the ratios of the n-grams present, by full gradients with Adam.

    Only n-grams of at least ``least_docs`` documents and a ratio of at least ``least_ratio`` either way are weighted; the others hardly tell
    the labels apart. Both labels weigh the same in total, so 0.5 is where the evidence is even.
    """
    size, n = 1 << BITS, len(labels)
    y = labels.astype(np.float64)
    if n == 0 or y.min() == y.max():
        share = 0.5 if n == 0 else min(max(y.mean(), 1e-6), 1 - 1e-6)
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    p, q = np.full(size, smooth), np.full(size, smooth)
    for at in range(0, len(bucket), 1 << 20):  # piece by piece: few of the features are used further on
        positive = labels[row[at : at + (1 << 20)]] == 1
        p += np.bincount(bucket[at : at + (1 << 20)][positive], minlength=size)
        q += np.bincount(bucket[at : at + (1 << 20)][~positive], minlength=size)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    used = (np.abs(ratio) >= least_ratio) & (p + q - 2 * smooth >= least_docs)
    telling = used[bucket]
    row, bucket = row[telling], bucket[telling]
    value = ratio[bucket] * scale[row]
    w, b = np.zeros(size), 0.0
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    m, v, mb, vb, rate = np.zeros(size), np.zeros(size), 0.0, 0.0, 0.05
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=value * w[bucket], minlength=n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        g = np.bincount(bucket, weights=value * error[row], minlength=size) + l2 * w / n
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return Model((w * ratio * used).astype(np.float32), float(b))


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Scores from 0 to 1 of a string column."""
    data, offsets = text_bytes(column)
    out = np.zeros(len(column))
    for lo, hi in slices(offsets):
        row, bucket = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        n = np.maximum(np.bincount(row, minlength=hi - lo), 1)
        out[lo:hi] = np.bincount(row, weights=model.weights[bucket], minlength=hi - lo) / np.sqrt(n)
    return 1 / (1 + np.exp(-np.clip(out + model.intercept, -40, 40)))


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 3000) -> Model:
    """Fit on at most ``max_rows`` labelled documents, half of either label at most, those with the least hash of their key."""
    told = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)").dropDuplicates()
    sides = [told.filter(F.col("label") == side).orderBy(F.xxhash64("key"), "key").limit(max_rows // 2) for side in (0, 1)]
    few = F.broadcast(sides[0].unionByName(sides[1]))  # at most max_rows short rows
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(few, "key").select("text", "label").limit(max_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in slices(offsets):
                row, bucket = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), lists], ["label", "buckets"])

    found = rows.mapInArrow(extract, "label int, buckets array<int>").toArrow()
    lists = [c for c in found.column("buckets").chunks if len(c)]
    bucket = np.concatenate([c.flatten().to_numpy() for c in lists] or [np.zeros(0, np.int32)])
    size = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in lists] or [np.zeros(0, np.int64)])
    label = found.column("label").to_numpy()
    del found, lists
    return fit(size, bucket, label)


def score(documents: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted): predicted is 1 where the score is at least ``threshold``."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1), model))], ["key", "score"])

    scored = rows.mapInArrow(apply, f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
