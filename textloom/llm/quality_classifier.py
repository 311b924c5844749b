"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

The raw model counts the words and word pairs of every document, hashed into ``1 << bits`` buckets; counts are summed in
each task and then combined, so what moves is a fixed number of rows a task. The target model counts those of at most ``max_target``
labelled good documents (those with the least hash of their key). A document's weight is its mean log ratio of target to raw; its
sampling key is weight / temperature plus Gumbel noise from a hash of its key, and the ``keep`` share with the largest keys
is kept: a sample without replacement in proportion to exp(weight / temperature). The limit is found exactly from histograms that
narrow down on it, so no sort or task sees all keys.

Defined results: a text without words (null, empty, blank) has no weight and is never kept; rows whose key ties with the last kept are kept too,
so repeated rows share one fate; without good labels the target is uniform; an empty table gives an empty result; of other columns ``sample`` keeps all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import PLAIN, Words, grams, slices, text_bytes, written

BITS = 14


def _features(column: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, bucket) of the words and word pairs, slice by slice."""
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], PLAIN, lower=True)
        one = words.hashes()
        two, row = grams(one, words.row, 2)
        yield lo, hi, np.concatenate((words.row, row)), (np.concatenate((one, two)) >> np.uint64(64 - bits)).astype(np.int64)


def log_ratio(documents: DataFrame, good: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS, max_target: int = 10_000, smooth: float = 1.0) -> np.ndarray:
    """log(target / raw) of each bucket. ``good`` lists the keys of good documents."""
    few = good.select(F.col(key).alias("key")).distinct().orderBy(F.xxhash64("key"), "key").limit(max_target).withColumn("good", F.lit(1))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(few), "key", "left").select("text", F.coalesce("good", F.lit(0)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            mark = batch.column(1).to_numpy()
            for lo, _, row, bucket in _features(batch.column(0), bits):
                raw += np.bincount(bucket, minlength=1 << bits)
                target += np.bincount(bucket[mark[row + lo] == 1], minlength=1 << bits)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(1 << bits)), "raw": pa.array(raw), "target": pa.array(target)})

    counts = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = counts.toArrow()
    raw, target = np.full(1 << bits, smooth), np.full(1 << bits, smooth)
    at = got.column("bucket").to_numpy()
    raw[at] += got.column("raw").to_numpy()
    target[at] += got.column("target").to_numpy()
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def weights(column: pa.Array, ratio: np.ndarray) -> pa.Array:
    """Mean log ratio of each text, null for texts without words."""
    bits = len(ratio).bit_length() - 1
    total, n = np.zeros(len(column)), np.zeros(len(column))
    for lo, hi, row, bucket in _features(column, bits):
        total[lo:hi] = np.bincount(row, weights=ratio[bucket], minlength=hi - lo)
        n[lo:hi] = np.bincount(row, minlength=hi - lo)
    return pa.array(total / np.maximum(n, 1), mask=n == 0)


def weight(text: Column, ratio: np.ndarray) -> Column:
    @F.arrow_udf("double")
    def apply(column: pa.Array) -> pa.Array:
        return weights(column, ratio)

    return apply(text)


def sampling_key(weight: Column, key: Column, temperature: float, seed: int) -> Column:
    """weight / temperature + Gumbel noise that depends on the key and seed alone."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return weight / temperature - F.log(-F.log(uniform))


def kth_largest(values: DataFrame, k: int, buckets: int = 2048, few: int = 10_000) -> float | None:
    """The k-th largest of the one column of ``values``, exactly; None if there are fewer than k. The driver sees at most ``buckets`` counts or ``few`` values at a time."""
    (name,) = values.columns
    v = values.filter(F.col(name).isNotNull())
    while True:
        lo, hi, n = v.agg(F.min(name), F.max(name), F.count(name)).first()
        if k < 1 or n < k:
            return None
        if lo == hi:
            return lo
        if n <= few:
            return sorted((r[0] for r in v.collect()), reverse=True)[k - 1]
        width = (hi - lo) / buckets
        at = F.least(F.floor((F.col(name) - lo) / width), F.lit(buckets - 1))
        for bucket, count in sorted(v.groupBy(at.alias("b")).count().collect(), reverse=True):
            if k <= count:
                v = v.filter(at == bucket)
                break
            k -= count


def ranked(documents: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text", temperature: float = 0.02, keep: float = 0.9, seed: int = 1) -> tuple[DataFrame, float]:
    """((key, log_weight, sampling_key), limit): kept are the rows whose sampling key is at least the limit."""
    kept = documents.select(F.col(key).alias("key"), weight(F.col(text), ratio).alias("log_weight"))
    kept = written(kept.select("key", "log_weight", sampling_key(F.col("log_weight"), F.col("key"), temperature, seed).alias("sampling_key")), "weights")
    n = kept.filter("sampling_key IS NOT NULL").count()
    limit = kth_largest(kept.select("sampling_key"), max(1, round(keep * n)))
    return kept, float("inf") if limit is None else limit


def sample(documents: DataFrame, good: DataFrame, key: str = "doc_id", text: str = "text", temperature: float = 0.02, keep: float = 0.9, seed: int = 1, **model) -> DataFrame:
    """The kept documents, with their columns. Weights are computed again rather than shuffled back to the texts."""
    ratio = log_ratio(documents, good, key, text, **model)
    _, limit = ranked(documents, ratio, key, text, temperature, keep, seed)
    return documents.filter(sampling_key(weight(F.col(text), ratio), F.col(key), temperature, seed) >= limit)
