"""Nearest vectors of a stated query set, in blocks of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.sources.shared import written

#: Products of two summation orders, and their rounding to five places, differ by less.
SLACK = 2e-5


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of doubles; a null vector, or one with a null in it, is a row of NaN."""
    out = np.full((len(column), dims), np.nan)
    there = np.flatnonzero(~np.asarray(column.is_null()))
    if len(there):
        out[there] = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(there), dims)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = 4096, rows: int = 1024) -> DataFrame:
    """(q, key, dot): for each query (q, e) the ``k`` vectors of the largest dot product, itself left out, ties by key, null products last. Keys are long.

    Queries go out ``block`` at a time; a task multiplies them with ``rows`` of its vectors at a time and keeps what can be among a query's best: matrix products find
    what is near the ``k``-th best so far, whose products are then made in the vectors' order, as SQL makes them. The last choice is made over all tasks.
    """
    parts = max(1, -(-queries.count() // block))
    dealt = written(queries.withColumn("_block", F.pmod(F.xxhash64("q"), F.lit(parts))), "queries")

    def scan(asked: np.ndarray, wanted: np.ndarray):
        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least = np.full(len(asked), -np.inf)
            of, keys, dots = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            for batch in batches:
                for lo in range(0, batch.num_rows, rows):
                    some = batch.slice(lo, rows)
                    own, vector_ = some.column(0).to_numpy(zero_copy_only=False), _matrix(some.column(1), wanted.shape[1])
                    near = np.nan_to_num(wanted @ vector_.T, nan=-np.inf)
                    if len(own) > k + 1:
                        least = np.maximum(least, np.partition(near, len(own) - k - 1, axis=1)[:, len(own) - k - 1])  # the query itself may be one of them
                    i, j = np.nonzero(near >= least[:, None] - SLACK)
                    i, j = i[asked[i] != own[j]], j[asked[i] != own[j]]
                    exact = [np.add.accumulate(wanted[a] * vector_[b], axis=1)[:, -1] for a, b in zip(*(np.array_split(x, len(i) // 10_000 + 1) for x in (i, j)), strict=True)]
                    of, keys, dots = np.append(of, i), np.append(keys, own[j]), np.append(dots, np.nan_to_num(np.concatenate(exact), nan=-np.inf))
                    order = np.lexsort((keys, -dots, of))
                    of, keys, dots = of[order], keys[order], dots[order]
                    at = np.arange(len(of))
                    new = np.append(True, of[1:] != of[:-1])[: len(of)]
                    place = at - np.maximum.accumulate(np.where(new, at, 0))
                    equal = at - np.maximum.accumulate(np.where(new | np.append(True, dots[1:] != dots[:-1])[: len(of)], at, 0))
                    kth = place == k - 1
                    least[of[kth]] = np.maximum(least[of[kth]], dots[kth])
                    kept = (equal < k) & (dots >= least[of] - SLACK)  # of copies, which tie, the k first are enough
                    of, keys, dots = of[kept], keys[kept], dots[kept]
            yield pa.RecordBatch.from_arrays([pa.array(asked[of]), pa.array(keys), pa.array(dots, mask=np.isinf(dots))], ["q", key, "dot"])

        return best

    out = []
    for b in range(parts):
        table = dealt.filter(F.col("_block") == b).select(F.col("q").cast("long").alias("q"), "e").toArrow().combine_chunks()  # about ``block`` vectors
        if table.num_rows:
            e = table.column("e").combine_chunks()
            dims = max((len(x) for x in e if x.is_valid), default=1)
            mapped = vectors.select(F.col(key).cast("long").alias(key), vector).mapInArrow(scan(table.column("q").to_numpy(), _matrix(e, dims)), f"q long, {key} long, dot double")
            out.append(mapped)
    if not out:
        return vectors.limit(0).select(F.col(key).cast("long").alias("q"), F.col(key).cast("long").alias(key), F.lit(0.0).alias("dot"))
    found = reduce(DataFrame.unionByName, out).withColumn("dot", F.round("dot", 5))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("dot"), key))
    return found.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
