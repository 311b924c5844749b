"""Join patterns: as-of, interval ownership, band, anti-with-mismatch, snapshot difference and upsert.

All are equi-joins once time or index is cut into bins, so none plans a nested loop or a Cartesian product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, value: str, until: str | None = None) -> DataFrame:
    """Each row of ``left`` with the ``value`` of the last row of ``right`` whose ``on`` isn't later, within ``by``.

    Union, one shuffle by key, and a running last value: linear however the two interleave. With ``until``, a column of
    ``right``, a value lapses from that point on.
    """
    names = left.columns
    a = left.select(*names, F.lit(None).alias("_mark"), F.lit(1).alias("_side"))
    b = right.select(*by, on, F.struct(F.col(value).alias("v"), F.col(until or on).alias("u")).alias("_mark"), F.lit(0).alias("_side"))
    order = Window.partitionBy(*by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_last", F.last("_mark", ignorenulls=True).over(order))
    last = F.when(F.col("_last.u").isNull() | (F.col(on) < F.col("_last.u")), F.col("_last.v")) if until else F.col("_last.v")
    return both.filter("_side = 1").select(*names, last.alias(value))


def interval_owner(points: DataFrame, windows: DataFrame, by: Sequence[str], at: Column, start: str, end: str, width: float) -> DataFrame:
    """Points joined with the windows [start, end) of their key that hold ``at``. Windows are spread over bins of ``width``, points fall into one."""
    binned = windows.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1e-9) / width))))
    placed = points.withColumn("_at", at).withColumn("_bin", F.floor(F.col("_at") / width))
    return placed.join(binned, [*by, "_bin"]).filter((F.col("_at") >= F.col(start)) & (F.col("_at") < F.col(end))).drop("_bin", "_at")


def band(rows: DataFrame, anchors: DataFrame, by: Sequence[str], index: str, radius: int) -> DataFrame:
    """Rows whose ``index`` is within ``radius`` of an anchor of their key, each with the anchor as ``anchor``: anchors are spread, then joined by equality."""
    near = anchors.select(*by, F.col(index).alias("anchor"), F.explode(F.sequence(F.col(index) - radius, F.col(index) + radius)).alias(index))
    return rows.join(near, [*by, index])


def traceability(evidence: DataFrame, segments: DataFrame, key: str, quote: str, text: str) -> DataFrame:
    """Evidence rows whose segment is missing, or whose quote isn't in its text, with the ``problem``."""
    found = segments.select(key, F.col(text).alias("_text"), F.lit(True).alias("_there"))
    joined = evidence.join(found, key, "left")
    problem = F.when(F.col("_there").isNull(), "missing_segment").when(~F.contains("_text", F.col(quote)), "quote_mismatch")
    return joined.withColumn("problem", problem).filter("problem IS NOT NULL").drop("_text", "_there")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, status, changed): added, removed or changed rows and the changed fields, comma-joined in order."""
    a = before.select(*keys, F.struct(*fields).alias("_a"))
    b = after.select(*keys, F.struct(*fields).alias("_b"))
    names = F.filter(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), f) for f in fields]), lambda x: x.isNotNull())
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.size(names) > 0, "changed")
    both = a.join(b, list(keys), "full").withColumn("status", status).filter("status IS NOT NULL")
    return both.select(*keys, "status", F.when(F.col("status") == "changed", F.array_join(names, ",")).otherwise("").alias("changed"))


def upsert(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, fields, origin): new values where given, else old ones; rows of one side alone are kept."""
    a = old.select(key, *[F.col(f).alias(f"_old_{f}") for f in fields], F.lit(True).alias("_in_old"))
    b = new.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_in_new"))
    origin = F.when(F.col("_in_old").isNull(), "inserted").when(F.col("_in_new").isNull(), "kept").otherwise("updated")
    return a.join(b, key, "full").select(key, *[F.coalesce(f"_new_{f}", f"_old_{f}").alias(f) for f in fields], origin.alias("origin"))
