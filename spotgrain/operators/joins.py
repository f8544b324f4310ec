"""Joins beyond plain equality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_join(points: DataFrame, at: str, ranges: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """Pairs with start <= at < end.  Ranges go to each bucket of ``width``
    that they touch, points to their own: an equality join, checked after."""
    r = ranges.withColumn("ij_b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    p = points.withColumn("ij_b", F.floor(F.col(at) / width))
    return p.join(r, "ij_b").where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("ij_b")


def overlap(members: DataFrame, group: str, item: str) -> DataFrame:
    """Pairs of groups that share items: (a, b, common, overlap coefficient).
    An item makes a row for each pair of its groups: it is for some dozen
    groups, such as the probe barcodes of a run, whose pairs are the result."""
    m = members.select(F.col(group).alias("g"), F.col(item).alias("i")).distinct()
    size = m.groupBy("g").agg(F.count("*").alias("n"))
    pair = m.select(F.col("g").alias("a"), "i").join(m.select(F.col("g").alias("b"), "i"), "i").where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    pair = pair.join(size.select(F.col("g").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("g").alias("b"), F.col("n").alias("nb")), "b")
    return pair.select("a", "b", "common", (F.col("common") / F.least("na", "nb")).alias("overlap"))


def last_before(left: DataFrame, right: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """As-of join: to each left row the latest right ``value`` of its key at or
    before it (of equal times the one with the highest ``tie``), by one sort of
    both sides instead of a range join."""
    side = lambda df, v, t, is_left, row: df.select(F.col(key).alias("k"), F.col(at).alias("at"), v.alias("v"), t.alias("t"), F.lit(is_left).alias("is_left"), row.alias("row"))
    kind = left.select(F.struct(*left.columns).alias("row")).schema["row"].dataType
    none = lambda c: F.lit(None).cast(dict(right.dtypes)[c])
    both = side(left, none(value), none(tie), 1, F.struct(*left.columns)).unionByName(side(right, F.col(value), F.col(tie), 0, F.lit(None).cast(kind)))
    w = Window.partitionBy("k").orderBy("at", "is_left", "t").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("asof", F.last("v", ignorenulls=True).over(w)).where("is_left = 1").select("row.*", F.col("asof").alias(f"last_{value}"))


def overlapping(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """Pairs of closed intervals that share a place: left (lo, hi), right
    (start, end), all of the columns.  Both go to the buckets they touch; a
    pair is taken only in the bucket where the later of the two begins."""
    spread = lambda df, a, b: df.withColumn("ov_b", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))))
    l = spread(left.where("lo <= hi"), "lo", "hi")  # noqa: E741
    r = spread(right.where("start <= end"), "start", "end")
    both = l.join(r, "ov_b").where("lo <= end AND start <= hi")
    return both.where(F.col("ov_b") == F.floor(F.greatest("lo", "start") / width)).drop("ov_b")


def nearest_on_grid(spots: DataFrame, targets: DataFrame, radius: int) -> DataFrame:
    """``spots`` (row, col) with the nearest of ``targets`` (row, col, target)
    within ``radius`` and its squared distance; of equally near ones the
    offset first in row-major order.  An equality join on the offsets."""
    offsets = sorted((a * a + b * b, a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius)
    near = F.array(*[F.struct(F.lit(d).alias("d2"), F.lit(a).alias("da"), F.lit(b).alias("db")) for d, a, b in offsets])
    t = targets.select("row", "col", "target", F.explode(near).alias("o"))
    t = t.select((F.col("row") - F.col("o.da")).alias("row"), (F.col("col") - F.col("o.db")).alias("col"), F.struct("o.d2", "o.da", "o.db", "target").alias("x"))
    best = t.groupBy("row", "col").agg(F.min("x").alias("x"))
    return spots.join(best, ["row", "col"], "left").select(*spots.columns, F.col("x.target").alias("target"), F.col("x.d2").alias("d2"))
