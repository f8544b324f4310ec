"""Running metrics of a stream of reads or molecules.

Partial sums merge in any order, so the batch aggregates work on streams: a
window of time for each group, late rows up to a delay, and one row for each
window when it closes (or, in update mode, whenever it changes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def windowed_metrics(rows: DataFrame, at: str, group: str, width: str, delay: str, value: str) -> DataFrame:
    """(group, start, n, total, least, most) by window of event time."""
    w = rows.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), F.col(group).alias("group"))
    return w.agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most")).select("group", F.col("w.start").alias("start"), "n", "total", "least", "most")


def first_of_key(rows: DataFrame, at: str, delay: str, *keys: str) -> DataFrame:
    """Each key once, as long as its repeats come within the delay."""
    return rows.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def visited(rows: DataFrame, name: str, **visitors: Column) -> tuple[DataFrame, Observation]:
    """``rows`` as they are, and an observation with one value for each
    visitor, an aggregate: it is filled while the rows pass, in their job."""
    seen = Observation(name)
    return rows.observe(seen, *[c.alias(n) for n, c in visitors.items()]), seen
