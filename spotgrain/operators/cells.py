"""Cell calling, dense indexes and ranks of barcodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_curve(totals: DataFrame, value: str = "umis") -> DataFrame:
    """(value, n, rank): how many barcodes hold at least ``value``.  The one
    ordered window runs over distinct values, never over barcodes."""
    h = totals.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return h.withColumn("rank", F.sum("n").over(Window.orderBy(F.desc("value"))))


def order_of_magnitude_cutoff(totals: DataFrame, recovered: int, quantile: float = 0.99, value: str = "umis") -> DataFrame:
    """(cutoff): a tenth, half to even and 1 at least, of the value at the rank
    that leaves 1 - ``quantile`` of the recovered cells above it."""
    # half to even, as in round()
    at = round(recovered * (1 - quantile))
    base = rank_curve(totals.where(F.col(value) > 0), value)
    # Fewer barcodes than that: the last one.
    hit = base.agg(F.coalesce(F.max(F.when(F.col("rank") > at, F.col("value"))), F.min("value"), F.lit(0)).alias("v"))
    return hit.select(F.greatest(F.lit(1).cast("long"), F.bround(F.col("v") * F.lit(0.1), 0).cast("long")).alias("cutoff"))


def call_cells(totals: DataFrame, recovered: int, value: str = "umis") -> DataFrame:
    """``totals`` with ``is_cell``: the value reaches the cutoff."""
    cut = order_of_magnitude_cutoff(totals, recovered, value=value)
    return totals.crossJoin(F.broadcast(cut)).withColumn("is_cell", F.col(value) >= F.col("cutoff"))  # one row


def dense_index(keys: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """(key, index) from 0 in the order of an integer key.  Keys are counted in
    ranges of ``width``; only the ranges' counts pass through one task, each
    range is numbered on its own."""
    k = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("di_range", F.floor(F.col(key) / width))
    before = F.sum("n").over(Window.orderBy("di_range").rowsBetween(Window.unboundedPreceding, -1))
    start = k.groupBy("di_range").agg(F.count("*").alias("n")).select("di_range", F.coalesce(before, F.lit(0)).alias("di_start"))
    inside = F.row_number().over(Window.partitionBy("di_range").orderBy(key)) - 1
    return k.join(start, "di_range").select(key, (F.col("di_start") + inside).alias("index"))


def compressed_columns(matrix: DataFrame) -> DataFrame:
    """A matrix by columns: per barcode the sorted features and their counts."""
    pair = F.array_sort(F.collect_list(F.struct("feature", "umis")))
    return matrix.groupBy("barcode").agg(pair.alias("c")).select("barcode", F.col("c.feature").alias("indices"), F.col("c.umis").alias("data"))


def expanded(columns: DataFrame) -> DataFrame:
    """``compressed_columns`` taken apart again."""
    return columns.select("barcode", F.explode(F.arrays_zip(F.col("indices").alias("feature"), F.col("data").alias("umis"))).alias("x")).select("x.feature", "barcode", "x.umis")


def in_tissue(spots: DataFrame, factor: int, flag: Column) -> DataFrame:
    """A bin is in tissue if any of its spots is; every bin is listed."""
    return spots.groupBy(F.floor(F.col("row") / factor).alias("bin_row"), F.floor(F.col("col") / factor).alias("bin_col")).agg(F.max(F.coalesce(flag, F.lit(False))).alias("in_tissue"))
