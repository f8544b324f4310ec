"""Histograms, quantiles and other summaries of distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, key: str, value: str, at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Type-7 quantiles from counts of distinct values."""
    h = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return h.groupBy(key).agg(*[F.expr(f"percentile({value}, {q}D, n)").alias(f"q{round(100 * q)}") for q in at])


def effective_diversity(df: DataFrame, key: str, part: str, weight: Column) -> DataFrame:
    """1 / sum of squared shares of the parts of each key; NaN without weight."""
    s = df.groupBy(key, part).agg(F.sum(weight).alias("w"))
    return s.groupBy(key).agg(robust_divide(F.sum("w") * F.sum("w"), F.sum(F.col("w") * F.col("w"))).alias("diversity"))


def n50(df: DataFrame, key: str, value: str) -> DataFrame:
    """The largest length such that rows of it and over hold half of the total."""
    h = df.groupBy(key, value).agg(F.sum(value).alias("s"))
    run = F.sum("s").over(Window.partitionBy(key).orderBy(F.desc(value)))
    total = F.sum("s").over(Window.partitionBy(key))
    h = h.select(key, value, run.alias("run"), total.alias("total"))
    return h.where(2 * F.col("run") >= F.col("total")).groupBy(key).agg(F.max(value).alias("n50"))


def benjamini_hochberg(df: DataFrame, p: str, *keys: str) -> DataFrame:
    """Adjusted p-values within ``keys``; ties share the smaller.  The windows
    run over distinct p-values with their counts."""
    h = df.groupBy(*keys, p).agg(F.count("*").alias("bh_c"))
    up = Window.partitionBy(*keys).orderBy(p).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    r = h.withColumn("bh_rank", F.sum("bh_c").over(up)).withColumn("bh_n", F.sum("bh_c").over(Window.partitionBy(*keys)))
    r = r.withColumn("adjusted", F.least(F.lit(1.0), F.min(F.col(p) * F.col("bh_n") / F.col("bh_rank")).over(down)))
    return df.join(r.select(*keys, p, "adjusted"), [*keys, p])


def running_occurrence(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.withColumn("occurrence", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def subtotals(df: DataFrame, *keys: str) -> DataFrame:
    return df.rollup(*keys).agg(F.sum("reads").alias("reads"), F.count("*").alias("umis"))
