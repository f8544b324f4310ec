"""Subsampling of reads to given depths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def depth_rates(libraries: DataFrame, depth: float) -> DataFrame:
    """``libraries`` (library, reads, cells) with the ``rate`` that leaves
    ``depth`` reads a cell; a library without that many gets 0."""
    rate = F.lit(float(depth)) * F.col("cells") / F.col("reads")
    return libraries.withColumn("rate", F.when((F.col("reads") > 0) & (rate <= 1), rate).otherwise(0.0))


def thinned(molecules: DataFrame, rates: DataFrame, seed: int = 42) -> DataFrame:
    """Each read of a molecule stays with its library's rate; molecules
    without reads go.  A read's draw is a hash of its molecule, its number and
    the seed, so a task that runs again draws the same."""
    m = molecules.join(F.broadcast(rates.select("library", "rate")), "library")  # a row for each library
    name = [F.col(c) for c in molecules.columns]
    draw = lambda i: F.pmod(F.xxhash64(*name, i, F.lit(seed)), F.lit(1 << 40)) < F.col("rate") * (1 << 40)
    some = F.size(F.filter(F.sequence(F.lit(1).cast("long"), F.col("reads")), draw)).cast("long")
    kept = F.when(F.col("rate") >= 1, F.col("reads")).when((F.col("rate") <= 0) | (F.col("reads") < 1), 0).otherwise(some)
    return m.withColumn("reads", kept).where("reads > 0").select(*molecules.columns)
