"""Sparse feature-by-barcode matrices as (feature, barcode, umis) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def count_matrix(molecules: DataFrame) -> DataFrame:
    return molecules.groupBy("feature", "barcode").agg(F.count("*").alias("umis"), F.sum("reads").alias("reads"))


def feature_summary(molecules: DataFrame, features: DataFrame, cells: DataFrame) -> DataFrame:
    """Per feature: molecules, reads, barcodes and the share of reads beyond
    the first of a molecule, over all and over cells; zeros where it has none."""
    # Entries first: a barcode is a cell or not as a whole, so distinct barcodes are plain counts.
    e = molecules.groupBy("feature", "barcode").agg(F.count("*").alias("u"), F.sum("reads").alias("r"))
    e = e.join(cells.where("is_cell").select("barcode", F.lit(1).alias("c")), "barcode", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    s = e.groupBy("feature").agg(
        F.sum("u").alias("umis"),
        F.sum("r").alias("reads"),
        F.count("*").alias("barcodes"),
        F.sum(F.col("u") * F.col("c")).alias("umis_cells"),
        F.sum(F.col("r") * F.col("c")).alias("reads_cells"),
        F.sum("c").alias("barcodes_cells"),
    )
    out = features.select("feature", "feature_type").join(s, "feature", "left").na.fill(0)
    return out.withColumn("dup_frac", F.when(F.col("reads") > 0, 1 - F.col("umis") / F.col("reads")).otherwise(0.0))


def barcode_totals(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("barcode").agg(F.sum("umis").alias("umis"), F.count("*").alias("n_features"))


def above_threshold(matrix: DataFrame, low: int) -> DataFrame:
    """Entries whose row and whose column total, both of the input, exceed ``low``."""
    of = lambda axis: matrix.groupBy(axis).agg(F.sum("umis").alias("t")).where(F.col("t") > low).select(axis)
    return matrix.join(of("feature"), "feature", "left_semi").join(of("barcode"), "barcode", "left_semi")


def merge_matrices(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("feature", "barcode").agg(F.sum("umis").alias("umis"))


def top_features(matrix: DataFrame, n: int = 3) -> DataFrame:
    """The n features of each barcode with most molecules; ties by feature."""
    w = Window.partitionBy("barcode").orderBy(F.desc("umis"), "feature")
    return matrix.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def normalised(matrix: DataFrame, scale: float) -> DataFrame:
    """log2(1 + umis * scale / barcode total)."""
    total = matrix.groupBy("barcode").agg(F.sum("umis").alias("total"))
    share = F.when(F.col("total") == 0, 0.0).otherwise(F.col("umis") * scale / F.when(F.col("total") == 0, 1).otherwise(F.col("total")))
    return matrix.join(total, "barcode").select("feature", "barcode", F.log2(1 + share).alias("value"))


def dispersion(matrix: DataFrame, n_barcodes: int) -> DataFrame:
    """Mean, population variance and their ratio (NaN for a mean of 0) per
    feature, barcodes without it as zeros."""
    s = matrix.groupBy("feature").agg(F.sum("umis").alias("s"), F.sum(F.col("umis") * F.col("umis")).alias("q"))
    mean = F.col("s") / n_barcodes
    var = F.col("q") / n_barcodes - mean * mean
    return s.select("feature", mean.alias("mean"), var.alias("variance"), robust_divide(var, mean).alias("dispersion"))


def spatial_bins(points: DataFrame, factor: int) -> DataFrame:
    """Counts of (row, col, umis) on a grid ``factor`` times coarser."""
    return points.groupBy(F.floor(F.col("row") / factor).alias("bin_row"), F.floor(F.col("col") / factor).alias("bin_col")).agg(F.sum("umis").alias("umis"), F.count("*").alias("spots"))


def morans_i(points: DataFrame) -> DataFrame:
    """Spatial autocorrelation of ``umis`` over the four neighbours on a grid;
    NaN where all values are equal, or no two points are neighbours."""
    mean = points.agg(F.avg("umis").alias("m"), F.count("*").alias("n"))
    z = points.crossJoin(F.broadcast(mean)).select("row", "col", (F.col("umis") - F.col("m")).alias("z"), "n")  # one row
    near = z.select(F.explode(F.array(*[F.struct((F.col("row") + a).alias("r"), (F.col("col") + b).alias("c")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))])).alias("k"), F.col("z").alias("zn")).select("k.r", "k.c", "zn")
    pairs = z.join(near, (F.col("row") == F.col("r")) & (F.col("col") == F.col("c")))
    top = pairs.agg(F.sum(F.col("z") * F.col("zn")).alias("s"), F.count("*").alias("w"))
    low = z.agg(F.sum(F.col("z") * F.col("z")).alias("q"), F.max("n").alias("n"))
    return top.crossJoin(low).select(robust_divide(F.col("n") * F.col("s"), F.col("w") * F.col("q")).alias("morans_i"))  # a row each
