"""Statistics of count matrices by cluster and feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def size_factors(matrix: DataFrame) -> DataFrame:
    """(barcode, size_factor): a barcode's total over the median total; NaN if
    that is 0."""
    t = matrix.groupBy("barcode").agg(F.sum("umis").alias("total"))
    m = t.groupBy("total").agg(F.count("*").alias("n")).agg(F.expr("percentile(total, 0.5D, n)").alias("m"))
    return t.crossJoin(F.broadcast(m)).select("barcode", robust_divide(F.col("total"), F.col("m")).alias("size_factor"))  # one row


def cluster_means(matrix: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, feature, mean) over all barcodes of the cluster, zeros included."""
    size = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    s = matrix.join(clusters, "barcode").groupBy("cluster", "feature").agg(F.sum("umis").alias("s"))
    return s.join(size, "cluster").select("cluster", "feature", (F.col("s") / F.col("n")).alias("mean"))


def renumbered(clusters: DataFrame) -> DataFrame:
    """Labels from 1 in order of falling size; ties by the old label."""
    size = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    label = size.select("cluster", F.row_number().over(Window.orderBy(F.desc("n"), "cluster")).alias("label"))  # a row for each cluster
    return clusters.join(label, "cluster")


def purity(members: DataFrame, cluster: str, kind: str) -> DataFrame:
    """(cluster, purity): the share of its commonest kind."""
    c = members.groupBy(cluster, kind).agg(F.count("*").alias("n"))
    return c.groupBy(F.col(cluster).alias("cluster")).agg((F.max("n") / F.sum("n")).alias("purity"))


def shrunken_dispersions(matrix: DataFrame, at: float = 0.995) -> DataFrame:
    """(feature, mean, variance, moment, shrunken): negative-binomial
    dispersions by moments of size-normalised counts, drawn towards their
    ``at`` quantile (sSeq, Yu and others 2013)."""
    f = size_factors(matrix)
    one = f.agg(F.count("*").alias("n"), F.sum(1 / F.col("size_factor")).alias("inv"))
    x = matrix.join(f, "barcode").select("feature", (F.col("umis") / F.col("size_factor")).alias("v"))
    s = x.groupBy("feature").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).crossJoin(F.broadcast(one))  # one row
    mean = F.col("s") / F.col("n")
    s = s.select("feature", mean.alias("mean"), (F.col("q") / F.col("n") - mean * mean).alias("variance"), "n", "inv")
    moment = (F.col("n") * F.col("variance") - F.col("mean") * F.col("inv")) / (F.col("mean") * F.col("mean") * F.col("n"))
    s = s.withColumn("moment", F.greatest(F.lit(0.0), moment))
    zeta = s.agg(F.percentile("moment", at).alias("zeta"), F.avg("moment").alias("centre"), F.count("*").alias("g"))
    s = s.crossJoin(F.broadcast(zeta))  # one row
    d = F.col("moment") - F.col("centre")
    e = F.col("moment") - F.col("zeta")
    delta = s.agg(((F.sum(d * d) / (F.max("g") - 1)) / (F.sum(e * e) / (F.max("g") - 2))).alias("delta"))
    s = s.crossJoin(F.broadcast(delta))  # one row
    return s.select("feature", "mean", "variance", "moment", ((1 - F.col("delta")) * F.col("moment") + F.col("delta") * F.col("zeta")).alias("shrunken"))


def fold_changes(matrix: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, feature, inside, outside, log2_fold_change), each cluster
    against the rest, in one pass: the rest is the total less the cluster.
    Sums are set against the sums of the sides' size factors."""
    f = size_factors(matrix)
    sf = clusters.join(f, "barcode").groupBy("cluster").agg(F.sum("size_factor").alias("fa"))
    all_f = sf.agg(F.sum("fa").alias("ft"))
    inside = matrix.join(clusters, "barcode").groupBy("cluster", "feature").agg(F.sum("umis").alias("inside"))
    total = inside.groupBy("feature").agg(F.sum("inside").alias("total"))
    grid = total.crossJoin(F.broadcast(sf.crossJoin(all_f)))  # a row for each cluster, of which there are few
    r = grid.join(inside, ["cluster", "feature"], "left").withColumn("inside", F.coalesce("inside", F.lit(0)))
    r = r.withColumn("outside", F.col("total") - F.col("inside"))
    change = F.log2((1 + F.col("inside")) / (1 + F.col("fa"))) - F.log2((1 + F.col("outside")) / (1 + F.col("ft") - F.col("fa")))
    return r.select("cluster", "feature", "inside", "outside", change.alias("log2_fold_change"))


def shares(counts: DataFrame, group: str, value: str) -> DataFrame:
    """``counts`` with ``share`` of ``value`` within ``group``; the totals are
    aggregated first, so that a large group is no one task's."""
    t = counts.groupBy(group).agg(F.sum(value).alias("share_total"))
    return counts.join(t, group).withColumn("share", F.when(F.col("share_total") > 0, F.col(value) / F.col("share_total")).otherwise(0.0)).drop("share_total")


def median_features(matrix: DataFrame) -> DataFrame:
    """(median): of the features seen in a barcode."""
    n = matrix.groupBy("barcode").agg(F.count("*").alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    return n.agg(F.expr("percentile(k, 0.5D, n)").alias("median"))
