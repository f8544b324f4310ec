"""Dispersion, normalisation, likelihoods, tests, neighbours and components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def normalised_dispersion(features: DataFrame, bins: int = 20) -> DataFrame:
    """``features`` (feature, mean, dispersion) with ``normalised``: the
    distance of the dispersion from its bin's median, over the bin's median
    absolute deviation (NaN if that is 0).  Bins lie between quantiles of the
    mean; equal edges are one.  With one bin the dispersion stays as it is."""
    edges = features.agg(F.percentile("mean", [i / bins for i in range(1, bins)]).alias("e"))
    # One row of at most bins - 1 numbers.
    f = features.crossJoin(F.broadcast(edges.select(F.array_distinct("e").alias("e"))))
    f = f.withColumn("bin", F.size(F.filter("e", lambda x: x < F.col("mean")))).drop("e")
    m = f.groupBy("bin").agg(F.median("dispersion").alias("middle"))
    f = f.join(F.broadcast(m), "bin").withColumn("off", F.abs(F.col("dispersion") - F.col("middle")))
    d = f.groupBy("bin").agg(F.median("off").alias("mad"))
    n = d.agg(F.count("*").alias("n_bins"))
    f = f.join(F.broadcast(d), "bin").crossJoin(F.broadcast(n))  # one row
    return f.withColumn("normalised", F.when(F.col("n_bins") == 1, F.col("dispersion")).otherwise(robust_divide(F.col("dispersion") - F.col("middle"), F.col("mad")))).drop("middle", "off", "mad", "n_bins")


def median_normalised(matrix: DataFrame) -> DataFrame:
    """Counts scaled so that each barcode has the median total (1 at least)."""
    t = matrix.groupBy("barcode").agg(F.sum("umis").alias("total"))
    m = t.groupBy("total").agg(F.count("*").alias("n")).agg(F.greatest(F.expr("percentile(total, 0.5D, n)"), F.lit(1.0)).alias("m"))
    t = t.crossJoin(F.broadcast(m))  # one row
    return matrix.join(t, "barcode").select("feature", "barcode", robust_divide(F.col("umis") * F.col("m"), F.col("total")).alias("value"))


def inverse_frequency(matrix: DataFrame, n_barcodes: int) -> DataFrame:
    """(feature, weight): log(N + 1) - log(1 + barcodes with the feature)."""
    return matrix.groupBy("feature").agg(F.count("*").alias("df")).select("feature", (math.log(n_barcodes + 1) - F.log1p("df")).alias("weight"))


def unit_length(matrix: DataFrame, value: str = "umis") -> DataFrame:
    """Each barcode's values over their root sum of squares."""
    n = matrix.groupBy("barcode").agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
    return matrix.join(n, "barcode").select("feature", "barcode", robust_divide(F.col(value), F.col("norm")).alias("value"))


def log_moments(matrix: DataFrame, n_barcodes: int) -> DataFrame:
    """(feature, mean, sd) of log2(1 + umis) over all barcodes, zeros included."""
    v = F.log2(1 + F.col("umis"))
    s = matrix.groupBy("feature").agg(F.sum(v).alias("s"), F.sum(v * v).alias("q"))
    mean = F.col("s") / n_barcodes
    return s.select("feature", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / n_barcodes - mean * mean, F.lit(0.0))).alias("sd"))


def by_controls(matrix: DataFrame, is_control: Column, scale: float, most: int) -> DataFrame:
    """Counts over 1 + the barcode's control counts, scaled, floored and cut at
    ``most``; clipped says where."""
    c = matrix.groupBy("barcode").agg(F.sum(F.when(is_control, F.col("umis")).otherwise(0)).alias("controls"))
    v = F.floor(F.col("umis") * scale / (1 + F.col("controls")))
    return matrix.join(c, "barcode").select("feature", "barcode", F.least(v, F.lit(most)).cast("long").alias("umis"), (v > most).alias("clipped"))


def _log_products(matrix: DataFrame, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feature, s) and (a, b, p), a <= b: sums of log2(1 + umis), and of its
    products for the pairs that meet in a barcode."""
    x = matrix.join(F.broadcast(features.select("feature")), "feature").select("barcode", "feature", F.log2(1 + F.col("umis")).alias("v"))
    s = x.groupBy("feature").agg(F.sum("v").alias("s"))
    p = x.select("barcode", F.col("feature").alias("a"), F.col("v").alias("va")).join(x.select("barcode", F.col("feature").alias("b"), F.col("v").alias("vb")), "barcode")
    p = p.where("a <= b").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("p"))
    return s, p


def covariances(matrix: DataFrame, features: DataFrame, n_barcodes: int) -> DataFrame:
    """(a, b, covariance), a <= b, of log2(1 + umis) over all barcodes.  For the
    few hundred features of a principal component analysis: a barcode makes a
    row for each pair of them that it has."""
    s, p = _log_products(matrix, features)
    all_pairs = s.select(F.col("feature").alias("a"), F.col("s").alias("sa")).join(F.broadcast(s.select(F.col("feature").alias("b"), F.col("s").alias("sb"))), F.col("a") <= F.col("b"))
    j = all_pairs.join(p, ["a", "b"], "left").na.fill(0.0, ["p"])
    return j.select("a", "b", (F.col("p") / n_barcodes - F.col("sa") / n_barcodes * F.col("sb") / n_barcodes).alias("covariance"))


def varying(matrix: DataFrame, features: DataFrame, n_barcodes: int) -> DataFrame:
    """(feature) of the features whose log2(1 + umis) has a variance; whether one
    is the same in all barcodes is told by counts, not by rounded sums."""
    x = matrix.join(features.select("feature"), "feature", "left_semi").where("umis <> 0")
    v = F.log2(1 + F.col("umis"))
    s = x.groupBy("feature").agg(F.count("*").alias("n"), F.min("umis").alias("low"), F.max("umis").alias("high"), F.sum(v).alias("s"), F.sum(v * v).alias("q"))
    mean = F.col("s") / n_barcodes
    return s.where(((F.col("n") != n_barcodes) | (F.col("low") != F.col("high"))) & (F.col("q") / n_barcodes > mean * mean)).select("feature")


def _correlations(matrix: DataFrame, features: DataFrame, n_barcodes: int) -> tuple[list, np.ndarray]:
    """The features in order and their correlation matrix.  Only pairs that meet
    in a barcode come to the driver; the others have a product of 0."""
    sums, products = _log_products(matrix, features)
    s = sums.toArrow().sort_by("feature")
    names, mean = s["feature"].to_pylist(), s["s"].to_numpy() / n_barcodes
    p = products.toArrow()
    a, b = np.searchsorted(s["feature"].to_numpy(), p["a"].to_numpy()), np.searchsorted(s["feature"].to_numpy(), p["b"].to_numpy())
    c = -np.outer(mean, mean)
    c[a, b] += p["p"].to_numpy() / n_barcodes
    c[b, a] = c[a, b]
    sd = np.sqrt(np.diag(c))
    return names, c / np.outer(sd, sd)


def principal_components(matrix: DataFrame, features: DataFrame, n_barcodes: int, k: int, most: int = 2000) -> DataFrame:
    """(feature, component, weight, variance): the eigenvectors of the
    correlation matrix of up to ``most`` features, in order of variance, the
    largest weight positive.  Features that are the same everywhere have no
    correlation and are left out.  Only the matrix of features comes to the driver."""
    f = varying(matrix, features, n_barcodes)
    if f.count() > most:
        raise ValueError(f"more than {most} features: choose by normalised dispersion first")
    names, c = _correlations(matrix, f, n_barcodes)
    value, vector = np.linalg.eigh(c)
    rows = []
    for j, i in enumerate(np.argsort(-value)[:k]):
        v = vector[:, i] * np.sign(vector[np.argmax(np.abs(vector[:, i])), i])
        rows += [(f, j + 1, float(w), float(value[i])) for f, w in zip(names, v)]
    return matrix.sparkSession.createDataFrame(rows, "feature long, component int, weight double, variance double")


def component_variances(matrix: DataFrame, features: DataFrame, n_barcodes: int, most: int = 2000) -> DataFrame:
    """(first, last, variance): the variance that the principal components from
    ``first`` to ``last`` have together, for all components.  Up to ``most``
    features each component has a row of its own.  Of more features all have
    one: their matrix grows with the square and its eigenvalues with the cube of
    their number, but the sum of all is its trace, 1 for each feature that varies."""
    f = varying(matrix, features, n_barcodes)
    n = f.count()
    if n > most:
        rows = [(1, n, float(n))]
    else:
        value = np.linalg.eigvalsh(_correlations(matrix, f, n_barcodes)[1])
        rows = [(j + 1, j + 1, float(v)) for j, v in enumerate(value[::-1])]
    return matrix.sparkSession.createDataFrame(rows, "first long, last long, variance double")


def log_gamma(x: Column):
    def apply(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in column:
            yield pd.Series([math.lgamma(v) if v is not None and v > 0 else None for v in s.tolist()], dtype="float64")

    return F.pandas_udf(apply, "double")(x.cast("double"))


def multinomial_likelihoods(matrix: DataFrame, profile: DataFrame) -> DataFrame:
    """(barcode, log_likelihood) of each barcode's counts under the profile
    (feature, p).  log-gamma is worked out once for each different count."""
    g = matrix.select(F.explode(F.array(F.col("umis") + 1)).alias("x")).distinct()
    t = matrix.groupBy("barcode").agg(F.sum("umis").alias("n"))
    known = g.union(t.select((F.col("n") + 1).alias("x"))).distinct()
    known = known.select("x", log_gamma(F.col("x")).alias("lg"))
    s = matrix.join(profile, "feature").withColumn("x", F.col("umis") + 1).join(known, "x")
    s = s.groupBy("barcode").agg(F.sum(F.col("umis") * F.log("p") - F.col("lg")).alias("part"))
    return s.join(t.withColumn("x", F.col("n") + 1).join(known, "x"), "barcode").select("barcode", (F.col("part") + F.col("lg")).alias("log_likelihood"))


def exact_p(a: int, b: int, mean_a: float, mean_b: float, dispersion: float) -> float:
    """P of a split of a + b counts no likelier than (a, b), for two negative
    binomials with sizes 1 / dispersion (scaled by the sides' factors)."""
    total = a + b
    if total == 0 or mean_a <= 0 or mean_b <= 0:
        return 1.0

    def logs(mean: float) -> np.ndarray:
        x = np.arange(total + 1)
        if dispersion <= 0:
            return x * math.log(mean) - mean - np.array([math.lgamma(v + 1) for v in x])
        r = 1 / dispersion
        lg = np.array([math.lgamma(v + r) - math.lgamma(r) - math.lgamma(v + 1) for v in x])
        return lg + r * math.log(r / (r + mean)) + x * math.log(mean / (r + mean))

    both = logs(mean_a) + logs(mean_b)[::-1]
    weight = np.exp(both - both.max())
    return float(min(1.0, weight[both <= both[a] + 1e-9].sum() / weight.sum()))


def with_exact_p(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df`` (a, b, mean_a, mean_b, dispersion) with p.  Sums over ``most`` are
    scaled down to it with their means: the test would find them different, or
    not, all the same."""

    def apply(a: pd.Series, b: pd.Series, ma: pd.Series, mb: pd.Series, d: pd.Series) -> pd.Series:
        out = []
        for x, y, u, v, w in zip(a, b, ma, mb, d):
            f = max(1.0, (x + y) / most)
            out.append(exact_p(round(x / f), round(y / f), u / f, v / f, w))
        return pd.Series(out, dtype="float64")

    return df.withColumn("p", F.pandas_udf(apply, "double")("a", "b", "mean_a", "mean_b", "dispersion"))


def nearest(queries: DataFrame, points: DataFrame, k: int, most: int = 100_000, part: int = 2_000) -> DataFrame:
    """(query, neighbour, rank, distance): the k nearest points of each query
    by Euclidean distance, exactly; (id, vector) on both sides, a point is not
    its own neighbour, ties by id.  Queries (``most`` at most) are the small
    side: they go to every task in parts, each keeps its k best, and the
    tasks' best are merged."""
    rows = queries.select("id", "vector").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} queries: take them in turns")
    out, spark = None, points.sparkSession
    for lo in range(0, max(len(rows), 1), part):
        some = rows[lo : lo + part]
        ids = np.array([r.id for r in some], np.int64)
        q = np.array([r.vector for r in some], np.float64).reshape(len(some), -1)
        shared = spark.sparkContext.broadcast((ids, q))

        def best(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            if not len(ids):
                return
            d, n = np.full((len(ids), k), np.inf), np.full((len(ids), k), -1, np.int64)
            for b in batches:
                for at in range(0, len(b), 1000):
                    p = np.stack(b["vector"].iloc[at : at + 1000].to_numpy()).astype(np.float64)
                    own = b["id"].iloc[at : at + 1000].to_numpy()
                    new = np.sqrt(np.maximum((q * q).sum(1)[:, None] + (p * p).sum(1) - 2 * q @ p.T, 0))
                    new[ids[:, None] == own] = np.inf
                    both, names = np.concatenate([d, new], 1), np.concatenate([n, np.broadcast_to(own, new.shape)], 1)
                    order = np.lexsort((names, both), axis=1)[:, :k]
                    d, n = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
            row, col = np.nonzero(np.isfinite(d))
            yield pd.DataFrame({"query": ids[row], "neighbour": n[row, col], "distance": d[row, col]})

        got = points.select("id", "vector").mapInPandas(best, "query long, neighbour long, distance double")
        out = got if out is None else out.unionByName(got)
    w = Window.partitionBy("query").orderBy("distance", "neighbour")
    return out.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def centroids(points: DataFrame, cluster: str) -> DataFrame:
    """(cluster, at, mean, n): the mean of each coordinate."""
    e = points.select(F.col(cluster).alias("cluster"), F.posexplode("vector").alias("at", "v"))
    return e.groupBy("cluster", "at").agg(F.avg("v").alias("mean"), F.count("*").alias("n"))


def davies_bouldin(points: DataFrame, cluster: str) -> DataFrame:
    """(index): the mean over clusters of the worst ratio of two clusters'
    spreads to the distance of their centroids.  Clusters are few."""
    c = centroids(points, cluster).groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("c"))
    c = c.select("cluster", F.col("c.mean").alias("centre"))
    gap = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    spread = points.select(F.col(cluster).alias("cluster"), F.col("vector").cast("array<double>").alias("vector")).join(F.broadcast(c), "cluster").groupBy("cluster").agg(F.avg(gap(F.col("vector"), F.col("centre"))).alias("s"))
    x = c.join(spread, "cluster")
    y = x.select(F.col("cluster").alias("other"), F.col("centre").alias("c2"), F.col("s").alias("s2"))
    pair = x.join(F.broadcast(y), F.col("cluster") != F.col("other"))  # a row for each pair of clusters
    return pair.groupBy("cluster").agg(F.max(robust_divide(F.col("s") + F.col("s2"), gap(F.col("centre"), F.col("c2")))).alias("r")).agg(F.avg("r").alias("index"))


def merged_clusters(centres: dict[int, tuple[list[float], int]]) -> list[tuple[int, int, float, int]]:
    """Ward's merges of at most some hundred clusters {label: (centre, size)}:
    (first, second, distance, size of the new cluster), new labels upwards."""
    live = {k: (np.array(c, float), n) for k, (c, n) in centres.items()}
    out, new = [], max(live, default=0) + 1
    while len(live) > 1:
        pairs = [(float(np.sqrt(2 * m * n / (m + n)) * np.linalg.norm(c - e)), a, b) for a, (c, m) in live.items() for b, (e, n) in live.items() if a < b]
        d, a, b = min(pairs)
        (c, m), (e, n) = live.pop(a), live.pop(b)
        live[new] = ((c * m + e * n) / (m + n), m + n)
        out.append((a, b, d, m + n))
        new += 1
    return out


def recovered_cells(totals: DataFrame, value: str, most: int = 1 << 18, quantile: float = 0.99) -> tuple[int, float]:
    """(recovered, loss): the number of cells for which the number of barcodes
    over a tenth of the value at its rank comes closest to itself: the least
    (observed - expected)^2 / expected over a grid of powers of 2 in eighths.
    Counts of distinct values come to the driver, not barcodes."""
    h = totals.where(F.col(value) > 0).groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc(value)).collect()
    values, run = np.array([r[0] for r in h], float), np.cumsum([r[1] for r in h]) if h else np.zeros(0)
    if not len(values):
        return 0, 0.0
    best = None
    for e in sorted({round(2 ** (i / 8)) for i in range(8, 8 * int(math.log2(most)) + 1)}):
        at = min(int(np.searchsorted(run, round(e * (1 - quantile)), "right")), len(values) - 1)
        cut = max(1.0, float(np.round(0.1 * values[at])))
        seen = int(run[np.flatnonzero(values >= cut)[-1]])
        loss = (seen - e) ** 2 / e
        if best is None or loss < best[1]:
            best = (e, loss)
    return best


def two_genomes(totals: DataFrame, a: str, b: str, at: float = 0.1) -> DataFrame:
    """``totals`` with call: genome a or b, or Multiplet where both counts reach
    the ``at`` quantile of their own genome's barcodes."""
    cut = lambda x, y: F.percentile(F.when(F.col(x) > F.col(y), F.col(x)), at)
    c = totals.agg(cut(a, b).alias("cut_a"), cut(b, a).alias("cut_b"))
    t = totals.crossJoin(F.broadcast(c))  # one row
    both = (F.col(a) >= F.col("cut_a")) & (F.col(b) >= F.col("cut_b"))
    return t.withColumn("call", F.when(F.coalesce(both, F.lit(False)), "Multiplet").when(F.col(a) >= F.col(b), a).otherwise(b)).drop("cut_a", "cut_b")


def depth_rates(libraries: DataFrame, depths: list[float]) -> DataFrame:
    """(library, depth, rate): what part of a library's reads gives each mean
    depth per cell.  A depth that a library lacks has rate 0; the largest is
    what the library has, so that rate is 1."""
    top = F.col("reads") / F.col("cells")
    d = libraries.withColumn("depth", F.explode(F.concat(F.array(*[F.lit(float(x)) for x in depths]), F.array(top))))
    rate = robust_divide(F.col("depth"), top)
    return d.select("library", "depth", F.when(rate > 1, 0.0).otherwise(rate).alias("rate"))


def sampled(df: DataFrame, order: Column, n: int) -> DataFrame:
    """n rows by the smallest values of a hash: the same rows in every run."""
    return df.orderBy(order).limit(n)


def sampled_by_group(df: DataFrame, group: str, order: Column, most: int) -> DataFrame:
    """A row of each group, then others up to ``most`` in all, by a hash; all
    rows if there are no more than that."""
    r = df.withColumn("sg_h", order)
    first = r.groupBy(group).agg(F.min("sg_h").alias("sg_h")).withColumn("sg_first", F.lit(0))
    r = r.join(first, [group, "sg_h"], "left").withColumn("sg_first", F.coalesce("sg_first", F.lit(1)))
    return r.orderBy("sg_first", "sg_h").limit(most).drop("sg_h", "sg_first")


def moran_on_graph(values: DataFrame, edges: DataFrame) -> DataFrame:
    """(morans_i, expected) of (node, value) over directed (src, dst, weight)."""
    m = values.agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    z = values.crossJoin(F.broadcast(m)).select("node", (F.col("value") - F.col("m")).alias("z"), "n")  # one row
    p = edges.join(z.select(F.col("node").alias("src"), F.col("z").alias("zs")), "src").join(z.select(F.col("node").alias("dst"), F.col("z").alias("zd")), "dst")
    top = p.agg(F.sum(F.col("weight") * F.col("zs") * F.col("zd")).alias("s"), F.sum("weight").alias("w"))
    low = z.agg(F.sum(F.col("z") * F.col("z")).alias("q"), F.max("n").alias("n"))
    return top.crossJoin(low).select(robust_divide(F.col("n") * F.col("s"), F.col("w") * F.col("q")).alias("morans_i"), robust_divide(F.lit(-1.0), F.col("n") - 1).alias("expected"))  # a row each


def grid_edges(points: DataFrame, radius: int) -> DataFrame:
    """(src, dst, weight): directed edges to every other point within
    ``radius`` on the grid, with 1 / squared distance; an equality join."""
    offsets = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if 0 < a * a + b * b <= radius * radius]
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(1.0 / (a * a + b * b)).alias("w")) for a, b in offsets])
    e = points.select(F.col("node").alias("src"), "row", "col", F.explode(near).alias("o"))
    e = e.select("src", (F.col("row") + F.col("o.a")).alias("row"), (F.col("col") + F.col("o.b")).alias("col"), F.col("o.w").alias("weight"))
    return e.join(points.select(F.col("node").alias("dst"), "row", "col"), ["row", "col"]).select("src", "dst", "weight")
