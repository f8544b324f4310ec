"""Dispersion, normalisation, likelihoods, neighbours and sampling as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix, modelling
from ..operators.graph import connected_components
from ..sources.scratch import scratch_dir
from ..sources.tables import molecules, table
from .queries import GRID, M, _matrix, _points, query

N = ", n AS (SELECT count(*)::DOUBLE AS n FROM orders)"


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _n(spark, d):
    return table(spark, d, "orders").count()


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label")


@query(M + N + """, f AS (SELECT feature, sum(umis) / max(n) AS mean, (sum(umis * umis) / max(n) - (sum(umis) / max(n)) * (sum(umis) / max(n))) / (sum(umis) / max(n)) AS dispersion FROM x, n GROUP BY 1),
e AS (SELECT list_distinct(quantile_cont(mean, [i / 20.0 FOR i IN range(1, 20)])) AS e FROM f), b AS (SELECT f.*, len(list_filter(e, lambda y: y < mean)) AS bin FROM f, e), o AS (SELECT *, dispersion - median(dispersion) OVER (PARTITION BY bin) AS off FROM b)
SELECT feature, CAST(bin AS INTEGER) AS bin, round(CASE WHEN median(abs(off)) OVER (PARTITION BY bin) = 0 THEN 'nan'::DOUBLE ELSE off / median(abs(off)) OVER (PARTITION BY bin) END, 4) AS normalised FROM o""")
def normalised_dispersions(spark, d):
    n = _n(spark, d)
    r = modelling.normalised_dispersion(matrix.dispersion(_matrix(spark, d), n).drop("variance"))
    return r.select("feature", "bin", F.round("normalised", 4).alias("normalised"))


@query(M + ", t AS (SELECT barcode, sum(umis) AS total FROM x GROUP BY 1) SELECT feature, barcode, round(umis * greatest((SELECT median(total) FROM t), 1) / total, 6) AS value FROM x JOIN t USING (barcode)")
def median_normalised(spark, d):
    return _rounded(modelling.median_normalised(_matrix(spark, d)), "value")


@query(M + N + " SELECT feature, round(ln(max(n) + 1) - ln(1 + count(*)), 6) AS weight FROM x, n GROUP BY 1")
def inverse_frequencies(spark, d):
    return _rounded(modelling.inverse_frequency(_matrix(spark, d), _n(spark, d)), "weight")


@query(M + " SELECT feature, barcode, round(umis / sqrt(sum(umis * umis) OVER (PARTITION BY barcode)), 6) AS value FROM x")
def unit_length(spark, d):
    return _rounded(modelling.unit_length(_matrix(spark, d)), "value")


@query(M + N + " SELECT feature, round(sum(log2(1 + umis)) / max(n), 6) AS mean, round(sqrt(greatest(sum(log2(1 + umis) * log2(1 + umis)) / max(n) - pow(sum(log2(1 + umis)) / max(n), 2), 0)), 6) AS sd FROM x, n GROUP BY 1")
def log_moments(spark, d):
    return _rounded(modelling.log_moments(_matrix(spark, d), _n(spark, d)), "mean", "sd")


@query(M + ", c AS (SELECT barcode, sum(CASE WHEN feature % 10 = 0 THEN umis ELSE 0 END) AS controls FROM x GROUP BY 1) SELECT feature, barcode, CAST(least(floor(umis * 7.0::DOUBLE / (1 + controls)), 5) AS BIGINT) AS umis, floor(umis * 7.0::DOUBLE / (1 + controls)) > 5 AS clipped FROM x JOIN c USING (barcode)")
def counts_by_controls(spark, d):
    return modelling.by_controls(_matrix(spark, d), F.col("feature") % 10 == 0, 7.0, 5)


@query(M + N + ", y AS (SELECT feature, barcode, log2(1 + umis) AS v FROM x WHERE feature % 20 = 3), s AS (SELECT feature, sum(v) AS s FROM y GROUP BY 1) SELECT a.feature AS a, b.feature AS b, round(coalesce((SELECT sum(p.v * q.v) FROM y p JOIN y q ON p.barcode = q.barcode WHERE p.feature = a.feature AND q.feature = b.feature), 0) / n - a.s / n * b.s / n, 6) AS covariance FROM s a JOIN s b ON a.feature <= b.feature, n")
def feature_covariances(spark, d):
    x = _matrix(spark, d)
    return _rounded(modelling.covariances(x, x.where("feature % 20 = 3").select("feature").distinct(), _n(spark, d)), "covariance")


@query(M + N + ", y AS (SELECT feature, barcode, log2(1 + umis) AS v FROM x WHERE feature % 20 = 3), s AS (SELECT feature FROM y GROUP BY 1 HAVING sum(v * v) / (SELECT n FROM n) - pow(sum(v) / (SELECT n FROM n), 2) > 0) SELECT count(*)::DOUBLE AS total, count(*) AS components FROM s")
def component_variances(spark, d):
    """The variances of all components of standardised features add up to their number."""
    x = _matrix(spark, d)
    f = x.where("feature % 20 = 3").select("feature").distinct()
    v = modelling.component_variances(x, f, _n(spark, d))
    n = F.sum(F.col("last") - F.col("first") + 1)
    return v.agg(F.coalesce(F.round(F.sum("variance"), 6), F.lit(0.0)).alias("total"), F.coalesce(n, F.lit(0)).alias("components"))


@query(M + ", y AS (SELECT barcode % 40 AS barcode, feature % 15 AS feature, count(*) AS umis FROM m GROUP BY 1, 2), p AS (SELECT feature, sum(umis) / (SELECT sum(umis) FROM y)::DOUBLE AS p FROM y GROUP BY 1) SELECT barcode, round(lgamma(sum(umis) + 1) + sum(umis * ln(p) - lgamma(umis + 1)), 4) AS log_likelihood FROM y JOIN p USING (feature) GROUP BY 1")
def multinomial_likelihoods(spark, d):
    y = molecules(spark, d).groupBy((F.col("barcode") % 40).alias("barcode"), (F.col("feature") % 15).alias("feature")).agg(F.count("*").alias("umis"))
    t = y.agg(F.sum("umis").alias("t"))
    p = y.groupBy("feature").agg(F.sum("umis").alias("u")).crossJoin(F.broadcast(t)).select("feature", (F.col("u") / F.col("t")).alias("p"))  # one row
    r = modelling.multinomial_likelihoods(y, p)
    return r.withColumn("log_likelihood", F.round("log_likelihood", 4))


@query("""WITH e AS (SELECT vec_id AS id, embedding AS v FROM embeddings), p AS (SELECT q.id AS query, p.id AS neighbour, list_distance(q.v::DOUBLE[], p.v::DOUBLE[]) AS distance FROM e q JOIN e p ON q.id <> p.id WHERE q.id % 100 = 0)
SELECT query, neighbour, rank, round(distance, 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank FROM p) WHERE rank <= 10""")
def nearest_vectors(spark, d):
    v = _vectors(spark, d)
    return modelling.nearest(v.where("id % 100 = 0"), v, 10).withColumn("distance", F.round("distance", 4))


@query("WITH e AS (SELECT label AS cluster, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) SELECT cluster, CAST(i AS INTEGER) AS \"at\", round(avg(v), 6) AS mean, count(*) AS n FROM e GROUP BY 1, 2")
def cluster_centroids(spark, d):
    return _rounded(modelling.centroids(_vectors(spark, d), "label"), "mean")


@query("""WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1, 2),
s AS (SELECT label, avg(d) AS s FROM (SELECT label, vec_id, sqrt(sum((v - m) * (v - m))) AS d FROM e JOIN c USING (label, i) GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS gap FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2)
SELECT round(avg(r), 6) AS index FROM (SELECT a, max((x.s + y.s) / gap) AS r FROM g JOIN s x ON x.label = a JOIN s y ON y.label = b GROUP BY 1)""")
def davies_bouldin(spark, d):
    return _rounded(modelling.davies_bouldin(_vectors(spark, d), "label"), "index")


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS a, p_partkey // 3 AS b FROM part WHERE p_partkey % 5 <> 0 UNION SELECT p_partkey // 3, p_partkey FROM part WHERE p_partkey % 5 <> 0),
r AS (SELECT DISTINCT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node) SELECT node, min(root) AS component FROM r GROUP BY 1""")
def equivalence_classes(spark, d):
    e = table(spark, d, "part").where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 3).alias("dst"))
    return connected_components(e, checkpoint_dir=scratch_dir(spark))


@query(M + ", t AS (SELECT barcode, sum(CASE WHEN feature % 2 = 0 THEN umis ELSE 0 END)::BIGINT AS a, sum(CASE WHEN feature % 2 = 1 THEN umis ELSE 0 END)::BIGINT AS b FROM x GROUP BY 1), c AS (SELECT quantile_cont(a, 0.1) FILTER (a > b) AS ca, quantile_cont(b, 0.1) FILTER (b > a) AS cb FROM t) SELECT barcode, a, b, CASE WHEN a >= ca AND b >= cb THEN 'Multiplet' WHEN a >= b THEN 'a' ELSE 'b' END AS call FROM t, c")
def genome_calls(spark, d):
    side = lambda k: F.sum(F.when(F.col("feature") % 2 == k, F.col("umis")).otherwise(0))
    t = _matrix(spark, d).groupBy("barcode").agg(side(0).alias("a"), side(1).alias("b"))
    return modelling.two_genomes(t, "a", "b")


@query(M + ", l AS (SELECT library, sum(reads)::DOUBLE / count(DISTINCT barcode) AS top FROM m GROUP BY 1), r AS (SELECT library, unnest([20.0::DOUBLE, 30.0::DOUBLE, top]) AS depth, top FROM l) SELECT library, round(depth, 6) AS depth, round(CASE WHEN depth / top > 1 THEN 0 ELSE depth / top END, 6) AS rate FROM r")
def library_depth_rates(spark, d):
    one = molecules(spark, d).groupBy("library", "barcode").agg(F.sum("reads").alias("reads"))
    l = one.groupBy("library").agg(F.sum("reads").alias("reads"), F.count("*").alias("cells"))  # noqa: E741
    return _rounded(modelling.depth_rates(l, [20.0, 30.0]), "depth", "rate")


@query("SELECT o_orderkey AS barcode FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
def sampled_barcodes(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"))
    return modelling.sampled(o, F.md5(F.col("barcode").cast("string")), 50)


@query("WITH r AS (SELECT o_orderkey, o_custkey, md5(CAST(o_orderkey AS VARCHAR)) AS h, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(CAST(o_orderkey AS VARCHAR))) > 1 AS later FROM orders) SELECT o_orderkey, o_custkey FROM r ORDER BY later, h LIMIT 1200")
def sampled_by_customer(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return modelling.sampled_by_group(o, "o_custkey", F.md5(F.col("o_orderkey").cast("string")), 1200).select("o_orderkey", "o_custkey")


@query(M + GRID + ", z AS (SELECT r, c, umis - avg(umis) OVER () AS z, count(*) OVER () AS n FROM g), p AS (SELECT a.z AS za, b.z AS zb, 1.0::DOUBLE / ((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) AS w FROM z a JOIN z b ON (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) BETWEEN 1 AND 9) SELECT round((SELECT max(n) FROM z) * sum(w * za * zb) / (sum(w) * (SELECT sum(z * z) FROM z)), 6) AS morans_i, round(-1.0::DOUBLE / ((SELECT max(n) FROM z) - 1), 6) AS expected FROM p")
def moran_by_distance(spark, d):
    p = _points(spark, d).withColumn("node", F.col("row") * 50 + F.col("col"))
    return _rounded(modelling.moran_on_graph(p.select("node", F.col("umis").alias("value")), modelling.grid_edges(p, 3)), "morans_i", "expected")


@query(M + GRID + " SELECT a.r * 50 + a.c AS src, b.r * 50 + b.c AS dst, round(1.0::DOUBLE / ((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)), 6) AS weight FROM g a JOIN g b ON (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) BETWEEN 1 AND 4")
def spatial_graph(spark, d):
    p = _points(spark, d).withColumn("node", F.col("row") * 50 + F.col("col"))
    return _rounded(modelling.grid_edges(p, 2), "weight")
