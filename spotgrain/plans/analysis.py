"""Cell calling, statistics, sampling and spatial look-ups as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cells, correction, joins, matrix, sampling, statistics
from ..sources.tables import features, molecules, table
from .queries import GRID, M, SEQ, _matrix, _points, _umis, query

T = ", t AS (SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS n_features FROM x GROUP BY 1)"
SF = T + ", f AS (SELECT barcode, umis / (SELECT median(umis) FROM t) AS sf FROM t)"
CL = ", cl AS (SELECT barcode, barcode % 7 AS cluster FROM t)"


def _totals(spark, d):
    return matrix.barcode_totals(_matrix(spark, d))


def _clusters(spark, d):
    return _totals(spark, d).select("barcode", (F.col("barcode") % 7).alias("cluster"))


@query(M + T + " SELECT umis AS value, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY umis DESC) AS BIGINT) AS rank FROM t GROUP BY umis")
def barcode_rank_curve(spark, d):
    return cells.rank_curve(_totals(spark, d))


@query(M + T + ", c AS (SELECT greatest(1, round_even(0.1::DOUBLE * umis, 0))::BIGINT AS cutoff FROM t ORDER BY umis DESC LIMIT 1 OFFSET 1) SELECT barcode, umis, n_features, cutoff, umis >= cutoff AS is_cell FROM t, c")
def call_cells(spark, d):
    return cells.call_cells(_totals(spark, d), 100)


@query("SELECT l_orderkey AS barcode, row_number() OVER (ORDER BY l_orderkey) - 1 AS index FROM (SELECT DISTINCT l_orderkey FROM lineitem)")
def barcode_index(spark, d):
    return cells.dense_index(molecules(spark, d), "barcode", 256)


@query(M + " SELECT barcode, array_to_string(list(feature ORDER BY feature), ',') AS indices, array_to_string(list(umis ORDER BY feature), ',') AS data FROM x GROUP BY 1")
def compressed_columns(spark, d):
    c = cells.compressed_columns(_matrix(spark, d))
    return c.select("barcode", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), F.array_join(F.col("data").cast("array<string>"), ",").alias("data"))


@query(M + " SELECT feature, barcode, umis FROM x")
def matrix_round_trip(spark, d):
    return cells.expanded(cells.compressed_columns(_matrix(spark, d)))


@query(M + GRID + " SELECT r // 8 AS bin_row, c // 8 AS bin_col, bool_or(umis > 30) AS in_tissue FROM g GROUP BY 1, 2")
def bins_in_tissue(spark, d):
    return cells.in_tissue(_points(spark, d), 8, F.col("umis") > 30)


@query(M + SF + " SELECT barcode, round(sf, 9) AS size_factor FROM f")
def size_factors(spark, d):
    return statistics.size_factors(_matrix(spark, d)).withColumn("size_factor", F.round("size_factor", 9))


@query(M + T + CL + ", z AS (SELECT cluster, count(*) AS n FROM cl GROUP BY 1) SELECT cluster, feature, round(sum(umis) / max(n)::DOUBLE, 9) AS mean FROM x JOIN cl USING (barcode) JOIN z USING (cluster) GROUP BY 1, 2")
def cluster_means(spark, d):
    return statistics.cluster_means(_matrix(spark, d), _clusters(spark, d)).withColumn("mean", F.round("mean", 9))


@query(M + T + CL + ", z AS (SELECT cluster, row_number() OVER (ORDER BY count(*) DESC, cluster)::INTEGER AS label FROM cl GROUP BY 1) SELECT barcode, cluster, label FROM cl JOIN z USING (cluster)")
def renumbered_clusters(spark, d):
    return statistics.renumbered(_clusters(spark, d))


@query("WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT o_orderpriority AS cluster, round(max(n) / sum(n)::DOUBLE, 9) AS purity FROM c GROUP BY 1")
def cluster_purity(spark, d):
    return statistics.purity(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus").withColumn("purity", F.round("purity", 9))


@query(M + SF + """, o AS (SELECT count(*)::DOUBLE AS n, sum(1 / sf) AS inv FROM f), v AS (SELECT feature, umis / sf AS v FROM x JOIN f USING (barcode)),
s AS (SELECT feature, sum(v) / max(n) AS mean, sum(v * v) / max(n) - (sum(v) / max(n)) ** 2 AS variance, max(n) AS n, max(inv) AS inv FROM v, o GROUP BY 1),
p AS (SELECT *, greatest(0, (n * variance - mean * inv) / (mean * mean * n)) AS moment FROM s), z AS (SELECT quantile_cont(moment, 0.995) AS zeta, avg(moment) AS centre, count(*)::DOUBLE AS g FROM p),
e AS (SELECT (sum((moment - centre) ** 2) / (max(g) - 1)) / (sum((moment - zeta) ** 2) / (max(g) - 2)) AS delta FROM p, z)
SELECT feature, round(mean, 6) AS mean, round(variance, 6) AS variance, round(moment, 6) AS moment, round((1 - delta) * moment + delta * zeta, 6) AS shrunken FROM p, z, e""")
def shrunken_dispersions(spark, d):
    r = statistics.shrunken_dispersions(_matrix(spark, d))
    return r.select("feature", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "moment", "shrunken")])


@query(M + SF + CL + """, k AS (SELECT cluster, sum(sf) AS fa FROM cl JOIN f USING (barcode) GROUP BY 1), a AS (SELECT cluster, feature, CAST(sum(umis) AS BIGINT) AS i FROM x JOIN cl USING (barcode) GROUP BY 1, 2),
t2 AS (SELECT feature, CAST(sum(umis) AS BIGINT) AS t FROM x GROUP BY 1), j AS (SELECT k.cluster, t2.feature, coalesce(i, 0) AS inside, t - coalesce(i, 0) AS outside, fa, (SELECT sum(fa) FROM k) AS ft FROM t2 CROSS JOIN k LEFT JOIN a ON a.cluster = k.cluster AND a.feature = t2.feature)
SELECT cluster, feature, inside, outside, round(log2((1 + inside) / (1 + fa)) - log2((1 + outside) / (1 + ft - fa)), 6) AS log2_fold_change FROM j""")
def fold_changes(spark, d):
    return statistics.fold_changes(_matrix(spark, d), _clusters(spark, d)).withColumn("log2_fold_change", F.round("log2_fold_change", 6))


@query(M + ", c AS (SELECT p_brand AS feature_type, feature, CAST(sum(reads) AS BIGINT) AS reads FROM m JOIN part ON p_partkey = feature GROUP BY 1, 2) SELECT feature_type, feature, reads, round(reads / (sum(reads) OVER (PARTITION BY feature_type))::DOUBLE, 9) AS share FROM c")
def feature_shares(spark, d):
    c = molecules(spark, d).groupBy("feature").agg(F.sum("reads").alias("reads")).join(features(spark, d).select("feature", "feature_type"), "feature")
    return statistics.shares(c, "feature_type", "reads").withColumn("share", F.round("share", 9))


@query(M + T + " SELECT median(n_features)::DOUBLE AS median FROM t")
def median_features(spark, d):
    return statistics.median_features(_matrix(spark, d))


L = ", l AS (SELECT library, CAST(sum(reads) AS BIGINT) AS reads, count(DISTINCT barcode) AS cells FROM m GROUP BY 1)"


def _libraries(spark, d):
    return molecules(spark, d).groupBy("library").agg(F.sum("reads").alias("reads"), F.countDistinct("barcode").alias("cells"))


@query(M + L + " SELECT library, reads, cells, round(CASE WHEN 25.5 * cells / reads <= 1 THEN 25.5::DOUBLE * cells / reads ELSE 0 END, 9) AS rate FROM l")
def depth_rates(spark, d):
    return sampling.depth_rates(_libraries(spark, d), 25.5).withColumn("rate", F.round("rate", 9))


@query(M + " SELECT library, feature, count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads FROM m WHERE library % 2 = 1 AND reads > 0 GROUP BY 1, 2")
def thinned_counts(spark, d):
    rates = _libraries(spark, d).select("library", (F.col("library") % 2).cast("double").alias("rate"))
    return sampling.thinned(molecules(spark, d), rates).groupBy("library", "feature").agg(F.count("*").alias("umis"), F.sum("reads").alias("reads"))


@query("SELECT l_orderkey % 100 AS barcode, l_partkey % 50 AS umi, l_suppkey % 5 AS gene, count(*) AS reads, min(l_returnflag || l_linestatus)[1] AS kind, min(l_returnflag || l_linestatus)[2] AS name FROM lineitem GROUP BY 1, 2, 3")
def read_molecules(spark, d):
    r = table(spark, d, "lineitem").select((F.col("l_orderkey") % 100).alias("barcode"), (F.col("l_partkey") % 50).alias("umi"), (F.col("l_suppkey") % 5).alias("gene"), F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("name"))
    return correction.molecules_of(r)


KNOWN = "('AAA', 900), ('ACG', 40), ('AGT', 10), ('CCC', 3), ('GTA', 0), ('TTT', 70)"


@query(SEQ + f""", k AS (SELECT * FROM (VALUES {KNOWN}) k(b, n)), o AS (SELECT DISTINCT umi AS barcode, barcode % 3 AS kind FROM u), q AS (SELECT barcode, kind, [47 + kind, 57 + kind, 66 + kind] AS q FROM o),
h AS (SELECT barcode, kind, b, (1 + n) * 10 ** (-(least(66, CASE WHEN barcode[1] <> b[1] THEN q[1] WHEN barcode[2] <> b[2] THEN q[2] ELSE q[3] END) - 33) / 10.0::DOUBLE) AS w FROM q JOIN k ON hamming(barcode, b) = 1),
r AS (SELECT barcode, kind, arg_max(b, w) AS b FROM h GROUP BY 1, 2 HAVING max(w) / sum(w) >= 0.9)
SELECT q.barcode, q.kind, r.b AS corrected FROM q LEFT JOIN r USING (barcode, kind)""")
def correct_barcodes(spark, d):
    o = _umis(spark, d).select(F.col("umi").alias("barcode"), (F.col("barcode") % 3).alias("kind")).distinct()
    o = o.withColumn("quality", F.array(*[(F.col("kind") + q).cast("int") for q in (47, 57, 66)]))
    known = spark.sql(f"SELECT * FROM VALUES {KNOWN} AS k(barcode, count)")
    return correction.correct_barcodes(o, known, 0.9).select("barcode", "kind", "corrected")


@query("SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_partkey <= s_suppkey * 7 + 20 AND s_suppkey * 7 <= p_partkey + p_size")
def overlapping_intervals(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_partkey").alias("lo"), (F.col("p_partkey") + F.col("p_size")).alias("hi"))
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 7).alias("start"), (F.col("s_suppkey") * 7 + 20).alias("end"))
    return joins.overlapping(p, s, 32).select("p_partkey", "s_suppkey")


@query("""WITH s AS (SELECT p_partkey // 50 AS row, p_partkey % 50 AS col, p_partkey AS id FROM part), n AS (SELECT * FROM s WHERE id % 11 = 0),
j AS (SELECT s.row, s.col, n.id AS target, (n.row - s.row) ** 2 + (n.col - s.col) ** 2 AS d2, row_number() OVER (PARTITION BY s.row, s.col ORDER BY (n.row - s.row) ** 2 + (n.col - s.col) ** 2, n.row - s.row, n.col - s.col) AS k
 FROM s JOIN n ON (n.row - s.row) ** 2 + (n.col - s.col) ** 2 <= 9)
SELECT s.row, s.col, target, CAST(d2 AS INTEGER) AS d2 FROM s LEFT JOIN j ON s.row = j.row AND s.col = j.col AND k = 1""")
def nearest_nucleus(spark, d):
    p = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 50).alias("row"), (F.col("p_partkey") % 50).alias("col"), F.col("p_partkey").alias("target"))
    return joins.nearest_on_grid(p.drop("target"), p.where("target % 11 = 0"), 3)


@query("SELECT l_orderkey AS barcode FROM lineitem WHERE l_suppkey % 2 = 0 INTERSECT SELECT l_orderkey FROM lineitem WHERE l_suppkey % 2 = 1")
def shared_barcodes(spark, d):
    m = molecules(spark, d)
    return m.where("library % 2 = 0").select("barcode").intersect(m.where("library % 2 = 1").select("barcode"))


@query("SELECT o_orderkey AS barcode FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def unseen_barcodes(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode")).exceptAll(molecules(spark, d).select("barcode").distinct()).distinct()
