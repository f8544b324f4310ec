"""Metric tables, curves, reshapes and spatial look-ups as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sequence import moved
from ..operators import matrix, reports
from ..sources.tables import barcodes, molecules, table
from .queries import GRID, M, _matrix, _points, query

T = ", t AS (SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS n_features FROM x GROUP BY 1)"
CELL = ", c AS (SELECT t.*, o_orderstatus = 'F' AS is_cell, o_custkey % 10 AS sample FROM t JOIN orders ON o_orderkey = barcode)"
MET = "WITH k AS (SELECT l_returnflag || '_' || l_linestatus || '_reads' AS name, CAST(sum(l_quantity) AS BIGINT) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT l_returnflag || '_' || l_linestatus || '_rows', count(*) FROM lineitem GROUP BY 1)"


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _totals(spark, d):
    b = table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"), (F.col("o_orderstatus") == "F").alias("is_cell"), (F.col("o_custkey") % 10).alias("sample"))
    return matrix.barcode_totals(_matrix(spark, d)).join(b, "barcode")


def _metrics(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.concat_ws("_", "l_returnflag", "l_linestatus").alias("k")).agg(F.sum("l_quantity").cast("long").alias("reads"), F.count("*").alias("rows"))
    return g.unpivot(["k"], ["reads", "rows"], "m", "value").select(F.concat_ws("_", "k", "m").alias("name"), "value")


@query(MET + " SELECT count(*) AS n, min('all_' || name) AS first, CAST(sum(value) AS BIGINT) AS total FROM k")
def metrics_as_map(spark, d):
    m = reports.metric_map(_metrics(spark, d)).select(reports.prefixed(F.col("metrics"), "all_").alias("m"))
    return m.select(F.size("m").cast("long").alias("n"), F.array_min(F.map_keys("m")).alias("first"), F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("SELECT a.l_linenumber AS line, CAST(a.n + coalesce(b.n, 0) AS BIGINT) AS n FROM (SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY 1) a LEFT JOIN (SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber < 4 GROUP BY 1) b USING (l_linenumber)")
def merged_metric_maps(spark, d):
    one = lambda df: df.groupBy("l_linenumber").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.collect_list(F.struct("l_linenumber", "n"))).alias("m"))
    l = table(spark, d, "lineitem")  # noqa: E741
    both = one(l).crossJoin(one(l.where("l_linenumber < 4")).withColumnRenamed("m", "o"))  # a row each
    return both.select(F.explode(reports.merged_maps(F.col("m"), F.col("o"))).alias("line", "n"))


@query("SELECT p_partkey, 'tin' AS metal, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size FROM part")
def tagged_features(spark, d):
    tags = F.create_map(F.lit("metal"), F.lit("zinc"), F.lit("size"), F.when(F.col("p_size") > 25, "large").otherwise("small"))
    t = table(spark, d, "part").select("p_partkey", reports.with_tag(tags, "metal", F.lit("tin")).alias("t"))
    return t.select("p_partkey", F.element_at("t", "metal").alias("metal"), F.element_at("t", "size").alias("size"))


@query(MET + " SELECT regexp_extract(name, '^(\\w)_(\\w)_(\\w+)$', 1) AS flag, regexp_extract(name, '^(\\w)_(\\w)_(\\w+)$', 2) AS status, value FROM k WHERE name LIKE '%rows'")
def parsed_metric_names(spark, d):
    return reports.parsed_names(_metrics(spark, d), r"^(\w)_(\w)_rows$", ["flag", "status"])


@query(M + " SELECT barcode, CAST(sum(CASE WHEN library % 6 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS t0, CAST(sum(CASE WHEN library % 6 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS t1, CAST(sum(CASE WHEN library % 6 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS t2 FROM m WHERE library % 6 < 3 GROUP BY 1")
def wide_tags(spark, d):
    c = molecules(spark, d).where("library % 6 < 3").groupBy("barcode", F.concat(F.lit("t"), (F.col("library") % 6).cast("string")).alias("tag")).agg(F.count("*").alias("n"))
    return reports.wide(c, "barcode", "tag", "n", ["t0", "t1", "t2"])


@query(M + T + CELL + ", h AS (SELECT umis, count(*) AS n, count(*) FILTER (is_cell) AS cells FROM c GROUP BY 1) SELECT umis, n, cells, CAST(sum(n) OVER (ORDER BY umis DESC) AS BIGINT) AS rank, round(cells / n::DOUBLE, 6) AS density FROM h")
def rank_curve_by_call(spark, d):
    return _rounded(reports.rank_curve_by_call(_totals(spark, d)), "density")


@query(M + T + CELL + ", h AS (SELECT umis, count(*) AS n, 2 * count(*) FILTER (is_cell) > count(*) AS mostly FROM c GROUP BY 1), s AS (SELECT *, CASE WHEN mostly = lag(mostly) OVER (ORDER BY umis) THEN 0 ELSE 1 END AS new FROM h), g AS (SELECT *, sum(new) OVER (ORDER BY umis) AS segment FROM s) SELECT CAST(segment AS BIGINT) AS segment, min(umis) AS first, max(umis) AS last, CAST(sum(n) AS BIGINT) AS n, bool_or(mostly) AS mostly FROM g GROUP BY 1")
def rank_segments(spark, d):
    c = reports.rank_curve_by_call(_totals(spark, d)).withColumn("mostly", 2 * F.col("cells") > F.col("n"))
    return reports.segments(c, "umis", "mostly")


RULES = [("A_F_rows", True, 100.0, 1000000.0), ("N_O_rows", False, 100.0, 10.0), ("R_F_reads", True, 1.0, 2.0)]


@query(MET + " SELECT name, value, CASE WHEN name = 'R_F_reads' AND value >= 2 THEN 'error' WHEN name = 'A_F_rows' AND value >= 1000000 THEN 'error' WHEN name = 'N_O_rows' AND value <= 10 THEN 'error' WHEN name = 'A_F_rows' AND value >= 100 THEN 'warning' WHEN name = 'N_O_rows' AND value <= 100 THEN 'warning' ELSE 'ok' END AS level FROM k")
def metric_alerts(spark, d):
    return reports.alerts(_metrics(spark, d), spark.createDataFrame(RULES, "name string, higher boolean, warn double, error double"))


@query(MET + " SELECT 'reads' AS section, 'Returned' AS label, value / 1000.0::DOUBLE AS value FROM k WHERE name = 'R_F_reads' UNION ALL SELECT 'rows', 'Open', CAST(value AS DOUBLE) FROM k WHERE name = 'N_O_rows'")
def selected_metrics(spark, d):
    config = spark.createDataFrame([("R_F_reads", "reads", "Returned", 0.001), ("N_O_rows", "rows", "Open", 1.0)], "name string, section string, label string, scale double")
    return _rounded(reports.selected_metrics(_metrics(spark, d), config), "value")


@query("SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent FROM events GROUP BY 1")
def counts_and_shares(spark, d):
    return _rounded(reports.count_and_share(table(spark, d, "events"), "event_type"), "percent")


@query(M + ", r AS (SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE]) AS rate), s AS (SELECT rate, sum(reads * rate) AS reads, sum(1 - pow(1 - rate, reads)) AS molecules FROM m, r GROUP BY 1) SELECT rate, round(reads, 4) AS reads, round(molecules, 4) AS molecules, round(1 - molecules / reads, 6) AS saturation FROM s")
def saturation_curve(spark, d):
    s = reports.saturation_curve(molecules(spark, d), [0.1, 0.5, 1.0])
    return s.select("rate", F.round("reads", 4).alias("reads"), F.round("molecules", 4).alias("molecules"), F.round("saturation", 6).alias("saturation"))


@query(M + T + CELL + " SELECT sample, median(n_features)::DOUBLE AS median FROM c WHERE is_cell GROUP BY 1")
def median_features_by_sample(spark, d):
    return reports.medians_by(_totals(spark, d).where("is_cell"), "sample", "n_features")


@query("WITH c AS (SELECT o_custkey % 3 AS cluster, o_custkey % 40 AS feature, sum(o_totalprice) AS change FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY change DESC, feature) AS k FROM c) SELECT feature, round(max(change) FILTER (cluster = 0), 2) AS \"0\", round(max(change) FILTER (cluster = 1), 2) AS \"1\", round(max(change) FILTER (cluster = 2), 2) AS \"2\" FROM c WHERE feature IN (SELECT feature FROM r WHERE k <= 5) GROUP BY 1")
def top_changes(spark, d):
    c = table(spark, d, "orders").groupBy((F.col("o_custkey") % 3).alias("cluster"), (F.col("o_custkey") % 40).alias("feature")).agg(F.sum("o_totalprice").alias("change"))
    t = reports.top_wide(c, [0, 1, 2], 5)
    return t.select("feature", *[F.round(F.col(f"`{k}`"), 2).alias(str(k)) for k in range(3)])


@query(M + T + ", q AS (SELECT floor(quantile_cont(umis, 0.05)) AS lo, ceil(quantile_cont(umis, 0.95)) AS hi FROM t) SELECT barcode, umis, CAST(greatest(lo, least(hi, umis)) AS BIGINT) AS clamped FROM t, q")
def clamped_umis(spark, d):
    t = matrix.barcode_totals(_matrix(spark, d)).drop("n_features")
    return reports.clamped(t, "umis", 0.05, 0.95).withColumn("clamped", F.col("clamped").cast("long"))


@query(M + " SELECT tag, CAST(floor(log10(1 + umis) * 10) AS BIGINT) AS bin, count(*) AS n FROM (SELECT barcode, library % 6 AS tag, sum(reads) AS umis FROM m GROUP BY 1, 2) GROUP BY 1, 2")
def tag_histograms(spark, d):
    c = molecules(spark, d).groupBy("barcode", (F.col("library") % 6).alias("tag")).agg(F.sum("reads").alias("umis"))
    return reports.log_histogram(c, "tag", "umis", 10)


@query(M + T + CELL + " SELECT sample, round(corr(umis, n_features), 6) AS r FROM c GROUP BY 1")
def umi_feature_correlation(spark, d):
    return _rounded(reports.correlation(_totals(spark, d), "umis", "n_features", "sample"), "r")


@query("""WITH a AS (SELECT l_suppkey AS key, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), b AS (SELECT l_suppkey AS key, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
ca AS (SELECT min(n) AS cap FROM (SELECT n, sum(n) OVER (ORDER BY n) AS run, sum(n) OVER () AS total FROM a) WHERE run >= 0.9::DOUBLE * total), cb AS (SELECT min(n) AS cap FROM (SELECT n, sum(n) OVER (ORDER BY n) AS run, sum(n) OVER () AS total FROM b) WHERE run >= 0.9::DOUBLE * total),
j AS (SELECT coalesce(least(a.n, ca.cap), 0)::DOUBLE AS x, coalesce(least(b.n, cb.cap), 0)::DOUBLE AS y FROM a FULL JOIN b USING (key), ca, cb) SELECT round(sum(x * y) / sqrt(sum(x * x) * sum(y * y)), 6) AS cosine FROM j""")
def capped_cosine(spark, d):
    one = lambda s: table(spark, d, "lineitem").where(F.col("l_linestatus") == s).groupBy(F.col("l_suppkey").alias("key")).agg(F.count("*").alias("n"))
    return _rounded(reports.capped_cosine(one("F"), one("O"), 0.9), "cosine")


@query(M + GRID + " SELECT r AS row, c AS col, umis FROM g WHERE 2.0 * r + 0.5 * c + 1 >= 5 AND 2.0 * r + 0.5 * c + 1 < 20 AND 1.5 * c - 0.5 * r >= 10 AND 1.5 * c - 0.5 * r < 60")
def spots_in_window(spark, d):
    p = moved(F.col("row"), F.col("col"), [[2.0, 0.5, 1.0], [-0.5, 1.5, 0.0], [0.0, 0.0, 1.0]])
    return reports.in_box(_points(spark, d), p["x"], p["y"], (5, 20, 10, 60)).select("row", "col", "umis")


@query(M + GRID + ", k AS (SELECT r, c, umis, (r // 3) * 20 + c // 3 + 1 AS cell FROM g WHERE (r + c) % 4 <> 0) SELECT cell, count(*) AS spots, CAST(sum(umis) AS BIGINT) AS umis, round(avg(umis), 6) AS mean, round(stddev_pop(umis), 6) AS sd, min(r) AS top, max(c) AS right_edge FROM k GROUP BY 1")
def cells_of_spots(spark, d):
    p = _points(spark, d)
    mask = p.select("row", "col", F.when((F.col("row") + F.col("col")) % 4 != 0, F.floor(F.col("row") / 3) * 20 + F.floor(F.col("col") / 3) + 1).otherwise(0).alias("cell")).where("cell > 0")
    return _rounded(p.join(mask, ["row", "col"]).groupBy("cell").agg(F.count("*").alias("spots"), F.sum("umis").alias("umis"), F.avg("umis").alias("mean"), F.stddev_pop("umis").alias("sd"), F.min("row").alias("top"), F.max("col").alias("right_edge")), "mean", "sd")


@query(M + ", f AS (SELECT feature % 8 AS feature, feature // 50 AS r, feature % 50 AS c, count(*) AS n FROM m GROUP BY 1, 2, 3) SELECT r // 2 AS bin_row, c // 2 AS bin_col, CAST(sum(n) AS BIGINT) AS n FROM f WHERE feature IN (1, 3, 5) GROUP BY 1, 2")
def listed_feature_grid(spark, d):
    f = molecules(spark, d).where((F.col("feature") % 8).isin(1, 3, 5)).groupBy(F.floor(F.col("feature") / 50).alias("row"), (F.col("feature") % 50).alias("col")).agg(F.count("*").alias("n"))
    return f.groupBy(F.floor(F.col("row") / 2).alias("bin_row"), F.floor(F.col("col") / 2).alias("bin_col")).agg(F.sum("n").alias("n"))


@query("SELECT 'missing c_name' AS \"check\", count(*) FILTER (c_name IS NULL OR trim(c_name) = '') AS bad FROM customer UNION ALL SELECT 'repeated c_custkey', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'repeated c_mktsegment', count(*) FROM (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING count(*) > 1)")
def table_constraints(spark, d):
    return reports.constraints(table(spark, d, "customer"), ["c_name"], ["c_custkey", "c_mktsegment"])


@query("SELECT l_suppkey, rank, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 4")
def leading_reads(spark, d):
    l = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")  # noqa: E741
    return reports.first_per(l, "l_suppkey", [F.col("l_orderkey"), F.col("l_linenumber")], 4)


@query("SELECT feature, listagg FROM (SELECT library % 6 AS feature, string_agg(DISTINCT CAST(barcode AS VARCHAR), ',' ORDER BY CAST(barcode AS VARCHAR)) AS listagg FROM (SELECT l_suppkey AS library, l_orderkey AS barcode FROM lineitem WHERE l_quantity > 49) GROUP BY 1)")
def cells_per_feature(spark, d):
    m = molecules(spark, d).where("reads > 49").select((F.col("library") % 6).alias("feature"), F.col("barcode").cast("string").alias("b")).distinct()
    return m.groupBy("feature").agg(F.array_join(F.array_sort(F.collect_list("b")), ",").alias("listagg"))


@query("SELECT b.o_orderkey AS barcode, b.o_orderpriority AS cluster, CASE WHEN c_mktsegment IS NULL THEN 'none' ELSE c_mktsegment END AS cell_type, c_nationkey AS projection FROM orders b LEFT JOIN customer ON c_custkey = o_custkey")
def clusters_with_types(spark, d):
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("cell_type"), F.col("c_nationkey").alias("projection"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"), F.col("o_orderpriority").alias("cluster"), "o_custkey").join(t, "o_custkey", "left").drop("o_custkey").na.fill("none", ["cell_type"])


@query("SELECT o_orderpriority AS t, count(*) + 1 AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) >= 100")
def frequent_types(spark, d):
    c = barcodes(spark, d).where("is_cell").select("barcode").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"), F.col("o_orderpriority").alias("t")), "barcode")
    return c.groupBy("t").agg((F.count("*") + 1).alias("n")).where("n > 100")
