"""Tags, masked sums, histograms, grids and reports as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix, summaries
from ..sources.tables import barcodes, features, molecules, table
from .queries import GRID, M, _matrix, _points, query

T = ", t AS (SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS n_features FROM x GROUP BY 1)"
TAGS = ", tg AS (SELECT barcode, library % 6 AS tag, count(*) AS umis FROM m GROUP BY 1, 2)"
CELLS = ", c AS (SELECT o_orderkey AS barcode FROM orders WHERE o_orderstatus = 'F')"
USABLE = " count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads, count(c.barcode) AS umis_in_cells, CAST(sum(CASE WHEN c.barcode IS NOT NULL THEN reads ELSE 0 END) AS BIGINT) AS reads_in_cells, CAST(sum(CASE WHEN c.barcode IS NULL THEN reads ELSE 0 END) AS BIGINT) AS reads_in_background FROM m LEFT JOIN c ON m.barcode = c.barcode GROUP BY 1"


def _tags(spark, d):
    return molecules(spark, d).groupBy("barcode", (F.col("library") % 6).alias("tag")).agg(F.count("*").alias("umis"))


def _totals(spark, d):
    return matrix.barcode_totals(_matrix(spark, d))


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(M + CELLS + " SELECT library," + USABLE)
def usable_by_library(spark, d):
    return summaries.usable_by(molecules(spark, d), barcodes(spark, d).where("is_cell"), "library")


@query(M + CELLS + " SELECT feature," + USABLE)
def usable_by_feature(spark, d):
    return summaries.usable_by(molecules(spark, d), barcodes(spark, d).where("is_cell"), "feature")


@query(M + " SELECT CAST(least(reads // 8 * 8, 40) AS BIGINT) AS bin, count(*) AS n FROM m GROUP BY 1")
def reads_binned(spark, d):
    return summaries.binned(molecules(spark, d), "reads", 8, 40)


@query(M + " SELECT CAST(CASE WHEN reads >= 30 THEN 2 WHEN reads >= 10 THEN 1 WHEN reads >= 5 THEN 0 ELSE -1 END AS BIGINT) AS bucket, count(*) AS n FROM m GROUP BY 1")
def reads_bucketed(spark, d):
    return summaries.bucketed(molecules(spark, d), "reads", [5, 10, 30])


@query(M + " SELECT library, round(avg(reads), 6) AS mean, round(var_pop(reads), 6) AS variance, round(stddev_pop(reads) / avg(reads), 6) AS cv, round(var_pop(reads) / avg(reads), 6) AS dispersion FROM m GROUP BY 1")
def reads_moments(spark, d):
    return _rounded(summaries.moments(molecules(spark, d), "library", "reads"), "mean", "variance", "cv", "dispersion")


@query("WITH p AS (SELECT p_type AS s, unnest(range(length(p_type))) AS position FROM part) SELECT position, s[position + 1] AS letter, count(*) AS n FROM p GROUP BY ALL")
def letters_by_position(spark, d):
    return summaries.letter_counts(table(spark, d, "part"), "p_type")


@query(M + TAGS + """ SELECT barcode, count(*) FILTER (umis >= 2) AS n_tags, CASE count(*) FILTER (umis >= 2) WHEN 0 THEN 'Blank' WHEN 1 THEN CAST(max(tag) FILTER (umis >= 2) AS VARCHAR) ELSE 'Multiplet' END AS call,
 coalesce(string_agg(CAST(tag AS VARCHAR), '|' ORDER BY tag) FILTER (umis >= 2), '') AS tags, coalesce(string_agg(CAST(umis AS VARCHAR), '|' ORDER BY tag) FILTER (umis >= 2), '') AS umis FROM tg GROUP BY 1""")
def tag_calls(spark, d):
    return summaries.tag_calls(_tags(spark, d), 2)


@query(M + TAGS + """, b AS (SELECT DISTINCT barcode FROM m), k AS (SELECT DISTINCT tag FROM tg), z AS (SELECT b.barcode, k.tag, coalesce(umis, 0)::DOUBLE AS v FROM b CROSS JOIN k LEFT JOIN tg ON tg.barcode = b.barcode AND tg.tag = k.tag)
SELECT l.tag AS a, r.tag AS b, round(corr(l.v, r.v), 6) AS r FROM z l JOIN z r ON l.barcode = r.barcode AND l.tag < r.tag GROUP BY 1, 2""")
def tag_correlations(spark, d):
    n = molecules(spark, d).select("barcode").distinct().count()
    return _rounded(summaries.tag_correlations(_tags(spark, d), n), "r")


@query("""WITH a AS (SELECT l_returnflag AS flag, l_linenumber AS line, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY ALL), b AS (SELECT l_returnflag AS flag, l_linenumber AS line, count(*) AS n FROM lineitem WHERE l_discount > 0.05 GROUP BY ALL)
SELECT coalesce(a.flag, b.flag) AS flag, coalesce(a.line, b.line) AS line, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right FROM a FULL JOIN b ON a.flag = b.flag AND a.line = b.line WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def row_differences(spark, d):
    x = table(spark, d, "lineitem")
    cols = [F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line")]
    return summaries.row_differences(x.where("l_quantity > 25").select(*cols), x.where("l_discount > 0.05").select(*cols))


@query(M + GRID + ", q AS (SELECT r, c, umis FROM g WHERE umis > 30) SELECT i // 50 AS row, i % 50 AS col, coalesce(umis, 0) AS umis FROM range(500) t(i) LEFT JOIN q ON r = i // 50 AND c = i % 50")
def whole_grid(spark, d):
    return summaries.whole_grid(_points(spark, d).where("umis > 30"), 10, 50, "umis")


@query(M + " SELECT * FROM (SELECT library, feature, count(*) AS umis, row_number() OVER (PARTITION BY library ORDER BY count(*) DESC, feature) AS rank FROM m GROUP BY 1, 2) WHERE rank <= 3")
def top_features_by_library(spark, d):
    c = molecules(spark, d).groupBy("library", "feature").agg(F.count("*").alias("umis"))
    return summaries.top_per_group(c, "library", [F.desc("umis"), F.asc("feature")], 3)


@query(M + T + """, r AS (SELECT avg(umis) AS mean_umis, median(umis)::DOUBLE AS median_umis, min(umis)::DOUBLE AS min_umis, max(umis)::DOUBLE AS max_umis, avg(n_features) AS mean_features, count(*)::DOUBLE AS barcodes FROM t)
SELECT 'bin_' || name AS name, round(value, 6) AS value FROM (UNPIVOT r ON mean_umis, median_umis, min_umis, max_umis, mean_features, barcodes INTO NAME name VALUE value)""")
def barcode_report(spark, d):
    r = _totals(spark, d).agg(
        F.avg("umis").alias("mean_umis"), F.median("umis").alias("median_umis"), F.min("umis").alias("min_umis"), F.max("umis").alias("max_umis"),
        F.avg("n_features").alias("mean_features"), F.count("*").alias("barcodes"),
    )
    return _rounded(summaries.report(r, "bin_", r.columns), "value")


@query(M + T + " SELECT barcode, 'umis' AS metric, umis AS value FROM t UNION ALL SELECT barcode, 'n_features', n_features FROM t")
def melted_totals(spark, d):
    return _totals(spark, d).unpivot(["barcode"], ["umis", "n_features"], "metric", "value")


@query("SELECT o_orderpriority AS cluster, o_orderstatus AS kind, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY o_orderpriority))::DOUBLE, 6) AS fraction FROM orders GROUP BY 1, 2")
def cluster_fractions(spark, d):
    c = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("cluster"), F.col("o_orderstatus").alias("kind")).agg(F.count("*").alias("n"))
    whole = c.groupBy("cluster").agg(F.sum("n").alias("total"))
    return _rounded(c.join(whole, "cluster").withColumn("fraction", F.col("n") / F.col("total")).drop("total"), "fraction")


@query(M + CELLS + " SELECT m.barcode, coalesce(CAST(max(o_custkey) AS VARCHAR), 'unassigned') AS sample, count(*) AS umis FROM m LEFT JOIN orders ON o_orderkey = m.barcode AND o_orderstatus = 'F' GROUP BY 1")
def barcode_samples(spark, d):
    s = barcodes(spark, d).where("is_cell").select("barcode", F.col("sample").cast("string").alias("sample"))
    t = molecules(spark, d).groupBy("barcode").agg(F.count("*").alias("umis"))
    return t.join(s, "barcode", "left").fillna("unassigned", ["sample"])


@query(M + " SELECT m.barcode, p_brand AS feature_type, count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads FROM m JOIN part ON p_partkey = feature GROUP BY 1, 2")
def totals_by_feature_type(spark, d):
    m = molecules(spark, d).groupBy("barcode", "feature").agg(F.count("*").alias("umis"), F.sum("reads").alias("reads"))
    return m.join(features(spark, d).select("feature", "feature_type"), "feature").groupBy("barcode", "feature_type").agg(F.sum("umis").alias("umis"), F.sum("reads").alias("reads"))


@query(M + " SELECT library, count(*) FILTER (umis >= 1 AND feature % 3 = 0) AS entries, CAST(sum(CASE WHEN feature % 3 = 0 THEN umis ELSE 0 END) AS BIGINT) AS masked, CAST(sum(umis) AS BIGINT) AS total FROM (SELECT library, feature, barcode, count(*) AS umis FROM m GROUP BY ALL) GROUP BY 1")
def masked_sums(spark, d):
    c = molecules(spark, d).groupBy("library", "feature", "barcode").agg(F.count("*").alias("umis"))
    on = F.col("feature") % 3 == 0
    return c.groupBy("library").agg(F.count_if(on & (F.col("umis") >= 1)).alias("entries"), F.sum(F.when(on, F.col("umis")).otherwise(0)).alias("masked"), F.sum("umis").alias("total"))


@query(M + " SELECT library, unnest(list_distinct([CAST(floor(reads * k / 4.0::DOUBLE) AS BIGINT) FOR k IN [1, 2, 3, 4]])) AS depth FROM (SELECT library, CAST(sum(reads) AS BIGINT) AS reads FROM m GROUP BY 1)")
def target_depths(spark, d):
    s = molecules(spark, d).groupBy("library").agg(F.sum("reads").alias("reads"))
    return s.select("library", F.explode(summaries.target_depths(F.col("reads"), 4)).alias("depth"))


@query("SELECT c_mktsegment AS kind, min(CASE WHEN c_acctbal > 0 THEN c_acctbal END) AS least, count(*) FILTER (c_acctbal > 0) AS n FROM customer GROUP BY 1")
def least_above_zero(spark, d):
    return table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("kind")).agg(F.min(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))).alias("least"), F.count_if(F.col("c_acctbal") > 0).alias("n"))


@query(M + TAGS + " SELECT tag, arg_max(barcode, (umis, -barcode)) AS barcode, max(umis) AS umis, round(max(umis) / sum(umis)::DOUBLE, 9) AS share FROM tg GROUP BY 1")
def largest_share(spark, d):
    g = _tags(spark, d).groupBy("tag").agg(F.max_by("barcode", F.struct(F.col("umis"), -F.col("barcode"))).alias("barcode"), F.max("umis").alias("umis"), F.sum("umis").alias("total"))
    return _rounded(g.withColumn("share", F.col("umis") / F.col("total")).drop("total"), "share", digits=9)


WORDS = "('ACGT'), ('ACGA'), ('TTTT'), ('GGCA')"
SEEN = "('ACNT'), ('ACGN'), ('NTTT'), ('TNNT'), ('ACGT'), ('GGNA'), ('GGNC')"


@query(f"WITH s AS (SELECT * FROM (VALUES {SEEN}) s(seq)), k AS (SELECT * FROM (VALUES {WORDS}) k(known)), h AS (SELECT seq, min(known) AS match FROM s JOIN k ON seq LIKE '%N%' AND seq NOT LIKE '%N%N%' AND known LIKE replace(seq, 'N', '_') GROUP BY 1 HAVING count(*) = 1) SELECT seq, match FROM s LEFT JOIN h USING (seq)")
def wildcard_match(spark, d):
    return summaries.wildcard_match(spark.sql(f"SELECT * FROM VALUES {SEEN} AS s(seq)"), spark.sql(f"SELECT * FROM VALUES {WORDS} AS k(known)"))
