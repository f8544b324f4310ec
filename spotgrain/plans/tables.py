"""Scans, selections, summaries and set operations as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix, selections, summaries
from ..sources.tables import barcodes, features, molecules, table
from .queries import M, _matrix, query

T = ", t AS (SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS n_features FROM x GROUP BY 1)"
FT = ", ft AS (SELECT p_partkey AS feature, p_brand AS feature_type, p_type AS genome FROM part)"


def _totals(spark, d):
    return matrix.barcode_totals(_matrix(spark, d))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(M + " SELECT barcode, feature, reads FROM m WHERE barcode BETWEEN 100 AND 3000 AND reads >= 10 AND library % 2 = 0 AND barcode IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND feature IN (SELECT p_partkey FROM part WHERE p_size <= 25)")
def scan_molecules(spark, d):
    few = table(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("feature"))
    return selections.scan(molecules(spark, d), ["barcode", "feature", "reads"], F.col("library") % 2 == 0, barcodes(spark, d).where("is_cell"), few, (100, 3000), 10)


@query(M + " SELECT barcode, len(list(umi)) AS n, array_to_string(list(feature ORDER BY feature, library, umi, reads), ',') AS features FROM m GROUP BY 1")
def molecules_by_barcode(spark, d):
    g = selections.per_barcode(molecules(spark, d))
    return g.select("barcode", F.size("umis").cast("long").alias("n"), F.array_join(F.col("umis.feature").cast("array<string>"), ",").alias("features"))


@query(M + " SELECT max(feature) AS features, count(DISTINCT barcode) AS barcodes, count(DISTINCT (feature, barcode)) AS entries, count(*) AS rows FROM m")
def matrix_dimensions(spark, d):
    # Entries first: the distinct barcodes are then counted over fewer rows.
    x = molecules(spark, d).groupBy("feature", "barcode").agg(F.count("*").alias("n"))
    b = x.groupBy("barcode").agg(F.count("*").alias("e"), F.sum("n").alias("n"), F.max("feature").alias("f"))
    return b.agg(F.max("f").alias("features"), F.count("*").alias("barcodes"), F.sum("e").alias("entries"), F.sum("n").alias("rows"))


@query(M + " SELECT barcode, feature, library, umi, reads, 1 AS umi_type, CAST(NULL AS INTEGER) AS probe FROM m WHERE feature % 10 = 3")
def upgraded_molecules(spark, d):
    return selections.with_defaults(molecules(spark, d).where("feature % 10 = 3"))


@query(M + " SELECT o_orderkey AS barcode, CAST(coalesce(sum(umis) FILTER (p_brand = 'Brand#11'), 0) AS BIGINT) AS umis, CAST(coalesce(sum(umis) FILTER (p_size > 30), 0) AS BIGINT) AS large FROM orders LEFT JOIN x ON barcode = o_orderkey LEFT JOIN part ON p_partkey = feature GROUP BY 1")
def counts_with_zeros(spark, d):
    f = table(spark, d, "part").select(F.col("p_partkey").alias("feature"), F.when(F.col("p_brand") == "Brand#11", 1).otherwise(0).alias("one"), F.when(F.col("p_size") > 30, 1).otherwise(0).alias("big"))
    s = _matrix(spark, d).join(f, "feature").groupBy("barcode").agg(F.sum(F.col("umis") * F.col("one")).alias("umis"), F.sum(F.col("umis") * F.col("big")).alias("large"))
    return barcodes(spark, d).select("barcode").join(s, "barcode", "left").na.fill(0)


@query(M + FT + " SELECT x.barcode, x.feature, umis, feature_type, genome FROM x JOIN ft USING (feature) WHERE feature_type IN ('Brand#11', 'Brand#22') AND genome LIKE 'PROMO%'")
def selected_features(spark, d):
    f = features(spark, d).drop("name")
    some = [r.genome for r in f.select("genome").distinct().where("genome LIKE 'PROMO%'").collect()]  # a bounded vocabulary
    return _matrix(spark, d).join(selections.select_features(f, types=["Brand#11", "Brand#22"], genomes=some), "feature")


@query("SELECT p_partkey AS feature FROM part WHERE p_type LIKE 'PROMO%' AND p_partkey % 2 = 0")
def features_with_tag(spark, d):
    f = features(spark, d).withColumn("tags", F.when(F.col("genome").like("PROMO%"), F.create_map(F.lit("metal"), F.lit("tin"))).otherwise(F.create_map(F.lit("other"), F.lit("x"))))
    return selections.select_features(f, tag="metal").where("feature % 2 = 0").select("feature")


@query("SELECT p_partkey AS feature, p_brand AS feature_type FROM part WHERE p_brand <> 'Brand#11' OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def genes_on_list(spark, d):
    listed = molecules(spark, d).where("reads > 45")
    return selections.genes_on_list(features(spark, d).select("feature", "feature_type"), listed, F.col("feature_type") == "Brand#11")


@query(M + ", k AS (SELECT DISTINCT feature FROM x WHERE umis > 0 AND feature % 3 = 1), i AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS feature_index FROM k) SELECT x.feature, barcode, umis, feature_index FROM x JOIN i USING (feature)")
def reindexed_features(spark, d):
    return selections.reindexed(_matrix(spark, d).where("feature % 3 = 1"), "feature")


@query("SELECT DISTINCT l_orderkey || '-' || (l_suppkey % 3 + 1) AS barcode FROM lineitem WHERE l_suppkey % 3 = 1")
def barcodes_of_group(spark, d):
    b = molecules(spark, d).select(F.concat_ws("-", F.col("barcode").cast("string"), (F.col("library") % 3 + 1).cast("string")).alias("barcode")).distinct()
    return selections.of_group(b, 2)


@query(M + " SELECT DISTINCT barcode FROM x WHERE barcode NOT IN (SELECT barcode FROM x WHERE feature % 50 = 7) AND barcode IN (SELECT barcode FROM x WHERE feature % 5 = 2)")
def clean_cells_with_targets(spark, d):
    x = _matrix(spark, d)
    cells = selections.without(x.select("barcode").distinct(), x.where("feature % 50 = 7"))
    return selections.cells_with_targets(cells, x, x.where("feature % 5 = 2"))


@query(M + ", s AS (SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, CAST(sum(CASE WHEN p_size <= 10 THEN umis ELSE 0 END) AS BIGINT) AS of_list FROM x JOIN part ON p_partkey = feature GROUP BY 1) SELECT barcode, umis, of_list, round(of_list / umis::DOUBLE, 6) AS share, of_list / umis::DOUBLE <= 0.25 AND umis >= 3 AS passes FROM s")
def listed_share(spark, d):
    few = table(spark, d, "part").where("p_size <= 10").select(F.col("p_partkey").alias("feature"))
    s = selections.share_of(_matrix(spark, d), few)
    return _rounded(s.withColumn("passes", (F.col("share") <= 0.25) & (F.col("umis") >= 3)), "share")


@query("SELECT o_orderkey AS barcode FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 14)")
def crowded_groups(spark, d):
    return selections.crowded(barcodes(spark, d), "sample", 14)


@query(M + ", b AS (SELECT feature AS barcode, CAST(sum(CASE WHEN feature % 150 = 0 THEN reads * 20 ELSE reads END) AS BIGINT) AS reads FROM m GROUP BY 1), t AS (SELECT * FROM b ORDER BY reads DESC, barcode LIMIT 100), c AS (SELECT greatest(quantile_cont(reads, 0.75) + 3 * (quantile_cont(reads, 0.75) - quantile_cont(reads, 0.25)), 100.0) AS cutoff FROM t) SELECT barcode, reads, round(cutoff, 6) AS cutoff FROM t, c WHERE reads > cutoff")
def outlying_barcodes(spark, d):
    value = F.when(F.col("feature") % 150 == 0, F.col("reads") * 20).otherwise(F.col("reads"))
    b = molecules(spark, d).groupBy(F.col("feature").alias("barcode")).agg(F.sum(value).alias("reads"))
    return _rounded(selections.outliers(b, "reads", 100, 100.0), "cutoff")


@query(M + ", y AS (SELECT barcode % 50 AS barcode, feature % 8 AS feature, count(*) AS umis FROM m GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY umis DESC, barcode) AS k FROM y) SELECT barcode, count(*) AS n FROM r WHERE k <= 10 GROUP BY 1 HAVING count(*) >= 3")
def aggregate_barcodes(spark, d):
    y = molecules(spark, d).groupBy((F.col("barcode") % 50).alias("barcode"), (F.col("feature") % 8).alias("feature")).agg(F.count("*").alias("umis"))
    return selections.aggregates(y, 10, 3)


BARCODES = " SELECT barcode, count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads, count(DISTINCT feature) AS n_features, round((sum(reads) - count(*)) / sum(reads), 6) AS dup_frac, '{0}' AS part FROM m WHERE {1} GROUP BY 1"


@query(M + BARCODES.format("all", "true") + " UNION ALL " + BARCODES.format("even", "feature % 2 = 0"))
def barcode_summary(spark, d):
    one = lambda m: summaries.barcode_summary(m)
    m = molecules(spark, d)
    return _rounded(selections.stacked([one(m), one(m.where("feature % 2 = 0"))], ["all", "even"]), "dup_frac")


@query(M + " SELECT 1 + barcode % 2 + 10 * i AS gem_group, library + 100 * i AS library, count(*) AS n FROM m, (SELECT unnest([0, 1]) AS i) GROUP BY 1, 2")
def remapped_tables(spark, d):
    m = molecules(spark, d).withColumn("gem_group", F.col("barcode") % 2 + 1)
    return selections.remapped([(m, 0, 0), (m, 10, 100)]).groupBy("gem_group", "library").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (l_quantity <= 40 AND l_quantity > 20) AS only_left, count(*) FILTER (l_quantity > 40) AS only_right FROM lineitem")
def same_rows(spark, d):
    m = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return selections.same_rows(m.where("l_quantity <= 40"), m.where("l_quantity <= 20 OR l_quantity > 40"))


@query(M + ", c AS (SELECT DISTINCT barcode, library % 6 AS tag FROM m WHERE reads > 30), n AS (SELECT barcode, count(*) AS n, min(tag) AS tag FROM c GROUP BY 1) SELECT barcode, CASE WHEN n > 1 THEN 'Multiplet' WHEN tag < 4 THEN 'sample' || tag ELSE 'Unassigned' END AS sample FROM n")
def sample_of_tags(spark, d):
    calls = molecules(spark, d).where("reads > 30").select("barcode", (F.col("library") % 6).alias("tag"))
    names = spark.range(4).select(F.col("id").alias("tag"), F.concat(F.lit("sample"), F.col("id").cast("string")).alias("sample"))
    return selections.multiplets(calls, names)


@query("SELECT o_custkey AS key, count(DISTINCT o_orderpriority) AS n_parts FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def claimed_twice(spark, d):
    return selections.disjoint(table(spark, d, "orders").select(F.col("o_custkey").alias("key"), "o_orderpriority"), "key", "o_orderpriority")


@query("SELECT barcode FROM (SELECT l_orderkey AS barcode FROM lineitem WHERE l_quantity > 30 UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')")
def barcode_union(spark, d):
    a = molecules(spark, d).where("reads > 30").select("barcode")
    return a.union(barcodes(spark, d).where(~F.col("is_cell")).select("barcode").join(table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("barcode")), "barcode", "left_semi")).distinct()


@query("SELECT (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40 INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS common, (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderstatus = 'F') AS cells")
def overlap_of_calls(spark, d):
    cells = barcodes(spark, d).where("is_cell").select("barcode")
    common = molecules(spark, d).where("reads > 40").select("barcode").intersect(cells)
    return common.agg(F.count("*").alias("common")).crossJoin(cells.distinct().agg(F.count("*").alias("cells")))  # a row each


@query("SELECT p_brand AS feature_type, count(*) AS n, count(DISTINCT p_type) AS genomes FROM part GROUP BY 1")
def features_by_type(spark, d):
    return features(spark, d).groupBy("feature_type").agg(F.count("*").alias("n"), F.count_distinct("genome").alias("genomes"))


@query(M + " SELECT library, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN barcode END) AS cells, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN reads ELSE 0 END) AS BIGINT) AS reads_in_cells, round(sum(CASE WHEN o_orderstatus = 'F' THEN reads ELSE 0 END) / sum(reads)::DOUBLE, 6) AS fraction, round(sum(reads) / count(DISTINCT barcode)::DOUBLE, 6) AS mean_reads FROM m JOIN orders ON o_orderkey = barcode GROUP BY 1")
def library_metrics(spark, d):
    # (library, barcode) first, so that distinct barcodes are plain counts.
    one = molecules(spark, d).groupBy("library", "barcode").agg(F.sum("reads").alias("reads"))
    s = one.join(barcodes(spark, d).select("barcode", "is_cell"), "barcode").groupBy("library").agg(F.count_if("is_cell").alias("cells"), F.sum(F.when(F.col("is_cell"), F.col("reads")).otherwise(0)).alias("reads_in_cells"), F.sum("reads").alias("reads"), F.count("*").alias("n"))
    return _rounded(s.select("library", "cells", "reads_in_cells", (F.col("reads_in_cells") / F.col("reads")).alias("fraction"), (F.col("reads") / F.col("n")).alias("mean_reads")), "fraction", "mean_reads")


@query(M + ", b AS (SELECT library, barcode, count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads, count(*) FILTER (reads > 1) AS candidates, CAST(sum(CASE WHEN umi > 3 THEN reads ELSE 0 END) AS BIGINT) AS corrected FROM m GROUP BY 1, 2) SELECT *, reads >= 60 AND corrected / reads::DOUBLE > 0.5 AS highly_corrected FROM b")
def barcode_reads(spark, d):
    b = molecules(spark, d).groupBy("library", "barcode").agg(
        F.count("*").alias("umis"), F.sum("reads").alias("reads"), F.count_if(F.col("reads") > 1).alias("candidates"), F.sum(F.when(F.col("umi") > 3, F.col("reads")).otherwise(0)).alias("corrected")
    )
    return b.withColumn("highly_corrected", (F.col("reads") >= 60) & (F.col("corrected") / F.col("reads") > 0.5))


@query(M + ", s AS (SELECT barcode, p_brand AS genome, sum(umis) AS umis FROM x JOIN part ON p_partkey = feature GROUP BY 1, 2) SELECT genome, count(*) AS barcodes, median(umis)::DOUBLE AS median_umis, GROUPING(genome) AS is_all FROM s GROUP BY GROUPING SETS ((genome), ())")
def genome_report(spark, d):
    f = table(spark, d, "part").select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("genome"))
    s = _matrix(spark, d).join(f, "feature").groupBy("barcode", "genome").agg(F.sum("umis").alias("umis"))
    # Counts of distinct values: what the grouping sets copy is small.
    h = s.groupBy("genome", "umis").agg(F.count("*").alias("n"))
    r = h.groupingSets([["genome"], []], "genome").agg(F.sum("n").alias("barcodes"), F.expr("percentile(umis, 0.5D, n)").alias("median_umis"), F.grouping("genome").cast("long").alias("is_all"))
    return r.select("genome", "barcodes", "median_umis", "is_all")
