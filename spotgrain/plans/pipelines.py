"""Composed plans: from reads to a matrix, cells and a report, merged runs,
bins of a grid.  Each is one declared plan, or some written in turn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cells, correction, matrix, selections, visitors
from ..sources.tables import molecules, table
from .queries import GRID, M, SEQ, _points, _umis, query



def count_run(counts: DataFrame, recovered: int) -> dict[str, DataFrame]:
    """(barcode, gene, umi, reads) to molecules, matrix, calls and report."""
    mol = correction.deduplicated(counts)
    x = mol.groupBy(F.col("gene").alias("feature"), "barcode").agg(F.count("*").alias("umis"))
    calls = cells.call_cells(matrix.barcode_totals(x), recovered)
    report = calls.where("is_cell").agg(F.count("*").alias("cells"), F.sum("umis").alias("umis"), F.median("n_features").alias("median_features"))
    return {"molecules": mol, "matrix": x, "calls": calls, "report": report}


def merge_runs(runs: list[tuple[DataFrame, int, int]], depth: float) -> DataFrame:
    """Runs (molecules, group offset, library offset) as one, with the rate
    that brings each library to the depth of the shallowest, or to ``depth``."""
    mol = selections.remapped(runs)
    one = mol.groupBy("library", "barcode").agg(F.sum("reads").alias("reads"))
    size = one.groupBy("library").agg(F.sum("reads").alias("reads"), F.count("*").alias("cells"))
    return size.withColumn("rate", F.least(F.lit(1.0), depth / (F.col("reads") / F.col("cells"))))


def binned_outputs(points: DataFrame, factors: list[int]) -> DataFrame:
    """(factor, bins, umis, mean_umis, most) of each level of bins."""
    one = lambda f: matrix.spatial_bins(points, f).agg(F.lit(f).alias("factor"), F.count("*").alias("bins"), F.sum("umis").alias("umis"), F.avg("umis").alias("mean_umis"), F.max("umis").alias("most"))
    return reduce(DataFrame.unionByName, [one(f) for f in factors])


DEDUP = SEQ + """, h AS (SELECT a.barcode, a.gene, a.umi, b.umi AS t, row_number() OVER (PARTITION BY a.barcode, a.gene, a.umi ORDER BY b.reads DESC, b.umi DESC) AS k
 FROM u a JOIN u b ON a.barcode = b.barcode AND a.gene = b.gene AND hamming(a.umi, b.umi) = 1 AND (b.reads > a.reads OR (b.reads = a.reads AND b.umi > a.umi))),
c AS (SELECT u.*, coalesce(h.t, u.umi) AS corrected FROM u LEFT JOIN h ON u.barcode = h.barcode AND u.gene = h.gene AND u.umi = h.umi AND h.k = 1),
i AS (SELECT barcode, gene, corrected AS umi, count(*) AS n_in, sum(reads) AS reads_in FROM c WHERE corrected <> umi GROUP BY 1, 2, 3),
s AS (SELECT c.barcode, c.gene, c.umi, c.reads - (corrected <> c.umi)::INT + coalesce(n_in, 0) AS before, CASE WHEN corrected <> c.umi THEN 0 ELSE c.reads END + coalesce(reads_in, 0) AS after FROM c LEFT JOIN i USING (barcode, gene, umi)),
w AS (SELECT *, max(before) OVER (PARTITION BY barcode, umi) AS top FROM s), v AS (SELECT *, count(*) FILTER (before = top) OVER (PARTITION BY barcode, umi) AS ties FROM w),
d AS (SELECT barcode, gene, umi, CAST(after AS BIGINT) AS reads FROM v WHERE before = top AND ties = 1 AND after > 0)"""


@query(DEDUP + " SELECT * FROM d")
def deduplicated_molecules(spark, d):
    return correction.deduplicated(_umis(spark, d))


@query(DEDUP + ", x AS (SELECT gene AS feature, barcode, count(*) AS umis FROM d GROUP BY 1, 2), t AS (SELECT barcode, sum(umis) AS umis, count(*) AS n_features FROM x GROUP BY 1), k AS (SELECT greatest(1, round_even(0.1::DOUBLE * umis, 0)) AS cutoff FROM t ORDER BY umis DESC LIMIT 1 OFFSET 1) SELECT count(*) AS cells, CAST(sum(umis) AS BIGINT) AS umis, median(n_features)::DOUBLE AS median_features FROM t, k WHERE umis >= cutoff")
def count_report(spark, d):
    return count_run(_umis(spark, d), 100)["report"]


@query(M + ", r AS (SELECT library + 100000 * i AS library, barcode, reads * (i + 1) AS reads FROM m, (SELECT unnest([0, 1]) AS i)), s AS (SELECT library, CAST(sum(reads) AS BIGINT) AS reads, count(DISTINCT barcode) AS cells FROM r GROUP BY 1) SELECT library, reads, cells, round(least(1.0, 20.0::DOUBLE / (reads / cells::DOUBLE)), 6) AS rate FROM s")
def merged_run_rates(spark, d):
    m = molecules(spark, d).withColumn("gem_group", F.lit(1))
    r = merge_runs([(m, 0, 0), (m.withColumn("reads", F.col("reads") * 2), 1, 100000)], 20.0)
    return r.withColumn("rate", F.round("rate", 6))


@query(M + GRID + ", b AS (SELECT f AS factor, r // f AS a, c // f AS b, sum(umis) AS umis FROM g, (SELECT unnest([2, 4, 8]) AS f) GROUP BY 1, 2, 3) SELECT factor, count(*) AS bins, CAST(sum(umis) AS BIGINT) AS umis, round(avg(umis), 6) AS mean_umis, CAST(max(umis) AS BIGINT) AS most FROM b GROUP BY 1")
def binned_outputs_by_level(spark, d):
    return binned_outputs(_points(spark, d), [2, 4, 8]).withColumn("mean_umis", F.round("mean_umis", 6))


@query("WITH e AS (SELECT user_id, event_id, value, ts, lag(value) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, count(*) AS n, count(*) FILTER (value > before) AS rises FROM e GROUP BY 1")
def processed_groups(spark, d):
    """A user's function over each group in order: how often a value rises."""

    def rises(key, rows):
        n = up = 0
        last = None
        for r in rows:
            n += 1
            # A null value comes as NaN, which is over nothing.
            up += last is not None and r["value"] is not None and r["value"] > last
            last = r["value"]
        yield {"user_id": key, "n": n, "rises": int(up)}

    e = table(spark, d, "events").select("user_id", "event_id", "value", "ts")
    return visitors.by_group(e, "user_id", ["ts", "event_id"], rises, "user_id long,n long,rises long")


@query("SELECT CASE WHEN l_quantity < 5 THEN 'small' WHEN l_discount > 0.08 THEN 'cheap' WHEN l_returnflag = 'R' THEN 'returned' END AS fate, count(*) AS n FROM lineitem GROUP BY 1")
def read_fates(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    return visitors.fates(l, [("small", F.col("l_quantity") < 5), ("cheap", F.col("l_discount") > 0.08), ("returned", F.col("l_returnflag") == "R")]).groupBy("fate").agg(F.count("*").alias("n"))


@query("SELECT l_shipdate < TIMESTAMP '1995-01-01' AS early, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_linestatus = 'F') AS final, count(*) FILTER (l_tax > 0.05) AS taxed FROM lineitem GROUP BY 1")
def visitor_counts(spark, d):
    l = table(spark, d, "lineitem").withColumn("early", F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp"))  # noqa: E741
    return visitors.flag_counts(l, {"returned": F.col("l_returnflag") == "R", "final": F.col("l_linestatus") == "F", "taxed": F.col("l_tax") > 0.05}, "early")
