"""The engine's operators as queries over the driver's tables, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import bin_name, parse_bin, reverse_complement, saturation, two_bit
from ..operators import correction, joins, matrix, metrics
from ..sources.tables import barcodes, features, molecules, table

M = "WITH m AS (SELECT l_orderkey AS barcode, l_partkey AS feature, l_suppkey AS library, l_linenumber AS umi, CAST(l_quantity AS BIGINT) AS reads FROM lineitem), x AS (SELECT feature, barcode, count(*) AS umis FROM m GROUP BY ALL)"
SQL: dict[str, str] = {}
QUERIES: dict[str, object] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    return matrix.count_matrix(molecules(spark, d)).drop("reads")


def _points(spark: SparkSession, d: str) -> DataFrame:
    c = _matrix(spark, d).groupBy("feature").agg(F.sum("umis").alias("umis"))
    return c.select(F.floor(F.col("feature") / 50).alias("row"), (F.col("feature") % 50).alias("col"), "umis")


GRID = ", g AS (SELECT feature // 50 AS r, feature % 50 AS c, CAST(sum(umis) AS BIGINT) AS umis FROM x GROUP BY feature)"


@query("""WITH c AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT l_partkey AS feature, count(*) AS umis, CAST(sum(l_quantity) AS BIGINT) AS reads, count(DISTINCT l_orderkey) AS barcodes,
 count(o_orderkey) AS umis_cells, CAST(sum(CASE WHEN o_orderkey IS NOT NULL THEN l_quantity END) AS BIGINT) AS reads_cells, count(DISTINCT o_orderkey) AS barcodes_cells
 FROM lineitem LEFT JOIN c ON l_orderkey = o_orderkey GROUP BY 1)
SELECT p_partkey AS feature, p_brand AS feature_type, coalesce(umis, 0) AS umis, coalesce(reads, 0) AS reads, coalesce(barcodes, 0) AS barcodes,
 coalesce(umis_cells, 0) AS umis_cells, coalesce(reads_cells, 0) AS reads_cells, coalesce(barcodes_cells, 0) AS barcodes_cells,
 round(CASE WHEN reads > 0 THEN 1 - umis / reads ELSE 0 END, 9) AS dup_frac FROM part LEFT JOIN s ON p_partkey = feature""")
def feature_summary(spark, d):
    s = matrix.feature_summary(molecules(spark, d), features(spark, d), barcodes(spark, d))
    return s.withColumn("dup_frac", F.round("dup_frac", 9))


@query(M + " SELECT feature, barcode, count(*) AS umis, CAST(sum(reads) AS BIGINT) AS reads FROM m GROUP BY ALL")
def count_matrix(spark, d):
    return matrix.count_matrix(molecules(spark, d))


@query(M + " SELECT barcode, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS n_features FROM x GROUP BY barcode")
def barcode_totals(spark, d):
    return matrix.barcode_totals(_matrix(spark, d))


@query(M + " SELECT * FROM x WHERE feature IN (SELECT feature FROM x GROUP BY 1 HAVING sum(umis) > 4) AND barcode IN (SELECT barcode FROM x GROUP BY 1 HAVING sum(umis) > 4)")
def select_above_threshold(spark, d):
    return matrix.above_threshold(_matrix(spark, d), 4)


@query(M + " SELECT feature, barcode, CAST(2 * umis AS BIGINT) AS umis FROM x")
def merge_matrices(spark, d):
    x = _matrix(spark, d)
    return matrix.merge_matrices(x, x)


@query(M + " SELECT feature, barcode, umis, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY barcode ORDER BY umis DESC, feature) AS INTEGER) AS rank FROM x) WHERE rank <= 3")
def top_features(spark, d):
    return matrix.top_features(_matrix(spark, d))


@query(M + ", t AS (SELECT barcode, sum(umis) AS total FROM x GROUP BY 1) SELECT feature, barcode, round(log2(1 + umis * 100.0::DOUBLE / total), 9) AS value FROM x JOIN t USING (barcode)")
def normalised(spark, d):
    return matrix.normalised(_matrix(spark, d), 100.0).withColumn("value", F.round("value", 9))


@query(M + ", n AS (SELECT count(*)::DOUBLE AS n FROM orders), s AS (SELECT feature, sum(umis)::DOUBLE AS s, sum(umis * umis)::DOUBLE AS q FROM x GROUP BY 1) SELECT feature, round(s / n, 9) AS mean, round(q / n - s * s / n / n, 9) AS variance, round((q / n - s * s / n / n) / (s / n), 6) AS dispersion FROM s, n")
def dispersion(spark, d):
    r = matrix.dispersion(_matrix(spark, d), table(spark, d, "orders").count())
    return r.select("feature", F.round("mean", 9).alias("mean"), F.round("variance", 9).alias("variance"), F.round("dispersion", 6).alias("dispersion"))


@query(M + GRID + " SELECT r // 2 AS bin_row, c // 2 AS bin_col, CAST(sum(umis) AS BIGINT) AS umis, count(*) AS spots FROM g GROUP BY 1, 2")
def spatial_bins(spark, d):
    return matrix.spatial_bins(_points(spark, d), 2)


@query(M + GRID + ", z AS (SELECT r, c, umis - avg(umis) OVER () AS z, count(*) OVER () AS n FROM g) SELECT round(max(a.n) / count(*) * sum(a.z * b.z) / (SELECT sum(z * z) FROM z), 9) AS morans_i FROM z a JOIN z b ON abs(a.r - b.r) + abs(a.c - b.c) = 1")
def morans_i(spark, d):
    return matrix.morans_i(_points(spark, d)).select(F.round("morans_i", 9).alias("morans_i"))


@query(M + " SELECT reads AS value, count(*) AS n FROM m GROUP BY 1")
def reads_histogram(spark, d):
    return metrics.histogram(molecules(spark, d), "reads")


@query(M + " SELECT library, quantile_cont(reads, 0.25) AS q25, quantile_cont(reads, 0.5) AS q50, quantile_cont(reads, 0.75) AS q75 FROM m GROUP BY 1")
def reads_quantiles(spark, d):
    return metrics.quantiles(molecules(spark, d), "library", "reads")


@query(M + ", s AS (SELECT library, feature, sum(reads)::DOUBLE AS w FROM m GROUP BY ALL) SELECT library, round(sum(w) * sum(w) / sum(w * w), 6) AS diversity FROM s GROUP BY 1")
def effective_diversity(spark, d):
    return metrics.effective_diversity(molecules(spark, d), "library", "feature", F.col("reads").cast("double")).withColumn("diversity", F.round("diversity", 6))


@query(M + ", h AS (SELECT library, reads, sum(reads) AS s FROM m GROUP BY ALL), r AS (SELECT library, reads, sum(s) OVER (PARTITION BY library ORDER BY reads DESC) AS run, sum(s) OVER (PARTITION BY library) AS total FROM h) SELECT library, max(reads) AS n50 FROM r WHERE 2 * run >= total GROUP BY 1")
def reads_n50(spark, d):
    return metrics.n50(molecules(spark, d), "library", "reads")


@query(M + " SELECT library, round(1 - greatest(count(*), 1)::DOUBLE / greatest(sum(reads), 1), 9) AS saturation FROM m GROUP BY 1")
def library_saturation(spark, d):
    s = molecules(spark, d).groupBy("library").agg(F.count("*").alias("u"), F.sum("reads").alias("r"))
    return s.select("library", F.round(saturation(F.col("u"), F.col("r")), 9).alias("saturation"))


@query(M + " SELECT library, feature_type, CAST(sum(reads) AS BIGINT) AS reads, count(*) AS umis FROM m JOIN (SELECT p_partkey AS feature, p_brand AS feature_type FROM part) USING (feature) GROUP BY ROLLUP (library, feature_type)")
def rollup_totals(spark, d):
    return metrics.subtotals(molecules(spark, d).join(features(spark, d).select("feature", "feature_type"), "feature"), "library", "feature_type")


@query("""WITH p AS (SELECT p_brand, p_partkey, (p_partkey % 97 + 1) / 1000.0::DOUBLE AS p FROM part), r AS (SELECT *, count(*) OVER (PARTITION BY p_brand ORDER BY p) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM p)
SELECT p_brand, p_partkey, p, round(least(1.0, min(p * n / k) OVER (PARTITION BY p_brand ORDER BY p DESC)), 9) AS adjusted FROM r""")
def benjamini_hochberg(spark, d):
    p = table(spark, d, "part").select("p_brand", "p_partkey", ((F.col("p_partkey") % 97 + 1) / 1000.0).alias("p"))
    return metrics.benjamini_hochberg(p, "p", "p_brand").withColumn("adjusted", F.round("adjusted", 9))


@query("SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS occurrence FROM events")
def running_occurrence(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return metrics.running_occurrence(e, "user_id", "ts", "event_id").drop("ts")


SEQ = """WITH b AS (SELECT l_orderkey AS barcode, l_suppkey AS gene, chr(65 + CAST(l_partkey % 4 AS INT)) || chr(65 + CAST(l_partkey // 4 % 4 AS INT)) || chr(65 + CAST(l_partkey // 16 % 4 AS INT)) AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
u AS (SELECT barcode % 100 AS barcode, gene % 5 AS gene, translate(k, 'ABCD', 'ACGT') AS umi, CAST(sum(q) AS BIGINT) AS reads FROM b GROUP BY ALL)"""


def _umis(spark, d):
    at = lambda k: F.substr(F.lit("ACGT"), (F.floor(F.col("feature") / k) % 4 + 1).cast("int"), F.lit(1))
    m = molecules(spark, d).select((F.col("barcode") % 100).alias("barcode"), (F.col("library") % 5).alias("gene"), F.concat(at(1), at(4), at(16)).alias("umi"), "reads")
    return m.groupBy("barcode", "gene", "umi").agg(F.sum("reads").alias("reads"))


@query(SEQ + """, h AS (SELECT a.barcode, a.gene, a.umi, b.umi AS t, row_number() OVER (PARTITION BY a.barcode, a.gene, a.umi ORDER BY b.reads DESC, b.umi DESC) AS k
 FROM u a JOIN u b ON a.barcode = b.barcode AND a.gene = b.gene AND hamming(a.umi, b.umi) = 1 AND (b.reads > a.reads OR (b.reads = a.reads AND b.umi > a.umi)))
SELECT u.*, coalesce(h.t, u.umi) AS corrected FROM u LEFT JOIN h ON u.barcode = h.barcode AND u.gene = h.gene AND u.umi = h.umi AND h.k = 1""")
def correct_umis(spark, d):
    return correction.correct_umis(_umis(spark, d))


@query(SEQ + " SELECT barcode, gene, umi, reads, reads < max(reads) OVER w OR (SELECT count(*) FROM u v WHERE v.barcode = u.barcode AND v.umi = u.umi AND v.reads = (SELECT max(reads) FROM u x WHERE x.barcode = u.barcode AND x.umi = u.umi)) > 1 AS low FROM u WINDOW w AS (PARTITION BY barcode, umi)")
def low_support(spark, d):
    return correction.low_support(_umis(spark, d))


@query(SEQ + " SELECT DISTINCT umi, reverse(translate(umi, 'ACGT', 'TGCA')) AS reverse_complement, CAST(instr('ACGT', umi[1]) * 16 + instr('ACGT', umi[2]) * 4 + instr('ACGT', umi[3]) - 21 AS BIGINT) AS code FROM u")
def sequence_scalars(spark, d):
    return _umis(spark, d).select("umi").distinct().select("umi", reverse_complement(F.col("umi")).alias("reverse_complement"), two_bit(F.col("umi")).alias("code"))


@query("SELECT p_partkey, printf('s_%03dum_%05d_%05d-1', 16, p_partkey // 50, p_partkey % 50) AS bin, CAST(p_partkey // 50 AS INTEGER) AS row, CAST(p_partkey % 50 AS INTEGER) AS col FROM part")
def bin_names(spark, d):
    p = table(spark, d, "part").select("p_partkey", bin_name(16, F.floor(F.col("p_partkey") / 50), F.col("p_partkey") % 50).alias("bin"))
    return p.select("p_partkey", "bin", parse_bin(F.col("bin"))["row"].alias("row"), parse_bin(F.col("bin"))["col"].alias("col"))


@query("WITH m AS (SELECT DISTINCT l_suppkey % 20 AS g, l_partkey AS i FROM lineitem), s AS (SELECT g, count(*) AS n FROM m GROUP BY 1) SELECT a.g AS a, b.g AS b, count(*) AS common, round(count(*)::DOUBLE / least(max(x.n), max(y.n)), 9) AS overlap FROM m a JOIN m b ON a.i = b.i AND a.g < b.g JOIN s x ON x.g = a.g JOIN s y ON y.g = b.g GROUP BY a.g, b.g")
def overlap_coefficient(spark, d):
    m = molecules(spark, d).select((F.col("library") % 20).alias("g"), "feature")
    return joins.overlap(m, "g", "feature").withColumn("overlap", F.round("overlap", 9))


@query("SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_partkey >= s_suppkey * 7 AND p_partkey < s_suppkey * 7 + 20")
def interval_join(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 7).alias("lo"), (F.col("s_suppkey") * 7 + 20).alias("hi"))
    return joins.interval_join(table(spark, d, "part").select("p_partkey"), "p_partkey", s, "lo", "hi", 32).select("p_partkey", "s_suppkey")


@query("SELECT l.event_id, l.user_id, arg_max(r.value, (r.ts, r.event_id)) AS last_value FROM events l LEFT JOIN events r ON l.user_id = r.user_id AND r.ts <= l.ts AND r.event_type = 'purchase' AND r.value IS NOT NULL GROUP BY 1, 2")
def asof_join(spark, d):
    e = table(spark, d, "events")
    buys = e.where("event_type = 'purchase' AND value IS NOT NULL").select("user_id", "ts", "value", "event_id")
    r = joins.last_before(e.select("event_id", "user_id", "ts"), buys, "user_id", "ts", "value", "event_id")
    return r.select("event_id", "user_id", "last_value")


@query("SELECT clonotype, count(*) AS frequency, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 9) AS proportion FROM (SELECT array_to_string(list_sort(list_distinct(list(l_partkey))), ';') AS clonotype FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def clonotypes(spark, d):
    g = molecules(spark, d).groupBy("barcode").agg(F.array_join(F.sort_array(F.collect_set("feature")), ";").alias("clonotype"))
    c = g.groupBy("clonotype").agg(F.count("*").alias("frequency"))
    total = c.agg(F.sum("frequency").alias("t"))
    return c.crossJoin(F.broadcast(total)).select("clonotype", "frequency", F.round(F.col("frequency") / F.col("t"), 9).alias("proportion"))  # one row


@query("SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS f, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS o FROM lineitem GROUP BY 1")
def pivot_counts(spark, d):
    p = table(spark, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().na.fill(0)
    return p.withColumnRenamed("F", "f").withColumnRenamed("O", "o")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("WITH k AS (SELECT user_id, ts, event_id, ts - lag(ts) OVER w > INTERVAL 6 HOUR AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), i AS (SELECT user_id, ts, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM k) SELECT user_id, island::BIGINT AS island, count(*) AS n FROM i GROUP BY ALL")
def gaps_and_islands(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").select("user_id", "ts", "event_id")
    e = e.withColumn("gap", (F.col("ts") - F.lag("ts").over(w)) > F.expr("INTERVAL 6 HOURS"))
    e = e.withColumn("island", F.sum(F.when(F.col("gap"), 1).otherwise(0)).over(w))
    return e.groupBy("user_id", "island").agg(F.count("*").alias("n"))
