"""Clonotype and contig operators, chemistry checks and reads as queries, with SQL.
A barcode is an order, a contig a part, a chain its supplier."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.sequence import substitutions
from ..operators import joins, repertoire
from ..sources.tables import molecules, table
from .queries import M, query
from .sequences import S, _reads

CG = ", cg AS (SELECT barcode, feature % 40 AS contig, count(*) AS umis FROM m WHERE reads > 30 GROUP BY 1, 2)"
CT = CG + ", cl AS (SELECT barcode, array_to_string(list_sort(list(CAST(contig AS VARCHAR))), ';') AS clonotype FROM cg GROUP BY 1)"


def _contigs(spark, d):
    return molecules(spark, d).where("reads > 30").groupBy("barcode", (F.col("feature") % 40).alias("contig")).agg(F.count("*").alias("umis"))


def _clonotypes(spark, d):
    c = repertoire.exact_clonotypes(_contigs(spark, d)).select("clonotype").distinct()
    return c.select("clonotype", F.split("clonotype", ";").alias("contigs"))


@query(M + CT + " SELECT clonotype, count(*) AS frequency, min(barcode) AS first, len(string_split(clonotype, ';'))::INTEGER AS n_contigs FROM cl GROUP BY 1")
def exact_clonotypes(spark, d):
    c = repertoire.exact_clonotypes(_contigs(spark, d))
    return c.groupBy("clonotype").agg(F.count("*").alias("frequency"), F.min("barcode").alias("first")).withColumn("n_contigs", F.size(F.split("clonotype", ";")))


@query(M + CG + " SELECT * FROM (SELECT contig, row_number() OVER (PARTITION BY contig ORDER BY umis DESC, barcode) AS rank, barcode, umis FROM cg) WHERE rank <= 5")
def cells_by_contig(spark, d):
    return repertoire.cells_by_contig(_contigs(spark, d), 5)


@query("WITH s AS (SELECT o_orderpriority AS clonotype, o_orderstatus AS kind, count(*) AS v FROM orders GROUP BY 1, 2) SELECT clonotype, arg_max(kind, (v, kind)) AS top, round(max(v) / sum(v)::DOUBLE, 6) AS concordance FROM s GROUP BY 1")
def clonotype_concordance(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("clonotype"), F.col("o_orderstatus").alias("kind"), F.lit(1).alias("v"))
    r = repertoire.concordance(o, "clonotype", "kind", "v")
    return r.withColumn("concordance", F.round("concordance", 6))


TW = S + ", c AS (SELECT DISTINCT ON (seq[1:3], contig) seq[1:3] AS barcode, id % 3 AS contig, id % 41 AS umis FROM s ORDER BY seq[1:3], contig, id)"


def _twins(spark, d):
    w = Window.partitionBy("barcode", "contig").orderBy("id")
    r = _reads(spark, d).select("id", F.substr("seq", F.lit(1), F.lit(3)).alias("barcode"), (F.col("id") % 3).alias("contig"), (F.col("id") % 41).alias("umis"))
    return r.withColumn("k", F.row_number().over(w)).where("k = 1").select("barcode", "contig", "umis")


@query(TW + " SELECT DISTINCT a.barcode FROM c a JOIN c b ON a.contig = b.contig AND hamming(a.barcode, b.barcode) = 1 AND b.umis >= 10 * a.umis")
def near_twin_barcodes(spark, d):
    return repertoire.near_twins(_twins(spark, d), substitutions(F.col("barcode")), 10)


@query("WITH c AS (SELECT o_orderkey AS barcode, o_custkey % 30 AS clonotype, o_orderkey % 3 AS half, o_orderkey % 29 + 1 AS umis FROM orders), t AS (SELECT clonotype, half, max(umis) AS top FROM c GROUP BY 1, 2), l AS (SELECT c.* FROM c JOIN t USING (clonotype, half) WHERE top >= 10 * umis) SELECT barcode FROM l WHERE clonotype IN (SELECT clonotype FROM l GROUP BY 1 HAVING count(*) >= 0.05::DOUBLE * (SELECT count(*) FROM c WHERE c.clonotype = l.clonotype))")
def contaminating_barcodes(spark, d):
    c = table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"), (F.col("o_custkey") % 30).alias("clonotype"), (F.col("o_orderkey") % 3).alias("half"), (F.col("o_orderkey") % 29 + 1).alias("umis"))
    return repertoire.contaminated(c, ["clonotype", "half"], 10, 0.05)


@query(M + CT + ", k AS (SELECT DISTINCT clonotype, list_sort(string_split(clonotype, ';')) AS x FROM cl) SELECT DISTINCT a.clonotype FROM k a JOIN k b ON len(b.x) < len(a.x) AND list_has_all(a.x, b.x) JOIN k c ON c.x = list_sort(list_filter(a.x, lambda y: NOT list_contains(b.x, y)))")
def doublet_clonotypes(spark, d):
    return repertoire.doublets(_clonotypes(spark, d))


@query("WITH c AS (SELECT o_orderkey AS barcode, o_custkey % 10 AS clonotype, o_orderkey % 17 AS chain FROM orders) SELECT barcode, clonotype, chain FROM c WHERE (clonotype, chain) NOT IN (SELECT (clonotype, chain) FROM (SELECT clonotype, chain, count(*) AS n FROM c GROUP BY 1, 2) a JOIN (SELECT clonotype, count(*) AS t FROM c GROUP BY 1) b USING (clonotype) WHERE n < 0.05::DOUBLE * t)")
def cells_without_weak_chains(spark, d):
    c = table(spark, d, "orders").select(F.col("o_orderkey").alias("barcode"), (F.col("o_custkey") % 10).alias("clonotype"), (F.col("o_orderkey") % 17).alias("chain"))
    return repertoire.weak_chains(c, "chain", "clonotype", 0.05).select("barcode", "clonotype", "chain")


LK = M + ", ch AS (SELECT barcode, library % 9 AS chain, library % 9 < 4 AS is_heavy, count(*) AS umis FROM m GROUP BY 1, 2), lk AS (SELECT a.chain AS heavy, b.chain AS light, count(*) AS cells, CAST(sum(least(a.umis, b.umis)) AS BIGINT) AS weight FROM ch a JOIN ch b ON a.barcode = b.barcode AND a.is_heavy AND NOT b.is_heavy GROUP BY 1, 2)"


def _links(spark, d):
    c = molecules(spark, d).groupBy("barcode", (F.col("library") % 9).alias("chain")).agg(F.count("*").alias("umis"))
    return repertoire.chain_links(c.withColumn("is_heavy", F.col("chain") < 4))


@query(LK + " SELECT * FROM lk")
def chain_links(spark, d):
    return _links(spark, d)


@query(LK + " SELECT lk.*, top FROM lk JOIN (SELECT light, max(weight) AS top FROM lk GROUP BY 1) USING (light) WHERE top >= 1.1::DOUBLE * weight")
def weak_chain_links(spark, d):
    return repertoire.weak_links(_links(spark, d), 1.1)


@query(M + CT + ", k AS (SELECT DISTINCT clonotype, unnest(string_split(clonotype, ';')) AS contig FROM cl WHERE contains(clonotype, ';')), o AS (SELECT contig, min(clonotype) AS clonotype FROM k GROUP BY 1 HAVING count(*) = 1) SELECT barcode, o.clonotype FROM cl LEFT JOIN o ON o.contig = cl.clonotype WHERE NOT contains(cl.clonotype, ';')")
def attached_singles(spark, d):
    cells = repertoire.exact_clonotypes(_contigs(spark, d))
    singles = cells.where(~F.contains("clonotype", F.lit(";"))).select("barcode", F.col("clonotype").alias("contig"))
    return repertoire.attach_singles(singles, _clonotypes(spark, d).where(F.size("contigs") > 1))


@query(S + ", b AS (SELECT id % 4 AS reference, i AS position, seq[i + 1] AS base FROM s, range(6) t(i)), c AS (SELECT reference, position, base, count(*) AS n FROM b GROUP BY 1, 2, 3), t AS (SELECT reference, position, sum(n) AS total, arg_max(base, (n, base)) AS top FROM c GROUP BY 1, 2) SELECT reference, position, base, n, round(n / total::DOUBLE, 6) AS share FROM c JOIN t USING (reference, position) WHERE base <> top AND n >= 10 AND n / total::DOUBLE >= 0.2")
def alternate_bases(spark, d):
    r = _reads(spark, d).select((F.col("id") % 4).alias("reference"), F.posexplode(F.slice(F.split("seq", ""), 1, 6)).alias("position", "base"))
    return repertoire.alternate_bases(r, 10, 0.2).withColumns({"share": F.round("share", 6), "position": F.col("position").cast("long")})


@query(S + ", b AS (SELECT id % 50 AS clonotype, id % 7 AS position, seq[1] AS base, ascii(qual[1]) - 33 AS quality FROM s), v AS (SELECT clonotype, position, base, max(quality) AS q, count(*) FILTER (quality >= 10) AS n FROM b WHERE base <> 'A' GROUP BY 1, 2, 3) SELECT DISTINCT clonotype FROM b WHERE clonotype NOT IN (SELECT clonotype FROM v WHERE q < 20 AND n < 2)")
def supported_clonotypes(spark, d):
    r = _reads(spark, d).select((F.col("id") % 50).alias("clonotype"), (F.col("id") % 7).alias("position"), F.substr("seq", F.lit(1), F.lit(1)).alias("base"), F.lit("A").alias("reference_base"), (F.ascii("qual") - 33).alias("quality"))
    return repertoire.supported(r, 20, 10)


@query("SELECT array_to_string(list_filter([CASE WHEN o_totalprice <= 100000 THEN 'low_umi' END, CASE WHEN o_orderstatus <> 'F' THEN 'open' END, CASE WHEN o_custkey % 3 = 0 THEN 'third' END], lambda x: x IS NOT NULL), '+') AS failed, count(*) AS n FROM orders GROUP BY 1")
def filter_combinations(spark, d):
    o = table(spark, d, "orders")
    return repertoire.reason_counts(repertoire.reasons(o, {"low_umi": F.col("o_totalprice") > 100000, "open": F.col("o_orderstatus") == "F", "third": F.col("o_custkey") % 3 != 0}))


@query(M + ", g AS (SELECT barcode, list_distinct(list(p_type[1:3])) AS k FROM m JOIN part ON p_partkey = feature GROUP BY 1) SELECT barcode, CASE WHEN len(k) = 1 THEN k[1] ELSE 'Multi' END AS chain FROM g")
def chain_types(spark, d):
    g = molecules(spark, d).join(table(spark, d, "part").select(F.col("p_partkey").alias("feature"), "p_type"), "feature").groupBy("barcode").agg(F.collect_set("p_type").alias("g"))
    return g.select("barcode", repertoire.chain_type(F.col("g")).alias("chain"))


@query("SELECT p_brand AS lane, count(*) AS n, min(length(p_name)) AS shortest, quantile_cont(length(p_name), 0.1) AS tenth, min(length(p_name)) >= 10 AS fits FROM part GROUP BY 1")
def read_lengths(spark, d):
    n = F.length("p_name")
    h = table(spark, d, "part").groupBy(F.col("p_brand").alias("lane"), n.alias("len")).agg(F.count("*").alias("c"))
    return h.groupBy("lane").agg(F.sum("c").alias("n"), F.min("len").alias("shortest"), F.expr("percentile(len, 0.1D, c)").alias("tenth"), (F.min("len") >= 10).alias("fits"))


@query(S + " SELECT w.k AS whitelist, count(*) AS n, round(avg(CASE WHEN EXISTS (SELECT 1 FROM s t WHERE t.id % 3 = w.k AND t.seq[1:3] = s.seq[1:3]) THEN 1.0 ELSE 0.0 END), 6) AS share FROM s, (SELECT unnest([0, 1, 2]) AS k) w GROUP BY 1")
def whitelist_shares(spark, d):
    r = _reads(spark, d).select("id", F.substr("seq", F.lit(1), F.lit(3)).alias("w"))
    known = r.select("w", (F.col("id") % 3).alias("whitelist")).distinct()
    n = r.groupBy("w").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    s = n.join(known, "w").groupBy("whitelist").agg(F.sum("n").alias("hit")).crossJoin(F.broadcast(total))  # one row
    return s.select("whitelist", F.col("total").alias("n"), F.round(F.col("hit") / F.col("total"), 6).alias("share"))


@query("WITH c AS (SELECT l_suppkey % 10 AS lib, count(*) FILTER (l_linestatus = 'F') AS sense, count(*) FILTER (l_linestatus = 'O') AS antisense FROM lineitem GROUP BY 1) SELECT lib, sense, antisense, CASE WHEN sense + antisense < 50 THEN 'unknown' WHEN sense > 1.05::DOUBLE * antisense THEN '3p' WHEN antisense > 1.05::DOUBLE * sense THEN '5p' ELSE 'ambiguous' END AS chemistry FROM c")
def chemistry_by_strand(spark, d):
    c = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("lib")).agg(F.count_if(F.col("l_linestatus") == "F").alias("sense"), F.count_if(F.col("l_linestatus") == "O").alias("antisense"))
    a, b = F.col("sense"), F.col("antisense")
    return c.withColumn("chemistry", F.when(a + b < 50, "unknown").when(a > 1.05 * b, "3p").when(b > 1.05 * a, "5p").otherwise("ambiguous"))


@query("WITH m AS (SELECT DISTINCT l_suppkey % 20 AS g, l_partkey AS i FROM lineitem), s AS (SELECT g, count(*) AS n FROM m GROUP BY 1), p AS (SELECT a.g AS a, b.g AS b, count(*) AS common, count(*)::DOUBLE / least(max(x.n), max(y.n)) AS overlap FROM m a JOIN m b ON a.i = b.i AND a.g < b.g JOIN s x ON x.g = a.g JOIN s y ON y.g = b.g GROUP BY a.g, b.g) SELECT a, b, common, round(overlap, 9) AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY overlap DESC, b) AS k FROM p) WHERE k = 1")
def best_pairings(spark, d):
    p = joins.overlap(molecules(spark, d).select((F.col("library") % 20).alias("g"), "feature"), "g", "feature")
    best = p.groupBy("a").agg(F.max_by(F.struct("b", "common", "overlap"), F.struct(F.col("overlap"), -F.col("b"))).alias("x"))
    return best.select("a", "x.b", "x.common", F.round("x.overlap", 9).alias("overlap"))


@query("WITH c AS (SELECT l_suppkey % 10 AS sample, l_linenumber AS code, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT sample, arg_max(code, (n, -code)) AS top, round(max(n) / sum(n)::DOUBLE, 6) AS share, max(n) / sum(n)::DOUBLE < 0.3 AS mixed FROM c GROUP BY 1")
def probe_mixtures(spark, d):
    c = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("sample"), F.col("l_linenumber").alias("code")).agg(F.count("*").alias("n"))
    g = c.groupBy("sample").agg(F.max_by("code", F.struct(F.col("n"), -F.col("code"))).alias("top"), F.max("n").alias("most"), F.sum("n").alias("total"))
    return g.select("sample", "top", F.round(F.col("most") / F.col("total"), 6).alias("share"), (F.col("most") / F.col("total") < 0.3).alias("mixed"))


@query("SELECT md5(p_type || p_size) AS digest, count(*) AS copies, min(p_partkey) AS first FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_files(spark, d):
    name = F.md5(F.concat("p_type", F.col("p_size").cast("string")))
    return table(spark, d, "part").groupBy(name.alias("digest")).agg(F.count("*").alias("copies"), F.min("p_partkey").alias("first")).where("copies > 1")


@query("SELECT file, lane, read, count(*) AS n FROM (SELECT regexp_extract(f, '^(.*)_S(\\d+)_L(\\d+)_(R[12])', 1) AS file, CAST(regexp_extract(f, '^(.*)_S(\\d+)_L(\\d+)_(R[12])', 3) AS INTEGER) AS lane, regexp_extract(f, '^(.*)_S(\\d+)_L(\\d+)_(R[12])', 4) AS read FROM (SELECT p_brand || '_S' || p_size || '_L00' || (p_partkey % 4 + 1) || '_R' || (p_partkey % 2 + 1) || '_001.fastq.gz' AS f FROM part)) GROUP BY ALL")
def files_by_lane(spark, d):
    k = F.col("p_partkey")
    f = F.concat("p_brand", F.lit("_S"), F.col("p_size").cast("string"), F.lit("_L00"), (k % 4 + 1).cast("string"), F.lit("_R"), (k % 2 + 1).cast("string"), F.lit("_001.fastq.gz"))
    part = lambda i: F.regexp_extract("f", r"^(.*)_S(\d+)_L(\d+)_(R[12])", i)
    return table(spark, d, "part").select(f.alias("f")).groupBy(part(1).alias("file"), part(3).cast("int").alias("lane"), part(4).alias("read")).agg(F.count("*").alias("n"))
