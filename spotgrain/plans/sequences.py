"""Sequence, barcode and coordinate expressions as queries, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as q
from ..sources.tables import table
from .queries import query

LETTERS = "translate(md5(p_name), '0123456789abcdef', 'ACGTACGTACGTACGT')"
S = f"WITH s AS (SELECT p_partkey AS id, {LETTERS} AS seq, translate(md5(p_type), '0123456789abcdef', '!&+05:?@ABCDEFGH') AS qual FROM part)"


def _reads(spark, d):
    letters = F.translate(F.md5("p_name"), "0123456789abcdef", "ACGT" * 4)
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), letters.alias("seq"), F.translate(F.md5("p_type"), "0123456789abcdef", "!&+05:?@ABCDEFGH").alias("qual"))


@query(S + """ SELECT id, contains(replace(seq, 'GG', 'NN'), 'N') AS has_n, regexp_matches(seq[1:2], '^(AA|CC|GG|TT)$') AS homopolymer, ends_with(seq, 'T') AS t_end, starts_with(seq, 'ATG') AS has_start,
 coalesce(list_max([length(x) FOR x IN regexp_extract_all(seq, 'A+')]), 0)::INTEGER AS longest_a, regexp_matches(replace(seq, 'GG', 'NN'), '^[ACGT]+$') AS valid FROM s""")
def sequence_flags(spark, d):
    seq = F.col("seq")
    masked = F.replace(seq, F.lit("GG"), F.lit("NN"))
    return _reads(spark, d).select(
        "id", q.has_n(masked).alias("has_n"), q.is_homopolymer(q.piece(seq, F.lit(0), 2)).alias("homopolymer"), q.ends_with_run(seq, "T", 1).alias("t_end"),
        q.has_start(seq).alias("has_start"), q.longest_run(seq, "A").alias("longest_a"), q.is_valid(masked).alias("valid"),
    )


NEAR = S + ", k AS (SELECT DISTINCT seq[1:5] AS seq FROM s), i AS (SELECT seq, unnest(range(1, 6)) AS i FROM k), c AS (SELECT unnest(['A', 'C', 'G', 'T']) AS c)"


@query(NEAR + """, e AS (SELECT seq, seq[:i - 1] || c || seq[i + 1:] AS near FROM i, c WHERE seq[i] <> c
 UNION SELECT seq, seq[:i - 1] || seq[i + 1:] FROM i UNION SELECT seq, seq[:i - 1] || c || seq[i:] FROM (SELECT seq, unnest(range(1, 7)) AS i FROM k), c) SELECT seq, near, length(near) - 5 AS change FROM e""")
def one_edit_neighbours(spark, d):
    k = _reads(spark, d).select(q.piece(F.col("seq"), F.lit(0), 5).alias("seq")).distinct()
    return k.select("seq", F.explode(q.one_edit(F.col("seq"))).alias("near")).select("seq", "near", (F.length("near") - 5).cast("long").alias("change"))


@query(NEAR + " SELECT seq, count(DISTINCT seq[:i - 1] || seq[i + 1:]) AS n_deleted, 15 AS n_substituted, (SELECT count(DISTINCT k.seq[:j.i - 1] || c || k.seq[j.i:]) FROM (SELECT unnest(range(1, 7)) AS i) j, c) AS n_inserted FROM i JOIN k USING (seq) GROUP BY k.seq, seq")
def neighbour_counts(spark, d):
    k = _reads(spark, d).select(q.piece(F.col("seq"), F.lit(0), 5).alias("seq")).distinct()
    size = lambda f: F.size(f(F.col("seq"))).cast("long")
    return k.select("seq", size(q.deletions).alias("n_deleted"), size(q.substitutions).cast("int").alias("n_substituted"), size(q.insertions).alias("n_inserted"))


@query(S + """ SELECT id, list_min(v) AS least, len(list_filter(v, lambda x: x > 30))::INTEGER AS over_30, round(list_sum([pow(10, -x / 10.0) FOR x IN v]), 6) AS errors
 FROM (SELECT id, [ascii(x) - 33 FOR x IN string_split(qual, '')] AS v FROM s)""")
def quality_summary(spark, d):
    v = F.col("qual")
    return _reads(spark, d).select("id", q.least_quality(v).alias("least"), q.bases_over(v, 30).alias("over_30"), F.round(q.expected_errors(v), 6).alias("errors"))


@query(S + ", a AS (SELECT id, seq[1:30] AS seq FROM s), c AS (SELECT id, [seq[3 * k + 1:3 * k + 3] FOR k IN range(10)] AS c FROM a) SELECT id, list_reduce(['' || 'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'[16 * (instr('TCAG', x[1]) - 1) + 4 * (instr('TCAG', x[2]) - 1) + instr('TCAG', x[3])] FOR x IN c], lambda u, v: u || v) AS protein FROM c")
def proteins(spark, d):
    return _reads(spark, d).select("id", q.protein(q.piece(F.col("seq"), F.lit(0), 30)).alias("protein"))


@query(S + ", p AS (SELECT id, seq, lead(seq) OVER (ORDER BY id) AS other FROM s) SELECT id, hamming(seq, other) AS distance, len(list_filter(range(1, 33), lambda i: seq[:i] = other[:i]))::INTEGER AS prefix FROM p WHERE other IS NOT NULL")
def neighbouring_reads(spark, d):
    r = _reads(spark, d)
    # Ids are dense in the driver's table: the next row is an equality join.
    p = r.join(r.select((F.col("id") - 1).alias("id"), F.col("seq").alias("other")), "id")
    return p.select("id", q.hamming(F.col("seq"), F.col("other")).cast("long").alias("distance"), q.common_prefix(F.col("seq"), F.col("other")).alias("prefix"))


@query(S + " SELECT id, seq[1:8] || '-' || (id % 4 + 1) AS barcode, seq[1:8] AS seq, CAST(id % 4 + 1 AS INTEGER) AS grp, printf('cellid_%09d-1', id) AS cell, id AS cell_id FROM s")
def barcode_names(spark, d):
    r = _reads(spark, d).select("id", q.with_group(q.piece(F.col("seq"), F.lit(0), 8), F.col("id") % 4 + 1).alias("barcode"), q.cell_name(F.col("id")).alias("cell"))
    part = q.split_group(F.col("barcode"))
    return r.select("id", "barcode", part["seq"].alias("seq"), part["group"].alias("grp"), "cell", q.cell_of(F.col("cell")).alias("cell_id"))


@query("SELECT p_partkey, CASE WHEN starts_with(p_type, 'ECONOMY') THEN 'ECONOMY' WHEN starts_with(p_type, 'STANDARD') THEN 'STANDARD' WHEN starts_with(p_type, 'PROMO') THEN 'PROMO' END AS genome, CASE WHEN regexp_matches(p_type, '^(ECONOMY|STANDARD|PROMO)') THEN regexp_replace(p_type, '^(ECONOMY|STANDARD|PROMO)_*', '') ELSE p_type END AS gene FROM part")
def genome_prefixes(spark, d):
    genomes = ["ECONOMY", "STANDARD", "PROMO"]
    t = F.col("p_type")
    return table(spark, d, "part").select("p_partkey", q.genome_of(t, genomes).alias("genome"), q.without_genome(t, genomes).alias("gene"))


@query("SELECT p_partkey, CAST(coalesce(list_sum([CAST(x[:-2] AS BIGINT) FOR x IN regexp_extract_all(c, '\\d+M')]), 0) AS BIGINT) AS matched, CAST(coalesce(list_sum([CAST(x[:-2] AS BIGINT) FOR x IN regexp_extract_all(c, '\\d+N')]), 0) AS BIGINT) AS skipped FROM (SELECT p_partkey, (p_partkey % 30 + 1) || 'M' || (p_partkey % 7 + 1) || 'N' || (p_partkey % 11 + 1) || 'M2S' AS c FROM part)")
def cigar_totals(spark, d):
    k = F.col("p_partkey")
    c = F.concat((k % 30 + 1).cast("string"), F.lit("M"), (k % 7 + 1).cast("string"), F.lit("N"), (k % 11 + 1).cast("string"), F.lit("M2S"))
    return table(spark, d, "part").select("p_partkey", q.cigar_total(c, "M").alias("matched"), q.cigar_total(c, "N").alias("skipped"))


@query(S + " SELECT id, regexp_matches(seq, '^..A(.{6})') AS found, regexp_extract(seq, '^..A(.{6})', 1) AS barcode FROM s")
def pattern_barcodes(spark, d):
    rx = q.feature_regex("5PNNA(BC)", 6)
    return _reads(spark, d).select("id", F.col("seq").rlike(rx).alias("found"), F.regexp_extract("seq", rx, 1).alias("barcode"))


@query("WITH p AS (SELECT p_partkey, p_partkey % 50 AS x, p_partkey // 50 AS y FROM part) SELECT p_partkey, round((2.0 * x + 0.5 * y + 3) / (0.001 * x + 1), 6) AS x, round((-0.5 * x + 1.5 * y - 1) / (0.001 * x + 1), 6) AS y FROM p")
def moved_points(spark, d):
    p = q.moved(F.col("p_partkey") % 50, F.floor(F.col("p_partkey") / 50), [[2.0, 0.5, 3.0], [-0.5, 1.5, -1.0], [0.001, 0.0, 1.0]])
    return table(spark, d, "part").select("p_partkey", F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y"))


@query("WITH r AS (SELECT s_suppkey AS id, s_suppkey % 20 AS a, s_suppkey % 20 + 10 AS b, s_suppkey % 7 * 3 AS c, s_suppkey % 7 * 3 + 8 AS d FROM supplier) SELECT id, CASE WHEN greatest(a, c) < least(b, d) THEN greatest(a, c) END AS start, CASE WHEN greatest(a, c) < least(b, d) THEN least(b, d) END AS stop FROM r")
def range_overlaps(spark, d):
    k = F.col("s_suppkey")
    o = q.overlap(k % 20, k % 20 + 10, k % 7 * 3, k % 7 * 3 + 8)
    return table(spark, d, "supplier").select(k.alias("id"), o["start"].alias("start"), o["end"].alias("stop"))


@query("SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 5 = 0 THEN range(1, 5) ELSE list_sort(list_distinct(list_concat(range(s_suppkey % 3 + 1, s_suppkey % 3 + 3), [s_suppkey % 4 + 2]))) END)::INTEGER AS lane FROM supplier")
def lane_numbers(spark, d):
    k = F.col("s_suppkey")
    spec = F.when(k % 5 == 0, "*").otherwise(F.concat((k % 3 + 1).cast("string"), F.lit("-"), (k % 3 + 2).cast("string"), F.lit(","), (k % 4 + 2).cast("string")))
    return table(spark, d, "supplier").select("s_suppkey", F.explode(q.numbers_of(spec, 4)).alias("lane"))


@query("WITH h AS (SELECT p_partkey, p_partkey % 3 > 0 AS l, p_partkey % 4 > 0 AS r, p_partkey % 5 > 0 AS e FROM part) SELECT p_partkey, CASE WHEN l AND r AND e THEN 255 WHEN l AND r THEN 5 WHEN l THEN 3 WHEN r THEN 1 ELSE 0 END AS mapq FROM h")
def half_probe_quality(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", q.mapping_quality(k % 3 > 0, k % 4 > 0, k % 5 > 0).alias("mapq"))


@query(S + " SELECT seq[1:4] AS word, count(*) AS n, min(id) AS first FROM s GROUP BY 1")
def word_frequencies(spark, d):
    return _reads(spark, d).groupBy(q.piece(F.col("seq"), F.lit(0), 4).alias("word")).agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query(S + " SELECT seq[i:i + 11] AS kmer, count(*) AS n, min(id) AS id FROM (SELECT id, seq, unnest(range(1, 22)) AS i FROM s) GROUP BY 1 HAVING count(*) > 1")
def shared_kmers(spark, d):
    at = F.explode(F.sequence(F.lit(0), F.length("seq") - 12)).alias("i")
    k = _reads(spark, d).select("id", "seq", at).select("id", q.piece(F.col("seq"), F.col("i"), 12).alias("kmer"))
    return k.groupBy("kmer").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n > 1")


@query(S + " SELECT id, len(list_distinct(x))::INTEGER AS n_distinct, list_position(list_sort(list_distinct(x)), 'C')::INTEGER - 1 AS below_c, array_to_string(list_sort(list_intersect(list_distinct(x), ['A', 'G'])), '') AS purines FROM (SELECT id, string_split(seq[1:6], '') AS x FROM s)")
def sorted_sets(spark, d):
    x = F.array_sort(F.array_distinct(F.filter(F.split(q.piece(F.col("seq"), F.lit(0), 6), ""), lambda c: c != "")))
    return _reads(spark, d).select("id", F.size(x).alias("n_distinct"), F.nullif(F.array_position(x, "C").cast("int"), F.lit(0)).alias("p"), F.array_join(F.array_sort(F.array_intersect(x, F.array(F.lit("A"), F.lit("G")))), "").alias("purines")).select("id", "n_distinct", (F.col("p") - 1).alias("below_c"), "purines")
