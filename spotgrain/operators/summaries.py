"""Tag calls, masked sums, histograms with bounds, correlations and reports.

All are one or two aggregations with partial sums before each exchange; none
collects rows to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def with_cells(mol: DataFrame, cells: DataFrame) -> DataFrame:
    """``mol`` with in_cell: whether the barcode is among ``cells``."""
    flag = cells.select("barcode").distinct().withColumn("in_cell", F.lit(True))
    return mol.join(flag, "barcode", "left").withColumn("in_cell", F.coalesce("in_cell", F.lit(False)))


def barcode_summary(mol: DataFrame) -> DataFrame:
    """Per barcode: umis, reads, features and the share of duplicate reads.
    Entries first, so the features are a plain count."""
    e = mol.groupBy("barcode", "feature").agg(F.count("*").alias("u"), F.sum("reads").alias("r"))
    s = e.groupBy("barcode").agg(F.sum("u").alias("umis"), F.sum("r").alias("reads"), F.count("*").alias("n_features"))
    return s.withColumn("dup_frac", F.when(F.col("reads") > 0, (F.col("reads") - F.col("umis")) / F.col("reads")).otherwise(0.0))


def usable_by(mol: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """Per key: umis and reads, and those in cells and in the background."""
    m = with_cells(mol, cells)
    count = lambda c: F.count_if(c)
    reads = lambda c: F.sum(F.when(c, F.col("reads")).otherwise(0))
    return m.groupBy(key).agg(
        F.count("*").alias("umis"),
        F.sum("reads").alias("reads"),
        count(F.col("in_cell")).alias("umis_in_cells"),
        reads(F.col("in_cell")).alias("reads_in_cells"),
        reads(~F.col("in_cell")).alias("reads_in_background"),
    )


def binned(df: DataFrame, value: str, width: int, top: int) -> DataFrame:
    """(bin, n): bins of ``width``; all from ``top`` on are one overflow bin."""
    return df.groupBy(F.least(F.floor(F.col(value) / width) * width, F.lit(top)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def bucketed(df: DataFrame, value: str, cutoffs: list[int]) -> DataFrame:
    """(bucket, n): bucket k holds the values from cutoff k on, below cutoff k + 1; -1 those below all."""
    k = reduce(lambda acc, c: acc + F.when(F.col(value) >= c, 1).otherwise(0), cutoffs, F.lit(-1))
    return df.groupBy(k.cast("long").alias("bucket")).agg(F.count("*").alias("n"))


def moments(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, population variance, coefficient of variation and dispersion (NaN
    for a mean of 0)."""
    v = F.col(value)
    return df.groupBy(key).agg(
        F.avg(v).alias("mean"), F.var_pop(v).alias("variance"), robust_divide(F.stddev_pop(v), F.avg(v)).alias("cv"), robust_divide(F.var_pop(v), F.avg(v)).alias("dispersion")
    )


def letter_counts(df: DataFrame, text: str) -> DataFrame:
    """(position, letter, n), positions from 0."""
    e = df.select(F.posexplode(F.split(text, "")).alias("position", "letter")).where("letter <> ''")
    return e.groupBy(F.col("position").cast("long").alias("position"), "letter").agg(F.count("*").alias("n"))


def tag_calls(counts: DataFrame, least: int) -> DataFrame:
    """(barcode, n_tags, call, umis): tags with ``least`` UMIs or more of a
    barcode, joined in order; call is the tag, Multiplet or Blank."""
    on = F.col("umis") >= least
    t = counts.groupBy("barcode").agg(F.array_sort(F.collect_list(F.when(on, F.struct("tag", "umis")))).alias("t"))
    n = F.size("t")
    return t.select(
        "barcode",
        n.cast("long").alias("n_tags"),
        F.when(n == 0, "Blank").when(n == 1, F.col("t")[0]["tag"].cast("string")).otherwise("Multiplet").alias("call"),
        F.concat_ws("|", F.col("t.tag").cast("array<string>")).alias("tags"),
        F.concat_ws("|", F.col("t.umis").cast("array<string>")).alias("umis"),
    )


def tag_correlations(counts: DataFrame, n_barcodes: int) -> DataFrame:
    """(a, b, r): Pearson over all barcodes, zeros included, a < b; NaN for a
    tag that is the same everywhere.  Counts are
    joined within a barcode, so a row makes as many pairs as the barcode has
    tags; it is for tag sets, not for whole feature lists."""
    c = counts.select("barcode", "tag", F.col("umis").cast("double").alias("v"))
    one = c.groupBy("tag").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    met = c.select("barcode", F.col("tag").alias("a"), F.col("v").alias("va")).join(c.select("barcode", F.col("tag").alias("b"), F.col("v").alias("vb")), "barcode")
    met = met.where("a < b").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("p"))
    # All pairs of tags, of which there are few: two that share no barcode are correlated too.
    side = lambda x: one.select(F.col("tag").alias(x), F.col("s").alias(f"s{x}"), F.col("q").alias(f"q{x}"))
    j = side("a").join(F.broadcast(side("b")), F.col("a") < F.col("b")).join(met, ["a", "b"], "left").na.fill(0.0, ["p"])
    n = F.lit(float(n_barcodes))
    spread = lambda s, q: F.sqrt(F.greatest(n * F.col(q) - F.col(s) * F.col(s), F.lit(0.0)))
    return j.select("a", "b", robust_divide(n * F.col("p") - F.col("sa") * F.col("sb"), spread("sa", "qa") * spread("sb", "qb")).alias("r"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number differs, with n_left and n_right: one exchange of
    partial counts, and no join."""
    side = lambda df, a, b: df.groupBy(*df.columns).count().select(*df.columns, (F.col("count") * a).alias("n_left"), (F.col("count") * b).alias("n_right"))
    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return both.groupBy(*left.columns).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")).where("n_left <> n_right")


def whole_grid(points: DataFrame, rows: int, cols: int, value: str) -> DataFrame:
    """Every (row, col) of the grid, with zero where ``points`` has none.  The
    grid is numbered by one range, which Spark makes in parts."""
    spark = points.sparkSession
    g = spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"))
    return g.join(points.select("row", "col", value), ["row", "col"], "left").fillna(0, [value])


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group with their rank: Spark keeps n rows of a
    group in each task before the exchange."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def report(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    """(name, value): the one row of ``df`` as named metrics."""
    return df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "name", "value").withColumn("name", F.concat(F.lit(prefix), F.col("name")))


def target_depths(most: Column, n: int) -> Column:
    """The distinct whole depths of n equal steps up to ``most``."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.floor(most * k / n)))


def wildcard_match(seqs: DataFrame, known: DataFrame) -> DataFrame:
    """(seq, match): the known sequence equal but for one N; null if several
    or none.  The N becomes each letter, so the look-up is an equi-join."""
    s = seqs.select("seq", F.explode(F.array(*[F.lit(x) for x in "ACGT"])).alias("letter"))
    s = s.where(F.length(F.regexp_replace("seq", "[^N]", "")) == 1).select("seq", F.translate("seq", "N", "#").alias("p"), "letter").select("seq", F.replace("p", F.lit("#"), F.col("letter")).alias("known"))
    hit = s.join(known.select("known").distinct(), "known").groupBy("seq").agg(F.count("*").alias("n"), F.min("known").alias("match"))
    return seqs.join(hit.where("n = 1").select("seq", "match"), "seq", "left")
