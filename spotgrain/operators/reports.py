"""Metric tables: maps and JSON, reshaping, curves, alerts and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import robust_divide


def metric_map(metrics: DataFrame) -> DataFrame:
    """(metrics): the rows (name, value) as one map; a name that comes twice
    is an error."""
    return metrics.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("metrics"))


def prefixed(metrics: Column, prefix: str) -> Column:
    return F.transform_keys(metrics, lambda k, v: F.concat(F.lit(prefix), k))


def merged_maps(a: Column, b: Column) -> Column:
    """Key by key the sum; a missing key counts as 0."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def with_tag(tags: Column, key: str, value: Column) -> Column:
    """The map with one more key, or the key's new value."""
    rest = F.map_filter(tags, lambda k, v: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def parsed_names(metrics: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Metrics with the groups of ``pattern`` in their names as columns; those
    that do not match are left out."""
    part = [F.regexp_extract("name", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return metrics.where(F.col("name").rlike(pattern)).select(*part, "value")


def wide(counts: DataFrame, rows: str, columns: str, value: str, keys: list) -> DataFrame:
    """A row for each of ``rows`` with a column for each of ``keys``, zeros
    where there is nothing; the keys are given, so no job looks for them."""
    return counts.groupBy(rows).pivot(columns, keys).agg(F.sum(value)).na.fill(0)


def long(table: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    return table.unpivot(ids, values, "metric", "value")


def segments(curve: DataFrame, order: str, flag: str) -> DataFrame:
    """(segment, first, last, n, share): runs of the curve with one value of
    ``flag``.  The curve has a row for each distinct value, not for each
    barcode, so its one window is short."""
    w = Window.orderBy(order)
    c = curve.withColumn("new", F.when(F.col(flag) == F.lag(flag).over(w), 0).otherwise(1))
    c = c.withColumn("segment", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return c.groupBy("segment").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.sum("n").alias("n"), F.max(flag).alias(flag))


def rank_curve_by_call(totals: DataFrame) -> DataFrame:
    """(umis, n, cells, rank, density): barcodes of each total, how many of
    them are cells, how many hold as much or more, and the share of cells."""
    h = totals.groupBy("umis").agg(F.count("*").alias("n"), F.count_if("is_cell").alias("cells"))
    return h.withColumn("rank", F.sum("n").over(Window.orderBy(F.desc("umis")))).withColumn("density", F.col("cells") / F.col("n"))


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """``metrics`` (name, value) with level by ``rules`` (name, higher, warn,
    error): the rule says which side is bad and where it begins."""
    m = metrics.join(F.broadcast(rules), "name", "left")
    bad = lambda at: F.when(F.col("higher"), F.col("value") >= F.col(at)).otherwise(F.col("value") <= F.col(at))
    return m.select("name", "value", F.when(F.coalesce(bad("error"), F.lit(False)), "error").when(F.coalesce(bad("warn"), F.lit(False)), "warning").otherwise("ok").alias("level"))


def selected_metrics(metrics: DataFrame, config: DataFrame) -> DataFrame:
    """(section, label, value) of the metrics that ``config`` (name, section,
    label, scale) names, scaled."""
    return metrics.join(F.broadcast(config), "name").select("section", "label", (F.col("value") * F.col("scale")).alias("value"))


def count_and_share(df: DataFrame, key: str) -> DataFrame:
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select(key, "n", (100.0 * F.col("n") / F.col("total")).alias("percent"))  # one row


def saturation_curve(molecules: DataFrame, rates: list[float]) -> DataFrame:
    """(rate, reads, molecules, saturation): what a thinned run would see, in
    expectation: a molecule of n reads is seen with 1 - (1 - rate)^n.  Reads
    are counted by value first, so the rates multiply a short table."""
    h = molecules.groupBy("reads").agg(F.count("*").alias("n"))
    r = h.withColumn("rate", F.explode(F.array(*[F.lit(float(x)) for x in rates])))
    seen = F.col("n") * (1 - F.pow(1 - F.col("rate"), F.col("reads")))
    s = r.groupBy("rate").agg(F.sum(F.col("n") * F.col("reads") * F.col("rate")).alias("reads"), F.sum(seen).alias("molecules"))
    return s.withColumn("saturation", 1 - robust_divide(F.col("molecules"), F.col("reads")))


def medians_by(totals: DataFrame, key: str, value: str) -> DataFrame:
    """(key, median) from counts of distinct values."""
    h = totals.groupBy(key, value).agg(F.count("*").alias("n"))
    return h.groupBy(key).agg(F.expr(f"percentile({value}, 0.5D, n)").alias("median"))


def top_wide(changes: DataFrame, clusters: list[int], n: int) -> DataFrame:
    """The features among the n highest of any cluster, with a column for
    each cluster's change."""
    w = Window.partitionBy("cluster").orderBy(F.desc("change"), "feature")
    top = changes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("feature").distinct()
    return changes.join(top, "feature", "left_semi").groupBy("feature").pivot("cluster", clusters).agg(F.first("change"))


def clamped(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """``df`` with the value held between two of its percentiles, whole numbers."""
    cut = df.agg(F.floor(F.percentile(value, low)).alias("lo"), F.ceil(F.percentile(value, high)).alias("hi"))
    return df.crossJoin(F.broadcast(cut)).withColumn("clamped", F.greatest(F.col("lo"), F.least(F.col("hi"), F.col(value)))).drop("lo", "hi")  # one row


def log_histogram(counts: DataFrame, key: str, value: str, per_decade: int) -> DataFrame:
    """(key, bin, n): bins of log10(1 + value)."""
    return counts.groupBy(key, F.floor(F.log10(1 + F.col(value)) * per_decade).alias("bin")).agg(F.count("*").alias("n"))


def correlation(pairs: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """Pearson's r of two columns within keys; NaN for a constant one."""
    s = [F.count("*").alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"s_{c}") for c in (a, b)], *[F.sum(F.col(x).cast("double") * F.col(y)).alias(f"p_{x}_{y}") for x, y in ((a, a), (a, b), (b, b))]]
    t = pairs.groupBy(*keys).agg(*s)
    spread = lambda c: F.greatest(F.col("n") * F.col(f"p_{c}_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}"), F.lit(0.0))
    return t.select(*keys, robust_divide(F.col("n") * F.col(f"p_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}"), F.sqrt(spread(a) * spread(b))).alias("r"))


def capped_cosine(a: DataFrame, b: DataFrame, share: float) -> DataFrame:
    """(cosine) of two histograms (key, n), each value capped at the least one
    such that values up to it hold ``share`` of the whole."""

    def capped(df: DataFrame, name: str) -> DataFrame:
        h = df.groupBy("n").agg((F.sum("n")).alias("mass"))  # distinct values
        run = F.sum("mass").over(Window.orderBy("n"))
        total = F.sum("mass").over(Window.partitionBy())
        cap = h.select("n", run.alias("run"), total.alias("total")).where(F.col("run") >= share * F.col("total")).agg(F.min("n").alias("cap"))
        return df.crossJoin(F.broadcast(cap)).select("key", F.least("n", "cap").cast("double").alias(name))  # one row

    j = capped(a, "a").join(capped(b, "b"), "key", "full").na.fill(0.0, ["a", "b"])
    return j.agg(robust_divide(F.sum(F.col("a") * F.col("b")), F.sqrt(F.sum(F.col("a") * F.col("a")) * F.sum(F.col("b") * F.col("b")))).alias("cosine"))


def in_box(points: DataFrame, x: Column, y: Column, box: tuple[float, float, float, float]) -> DataFrame:
    """Points whose transformed place lies in [x0, x1) and [y0, y1)."""
    x0, x1, y0, y1 = box
    return points.where((x >= x0) & (x < x1) & (y >= y0) & (y < y1))


def first_per(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def constraints(df: DataFrame, required: list[str], unique: list[str]) -> DataFrame:
    """(check, bad): rows without a required value, and values of a unique
    column that come more than once; all 0 is well."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(f"missing {c}") for c in required])
    out = nulls.unpivot([], nulls.columns, "check", "bad")
    twice = [df.groupBy(c).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("bad")).select(F.lit(f"repeated {c}").alias("check"), "bad") for c in unique]
    return reduce(DataFrame.unionByName, twice, out)
