"""Scans with options, selections, re-indexing and set operations of molecule
tables, matrices and dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import dense_index

#: Columns that older tables lack, and what they stand for there.
DEFAULTS = {"umi_type": 1, "probe": None}


def with_defaults(molecules: DataFrame, defaults: dict[str, object] = DEFAULTS) -> DataFrame:
    """An older table brought up to date: missing columns get their defaults."""
    return molecules.withColumns({c: F.lit(v).cast("int") for c, v in defaults.items() if c not in molecules.columns})


def scan(
    molecules: DataFrame, columns: list[str] | None = None, where: Column | None = None, barcodes: DataFrame | None = None,
    features: DataFrame | None = None, barcode_range: tuple[int, int] | None = None, least_reads: int = 0,
) -> DataFrame:
    """Molecules by the options of a reader: which columns, a predicate, semi
    joins with barcodes and features, a range of barcodes, fewest reads.  All
    of it is declared, so filters and columns reach the files."""
    m = molecules
    if barcode_range is not None:
        m = m.where(F.col("barcode").between(*barcode_range))
    if least_reads:
        m = m.where(F.col("reads") >= least_reads)
    if where is not None:
        m = m.where(where)
    if features is not None:
        m = m.join(features.select("feature").distinct(), "feature", "left_semi")
    if barcodes is not None:
        m = m.join(barcodes.select("barcode").distinct(), "barcode", "left_semi")
    return m.select(*columns) if columns else m


def per_barcode(molecules: DataFrame) -> DataFrame:
    """A row for each barcode with its molecules as an array, in order."""
    return molecules.groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("feature", "library", "umi", "reads"))).alias("umis"))


def select_features(features: DataFrame, ids: list | None = None, types: list[str] | None = None, genomes: list[str] | None = None, tag: str | None = None) -> DataFrame:
    """Features by any of id, type, genome, and a tag that they must have."""
    tests = [F.col(c).isin(v) for c, v in (("feature", ids), ("feature_type", types), ("genome", genomes)) if v is not None]
    if tag is not None:
        tests.append(F.map_contains_key("tags", tag))
    return features.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def genes_on_list(features: DataFrame, listed: DataFrame, is_gene: Column) -> DataFrame:
    """Genes stay if they are listed; other features always."""
    on = listed.select("feature").distinct().withColumn("listed", F.lit(True))
    return features.join(on, "feature", "left").where(~is_gene | F.coalesce("listed", F.lit(False))).drop("listed")


def restrict(matrix: DataFrame, features: DataFrame | None = None, barcodes: DataFrame | None = None) -> DataFrame:
    """Entries of the selected features and barcodes."""
    for side, key in ((features, "feature"), (barcodes, "barcode")):
        if side is not None:
            matrix = matrix.join(side.select(key).distinct(), key, "left_semi")
    return matrix


def reindexed(matrix: DataFrame, axis: str) -> DataFrame:
    """``matrix`` with a dense index, from 0, of what is left of an axis."""
    index = dense_index(matrix, axis).withColumnRenamed("index", f"{axis}_index")
    return matrix.join(index, axis)


def of_group(matrix: DataFrame, group: int, barcode: str = "barcode") -> DataFrame:
    """Barcodes whose name ends with ``-group``."""
    return matrix.where(F.endswith(F.col(barcode), F.lit(f"-{group}")))


def without(barcodes: DataFrame, flagged: DataFrame) -> DataFrame:
    return barcodes.join(flagged.select("barcode").distinct(), "barcode", "left_anti")


def cells_with_targets(cells: DataFrame, matrix: DataFrame, targets: DataFrame) -> DataFrame:
    """Cells with a molecule of a target feature."""
    return cells.join(restrict(matrix, targets).select("barcode").distinct(), "barcode", "left_semi")


def share_of(matrix: DataFrame, features: DataFrame) -> DataFrame:
    """(barcode, umis, of_list, share): what part of a barcode's molecules is
    of the listed features; 0 where it has none."""
    on = features.select("feature").distinct().withColumn("listed", F.lit(1))
    j = matrix.join(on, "feature", "left").groupBy("barcode").agg(F.sum("umis").alias("umis"), F.sum(F.col("umis") * F.coalesce("listed", F.lit(0))).alias("of_list"))
    return j.withColumn("share", F.when(F.col("umis") > 0, F.col("of_list") / F.col("umis")).otherwise(0.0))


def crowded(members: DataFrame, group: str, cutoff: int) -> DataFrame:
    """(barcode) of groups with over ``cutoff`` barcodes."""
    size = members.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > cutoff).select(group)
    return members.join(size, group, "left_semi").select("barcode")


def outliers(totals: DataFrame, value: str, top: int, floor: float) -> DataFrame:
    """Of the ``top`` barcodes by value those over the third quartile and three
    interquartile ranges, and over ``floor``; quartiles are of the top ones."""
    t = totals.orderBy(F.desc(value), "barcode").limit(top)
    cut = t.agg(F.percentile(value, 0.75).alias("q3"), F.percentile(value, 0.25).alias("q1"))
    cut = cut.select(F.greatest(F.col("q3") + 3 * (F.col("q3") - F.col("q1")), F.lit(float(floor))).alias("cutoff"))
    return t.crossJoin(F.broadcast(cut)).where(F.col(value) > F.col("cutoff"))  # one row


def aggregates(matrix: DataFrame, top: int, least: int) -> DataFrame:
    """(barcode, n): barcodes among the ``top`` of ``least`` features and more."""
    w = Window.partitionBy("feature").orderBy(F.desc("umis"), "barcode")
    high = matrix.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return high.groupBy("barcode").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def stacked(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Tables one below the other, with the name of the part."""
    return reduce(DataFrame.unionByName, [p.withColumn("part", F.lit(n)) for p, n in zip(parts, names)])


def remapped(parts: list[tuple[DataFrame, int, int]]) -> DataFrame:
    """Molecule tables as one: each (table, group offset, library offset)."""
    moved = [t.withColumn("gem_group", F.col("gem_group") + g).withColumn("library", F.col("library") + x) for t, g, x in parts]
    return reduce(DataFrame.unionByName, moved)


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """(only_left, only_right): how many rows each has that the other lacks."""
    side = lambda a, b, name: a.exceptAll(b.select(*a.columns)).agg(F.count("*").alias(name))
    return side(left, right, "only_left").crossJoin(side(right, left, "only_right"))  # a row each


def multiplets(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """(barcode, sample): the sample of a barcode's one tag; Multiplet where it
    has several."""
    c = calls.groupBy("barcode").agg(F.count_distinct("tag").alias("n"), F.min("tag").alias("tag"))
    return c.join(samples, "tag", "left").select("barcode", F.when(F.col("n") > 1, "Multiplet").otherwise(F.coalesce("sample", F.lit("Unassigned"))).alias("sample"))


def disjoint(parts: DataFrame, key: str, part: str) -> DataFrame:
    """Keys that more than one part claims, and how many do; none is well."""
    return parts.groupBy(key).agg(F.count_distinct(part).alias("n_parts")).where("n_parts > 1")
