"""Clonotypes and contigs: exact grouping, and the filters between cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_clonotypes(contigs: DataFrame) -> DataFrame:
    """(barcode, clonotype): the sorted set of a barcode's contigs by name."""
    return contigs.groupBy("barcode").agg(F.array_join(F.array_sort(F.collect_set(F.col("contig").cast("string"))), ";").alias("clonotype"))


def cells_by_contig(contigs: DataFrame, most: int) -> DataFrame:
    """(contig, rank, barcode, umis): the barcodes of each contig by falling
    UMIs, the first ``most``; ties by barcode."""
    w = Window.partitionBy("contig").orderBy(F.desc("umis"), "barcode")
    return contigs.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= most).select("contig", "rank", "barcode", "umis")


def concordance(counts: DataFrame, group: str, kind: str, value: str) -> DataFrame:
    """(group, top, concordance): the kind with the largest sum, its share."""
    s = counts.groupBy(group, kind).agg(F.sum(value).alias("v"))
    return s.groupBy(group).agg(F.max_by(kind, F.struct("v", kind)).alias("top"), F.sum("v").alias("total"), F.max("v").alias("most")).select(group, "top", (F.col("most") / F.col("total")).alias("concordance"))


def near_twins(cells: DataFrame, neighbours: Column, factor: int) -> DataFrame:
    """(barcode) of cells whose name is one step from that of a cell with the
    same contig and ``factor`` times the UMIs.  An equality join on the names
    that are one step away."""
    near = cells.select("barcode", "contig", "umis", F.explode(neighbours).alias("other"))
    big = cells.select(F.col("barcode").alias("other"), "contig", F.col("umis").alias("more"))
    return near.join(big, ["other", "contig"]).where(F.col("more") >= factor * F.col("umis")).select("barcode").distinct()


def contaminated(cells: DataFrame, group: list[str], factor: int, least_share: float) -> DataFrame:
    """(barcode) of cells in a group whose largest member has ``factor`` times
    their UMIs, if they make at least ``least_share`` of the clonotype."""
    top = cells.groupBy(*group).agg(F.max("umis").alias("top"))
    size = cells.groupBy("clonotype").agg(F.count("*").alias("size"))
    low = cells.join(top, group).where(F.col("top") >= factor * F.col("umis")).select("barcode", "clonotype")
    bad = low.groupBy("clonotype").agg(F.count("*").alias("bad")).join(size, "clonotype").where(F.col("bad") >= least_share * F.col("size"))
    return low.join(bad.select("clonotype"), "clonotype", "left_semi").select("barcode")


def doublets(clonotypes: DataFrame, most: int = 10) -> DataFrame:
    """(clonotype) of the clonotypes whose contigs are those of two others
    together, none in both.  Of up to ``most`` contigs each split in two parts
    is made and the parts are looked up; of more, whose splits double with each
    contig, the parts come from ``_parts``."""
    c = clonotypes.select("clonotype", F.array_sort(F.array_distinct("contigs")).alias("contigs"))
    few = c.where(F.size("contigs").between(2, most)).select("*", F.explode(F.expr("sequence(1, shiftleft(1, size(contigs) - 1) - 1)")).alias("split"))
    # The last contig is never in the part, so that a split comes once.
    side = "filter(contigs, (x, i) -> (shiftright(split, i) & 1) = {})"
    few = few.select("clonotype", F.expr(side.format(1)).alias("part"), F.expr(side.format(0)).alias("rest"))
    few = few.join(c.select(F.col("contigs").alias("part")), "part", "left_semi").select("clonotype", "rest")
    both = few.unionByName(_parts(c, most))
    return both.join(c.select(F.col("contigs").alias("rest")), "rest", "left_semi").select("clonotype").distinct()


def _parts(c: DataFrame, most: int) -> DataFrame:
    """(clonotype, rest): for clonotypes of more than ``most`` contigs, what
    clonotypes inside of them leave.  Of two parts one has the rarest contig of
    the whole, as its own rarest: an equality join on the three rarest contigs
    of a part (two in clonotypes of over 100), so that frequent ones bring no
    pairs together."""
    rows = c.select("*", F.explode("contigs").alias("contig"))
    n = rows.groupBy("contig").agg(F.count("*").alias("n"))
    by_n = F.transform(F.array_sort(F.collect_list(F.struct("n", "contig"))), lambda x: x["contig"])
    c = rows.join(n, "contig").groupBy("clonotype", "contigs").agg(by_n.alias("o"))
    part = c.select(F.col("contigs").alias("part"), "o", F.explode(F.array(F.lit(2), F.lit(3))).alias("depth"))
    part = part.select("part", "depth", F.expr("slice(o, 1, depth)").alias("key"))
    pairs = "transform(slice(o, 2, size(o)), x -> array(o[0], x))"
    triples = "flatten(transform(slice(o, 2, size(o)), (x, i) -> transform(slice(o, i + 3, size(o)), y -> array(o[0], x, y))))"
    whole = c.where(F.size("contigs") > most).withColumn("depth", F.when(F.size("o") > 100, 2).otherwise(3))
    whole = whole.select("clonotype", "contigs", "depth", F.explode(F.expr(f"concat(array(array(o[0])), {pairs}, IF(depth = 3, {triples}, array()))")).alias("key"))
    inside = (F.size("part") < F.size("contigs")) & (F.size(F.array_except("part", "contigs")) == 0)
    return whole.join(part, ["depth", "key"]).where(inside).select("clonotype", F.array_except("contigs", "part").alias("rest"))


def weak_chains(cells: DataFrame, chain: str, group: str, least_share: float) -> DataFrame:
    """Cells without those whose chain is rare in their group."""
    n = cells.groupBy(group, chain).agg(F.count("*").alias("n"))
    total = n.groupBy(group).agg(F.sum("n").alias("total"))
    rare = n.join(total, group).where(F.col("n") < least_share * F.col("total")).select(group, chain)
    return cells.join(rare, [group, chain], "left_anti")


def chain_links(chains: DataFrame) -> DataFrame:
    """(heavy, light, cells, weight): pairs of chains that meet in cells, with
    the sum of the smaller UMI count of each meeting."""
    heavy = chains.where("is_heavy").select("barcode", F.col("chain").alias("heavy"), F.col("umis").alias("h"))
    light = chains.where("NOT is_heavy").select("barcode", F.col("chain").alias("light"), F.col("umis").alias("l"))
    return heavy.join(light, "barcode").groupBy("heavy", "light").agg(F.count("*").alias("cells"), F.sum(F.least("h", "l")).alias("weight"))


def weak_links(links: DataFrame, factor: float) -> DataFrame:
    """Links of a light chain that are ``factor`` times weaker than its best."""
    top = links.groupBy("light").agg(F.max("weight").alias("top"))
    return links.join(top, "light").where(F.col("top") >= factor * F.col("weight"))


def attach_singles(singles: DataFrame, clonotypes: DataFrame) -> DataFrame:
    """(barcode, clonotype): cells with one chain join the only clonotype that
    has it; null where none or several do."""
    known = clonotypes.select("clonotype", F.explode("contigs").alias("contig"))
    one = known.groupBy("contig").agg(F.count("*").alias("n"), F.min("clonotype").alias("clonotype")).where("n = 1").select("contig", "clonotype")
    return singles.join(one, "contig", "left").select("barcode", "clonotype")


def alternate_bases(bases: DataFrame, least: int, least_share: float) -> DataFrame:
    """(reference, position, base, n, share): bases beside the commonest that
    are seen often enough to be an allele of their own."""
    s = bases.groupBy("reference", "position", "base").agg(F.count("*").alias("n"))
    t = s.groupBy("reference", "position").agg(F.sum("n").alias("total"), F.max_by("base", F.struct("n", "base")).alias("top"))
    s = s.join(t, ["reference", "position"]).withColumn("share", F.col("n") / F.col("total"))
    return s.where((F.col("base") != F.col("top")) & (F.col("n") >= least) & (F.col("share") >= least_share)).drop("top", "total")


def supported(bases: DataFrame, best: int, good: int) -> DataFrame:
    """(clonotype): those whose base is seen at ``best`` quality once, or at
    ``good`` quality twice, at every place where it differs from the reference."""
    s = bases.where("base <> reference_base").groupBy("clonotype", "position", "base").agg(F.max("quality").alias("q"), F.count_if(F.col("quality") >= good).alias("n"))
    bad = s.where((F.col("q") < best) & (F.col("n") < 2)).select("clonotype").distinct()
    return bases.select("clonotype").distinct().join(bad, "clonotype", "left_anti")


def reasons(cells: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """``cells`` with ``failed``, the names of the tests that are not met, and
    ``is_cell``, whether there are none."""
    names = F.array_compact(F.array(*[F.when(~F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()]))
    return cells.withColumn("failed", names).withColumn("is_cell", F.size("failed") == 0)


def reason_counts(cells: DataFrame) -> DataFrame:
    """(failed, n): how many cells fail each combination of tests."""
    return cells.groupBy(F.array_join("failed", "+").alias("failed")).agg(F.count("*").alias("n"))


def chain_type(genes: Column) -> Column:
    """The chain that all of a contig's genes name with their first three
    letters; Multi if they differ, None without genes."""
    kinds = F.array_distinct(F.transform(genes, lambda g: F.substr(g, F.lit(1), F.lit(3))))
    return F.when(F.size(kinds) == 1, kinds[0]).when(F.size(kinds) > 1, "Multi").otherwise("None")
