"""Correction and de-duplication of molecule keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def neighbours(seq):
    """All sequences one substitution away."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(seq)),
            lambda i: F.transform(
                F.filter(F.array(*[F.lit(b) for b in "ACGT"]), lambda b: b != F.substr(seq, i, F.lit(1))),
                lambda b: F.concat(F.substr(seq, F.lit(1), i - 1), b, F.substr(seq, i + 1)),
            ),
        )
    )


def correct_umis(counts: DataFrame) -> DataFrame:
    """(barcode, gene, umi, reads) with ``corrected``: within (barcode, gene) a
    UMI moves to the one-mismatch UMI with more reads (equal: the larger
    UMI), the best of them, in a single hop."""
    near = counts.select("barcode", "gene", F.col("umi").alias("from_umi"), F.col("reads").alias("from_reads"), F.explode(neighbours(F.col("umi"))).alias("umi"))
    hit = near.join(counts, ["barcode", "gene", "umi"]).where((F.col("reads") > F.col("from_reads")) | ((F.col("reads") == F.col("from_reads")) & (F.col("umi") > F.col("from_umi"))))
    best = hit.groupBy("barcode", "gene", F.col("from_umi").alias("umi")).agg(F.max(F.struct("reads", "umi"))["umi"].alias("target"))
    return counts.join(best, ["barcode", "gene", "umi"], "left").select("barcode", "gene", "umi", "reads", F.coalesce("target", "umi").alias("corrected"))


def low_support(counts: DataFrame) -> DataFrame:
    """Marks genes of a (barcode, umi) under its greatest count, all if it is tied."""
    w = Window.partitionBy("barcode", "umi")
    top = F.max("reads").over(w)
    c = counts.withColumn("top", top)
    ties = F.count_if(F.col("reads") == F.col("top")).over(w)
    return c.withColumn("low", (F.col("reads") < F.col("top")) | (ties > 1)).drop("top")


def deduplicated(counts: DataFrame) -> DataFrame:
    """(barcode, gene, umi, reads) of molecules after correction: one read of
    each corrected UMI moves before genes of low support are told, the rest
    after it, and genes of low support and keys without reads go."""
    c = correct_umis(counts).withColumn("moves", F.col("corrected") != F.col("umi"))
    keys = ["barcode", "gene", "umi"]
    got = c.where("moves").groupBy("barcode", "gene", F.col("corrected").alias("umi")).agg(F.count("*").alias("n_in"), F.sum("reads").alias("reads_in"))
    c = c.join(got, keys, "left").na.fill(0, ["n_in", "reads_in"])
    before = F.col("reads") - F.when(F.col("moves"), 1).otherwise(0) + F.col("n_in")
    after = F.when(F.col("moves"), 0).otherwise(F.col("reads")) + F.col("reads_in")
    c = low_support(c.select(*keys, before.alias("reads"), after.alias("after")))
    return c.where("NOT low AND after > 0").select(*keys, F.col("after").alias("reads"))


def corrected_features(observed: DataFrame, known: DataFrame, threshold: float = 0.975) -> DataFrame:
    """(seq, quality, kind) with ``corrected``: a known feature barcode stays;
    else the likeliest one substitution away, its weight the error at the base
    (quality up to 33) times the feature's share of its kind in ``known``
    (kind, seq, share); null under ``threshold`` of all weights."""
    exact = known.select("kind", "seq", F.lit(True).alias("is_known"))
    seen = observed.join(exact, ["kind", "seq"], "left")
    trial = seen.where("is_known IS NULL").select("kind", F.col("seq").alias("seen"), "quality", F.posexplode(neighbours(F.col("seq"))).alias("i", "seq")).distinct()
    q = F.least(F.get("quality", F.floor(F.col("i") / 3).cast("int")), F.lit(33))
    hit = trial.withColumn("p", F.pow(F.lit(10.0), -q / 10.0)).join(known, ["kind", "seq"]).withColumn("weight", F.col("p") * F.col("share"))
    best = hit.groupBy("kind", "seen", "quality").agg(F.max(F.struct("weight", "seq")).alias("b"), F.sum("weight").alias("t"))
    best = best.where((F.col("t") > 0) & (F.col("b.weight") >= threshold * F.col("t"))).select("kind", F.col("seen").alias("seq"), "quality", F.col("b.seq").alias("found"))
    return seen.join(best, ["kind", "seq", "quality"], "left").select("kind", "seq", "quality", F.when(F.col("is_known"), F.col("seq")).otherwise(F.col("found")).alias("corrected"))


def correct_barcodes(observed: DataFrame, known: DataFrame, threshold: float = 0.975, max_errors: float = 1.0) -> DataFrame:
    """(barcode, quality) with ``corrected``: of the known barcodes one
    substitution away the likeliest, null if none is likely enough.

    A substitution weighs 10^-((min(q, 66) - 33) / 10) at its base times one
    plus the known barcode's ``count``; the best needs ``threshold`` of the
    sum, and the read under ``max_errors`` expected errors.  ``quality`` is an
    array of numbers."""
    chance = lambda q: F.pow(F.lit(10.0), (33 - q) / 10.0)
    seen = observed.select("barcode", "quality").distinct()
    errors = F.aggregate("quality", F.lit(0.0), lambda a, q: a + chance(q))
    trial = seen.where(errors < max_errors).select(
        F.col("barcode").alias("seen"), "quality", F.posexplode(neighbours(F.col("barcode"))).alias("i", "barcode")
    )
    # Three neighbours for each base, in order.
    base = F.get("quality", F.floor(F.col("i") / 3).cast("int"))
    trial = trial.select("seen", "quality", "barcode", chance(F.least(base, F.lit(66))).alias("p"))
    hit = trial.join(known.select("barcode", "count"), "barcode").withColumn("weight", F.col("p") * (1 + F.coalesce("count", F.lit(0))))
    best = hit.groupBy("seen", "quality").agg(F.max(F.struct("weight", "barcode")).alias("b"), F.sum("weight").alias("t"))
    best = best.where(F.col("b.weight") / F.col("t") >= threshold).select(F.col("seen").alias("barcode"), "quality", F.col("b.barcode").alias("corrected"))
    return observed.join(best, ["barcode", "quality"], "left")


def molecules_of(reads: DataFrame) -> DataFrame:
    """Reads (barcode, umi, gene, kind, name) to molecules with their count
    and the representative, the smallest (kind, name)."""
    g = reads.groupBy("barcode", "umi", "gene").agg(F.count("*").alias("reads"), F.min(F.struct("kind", "name")).alias("r"))
    return g.select("barcode", "umi", "gene", "reads", F.col("r.kind").alias("kind"), F.col("r.name").alias("name"))
