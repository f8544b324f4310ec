"""Expressions on nucleotide sequences, qualities, barcodes and coordinates,
all of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "ACGT"
#: The standard genetic code, codons in the order T, C, A, G.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def letters() -> Column:
    return F.array(*[F.lit(x) for x in LETTERS])


def piece(seq: Column, at: Column, n: Column | int | None = None) -> Column:
    """``n`` letters (all by default) from place ``at``, counted from 0."""
    rest = F.length(seq) if n is None else F.lit(n) if isinstance(n, int) else n
    return F.substr(seq, at + 1, rest)


def has_n(seq: Column) -> Column:
    return F.contains(seq, F.lit("N"))


def is_homopolymer(seq: Column) -> Column:
    return seq.rlike(r"^(.)\1*$")


def ends_with_run(seq: Column, letter: str, n: int) -> Column:
    return F.endswith(seq, F.lit(letter * n))


def longest_run(seq: Column, letter: str) -> Column:
    runs = F.regexp_extract_all(seq, F.lit(f"({letter}+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def is_valid(seq: Column) -> Column:
    return seq.rlike("^[ACGT]+$")


def substitutions(seq: Column) -> Column:
    """All sequences with one letter changed."""
    at = F.sequence(F.lit(0), F.length(seq) - 1)
    other = lambda i: F.filter(letters(), lambda c: c != piece(seq, i, 1))
    return F.flatten(F.transform(at, lambda i: F.transform(other(i), lambda c: F.concat(piece(seq, F.lit(0), i), c, piece(seq, i + 1)))))


def deletions(seq: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.length(seq) - 1), lambda i: F.concat(piece(seq, F.lit(0), i), piece(seq, i + 1))))


def insertions(seq: Column) -> Column:
    put = lambda i: F.transform(letters(), lambda c: F.concat(piece(seq, F.lit(0), i), c, piece(seq, i)))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.length(seq)), put)))


def one_edit(seq: Column) -> Column:
    return F.array_distinct(F.concat(substitutions(seq), deletions(seq), insertions(seq)))


def hamming(a: Column, b: Column) -> Column:
    """Differing places over the shorter length; an N in ``b`` fits any letter."""
    split = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    n = F.least(F.length(a), F.length(b))
    differ = F.zip_with(F.slice(split(a), F.lit(1), n), F.slice(split(b), F.lit(1), n), lambda x, y: F.when((x == y) | (y == "N"), 0).otherwise(1))
    return F.aggregate(differ, F.lit(0), lambda acc, x: acc + x)


def common_prefix(a: Column, b: Column, mismatches: int = 0) -> Column:
    """Places before the one that makes more than ``mismatches`` mismatches."""
    n = F.least(F.length(a), F.length(b))
    walk = F.aggregate(
        F.sequence(F.lit(0), n),
        F.struct(F.lit(0).alias("bad"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(
            (acc["bad"] + F.when((i < n) & (piece(a, i, 1) == piece(b, i, 1)), 0).otherwise(1)).alias("bad"),
            F.when((i < n) & (acc["bad"] + F.when(piece(a, i, 1) == piece(b, i, 1), 0).otherwise(1) <= mismatches), acc["n"] + 1).otherwise(acc["n"]).alias("n"),
        ),
    )
    return walk["n"]


def codon(seq: Column) -> Column:
    """The amino acid of three letters; X for others."""
    at = lambda i: F.instr(F.lit("TCAG"), piece(seq, F.lit(i), 1)) - 1
    known = seq.rlike("^[ACGT]{3}$")
    return F.when(known, F.substr(F.lit(GENETIC_CODE), 16 * at(0) + 4 * at(1) + at(2) + 1, F.lit(1))).otherwise("X")


def protein(seq: Column, frame: int = 0) -> Column:
    n = F.floor((F.length(seq) - frame) / 3).cast("int")
    codons = F.transform(F.sequence(F.lit(0), n - 1), lambda k: codon(piece(seq, 3 * k + frame, 3)))
    return F.when(n > 0, F.array_join(codons, "")).otherwise("")


def has_start(seq: Column) -> Column:
    return F.startswith(seq, F.lit("ATG"))


def scores(quality: Column) -> Column:
    """Phred scores of a quality string."""
    return F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def least_quality(quality: Column) -> Column:
    return F.array_min(scores(quality))


def bases_over(quality: Column, cutoff: int) -> Column:
    return F.size(F.filter(scores(quality), lambda q: q > cutoff))


def expected_errors(quality: Column) -> Column:
    return F.aggregate(scores(quality), F.lit(0.0), lambda acc, q: acc + F.pow(F.lit(10.0), -q / 10.0))


def with_group(seq: Column, group: Column) -> Column:
    return F.concat_ws("-", seq, group.cast("string"))


def split_group(barcode: Column) -> Column:
    """struct(seq, group); group 1 where the barcode names none."""
    part = F.split(barcode, "-")
    return F.struct(part[0].alias("seq"), F.coalesce(F.get(part, F.lit(1)).cast("int"), F.lit(1)).alias("group"))


def cell_name(cell: Column) -> Column:
    return F.format_string("cellid_%09d-1", cell)


def cell_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^cellid_(\d+)(?:-\d+)?$", 1).cast("long")


def genome_of(name: Column, genomes: list[str]) -> Column:
    """The longest of ``genomes`` that the name begins with."""
    return F.coalesce(*[F.when(F.startswith(name, F.lit(g)), F.lit(g)) for g in sorted(genomes, key=lambda g: (-len(g), g))])


def without_genome(name: Column, genomes: list[str]) -> Column:
    g = genome_of(name, genomes)
    return F.when(g.isNull(), name).otherwise(F.ltrim(F.substr(name, F.length(g) + 1), F.lit("_")))


def clean_gene(name: Column) -> Column:
    """Without white space around it and without a version at its end."""
    return F.regexp_replace(F.trim(name), r"\.\d+$", "")


def cigar_total(cigar: Column, op: str) -> Column:
    hits = F.regexp_extract_all(cigar, F.lit(rf"(\d+){op}"), F.lit(1))
    return F.aggregate(hits, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def feature_regex(pattern: str, length: int) -> str:
    """The expression for a pattern such as ``5P...(BC)...``: ``5P`` and ``3P``
    are the ends of a read, N any letter, (BC) a barcode of ``length``."""
    out = pattern.replace("5P", "^").replace("3P", "$").replace("N", ".")
    return out.replace("(BC)", "(.{%d})" % length)


def moved(x: Column, y: Column, matrix: list[list[float]]) -> Column:
    """struct(x, y) after a projective transform of three by three."""
    row = lambda r: r[0] * x + r[1] * y + r[2]
    w = row(matrix[2])
    return F.struct((row(matrix[0]) / w).alias("x"), (row(matrix[1]) / w).alias("y"))


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """struct(start, end) of what [a, b) and [c, d) share; null if nothing."""
    lo, hi = F.greatest(a, c), F.least(b, d)
    return F.when(lo < hi, F.struct(lo.alias("start"), hi.alias("end")))


def numbers_of(spec: Column, most: int) -> Column:
    """The numbers of a list such as ``1-3,5``; ``*`` stands for 1 to ``most``."""
    one = lambda p: F.sequence(F.element_at(F.split(p, "-"), 1).cast("int"), F.element_at(F.split(p, "-"), -1).cast("int"))
    return F.when(spec == "*", F.sequence(F.lit(1), F.lit(most))).otherwise(F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), one)))))


def mapping_quality(left: Column, right: Column, same: Column) -> Column:
    """255 where both halves agree, 5 for different features, 3 for the left
    half alone, 1 for the right one, 0 for none."""
    return F.when(left & right & same, 255).when(left & right, 5).when(left, 3).when(right, 1).otherwise(0)
