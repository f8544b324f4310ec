"""Scalar expressions on columns, all of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def robust_divide(a: Column, b: Column) -> Column:
    """a / b, NaN where b is zero."""
    return F.when(b == 0, F.lit(float("nan"))).otherwise(a / F.when(b == 0, F.lit(1)).otherwise(b))


def saturation(umis: Column, reads: Column) -> Column:
    """1 - max(umis, 1) / max(reads, 1)."""
    return 1 - F.greatest(umis, F.lit(1)) / F.greatest(reads, F.lit(1))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def two_bit(seq: Column) -> Column:
    """A sequence of A, C, G, T as a number, two bits each."""
    return F.conv(F.translate(seq, "ACGT", "0123"), 4, 10).cast("long")


def bin_name(size: Column | int, row: Column, col: Column) -> Column:
    return F.format_string("s_%03dum_%05d_%05d-1", F.lit(size) if isinstance(size, int) else size, row, col)


def parse_bin(name: Column) -> Column:
    """struct(size, row, col) of a bin's name."""
    part = lambda k: F.regexp_extract(name, r"^s_(\d+)um_(\d+)_(\d+)(?:-\d+)?$", k).cast("int")
    return F.struct(part(1).alias("size"), part(2).alias("row"), part(3).alias("col"))
