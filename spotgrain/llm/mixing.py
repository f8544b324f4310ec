"""Temperature mixing of sources.

A source with token share p gets the weight p^a / sum(p^a).  The exponent a is
bisected (64 probes a round) to the smallest value in [0, 1] at which the
mix's entropy is at most the target and no source is repeated more often than
``max_repeats``.  Weights become rows by block permutations: a source's rows
lie in hash blocks of some 2048 rows; whole passes over the source repeat
every row, and the rest of its token budget takes blocks in a pseudo-random
order, and rows of the last block in theirs, until it is used up.

Where the budget ends is one place in that order for each source.  It is found
by running sums over 4096 ranges of the order, then over the blocks of one
range, then over the rows of one block; rows are then compared with it where
they lie, so no text is exchanged and no window holds more than some thousand
rows.

Cases: a null source is a source of its own; a null or empty text has no
tokens; the order is a hash of id and text, so rows that share an id, and null
ids, are dealt like others; rows with equal id, text and source are numbered
and dealt by that number, so the mix does not depend on the partitioning; very
long texts are counted in one pass; a source without tokens stays once, so
with no tokens at all every row does; column names of the input cannot clash
with the operator's; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns_of, join_counted, materialize, release, table

BLOCK_ROWS = 2048
RANGE_BITS = 12
#: Up to so many sources (a few MB) the table of sources is broadcast; of more, those with most rows are.
BROADCAST_SOURCES = 20_000
PROBES = 64


def token_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def temperature(sources: DataFrame, entropy_gain: float, max_repeats: float, budget_ratio: float = 1.0) -> float:
    """The exponent.  ``sources``: (share) of those with tokens.  The target
    entropy lies ``entropy_gain`` of the way from the corpus' to the most."""
    base = sources.agg(F.count("*"), F.sum(-F.col("share") * F.log("share"))).first()
    if not base[0] or base[0] == 1:
        return 1.0
    target = base[1] + entropy_gain * (math.log(base[0]) - base[1])
    low, high = 0.0, 1.0
    while high - low > 1e-6:
        grid = F.array(*[F.lit(low + (high - low) * i / PROBES) for i in range(PROBES + 1)])
        e = sources.select("share", F.posexplode(grid).alias("i", "a")).select("i", "share", F.pow("share", "a").alias("w"))
        z = F.sum("w")
        # With w/z the weights: H = ln z - sum(w ln w)/z; repeats = w/z / share.
        got = e.groupBy("i").agg((F.log(z) - F.sum(F.col("w") * F.log("w")) / z).alias("h"), (F.max(F.col("w") / F.col("share")) / z * budget_ratio).alias("r")).collect()
        bad = {x.i for x in got if x.h > target + 1e-12 or x.r > max_repeats + 1e-12}
        first = min((i for i in range(PROBES + 1) if i not in bad), default=PROBES)
        if first == 0:
            return low
        step = (high - low) / PROBES
        low, high = low + step * (first - 1), low + step * first
    return high


def numbered_repeats(rows: DataFrame) -> DataFrame | None:
    """(uid, u) for the rows of a written table (uid, key, h) that share key
    and h: they are numbered, and the number goes into their place u.  Numbers
    come from counts by the part of the table that a row lies in, so a group
    of any size is never one task's."""
    groups = materialize(rows.groupBy("key", "h").agg(F.count("*").alias("n")).where("n > 1"), "mix-repeats")
    if not groups.head(1):
        release(groups)
        return None
    again = materialize(join_counted(rows.select("uid", "key", "h"), groups, ["key", "h"]).select("uid", "key", "h", F.shiftright("uid", 33).alias("part")), "mix-repeated")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key", "h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = again.groupBy("key", "h", "part").agg(F.count("*").alias("n")).select("key", "h", "part", "n", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("key", "h", "part").orderBy("uid")) - 1
    number = join_counted(again, materialize(parts, "mix-parts"), ["key", "h", "part"]).select("uid", "h", (F.col("before") + inside).alias("k"))
    return materialize(number.select("uid", F.when(F.col("k") == 0, F.col("h")).otherwise(F.xxhash64("h", "k")).alias("u")), "mix-numbered")


def cut_places(rows: DataFrame, counts: DataFrame, with_sources) -> DataFrame:
    """(key, cut_o, cut_block, cut_u): the last row, in the order of blocks and
    of rows in them, before which less than ``rest`` tokens lie.  ``rows``:
    (key, tokens, u, o, block, rest) of the sources with a rest;
    ``with_sources`` joins rows with a table of one row for each source."""
    run = lambda *order: Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def last(df: DataFrame, *order: str) -> DataFrame:
        """The last part, in order, before which the rest is not used up."""
        ahead = F.col("base") + F.coalesce(F.sum("t").over(run(*order)), F.lit(0))
        df = df.withColumn("ahead", ahead).where("ahead < rest")
        return df.groupBy("key").agg(F.max(F.struct(*order, "ahead")).alias("x")).select("key", *[F.col(f"x.{c}").alias(f"cut_{c}") for c in order], F.col("x.ahead").alias("cut_base"))

    ranged = rows.withColumn("range", F.shiftright("o", 64 - RANGE_BITS))
    total = ranged.groupBy("key", "range", "rest").agg(F.sum("tokens").alias("t")).withColumn("base", F.lit(0))
    r = materialize(last(total, "range").join(counts, "key"), "mix-ranges")
    some = with_sources(ranged, r.withColumnRenamed("cut_base", "base")).where("range = cut_range")
    b = last(some.groupBy("key", "o", "block", "rest", "base").agg(F.sum("tokens").alias("t")), "o", "block")
    b = materialize(b.join(counts, "key"), "mix-blocks")
    some = with_sources(rows, b.withColumnRenamed("cut_base", "base")).where("o = cut_o AND block = cut_block")
    u = last(some.groupBy("key", "u", "rest", "base").agg(F.sum("tokens").alias("t")), "u").drop("cut_base")
    return materialize(b.drop("cut_base", "n").join(u, "key"), "mix-cuts")


def mix(docs: DataFrame, entropy_gain: float = 0.5, max_repeats: float = 4.0, budget_ratio: float = 1.0, seed: int = 42, columns: list[str] | None = None, slots: bool = True) -> DataFrame:
    """Rows of the mix: the ``columns`` of ``docs`` (by default doc_id and
    source), then mix_tokens, mix_weight, mix_epoch, mix_block and, with
    ``slots``, mix_slot: the row's place in its block."""
    row = F.struct(*columns_of(docs.select(*(columns or ["doc_id", "source"]))))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    h = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")), F.lit(seed))
    base = materialize(docs.select(F.monotonically_increasing_id().alias("uid"), row.alias("row"), key.alias("key"), token_count(F.col("text")).alias("tokens"), h.alias("h")), "mix-rows")
    sources = materialize(base.groupBy("key").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")), "mix-sources")
    total, n_sources = sources.agg(F.sum("t"), F.count("*")).first()
    shares = sources.where("t > 0").select((F.col("t") / F.lit(float(total or 1))).alias("share"))
    a = temperature(shares, entropy_gain, max_repeats, budget_ratio)
    z = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(float(total or 1)), F.lit(a)) / F.lit(z)).otherwise(0.0)
    s = sources.select("key", "n", weight.alias("mix_weight"), "t", F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("blocks"))
    s = s.withColumn("quota", F.col("mix_weight") * F.lit(float(total or 0) * budget_ratio))
    # A source without tokens has no share to weigh: its rows stay once.
    s = s.withColumn("full", F.when(F.col("t") > 0, F.floor(F.col("quota") / F.col("t") + 1e-9)).otherwise(1).cast("long"))
    s = materialize(s.select("key", "n", "mix_weight", "blocks", "full", F.greatest(F.col("quota") - F.col("full") * F.col("t"), F.lit(0.0)).alias("rest")), "mix-weights")

    def with_sources(df: DataFrame, right: DataFrame) -> DataFrame:
        return df.join(F.broadcast(right), "key") if n_sources <= BROADCAST_SOURCES else join_counted(df, right, ["key"])

    repeats = numbered_repeats(base.select("uid", "key", "h"))
    placed = base.withColumn("u", F.col("h")) if repeats is None else base.join(repeats, "uid", "left").withColumn("u", F.coalesce("u", "h"))
    block = F.pmod(F.col("u"), F.col("blocks"))
    order = F.xxhash64("key", "block", F.lit(seed))
    lean = with_sources(placed.select("key", "tokens", "u"), s).where("rest > 0").withColumn("block", block).withColumn("o", order)
    cuts = s.join(cut_places(lean.select("key", "tokens", "u", "o", "block", "rest"), s.select("key", "n"), with_sources), "key", "left")
    rows = with_sources(placed, materialize(cuts, "mix-sources-cut")).withColumn("block", block).withColumn("o", order)
    inside = (F.col("o") < F.col("cut_o")) | (
        (F.col("o") == F.col("cut_o")) & ((F.col("block") < F.col("cut_block")) | ((F.col("block") == F.col("cut_block")) & (F.col("u") <= F.col("cut_u"))))
    )
    copies = F.col("full") + F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    more = [F.col("block").alias("mix_block")]
    if slots:
        rows = rows.withColumn("slot", F.row_number().over(Window.partitionBy("key", "block").orderBy("u", "h", "uid")).cast("long"))
        more.append(F.col("slot").alias("mix_slot"))
    rows = rows.withColumn("copies", copies).where("copies > 0")
    return rows.select("row.*", F.col("tokens").alias("mix_tokens"), "mix_weight", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("mix_epoch"), *more)


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.round("mix_weight", 9).alias("weight"), F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"), F.col("mix_slot").alias("slot"))
