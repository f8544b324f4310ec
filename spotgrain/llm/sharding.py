"""Sharding by histogram sort.

Rows are ordered by a 60-bit key: 24 bits of the text's hash, 24 bits of the
id's, 12 bits of a row number's, so that a text, or an id, that a third of all
rows share still has keys to cut between.  Bytes and rows below candidate
boundaries are counted exactly over all partitions; the bins that hold a
splitter, or too many rows, are probed again with finer candidates, until every
splitter meets the tolerance or the key has no bits left.  Rows then move once,
dealt by the final bins.

Law: ``bytes`` (UTF-8 bytes of the text plus 1 are near equal; off by about
half a document where one is larger than the tolerance).

Cases: a null or empty text has size 1; a null doc_id is kept; rows that share
an id, or all of a row, get slots of their own, and which of two equal rows
gets which slot is open; a very long text counts in its bin like any other and
may fill shards' bounds on its own; other columns are not read, so their names
cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, table

#: Bits that each round of probes adds; their sum is the width of the key.
ROUNDS = (16, 8, 8, 8, 8, 12)
WIDTH = sum(ROUNDS)


def sort_key(text, doc_id, row):
    part = lambda c, bits, seed: F.shiftrightunsigned(F.xxhash64(c, F.lit(seed)), 64 - bits)
    return F.shiftleft(part(text, 24, 0), 36).bitwiseOR(F.shiftleft(part(doc_id, 24, 1), 12)).bitwiseOR(part(row, 12, 2))


def probe(keyed: DataFrame, n_shards: int, tolerance: float, piece: int) -> list[tuple[int, int, int, int]]:
    """Bins (round, prefix, rows, bytes) in key order, refined until done.
    Only bins with a splitter (fewer than shards) or over a 32768th of all
    rows (fewer than 32768, and twice what the first bins hold on average) are
    refined, so a round counts a bounded number of bins and
    only they come to the driver."""
    leaves: dict[tuple[int, int], tuple[int, int]] = {}
    bits, rows, refine = 0, keyed, None
    for k, more in enumerate(ROUNDS):
        bits += more
        prefix = F.shiftrightunsigned("ord", WIDTH - bits)
        if refine is not None:
            wanted = keyed.sparkSession.createDataFrame([(x,) for x in refine], "up long")
            rows = keyed.join(F.broadcast(wanted), F.shiftrightunsigned("ord", WIDTH - bits + more) == F.col("up"), "left_semi")
        for p, n, b in rows.groupBy(prefix.alias("p")).agg(F.count("*"), F.sum("size")).collect():
            leaves[k, p] = (n, b)
        order = sorted(leaves, key=lambda x: x[1] << (WIDTH - sum(ROUNDS[: x[0] + 1])))
        total_rows, total = (sum(v[i] for v in leaves.values()) for i in (0, 1))
        near = tolerance * total / n_shards
        targets = [total * j / n_shards for j in range(1, n_shards)]
        at, refine = 0, []
        for x in order:
            n, b = leaves[x]
            inside = any(at + near < t < at + b - near for t in targets[bisect_left(targets, at) : bisect_left(targets, at + b)])
            at += b
            if x[0] == k and n > 1 and (inside or n > max(piece, total_rows / 32768)):
                refine.append(x[1])
        if not refine or k == len(ROUNDS) - 1:
            return [(*x, *leaves[x]) for x in order]
        for p in refine:
            del leaves[k, p]
    return []


def place(leaves: list[tuple[int, int, int, int]], n_shards: int) -> list[tuple[int, int, int, int]]:
    """(round, prefix, shard, first slot) of each bin: a splitter is the bin
    edge nearest to its target."""
    total = sum(x[3] for x in leaves)
    edges = [0]
    for x in leaves:
        edges.append(edges[-1] + x[3])
    splitters = []
    for j in range(1, n_shards):
        t = total * j / n_shards
        i = bisect_left(edges, t)
        splitters.append(i - 1 if i and (i == len(edges) or t - edges[i - 1] <= edges[i] - t) else i)
    out, slot, last = [], 0, -1
    for i, (k, p, n, _) in enumerate(leaves):
        shard = sum(s <= i for s in splitters)
        slot = slot if shard == last else 0
        out.append((k, p, shard, slot))
        slot, last = slot + n, shard
    return out


def histogram_shards(docs: DataFrame, n_shards: int = 16, tolerance: float = 1e-4, piece: int = 1024) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    spark = docs.sparkSession
    d = docs_of(docs)
    keyed = materialize(
        d.select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            sort_key(F.col("text"), F.col("doc_id"), F.monotonically_increasing_id()).alias("ord"),
        ),
        "shard-keys",
    )
    placed = place(probe(keyed, n_shards, tolerance, piece), n_shards)
    out, bits = keyed, 0
    rounds = max((x[0] for x in placed), default=0) + 1
    for k, more in enumerate(ROUNDS[:rounds]):
        bits += more
        bins = [(p, s, b, i) for i, (at, p, s, b) in enumerate(placed) if at == k]
        t = spark.createDataFrame(bins, f"p{k} long, s{k} int, b{k} long, i{k} int")
        out = out.join(F.broadcast(t), F.shiftrightunsigned("ord", WIDTH - bits) == F.col(f"p{k}"), "left").drop(f"p{k}")
    pick = lambda c: F.coalesce(*[F.col(f"{c}{i}") for i in range(rounds)])
    out = out.select("doc_id", "size", "text_crc32", "ord", pick("s").alias("shard"), pick("b").alias("base"), pick("i").alias("bin"))
    slot = F.expr("row_number() OVER (PARTITION BY bin ORDER BY ord, text_crc32, doc_id)") - 1
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + slot).cast("long").alias("slot"))


def op5_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_result(table(spark, sf_dir, "documents"))


def shard_result(docs: DataFrame) -> DataFrame:
    s = histogram_shards(docs, 16)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
