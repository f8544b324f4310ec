"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes chooses where a chunk ends, so an
insertion moves at most the borders next to it.  Chunks are deduplicated by a
128-bit digest: the first occurrence (smallest doc_id, then first byte) stays
and all later ones go.  Chunks of under ``min_bytes`` are joined to the next
cut; a stretch without a cut ends at ``max_bytes``.

A lone repeated chunk may be a stock phrase: a chunk goes only in a run of
repeated chunks of ``min_run`` bytes together (0: every repeated chunk goes).

Cases: a null or empty text has no chunk; each row is judged on its own, rows
that share a doc_id in the order of their texts' hashes, null doc_ids last in
the same way; of rows with equal id and text all but one lose every run; of
equal chunks at equal places of rows whose id and hash agree though their texts
differ both stay; a very long text is chunked in blocks and costs in proportion
to its length; other columns of the input are not read, so their names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST, docs_of, join_counted, materialize, place_of, repeated_rows, row_blocks, row_order, table, text_column

MIN_BYTES, MASK_BITS, MAX_BYTES, MIN_RUN = 24, 6, 1024, 64
#: Finer chunks, for passages of some 50 words: what the query uses.
FINE_BYTES, FINE_BITS = 12, 5
#: The gear table: one 32-bit number for each byte.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - k]] << k over the last 32 bytes, by doubling."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        tail = h[:-k] << np.uint32(k)
        h = h.copy()
        h[k:] += tail
    return h


def chunk_ends(h: np.ndarray, lo: int, hi: int, cuts: np.ndarray, min_bytes: int, max_bytes: int) -> list[int]:
    """Ends of the chunks of one row [lo, hi); ``cuts``: ends that the hash
    proposes, in order.  Cuts within 32 bytes of the row's start saw bytes
    of the row before and are skipped."""
    ends, last = [], lo
    for c in cuts:
        if c - lo < 32:
            continue
        while c - last > max_bytes:
            last += max_bytes
            ends.append(last)
        if c - last >= min_bytes:
            ends.append(c)
            last = c
    while hi - last > max_bytes:
        last += max_bytes
        ends.append(last)
    if hi > last:
        ends.append(hi)
    return ends


KINDS = pa.schema([("uid", pa.int64()), ("ord", pa.int64()), ("th", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("digest", pa.binary())])


def chunk_batches(batches: Iterator[pa.RecordBatch], min_bytes: int, mask_bits: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """(uid, ord, th, text) to (uid, ord, th, first, last, digest): one row for
    each chunk, and one with first -1 for the text itself."""
    mask = np.uint32(((1 << mask_bits) - 1) << (32 - mask_bits))
    for b in batches:
        data, offsets = text_column(b, "text")
        keys = [b[c].to_numpy(zero_copy_only=False) for c in ("uid", "ord", "th")]
        for i, j in row_blocks(offsets, 1 << 20):
            base = offsets[i]
            part = data[base : offsets[j]]
            cuts = np.flatnonzero((gear_hash(part) & mask) == 0) + 1
            edges = np.searchsorted(cuts, offsets[i : j + 1] - base, "right")
            raw, rows, first, last, digest = part.tobytes(), [], [], [], []
            for k in range(j - i):
                lo, hi = int(offsets[i + k] - base), int(offsets[i + k + 1] - base)
                rows.append(i + k)
                first.append(-1)
                last.append(hi - lo)
                digest.append(hashlib.blake2b(raw[lo:hi], digest_size=16).digest())
                at = lo
                for end in chunk_ends(part, lo, hi, cuts[edges[k] : edges[k + 1]].tolist(), min_bytes, max_bytes):
                    rows.append(i + k)
                    first.append(at - lo)
                    last.append(end - lo)
                    digest.append(hashlib.blake2b(raw[at:end], digest_size=16).digest())
                    at = end
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[rows], pa.int64()) for x in keys], pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(digest, pa.binary())],
                schema=KINDS,
            )


def keyed(docs: DataFrame) -> DataFrame:
    d = docs_of(docs)
    return d.select(F.monotonically_increasing_id().alias("uid"), *row_order(), "doc_id", "text")


def chunks_of(rows: DataFrame, min_bytes: int = MIN_BYTES, mask_bits: int = MASK_BITS, max_bytes: int = MAX_BYTES) -> DataFrame:
    kind = "uid long, ord long, th long, first int, last int, digest binary"
    return rows.select("uid", "ord", "th", "text").mapInArrow(lambda it: chunk_batches(it, min_bytes, mask_bits, max_bytes), kind)


def _run_batches(batches: Iterator[pa.RecordBatch], min_run: int) -> Iterator[pa.RecordBatch]:
    """(uid, c: sorted chunks that go) to (uid, spans, owners): chunks next to
    each other make a run, and runs of min_run bytes are spans."""
    for b in batches:
        c = b["c"]
        flat = c.flatten()
        first, last, by = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
        size = c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        new = np.ones(len(first), bool)
        new[1:] = (row[1:] != row[:-1]) | (first[1:] != last[:-1])
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(first)]]) - 1
        long = last[end] - first[begin] >= min_run if len(begin) else np.zeros(0, bool)
        held = np.repeat(long, np.diff(np.concatenate([begin, [len(first)]]))) if len(begin) else long
        lo, hi, own = first[begin[long]], last[end[long]], row[begin[long]]
        # The owners of each row: sorted, once each.
        who = np.unique(np.stack([row[held], by[held]], 1), axis=0) if held.any() else np.zeros((0, 2), np.int64)
        some = np.unique(own)
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(own, np.append(some, len(size))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["first", "last"]),
        )
        owners = pa.ListArray.from_arrays(pa.array(np.searchsorted(who[:, 0], np.append(some, len(size))), pa.int32()), pa.array(who[:, 1], pa.int64(), mask=who[:, 1] == LAST))
        yield pa.RecordBatch.from_arrays([b["uid"].take(pa.array(some)), spans, owners], names=["uid", "spans", "owners"])


def repeated_spans(chunks: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(uid, spans, owners): the byte ranges to remove, as long as possible,
    and the documents that keep what they hold (null for one without an id).

    ``chunks`` is a written table of ``chunks_of``.  Counts and owners are
    partial sums; the join that carries them back leaves hot digests' rows
    where they are."""
    copies = repeated_rows(chunks.where("first < 0"))
    own = chunks.where("first >= 0")
    if copies is not None:
        again = own.join(copies, "uid", "left_semi").select("uid", "first", "last", F.col("ord").alias("by"))
        own = own.join(copies, "uid", "left_anti")
    own = own.withColumn("place", place_of("first"))
    owner = own.groupBy("digest").agg(F.count("*").alias("n"), F.min("place").alias("owner"), F.min_by("ord", "place").alias("by")).where("n > 1")
    owner = materialize(owner, "chunk-owners")
    hit = join_counted(own.select("uid", "first", "last", "digest", "place"), owner, ["digest"]).where("place <> owner").select("uid", "first", "last", "by")
    if copies is not None:
        hit = hit.unionByName(again)
    # A document's own chunks only: as many as the document is long.
    c = hit.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "last", "by"))).alias("c"))
    return c.mapInArrow(lambda it: _run_batches(it, min_run), "uid long, spans array<struct<first:int,last:int>>, owners array<long>")


def substring_dedup(docs: DataFrame, min_run: int = MIN_RUN, min_bytes: int = MIN_BYTES, mask_bits: int = MASK_BITS) -> DataFrame:
    """(doc_id, n_bytes, spans, owners) of every row; spans is null where
    nothing goes."""
    chunks = materialize(chunks_of(keyed(docs), min_bytes, mask_bits), "chunks")
    one = chunks.where("first < 0").select("uid", F.when(F.col("ord") != LAST, F.col("ord")).alias("doc_id"), F.col("last").cast("long").alias("n_bytes"))
    return one.join(repeated_spans(chunks, min_run), "uid", "left").drop("uid")


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, spans in zip(b["text"].to_pylist(), b["spans"].to_pylist()):
            raw, at, kept = text.encode(), 0, []
            for s in spans or ():
                kept.append(raw[at : s["first"]])
                at = s["last"]
            out.append(b"".join([*kept, raw[at:]]))
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(out, pa.binary())], names=["doc_id", "kept"])


def cleaned_bytes(docs: DataFrame, min_run: int = MIN_RUN, min_bytes: int = MIN_BYTES, mask_bits: int = MASK_BITS) -> DataFrame:
    """(doc_id, kept): the bytes that stay; a cut can fall inside a character."""
    rows = materialize(keyed(docs), "chunk-rows")
    gone = repeated_spans(materialize(chunks_of(rows, min_bytes, mask_bits), "chunks"), min_run)
    return rows.join(gone, "uid", "left").select("doc_id", "text", "spans").mapInArrow(_cut_batches, "doc_id long, kept binary")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, bytes removed, the ranges, and who keeps them.
    Repeated chunks go in runs of MIN_RUN bytes and more."""
    r = substring_dedup(table(spark, sf_dir, "documents"), MIN_RUN, FINE_BYTES, FINE_BITS)
    text = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["first"].cast("string"), x["last"].cast("string"))), ",")
    return r.select(
        "doc_id", "n_bytes",
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"]), F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(text, F.lit("")).alias("spans"),
        F.coalesce("owners", F.array().cast("array<long>")).alias("owners"),
    )
