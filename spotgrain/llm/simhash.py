"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes over 3-word shingles (XXH64, seed 42).  Two
link at 3 or fewer differing bits, and components of links are the classes.

Equal fingerprints become one row first.  Of five blocks of bits, two
fingerprints that link agree on two at least, so each fingerprint goes to ten
buckets.  A bucket is searched with the index: fingerprints in Gray rank
order, nodes of 16 neighbours above them and so on up; a node keeps the bits
that all below it share and its parent has not; the differences from the query
add up on the way down, and a group over 3 is pruned whole, as is one whose
members are all linked to the query already.  A bucket of up to 16 is one leaf.
The bits that a bucket of over DENSE fingerprints leaves open are cut into five
blocks again, and after that once more, so a group has 2^15 members at most and
a row of a dense bucket is copied tenfold each time.  A bucket passes on one
edge for each fingerprint that is not the root of its links, never all pairs.

``near_dedup`` judges by similarity: five-word shingles, Jaccard 0.8 and more.
Its candidates are components of the same index over TABLES SimHashes of the
different words of a text; within a component the first rows are kept as
centres, and a row goes if it is as similar as that to a kept centre.

Cases: null and empty texts have fingerprint zero and link like any other
(they are alike for ``near_dedup``); a null doc_id is kept and never names a
component unless alone; rows that share an id are told apart by a row number,
in the order of their texts' hashes; repeated rows are rows of one component,
of which ``near_dedup`` keeps one; very long texts are hashed in bounded parts;
``near_dedup`` carries the caller's columns in one struct, so no name can
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import columns_of, docs_of, ids_of, join_counted, materialize, release, row_blocks, row_order, scratch_dir, table, text_column

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}
RADIUS = 3
FAN = 16
#: A bucket of more fingerprints is cut by further bits, if it has any to spare.
DENSE = 8192
#: Word fingerprints of ``near_dedup``, and centres of a component in its first round.
TABLES, CENTRES = 6, 32
WIDTH, SIMILAR = 5, 0.8
#: Rows of a component that are compared with its centres in one task.
PART_ROWS = 256
#: Up to so many row numbers (some MB) are broadcast; of more, an exchange joins them.
BROADCAST_ROWS = 1_000_000


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_slices(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many slices of ``buf``, those of one length together."""
    import xxhash

    out = np.empty(len(start), np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lane8 = np.ndarray((len(buf) + 1,), np.uint64, padded, 0, (1,))
    lane4 = np.ndarray((len(buf) + 5,), np.uint32, padded, 0, (1,))
    s = np.uint64(seed)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    raw = buf.tobytes() if len(sizes) and sizes[-1] >= 64 else b""
    for size, a, b in zip(sizes.tolist(), first, [*first[1:], len(order)]):
        rows = order[a:b]
        at = start[rows]
        if size >= 64:
            out[rows] = [xxhash.xxh64_intdigest(raw[i : i + size], seed) for i in at.tolist()]
            continue
        n, done = np.uint64(size), 0
        with np.errstate(over="ignore"):
            if size >= 32:
                v = [_rotl(lane8[at + 8 * k] * P2 + x, 31) * P1 for k, x in enumerate((s + P1 + P2, s + P2, s, s - P1))]
                h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
                for x in v:
                    h = (h ^ (_rotl(x * P2, 31) * P1)) * P1 + P4
                h += n
                done = 32
            else:
                h = np.full(len(at), s + P5 + n, np.uint64)
            while size - done >= 8:
                h = _rotl(h ^ (_rotl(lane8[at + done] * P2, 31) * P1), 27) * P1 + P4
                done += 8
            if size - done >= 4:
                h = _rotl(h ^ (lane4[at + done].astype(np.uint64) * P1), 23) * P2 + P3
                done += 4
            while done < size:
                h = _rotl(h ^ (buf[at + done].astype(np.uint64) * P5), 11) * P1
                done += 1
            h = (h ^ (h >> np.uint64(33))) * P2
            h = (h ^ (h >> np.uint64(29))) * P3
        out[rows] = h ^ (h >> np.uint64(32))
    return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, one space after each: (bytes, word starts, word ends, words by row)."""
    n, rows = int(offsets[-1] - offsets[0]), len(offsets) - 1
    ends = offsets[1:] - offsets[0] + np.arange(rows)
    spaced = np.full(n + rows, 32, np.uint8)
    keep = np.ones(n + rows, bool)
    keep[ends] = False
    spaced[keep] = LOWER[data[offsets[0] : offsets[-1]]]
    blank = SPACE[spaced]
    before = np.concatenate([[True], blank[:-1]])
    keep = ~(blank & before)
    buf = np.where(blank, np.uint8(32), spaced)[keep]
    stops = np.flatnonzero(blank[keep])
    starts = np.concatenate([[0], stops[:-1] + 1]).astype(np.int64) if len(stops) else np.zeros(0, np.int64)
    row_end = np.cumsum(keep)[ends]  # bytes kept up to each row's end
    upto = np.searchsorted(stops, row_end - 1, "right")
    return buf, starts, stops, np.diff(np.concatenate([[0], upto]))


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, width: int = 3) -> np.ndarray:
    """The SimHash of each row of a block of texts."""
    buf, starts, stops, words = words_of(data, offsets)
    rows = len(words)
    shingles = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(words)[:-1]])
    begin = np.concatenate([[0], np.cumsum(shingles)[:-1]])
    total = int(shingles.sum())
    out = np.zeros(rows, np.uint64)
    if not total:
        return out
    row = np.repeat(np.arange(rows), shingles)
    word = np.arange(total) - begin[row] + first[row]
    last = word + np.minimum(words[row], width) - 1
    h = xxh64_slices(buf, starts[word], stops[last] - starts[word])
    some = np.flatnonzero(shingles)
    out[some] = majority(h, begin[some], shingles[some])
    return out


def majority(h: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each group of hashes, one after the other: the bits that are set in
    over half of them."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.empty((len(begin), 64), np.int64)
    at = 0
    while at < len(begin):  # a bounded part at a time: sums need wider numbers
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + 65536)))
        lo, hi = begin[at], begin[to] if to < len(begin) else len(h)
        counts[at:to] = np.add.reduceat(bits[lo:hi], begin[at:to] - lo, axis=0, dtype=np.int32)
        at = to
    on = (2 * counts > size[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1, bitorder="little").view("<u8")[:, 0]


def word_fingerprints(data: np.ndarray, offsets: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """rows x tables: SimHashes of the different words of each row."""
    buf, starts, stops, words = words_of(data, offsets)
    out = np.zeros((len(words), tables), np.uint64)
    if not len(starts):
        return out
    row = np.repeat(np.arange(len(words)), words)
    h = xxh64_slices(buf, starts, stops - starts)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])
    row, h = row[new], h[new]
    some, begin = np.unique(row, return_index=True)
    size = np.diff(np.concatenate([begin, [len(row)]]))
    for t in range(tables):
        with np.errstate(over="ignore"):
            x = (h ^ np.uint64((t + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * P2
            x = (x ^ (x >> np.uint64(29))) * P3
        out[some, t] = majority(x ^ (x >> np.uint64(32)), begin, size)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_column(b, "text")
        fp = np.zeros(len(offsets) - 1, np.uint64)
        for i, j in row_blocks(offsets, 1 << 20):
            fp[i:j] = fingerprints_of(data, offsets[i : j + 1])
        yield pa.RecordBatch.from_arrays([ids_of(b), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    return docs_of(docs).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


class GrayIndex:
    """The hierarchical index over fingerprints in Gray rank order."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.levels = fps, []
        both, either = fps, fps
        while len(both) > 1:
            starts = np.arange(0, len(both), FAN)
            both, either = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(either, starts)
            self.levels.append((~(both ^ either), both))
        self.levels.reverse()  # the root first

    def classes(self, root: np.ndarray) -> list[np.ndarray]:
        """For each level, the class that all below a node are in, or -1."""
        low, high, out = root, root, []
        while len(low) > 1:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            out.append(np.where(low == high, low, -1))
        return out[::-1]

    def links(self, lo: int, hi: int, root: np.ndarray, classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), lo <= i < hi and i < j, within RADIUS and of two
        classes so far: a group wholly of the query's class is pruned too."""
        q = np.arange(lo, hi)
        node, acc = np.zeros(len(q), np.int64), np.zeros(len(q), np.uint8)
        above = None
        for k, (mask, pattern) in enumerate(self.levels):
            own = mask[node] if above is None else mask[node] & ~above
            acc = acc + np.bitwise_count((self.fps[q] ^ pattern[node]) & own)
            ok = (acc <= RADIUS) & (classes[k][node] != root[q])
            q, node, acc = q[ok], node[ok], acc[ok]
            above = mask[node]
            width = len(self.levels[k + 1][0]) if k + 1 < len(self.levels) else len(self.fps)
            span = FAN ** (len(self.levels) - 1 - k)
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            q, acc, above = np.repeat(q, FAN), np.repeat(acc, FAN), np.repeat(above, FAN)
            ok = (child < width) & ((child + 1) * span - 1 > q)
            q, node, acc, above = q[ok], child[ok], acc[ok], above[ok]
        if above is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ok = (acc + np.bitwise_count((self.fps[q] ^ self.fps[node]) & ~above) <= RADIUS) & (node > q) & (root[node] != root[q])
        return q[ok], node[ok]


def joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root``, the smallest index linked to each, after the links (i, j) too."""
    while True:
        a, b = root[i], root[j]
        far = a != b
        if not far.any():
            return root
        i, j, a, b = i[far], j[far], a[far], b[far]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def group_edges(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, root) that connect what links within one bucket."""
    fps = np.unique(fps)
    fps = fps[np.argsort(gray_rank(fps), kind="stable")]
    n, step = len(fps), 256
    root = np.arange(n)
    # Neighbours in Gray order first: most of a dense group is one class then.
    for k in range(1, min(FAN, n)):
        i = np.flatnonzero(np.bitwise_count(fps[k:] ^ fps[:-k]) <= RADIUS)
        root = joined(root, i, i + k)
    index = GrayIndex(fps)
    classes = index.classes(root)
    for lo in range(0, n, step):
        i, j = index.links(lo, min(lo + step, n), root, classes)
        if len(i):
            root = joined(root, i, j)
            classes = index.classes(root)
    own = np.flatnonzero(root != np.arange(n))
    return fps[own], fps[root[own]]


def small_group_edges(group: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for groups of up to FAN rows, all of one leaf: each row against
    its next, second next, ... neighbour within the group."""
    left, right = [], []
    for k in range(1, FAN):
        if len(fps) <= k:
            break
        hit = np.flatnonzero((group[k:] == group[:-k]) & (np.bitwise_count(fps[k:] ^ fps[:-k]) <= RADIUS))
        left.append(fps[hit + k])
        right.append(fps[hit])
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def _bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, fp) sorted by group, to edges (src, dst)."""

    def edges(group: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.diff(group)) + 1
        first = np.concatenate([[0], cut])
        size = np.diff(np.concatenate([first, [len(group)]]))
        small = np.repeat(size <= FAN, size)
        found = [small_group_edges(group[small], fps[small])]
        found += [group_edges(fps[a : a + n]) for a, n in zip(first[size > FAN], size[size > FAN])]
        a, b = (np.concatenate([x[k] for x in found]).view(np.int64) for k in (0, 1))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["src", "dst"])

    rest: tuple | None = None
    for b in batches:
        got = tuple(b[k].to_numpy(zero_copy_only=False) for k in ("g", "fp"))
        got = tuple(np.concatenate(x) for x in zip(rest, got)) if rest else got
        g = got[0]
        if not len(g):
            continue
        group = np.cumsum(np.concatenate([[False], g[1:] != g[:-1]]))
        whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
        if whole:
            yield from edges(group[:whole], got[1][:whole].view(np.uint64))
        rest = tuple(x[whole:] for x in got)
    if rest and len(rest[0]):
        yield from edges(np.zeros(len(rest[0]), np.int64), rest[1].view(np.uint64))


def bucketed(rows: DataFrame, width: int) -> tuple[DataFrame, int]:
    """(g, fp, open) to ten rows each: ``open``, of ``width`` bits, is cut into
    five blocks; two of them join the group, the others stay open.  Also the
    number of bits that stay.  That two groups share a hash costs time only."""
    size = [width // 5 + (k < width % 5) for k in range(5)]
    part = [F.shiftrightunsigned("open", sum(size[:k])).bitwiseAND((1 << size[k]) - 1) for k in range(5)]
    keys = []
    for n, (i, j) in enumerate(combinations(range(5), 2)):
        left, at = F.lit(0).cast("long"), 0
        for k in range(5):
            if k not in (i, j):
                left, at = left.bitwiseOR(F.shiftleft(part[k], at)), at + size[k]
        keys.append(F.struct(F.xxhash64("g", F.lit(n), part[i], part[j]).alias("g"), left.alias("open")))
    return rows.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.g", "fp", "k.open"), width - sum(sorted(size)[:2])


def fingerprint_edges(fps: DataFrame) -> DataFrame:
    """(src, dst) over distinct fingerprints (columns g, a table's number, and
    fp): connects all of a table that link."""
    rows, width = bucketed(fps.select("g", "fp", F.col("fp").alias("open")), 64)
    dealt = None
    for _ in range(2):
        # Counts per bucket: partial sums, then one small row for each dense one.
        dense = materialize(rows.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > DENSE), "simhash-dense")
        n_dense = dense.count()
        if not n_dense:
            break
        few = F.broadcast(dense.select("g")) if n_dense <= BROADCAST_ROWS else dense.select("g")
        plain = rows.join(few, "g", "left_anti").select("g", "fp")
        dealt = plain if dealt is None else dealt.unionByName(plain)
        rows, width = bucketed(join_counted(rows, dense, ["g"]).select("g", "fp", "open"), width)
    dealt = rows.select("g", "fp") if dealt is None else dealt.unionByName(rows.select("g", "fp"))
    dealt = dealt.repartition("g").sortWithinPartitions("g")
    return dealt.mapInArrow(_bucket_batches, "src long, dst long").distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    spark = docs.sparkSession
    fps = materialize(fingerprints(docs), "simhash-fp")
    once = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = materialize(fingerprint_edges(once.select(F.lit(0).alias("g"), "fp")), "simhash-edges")
    comp = connected_components(edges, checkpoint_dir=scratch_dir(spark)).select(F.col("node").alias("fp"), "component")
    linked = once.join(comp, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(linked.join(ids, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def word_fps(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in column:
        out = []
        for at in range(0, len(s), 1000):  # a bounded part of the batch at a time
            data, offsets = text_column(pa.RecordBatch.from_arrays([pa.array(s.iloc[at : at + 1000], pa.large_string())], names=["text"]), "text")
            for i, j in row_blocks(offsets, 1 << 19):
                out += list(word_fingerprints(data, offsets[i : j + 1]).view(np.int64))
        yield pd.Series(out, dtype=object)


def candidate_components(rows: DataFrame) -> DataFrame:
    """(uid, component) for the rows of a written table (uid, fps) that share
    a component of links in any table with another row."""
    spark = rows.sparkSession
    # Rows with all fingerprints equal first: they have one representative.
    reps = materialize(rows.groupBy("fps").agg(F.min("uid").alias("rep"), F.count("*").alias("n")), "simhash-reps")
    tables = reps.select("rep", F.posexplode("fps").alias("g", "fp"))
    once = materialize(tables.groupBy("g", "fp").agg(F.min("rep").alias("least"), F.count("*").alias("n")), "simhash-tables")
    links = materialize(fingerprint_edges(once.select("g", "fp")), "simhash-links")
    # A fingerprint's table is not carried: it names the row that has it, and a row is one node for all tables.
    named = once.select("fp", "least")
    far = links.join(named.withColumnsRenamed({"fp": "src", "least": "a"}), "src").join(named.withColumnsRenamed({"fp": "dst", "least": "b"}), "dst").select("a", "b")
    same = join_counted(tables, once.where("n > 1"), ["g", "fp"]).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    edges = materialize(far.unionByName(same).where("a <> b").distinct(), "simhash-pairs")
    comp = connected_components(edges, "a", "b", checkpoint_dir=scratch_dir(spark)).withColumnsRenamed({"node": "rep"})
    # All rows of a linked representative, and of one that stands for several.
    known = reps.join(comp, "rep", "left").where("n > 1 OR component IS NOT NULL").select("fps", "n", F.coalesce("component", "rep").alias("component"))
    return join_counted(rows.select("uid", "fps"), materialize(known, "simhash-known"), ["fps"]).select("uid", "component")


def shingle_set(text: str, width: int) -> set[int]:
    """64-bit hashes of the shingles: an eighth of the memory, and as good as
    the shingles within one process."""
    words = re.findall("[^\x20\x09-\x0d]+", text.translate(ASCII_LOWER))
    return {hash(x) for x in zip(*[words[k:] for k in range(width)])} if len(words) >= width else {hash(tuple(words))}


def _centre_batches(batches: Iterator[pa.RecordBatch], width: int, similar: float) -> Iterator[pa.RecordBatch]:
    """Rows (component, salt, rank, uid, text), a group's centres (rank not 0)
    first, to (uid, verdict): 1 stays, -1 goes, 0 not decided."""
    group, index, sizes = None, {}, []
    for b in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
        uids, verdicts = [], []
        for component, salt, rank, uid, text in zip(*[b[c].to_pylist() for c in ("component", "salt", "rank", "uid", "text")]):
            if group != (component, salt):
                group, index, sizes = (component, salt), {}, []
            own, hits = shingle_set(text, width), Counter()
            for x in own:
                if x in index:
                    hits.update(index[x])
            near = any(n >= similar * (len(own) + sizes[k] - n) for k, n in hits.items())
            if rank and not near:
                for x in own:
                    index.setdefault(x, []).append(len(sizes))
                sizes.append(len(own))
            if not rank or not salt:  # every salt has the centres, the first reports them
                uids.append(uid)
                verdicts.append(-1 if near else 1 if rank else 0)
        yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(verdicts, pa.int32())], names=["uid", "verdict"])


def near_dedup(docs: DataFrame, width: int = WIDTH, similar: float = SIMILAR, part_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` without the rows that are near copies of a row that stays."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    order = row_order("doc_id", "plain")
    keyed = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*columns_of(docs)).alias("row"), text.alias("plain"), F.col("doc_id").cast("long").alias("doc_id"))
    base = materialize(keyed.select("uid", "row", *order, F.pandas_udf(word_fps, "array<long>")(F.col("plain")).alias("fps")), "simhash-rows")
    comp = materialize(candidate_components(base.select("uid", "fps")), "simhash-members")
    n_members = comp.count()
    if not n_members:
        return base.select("row.*")
    small = F.broadcast(comp) if n_members <= BROADCAST_ROWS else comp
    body = F.coalesce(F.col("row")["text"], F.lit(""))
    left = materialize(base.join(small, "uid").select("uid", "component", "ord", "th", body.alias("text")), "simhash-bodies")
    gone, centres = [], CENTRES
    while True:
        # The first rows of each component are its centres; they go to every part of a large one.
        # Parts of a component name their first rows before they meet, so no task gets more than some of each part.
        keys = left.select("uid", "component", "ord", "th", F.pmod(F.xxhash64("uid"), F.lit(64)).alias("part"))
        ranked = keys.withColumn("rank", F.row_number().over(Window.partitionBy("component", "part").orderBy("ord", "th", "uid"))).where(F.col("rank") <= centres)
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("component").orderBy("ord", "th", "uid"))).where(F.col("rank") <= centres)
        first = materialize(ranked.select("uid", "component", "rank"), "simhash-centres")
        size = left.groupBy("component").agg(F.sum(F.octet_length("text").cast("long") + 64).alias("bytes"), F.count("*").alias("n"))
        size = materialize(size.select("component", "n", F.greatest(F.ceil(F.col("bytes") / part_bytes), F.ceil(F.col("n") / PART_ROWS)).cast("int").alias("salts")), "simhash-sizes")
        n_first = first.count()
        named = left.join(F.broadcast(first.drop("component")) if n_first <= BROADCAST_ROWS else first.drop("component"), "uid", "left")
        named = join_counted(named, size, ["component"]).withColumn("rank", F.coalesce("rank", F.lit(0)))
        salt = F.when(F.col("rank") == 0, F.array(F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("salts") - 1))
        dealt = named.select("component", F.explode(salt).alias("salt"), "rank", "uid", "text").repartition("component", "salt")
        dealt = dealt.sortWithinPartitions("component", "salt", F.col("rank") == 0, "rank")
        verdicts = materialize(dealt.mapInArrow(lambda it: _centre_batches(it, width, similar), "uid long, verdict int"), "simhash-verdicts")
        gone.append(verdicts.where("verdict < 0").select("uid"))
        open_ = verdicts.where("verdict = 0").select("uid")
        if not open_.head(1):
            break
        left, before, centres = materialize(left.join(open_, "uid", "left_semi"), "simhash-bodies"), left, 4 * centres
        release(before, first, size)
    away = gone[0]
    for x in gone[1:]:
        away = away.unionByName(x)
    n_away = away.count()
    return base.join(F.broadcast(away) if n_away <= BROADCAST_ROWS else away, "uid", "left_anti").select("row.*")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash_components(table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
