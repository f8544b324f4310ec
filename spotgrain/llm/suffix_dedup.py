"""Substring dedup with suffix arrays.

Every byte goes that is covered by a 100-byte string which also starts
earlier (smaller doc_id, or earlier in the same document).

1. Anchors.  Each 100-byte window names the smallest hash among its 32-byte
   grams; equal windows name equal grams at equal places.  Only the grams'
   hashes are exchanged, and only text around grams that occur twice matters
   from here on.
2. Shards of some megabytes: a suffix array over that text by Larsson-Sadakane
   refinement (only groups not yet sorted are sorted again), common prefixes
   of neighbours after Kasai (a prefix is taken from the position before
   where both are neighbours there too), and so each window's first place in
   the shard, exactly.
3. What is first in its shard is merged across shards: the text around one
   anchor meets in one task, where equal texts become one and the windows of
   the others are put in one suffix order by their bytes; of equal neighbours
   the first in the corpus stays.  A shard sends a passage once, however often
   it holds it.
4. The text around a hot anchor (over HOT contexts) is dealt in parts, each of
   which drops what repeats in it, before the rest of the parts meets.  Where
   the rest is as much again, such as a stock line amid differing text, it is
   dealt by finer keys: windows are taken STEP offsets together, and the bytes
   that all of these share join the key.

Cases: a null or empty text, and one under 100 bytes, keeps all; rows that
share a doc_id are ordered by a 63-bit hash of their texts, and of equal rows
all but one lose all of it; a null doc_id comes last; the anchors of a very long text are
found in pieces, and its shard holds it whole, some 40 bytes a byte; other
columns are not read, so their names cannot clash; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST, docs_of, join_counted, materialize, repeated_rows, row_blocks, table, text_column

GRAM = 32
SHARD_BYTES = 4 << 20
PIECE = 1 << 20
#: A block of rows, or a piece of one, has no more bytes than 2 to that.
PLACE_BITS = 22
#: Contexts of an anchor from which it is hot; offsets of a hot key's windows that go together; its parts.
HOT, STEP, PARTS = 1024, 4, 64


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE = _splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
M64 = (1 << 64) - 1


def _power(k: int) -> np.uint64:
    return np.uint64(pow(BASE, k, 1 << 64))


def rolling(data: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Polynomial hashes of all substrings of the given lengths (powers of
    two), by doubling."""
    h, k, out = BYTE[data], 1, {}
    with np.errstate(over="ignore"):
        while True:
            if k in sizes:
                out[k] = h
            if k >= max(sizes) or len(h) <= k:
                return out
            h = h[:-k] * _power(k) + h[k:]
            k *= 2


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(key, anchor, lo, hi) over a block of rows: windows starting at lo to
    hi name the gram at anchor."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none
    h = _splitmix(rolling(data, (GRAM,))[GRAM])
    # Always the same bits give way to the place, so equal windows choose equal grams in any block.
    low = np.uint64((1 << PLACE_BITS) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    grams, k = width - GRAM + 1, 1
    while 2 * k <= grams:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    if grams > k:
        m = np.minimum(m[: -(grams - k)], m[grams - k :])
    at = (m & low).astype(np.int64)
    last = np.repeat(offsets[1:], np.diff(offsets))[: len(at)] - width
    ok = np.arange(len(at)) <= last
    new = ok.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
    end = ok.copy()
    end[:-1] &= (at[1:] != at[:-1]) | ~ok[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(end)
    return h[at[lo]].view(np.int64), at[lo], lo, hi


def pieces(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, start of the bytes) of blocks of rows; a
    long row comes in pieces that share width - 1 bytes."""
    for i, j in row_blocks(offsets, PIECE):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j - i > 1 or hi - lo <= 2 * PIECE:
            yield i, data[lo:hi], offsets[i : j + 1] - lo, lo
            continue
        for a in range(lo, hi - width + 1, PIECE):
            b = min(a + PIECE + width - 1, hi)
            yield i, data[a:b], np.array([0, b - a]), a


def _key_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(shard, text) to (key, shard, n): how often a shard's rows of this task name a gram."""
    keys, shards, held = [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal keys, shards, held
        if held:
            k, s = np.concatenate(keys), np.concatenate(shards)
            order = np.lexsort((s, k))
            k, s = k[order], s[order]
            first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])]))
            n = np.diff(np.concatenate([first, [len(k)]]))
            yield pa.RecordBatch.from_arrays([pa.array(k[first]), pa.array(s[first]), pa.array(np.minimum(n, 2).astype(np.int8))], names=["key", "shard", "n"])
        keys, shards, held = [], [], 0

    for b in batches:
        data, offsets = text_column(b, "text")
        shard = b["shard"].to_numpy(zero_copy_only=False)
        for i, part, off, _ in pieces(data, offsets, width):
            key, _, lo, _ = anchors(part, off, width)
            keys.append(key)
            shards.append(shard[i + np.searchsorted(off, lo, "right") - 1])
            held += len(key)
            if held > 1 << 21:
                yield from flush()
    yield from flush()


def _repeated_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, shard, n) sorted by key and shard, to (shard, key, across) of grams named twice."""

    def out(k, s, n):
        new = np.concatenate([[True], (k[1:] != k[:-1])])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n.astype(np.int64), first)
        many = np.maximum.reduceat(s, first) != np.minimum.reduceat(s, first)
        group = np.cumsum(new) - 1
        keep = (total[group] > 1) & np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])
        yield pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(k[keep]), pa.array(many[group[keep]])], names=["shard", "key", "across"])

    rest = None
    for b in batches:
        got = tuple(b[c].to_numpy(zero_copy_only=False) for c in ("key", "shard", "n"))
        got = tuple(np.concatenate(x) for x in zip(rest, got)) if rest else got
        if not len(got[0]):
            continue
        whole = int(np.searchsorted(got[0], got[0][-1]))
        if whole:
            yield from out(*(x[:whole] for x in got))
        rest = tuple(x[whole:] for x in got)
    if rest and len(rest[0]):
        yield from out(*rest)


def eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, zeros past the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), ">u8", padded, 0, (1,)).astype(np.uint64)


def larsson_sadakane(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, slots): sorted to ``depth`` bytes at least; ``slots``: of
    suffixes that shared over half of the sorted depth with a neighbour.

    A group of suffixes not yet told apart is numbered by its last slot;
    each round sorts only such groups, by the groups of the suffixes that
    start as far behind as is sorted so far."""
    n = len(data)
    word = eight(data)
    sa = np.argsort(word)  # equal ones in any order: their groups are sorted on
    new = np.concatenate([[True], word[sa[1:]] != word[sa[:-1]]])
    del word
    last = np.concatenate([np.flatnonzero(new)[1:], [n]]) - 1
    group = np.cumsum(new) - 1
    rank = np.empty(n, np.int64)
    rank[sa] = last[group]
    size = np.bincount(group)
    slots = np.flatnonzero(size[group] > 1)
    h = 8
    while True:
        if not len(slots) or h >= depth:
            return sa, slots
        half = slots
        s = sa[slots]
        behind = np.where(s + h < n, rank[np.minimum(s + h, n - 1)] + 1, 0)
        key = (rank[s] << 32) | behind
        order = np.argsort(key)
        s, key = s[order], key[order]
        sa[slots] = s
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(new) - 1
        last = np.concatenate([np.flatnonzero(new)[1:], [len(s)]]) - 1
        rank[s] = slots[last[group]]
        size = np.bincount(group)
        h *= 2
        if h >= depth:
            # Suffixes that are still one group, in the order of their places: neighbours then stay neighbours a byte on.
            key = np.sort((rank[s] << 32) | s)
            sa[half] = key & 0xFFFFFFFF
            return sa, half
        slots = slots[size[group] > 1]


def kasai(data: np.ndarray, sa: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Common prefix of the suffix at each of ``slots`` with the one before."""
    n = len(data)
    phi = np.full(n + 1, -1, np.int64)
    here = slots[slots > 0]
    phi[sa[here]] = sa[here - 1]
    at = np.flatnonzero(phi[:n] >= 0)
    reduced = np.zeros(len(at), bool)
    before = at - 1
    # Only where the pair before shares its byte: with a common prefix of 0 it says nothing about this one.
    last = np.maximum(before[1:], 0)
    reduced[1:] = (before[1:] >= 0) & (phi[last] >= 0) & (phi[at[1:]] == phi[last] + 1) & (data[last] == data[np.maximum(phi[last], 0)])
    # Where the pair before was no neighbour, compare eight bytes at a time.
    word = eight(data)
    i = at[~reduced]
    j = phi[i]
    length = np.zeros(len(i), np.int64)
    todo = np.arange(len(i))
    while len(todo):
        a, b = i[todo] + length[todo], j[todo] + length[todo]
        inside = (a < n) & (b < n)
        todo, a, b = todo[inside], a[inside], b[inside]
        differ = word[a] ^ word[b]
        same = differ == 0
        stop = todo[~same]
        lead = differ[~same]
        zero = np.zeros(len(stop), np.int64)
        for k in range(8):
            zero += (lead >> np.uint64(8 * (7 - k))) == 0
        length[stop] += zero
        todo = todo[same]
        length[todo] += 8
    length = np.minimum(length, n - np.maximum(i, j))
    filled = np.zeros(len(at), np.int64)
    filled[~reduced] = length
    source = np.maximum.accumulate(np.where(reduced, 0, np.arange(len(at))))
    plcp = np.zeros(n, np.int64)
    plcp[at] = np.maximum(filled[source] - (at - at[source]), 0)
    out = plcp[sa[slots]]
    out[phi[sa[slots]] < 0] = 0
    return out


def repeated_windows(data: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Of the window starts ``valid``: which have an equal one before them."""
    out = np.zeros(len(data), bool)
    if len(data) < width:
        return out
    sa, slots = larsson_sadakane(data, width)
    if not len(slots):
        return out
    same = kasai(data, sa, slots) >= width
    same[1:] &= np.diff(slots) == 1
    same[0] = False
    first = np.flatnonzero(~same)
    pos = sa[slots]
    least = np.minimum.reduceat(np.where(valid[pos], pos, len(data)), first)
    later = pos[valid[pos] & (pos > least[np.cumsum(~same) - 1])]
    out[later] = True
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [lo, hi) joined where they touch."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(hi) - 1]])]


SHARD_ROWS = "kind int, key long, doc_id long, row long, lo int, anchor int, n_bytes long, n_removed long, n_spans long, sha string, spans binary, body binary"
SHARD_TYPES = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("lo", pa.int32()), ("anchor", pa.int32()),
     ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.string()), ("spans", pa.binary()), ("body", pa.binary())]
)


def shard_rows(docs: pa.Table, keys: pa.Table, width: int) -> pa.Table:
    """One row for each document (kind 0), and the contexts (kind 1) of its
    windows that are first in the shard but may occur in others."""
    ids, row = docs["doc_id"].to_numpy(), docs["row"].to_numpy()
    order = np.lexsort((row, ids))
    ids, row = ids[order], row[order]
    texts = [x.as_py().encode() for x in docs["text"].take(pa.array(order))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    known, across = keys["key"].to_numpy(), keys["across"].to_numpy()
    by = np.argsort(known)
    known, across = known[by], across[by]
    found = [[], [], [], [], []]
    if len(known):
        for _, part, off, base in pieces(data, offsets, width):
            key, at, lo, hi = anchors(part, off, width)
            slot = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[slot] == key
            for f, x in zip(found, (key[hit], at[hit] + base, lo[hit] + base, hi[hit] + base, across[slot[hit]])):
                f.append(x)
    key, at, lo, hi, wide = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    wide = wide.astype(bool)
    gone = np.zeros(len(data) + 1, bool)
    if len(key):
        # The text around grams that occur twice, put together.
        a, b = merge(lo, hi + width)
        take = np.zeros(len(data) + 1, np.int8)
        np.add.at(take, a, 1)
        np.add.at(take, b, -1)
        pos = np.flatnonzero(np.cumsum(take[:-1]))
        starts = np.zeros(len(data) + 1, np.int32)
        np.add.at(starts, lo, 1)
        np.add.at(starts, hi + 1, -1)
        start = np.cumsum(starts[:-1]) > 0
        gone[pos] = repeated_windows(data[pos], start[pos], width)
    covered = np.zeros(len(data) + 1, np.int32)
    s, e = runs(gone[:-1])
    np.add.at(covered, s, 1)
    np.add.at(covered, e + width - 1, -1)
    cut = np.cumsum(covered[:-1]) > 0
    # Contexts: from an anchor's first to its last window that is still first.
    first_here = np.concatenate([[0], np.cumsum(~gone)])
    ask = np.flatnonzero(wide & (first_here[hi + 1] - first_here[lo] > 0)) if len(key) else np.zeros(0, np.int64)
    fresh = np.flatnonzero(~gone)
    low = fresh[np.searchsorted(fresh, lo[ask])] if len(ask) else ask
    high = fresh[np.searchsorted(fresh, hi[ask], "right") - 1] if len(ask) else ask
    doc = np.searchsorted(offsets, low, "right") - 1
    waits = np.zeros(len(ids), bool)
    waits[doc] = True
    out: dict[str, list] = {c: [] for c in SHARD_TYPES.names}

    def add(**x) -> None:
        for c in SHARD_TYPES.names:
            out[c].append(x.get(c))

    s, e = runs(cut)
    # A run never crosses a document, but two may touch.
    for d in range(len(ids)):
        i, j = offsets[d], offsets[d + 1]
        k = slice(np.searchsorted(e, i, "right"), np.searchsorted(s, j, "left"))
        span = np.stack([np.maximum(s[k], i) - i, np.minimum(e[k], j) - i], 1)
        x = {"kind": 0, "doc_id": int(ids[d]), "row": int(row[d]), "n_bytes": int(j - i)}
        if waits[d]:
            add(**x, spans=span.astype("<i4").tobytes(), body=texts[d])
        else:
            add(**x, **kept_of(texts[d], span))
    one = pa.Table.from_pydict(out, schema=SHARD_TYPES)
    if not len(ask):
        return one
    size = high + width - low
    ends = np.cumsum(size)
    body = data[np.arange(ends[-1]) + np.repeat(low - (ends - size), size)]
    bodies = pa.Array.from_buffers(pa.binary(), len(ask), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(body)])
    cols = {"kind": np.ones(len(ask)), "key": key[ask], "doc_id": ids[doc], "row": row[doc], "lo": low - offsets[doc], "anchor": at[ask] - low}
    arrays = [bodies if f.name == "body" else pa.array(cols[f.name]).cast(f.type) if f.name in cols else pa.nulls(len(ask), f.type) for f in SHARD_TYPES]
    return pa.concat_tables([one, pa.Table.from_arrays(arrays, schema=SHARD_TYPES)])


def kept_of(text: bytes, spans: np.ndarray) -> dict:
    kept, at = [], 0
    for lo, hi in spans.tolist():
        kept.append(text[at:lo])
        at = hi
    kept.append(text[at:])
    return {"n_removed": int((spans[:, 1] - spans[:, 0]).sum()), "n_spans": len(spans), "sha": hashlib.sha256(b"".join(kept)).hexdigest()}


def merged_contexts(group: np.ndarray, bodies: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, last, whole) of contexts in order of group and place:
    the ranges of windows that an earlier context of the group has, as bytes of
    the context; and for each context whether all of it has been seen."""
    seen: dict = {}
    whole = np.array([seen.setdefault(x, i) != i for i, x in enumerate(zip(group.tolist(), bodies))], bool)
    size = np.array([len(x) for x in bodies], np.int64)
    some = np.flatnonzero(~whole)
    # A group that has one text left has nothing more to compare.
    _, place, count = np.unique(group[some], return_inverse=True, return_counts=True)
    some = some[count[place] > 1]
    again = np.flatnonzero(whole)
    if not len(some):
        return again, np.zeros(len(again), np.int64), size[again], whole
    data = np.frombuffer(b"".join([bodies[i] for i in some]), np.uint8)
    end = np.cumsum(size[some])
    own = np.repeat(np.arange(len(some)), size[some])
    p = np.flatnonzero(np.arange(len(data)) + width <= end[own])
    # One suffix order of all shards' windows: equal ones are neighbours, in the order of their places.
    windows = np.lib.stride_tricks.as_strided(data, (len(data) - width + 1, width), (1, 1))[p].view(f"S{width}")[:, 0]
    order = np.argsort(windows, kind="stable")
    windows, in_group = windows[order], group[some[own[p[order]]]]
    later = np.flatnonzero((windows[1:] == windows[:-1]) & (in_group[1:] == in_group[:-1])) + 1
    flags = np.zeros(len(data), bool)
    flags[p[order[later]]] = True
    s, e = runs(flags)  # the last width - 1 bytes of a context start no window
    c = np.searchsorted(end, s, "right")
    base = (end - size[some])[c]
    return (
        np.concatenate([again, some[c]]),
        np.concatenate([np.zeros(len(again), np.int64), s - base]),
        np.concatenate([size[again], e - base + width - 1]),
        whole,
    )


MERGED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int32()), ("body", pa.binary())])
MERGED_ROWS = "key long, doc_id long, row long, first int, last int, anchor int, body binary"


def _merge_batches(batches: Iterator[pa.RecordBatch], width: int, rest: bool = False) -> Iterator[pa.RecordBatch]:
    """Contexts (key, part, doc_id, row, lo, anchor, body) sorted by these, to the
    ranges that repeat (body null); with ``rest`` also the contexts that have
    anything new (body set, first is lo)."""

    def out(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        key, part, bodies = t["key"].to_numpy(), t["part"].to_numpy(), t["body"].to_pylist()
        ids, row, lo, anchor = (t[c].to_numpy() for c in ("doc_id", "row", "lo", "anchor"))
        group = np.cumsum(np.concatenate([[False], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        at = 0
        while at < len(key):  # whole groups, about a megabyte at a time
            size, to = 0, at
            while to < len(key) and (size < 1 << 20 or group[to] == group[to - 1]):
                size += len(bodies[to])
                to += 1
            c, first, last, whole = merged_contexts(group[at:to], bodies[at:to], width)
            c = c + at
            n = pa.nulls(len(c), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(key[c]), pa.array(ids[c]), pa.array(row[c]), pa.array((lo[c] + first).astype(np.int32)), pa.array((lo[c] + last).astype(np.int32)), pa.array(anchor[c]), n], schema=MERGED)
            if rest:
                c = np.flatnonzero(~whole) + at
                zero = np.zeros(len(c), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(key[c]), pa.array(ids[c]), pa.array(row[c]), pa.array(lo[c]), pa.array(zero), pa.array(anchor[c]), pa.array([bodies[i] for i in c], pa.binary())], schema=MERGED)
            at = to

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        if size > 8 << 20:
            tail = (held[-1]["key"][-1].as_py(), held[-1]["part"][-1].as_py())
            same = (b["key"].to_numpy() == tail[0]) & (b["part"].to_numpy() == tail[1])
            new = len(same) if same.all() else int(np.argmin(same))
            if new < len(same):
                held.append(b.slice(0, new))
                yield from out(held)
                held, size, b = [], 0, b.slice(new)
        held.append(b)
        size += b["body"].nbytes
    if held:
        yield from out(held)


def _split_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Contexts of hot keys (key, doc_id, row, lo, anchor, body), cut by the
    offsets of their windows from the anchor; the bytes that all windows of STEP
    offsets share make the new key, so equal windows still meet."""
    for b in batches:
        out: list[tuple] = []
        for key, doc, row, lo, anchor, body in zip(*[b[c].to_pylist() for c in ("key", "doc_id", "row", "lo", "anchor", "body")]):
            last = len(body) - width  # the context's windows start from 0 to here
            for k in range((anchor - last) // STEP, anchor // STEP + 1):
                s0, s1 = max(0, anchor - STEP * k - STEP + 1), min(last, anchor - STEP * k)
                if s0 <= s1:
                    core = body[anchor - STEP * k : anchor - STEP * k - STEP + 1 + width]
                    new = hashlib.blake2b(core, digest_size=8, key=key.to_bytes(8, "little", signed=True), salt=k.to_bytes(4, "little", signed=True)).digest()
                    out.append((int.from_bytes(new, "little", signed=True), doc, row, lo + s0, anchor - s0, body[s0 : s1 + width]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=["key", "doc_id", "row", "lo", "anchor", "body"])


def merged_shards(rows: DataFrame, width: int, hot_from: int = HOT) -> DataFrame:
    """(doc_id, row, first, last): what repeats across shards."""
    ranges, fields = ["doc_id", "row", "first", "last"], ["key", "doc_id", "row", "lo", "anchor", "body"]

    def met(df: DataFrame, part=None) -> DataFrame:
        """What repeats where all of a key, or a part of it, meets; of parts
        also what they have that is new, in a written table."""
        rest = part is not None
        dealt = df.withColumn("part", F.lit(0) if part is None else part).repartition("key", "part")
        out = dealt.sortWithinPartitions("key", "part", "doc_id", "row", "lo").mapInArrow(lambda it: _merge_batches(it, width, rest), MERGED_ROWS)
        return out if not rest else materialize(out, "suffix-parts")

    def hot_of(df: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """The contexts of hot keys, if any, and the others."""
        hot = materialize(df.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_from), "suffix-hot")
        n = hot.count()
        few = F.broadcast(hot.select("key")) if n <= 1_000_000 else hot.select("key")
        return (join_counted(df, hot, ["key"]).select(*fields), df.join(few, "key", "left_anti")) if n else (None, df)

    def again(df: DataFrame) -> DataFrame:
        return df.where("body IS NOT NULL").select("key", "doc_id", "row", F.col("first").alias("lo"), "anchor", "body")

    part = F.pmod(F.xxhash64("doc_id", "row"), F.lit(PARTS)).cast("int")
    hot, cold = hot_of(rows.where("kind = 1").select(*fields))
    found = [met(cold)]
    if hot is not None:
        first = met(hot, part)
        hot, cold = hot_of(again(first))
        found += [first.where("body IS NULL"), met(cold)]
    if hot is not None:
        cut = hot.mapInArrow(lambda it: _split_batches(it, width), "key long, doc_id long, row long, lo int, anchor int, body binary")
        first = met(cut, part)
        found += [first.where("body IS NULL"), met(again(first))]
    out = found[0].select(*ranges)
    for x in found[1:]:
        out = out.unionByName(x.select(*ranges))
    return out


def _final_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: dict[str, list] = {"doc_id": b["doc_id"].to_pylist(), "n_bytes": b["n_bytes"].to_pylist(), "n_removed": [], "n_spans": [], "sha": []}
        for body, spans, more in zip(b["body"].to_pylist(), b["spans"].to_pylist(), b["more"].to_pylist()):
            own = np.frombuffer(spans, "<i4").reshape(-1, 2).astype(np.int64)
            far = np.array([(x["first"], x["last"]) for x in more or ()], np.int64).reshape(-1, 2)
            both = np.concatenate([own, far])
            lo, hi = merge(both[:, 0], both[:, 1])
            got = kept_of(body, np.stack([lo, hi], 1))
            for c in ("n_removed", "n_spans", "sha"):
                cols[c].append(got[c])
        yield pa.RecordBatch.from_pydict(cols, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.string())]))


def suffix_dedup(docs: DataFrame, width: int = 100, shard_bytes: int = SHARD_BYTES, hot_from: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    d = docs_of(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "text")
    if d.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").head(1):
        # Ids do not tell rows apart: their texts' hashes do, and equal rows are seen to first.
        digest = F.unhex(F.md5("text")).alias("digest")
        d = materialize(d.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("ord"), "doc_id", "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("row"), digest), "suffix-texts")
        copies = repeated_rows(d.select("uid", "ord", "digest"))
        again = None if copies is None else d.join(copies, "uid", "left_semi").select("doc_id", "text")
        d = (d if copies is None else d.join(copies, "uid", "left_anti")).select("doc_id", "row", "text")
    else:
        d, again = d.withColumn("row", F.lit(0).cast("long")), None
    total = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    d = d.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int"))
    named = d.select("shard", "text").mapInArrow(lambda it: _key_batches(it, width), "key long, shard int, n byte")
    keys = named.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_repeated_batches, "shard int, key long, across boolean")
    rows = d.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(lambda a, b: shard_rows(a, b, width), SHARD_ROWS)
    rows = materialize(rows, "suffix-shards")
    far = merged_shards(rows, width, hot_from)
    far = far.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "last")).alias("more"))
    one = rows.where("kind = 0")
    done = one.where("sha IS NOT NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    waits = one.where("sha IS NULL").select("doc_id", "row", "n_bytes", "spans", "body").join(far, ["doc_id", "row"], "left")
    last = waits.select("doc_id", "n_bytes", "spans", "body", "more").mapInArrow(_final_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, sha string")
    both = done.unionByName(last)
    if again is not None:
        n, long = F.octet_length("text").cast("long"), F.octet_length("text") >= width
        both = both.unionByName(
            again.select("doc_id", n.alias("n_bytes"), F.when(long, n).otherwise(0).alias("n_removed"), F.when(long, 1).otherwise(0).cast("long").alias("n_spans"), F.sha2(F.when(long, "").otherwise(F.col("text")), 256).alias("sha"))
        )
    return both.select(F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("sha").alias("kept_sha256"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
