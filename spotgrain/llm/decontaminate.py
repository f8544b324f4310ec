"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with each run of white space as one space.  A
document is contaminated by an item if some stretch of it is within k edits of
the whole item, k being ``rate`` of the item's length.  An alignment with k
edits keeps at least L - q + 1 - q k of the item's q-grams, on diagonals no
more than k apart: shared q-grams are counted in diagonal bands of width
2 (k + 1) that overlap by half, bands that reach the bound are kept, and a
banded alignment verifies them.  Grams have 8 characters, or 4 for items so
short that 8 would not filter; items that 4 would not filter either (under
4 characters by the default rate) are aligned directly.

The same holds for parts of an item: its overlapping regions of REGION
characters, one every STRIDE, each have an edit budget of their own.  A passage
of REGION + STRIDE - 1 characters holds a whole region, wherever it begins.
Regions found next to each other are aligned again as one passage.

The benchmark is the small side: it is indexed in parts of ``part_chars``
characters, each part passing over the documents once, so what is broadcast
(plain arrays, some 20 bytes a character) has a bound however large the
benchmark.

Repetitive text shares one gram at very many places.  Where a stretch of text
has over MOST_HITS places in common with the index, its documents are taken
one by one, then the items; an item that alone has so many in one document is
aligned with it directly, by bit-parallel columns, which takes a time in
proportion to the text and no more memory.

Cases: null and empty texts match nothing, nor do null and empty items; repeated
rows and items each give rows; each row is judged on its own, so shared and null
doc_ids and item_ids do no harm; of equally good alignments the one that starts
first is reported, one for each half length of the item, and one a document for
items under 4 characters; texts of over STRETCH characters are taken in
stretches that overlap by more than an item; other columns are not read, so
their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, table

Q, SHORT_Q, RATE, PART_CHARS = 8, 4, 0.1, 4_000_000
REGION, STRIDE = 64, 16
MOST_HITS, STRETCH = 500_000, 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Stands between documents of a block; no item holds it.
GAP = "\ue000"
KIND = "doc_id long, item_id long, first int, last int, distance int, item_chars int, item_first int, item_last int"


def normal(text: str) -> str:
    return " ".join(text.lower().replace(GAP, " ").split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q characters (q a power of two), by doubling."""
    h, k = code.astype(np.uint64), 1
    if len(code) < q:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        while k < q:
            h = h[:-k] * np.uint64(pow(BASE, k, 1 << 64)) + h[k:]
            k *= 2
        return h * SPREAD


def gram_index(items: list[tuple[int, np.ndarray]], rate: float, q: int) -> SimpleNamespace:
    """The q-grams of items (id, codes), as plain arrays.  A piece is what is
    looked for: an item, then its regions (the last ends with the item; of
    equal ones the first).  gram, first: the distinct grams and where their
    entries (item, at) begin; own, begin, size, edits: of each piece; base: the
    first piece of each item; regular: its regions but for the last."""
    x = SimpleNamespace(q=q, rate=rate, ids=[i for i, _ in items], texts=[c for _, c in items])
    own, begin, size, base, regular, live = [], [], [], [], [], []
    for k, (_, c) in enumerate(items):
        base.append(len(own))
        starts = [*range(0, len(c) - REGION, STRIDE), len(c) - REGION] if len(c) > REGION and q == Q else []
        regular.append(max(0, len(starts) - 1))
        seen: set[bytes] = set()
        for a, n in [(0, len(c)), *[(a, REGION) for a in starts]]:
            own.append(k)
            begin.append(a)
            size.append(n)
            raw = c[a : a + n].tobytes()
            live.append(raw not in seen)
            seen.add(raw)
    x.own, x.begin, x.size, x.base, x.regular = (np.array(v, np.int64) for v in (own, begin, size, base, regular))
    x.live = np.array(live, bool)
    x.edits = np.minimum((rate * x.size).astype(np.int64), np.maximum(x.size - q, 0) // q)
    x.bound = x.size - q + 1 - q * x.edits
    x.step = x.edits + 1
    gram = [grams(c, q) for c in x.texts]
    sizes = [len(g) for g in gram]
    gram = np.concatenate([np.zeros(0, np.uint64), *gram])
    order = np.argsort(gram, kind="stable")
    x.item = np.repeat(np.arange(len(items)), sizes)[order].astype(np.int32)
    x.at = (np.arange(len(gram)) - np.repeat(np.cumsum([0, *sizes])[:-1], sizes))[order].astype(np.int32)
    x.gram, first = np.unique(gram[order], return_index=True)
    x.first = np.concatenate([first, [len(gram)]]).astype(np.int64)
    x.shift = 64 - min(25, max(16, int(len(gram) * 32).bit_length()))
    x.seen = np.zeros(1 << (64 - x.shift), bool)
    x.seen[(x.gram >> np.uint64(x.shift)).astype(np.int64)] = True
    return x


def part_index(items: list[tuple[int, str]], rate: float = RATE) -> list[SimpleNamespace]:
    """The items by how they are looked for: grams of 8, of 4, or none."""
    by: dict[int, list] = {Q: [], SHORT_Q: [], 0: []}
    for i, text in items:
        c = codes(normal(text or ""))
        k = int(rate * len(c))
        if len(c):
            by[next((q for q in (Q, SHORT_Q) if len(c) - q + 1 - q * k >= 1), 0)].append((i, c))
    out = [gram_index(v, rate, q) for q, v in by.items() if q and v]
    if by[0]:
        out.append(SimpleNamespace(q=0, rate=rate, ids=[i for i, _ in by[0]], texts=[c for _, c in by[0]]))
    return out


def shared(x: SimpleNamespace, code: np.ndarray, items: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first entry, entries) of the text's grams that the index
    has; an entry of other items counts too."""
    h = grams(code, x.q)
    p = np.flatnonzero(x.seen[(h >> np.uint64(x.shift)).astype(np.int64)])
    if not len(x.gram) or not len(p):
        return (np.zeros(0, np.int64),) * 3
    slot = np.minimum(np.searchsorted(x.gram, h[p]), len(x.gram) - 1)
    ok = x.gram[slot] == h[p]
    p, slot = p[ok], slot[ok]
    lo, hi = x.first[slot], x.first[slot + 1]
    if items != (0, len(x.ids)):  # a gram's entries are in the order of the items
        key = np.repeat(np.arange(len(x.gram)), np.diff(x.first)) * (len(x.ids) + 1) + x.item
        lo = np.searchsorted(key, slot * (len(x.ids) + 1) + items[0])
        hi = np.searchsorted(key, slot * (len(x.ids) + 1) + items[1])
        p, lo, hi = p[hi > lo], lo[hi > lo], hi[hi > lo]
    return p, lo, hi - lo


def live_hits(x: SimpleNamespace, p: np.ndarray, item: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Which hits lie on two neighbouring strips of diagonals that have as many
    hits as a band of the item, or of a region, needs: no other can be in one.
    Strips are counted by a hash, which can only count too many."""
    out, diagonal, base = np.zeros(len(p), bool), p - at + size, x.base[item]
    tests = [(x.step[base], x.bound[base])]
    if x.q == Q and (x.size > REGION).any():
        edits = min(int(x.rate * REGION), (REGION - Q) // Q)
        tests.append((2 * (edits + 1), np.where(x.regular[item] > 0, REGION - Q + 1 - Q * edits, len(p) + 1)))
    for width, need in tests:
        key = item * np.int64(2 * size + 2) + diagonal // width
        with np.errstate(over="ignore"):
            low, own, high = (((key + k).astype(np.uint64) * SPREAD >> np.uint64(44)).astype(np.int64) for k in (-1, 0, 1))
        count = np.bincount(own, minlength=1 << 20)
        out |= count[own] + np.maximum(count[low], count[high]) >= need
    return out


def band_candidates(x: SimpleNamespace, code: np.ndarray, p: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
    """(piece, band, a position in it) of the bands that reach the bound; a
    band holds the diagonals from its own to two steps on."""
    if not len(p):
        return []
    entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    p, item, at = np.repeat(p, n), x.item[entry].astype(np.int64), x.at[entry].astype(np.int64)
    ok = live_hits(x, p, item, at, len(code))
    if not ok.any():
        return []
    p, item, at = p[ok], item[ok], at[ok]
    # An entry belongs to its item and to each region around it.
    found = [(p, x.base[item], at)]
    if x.q == Q:
        for r in range(REGION // STRIDE):
            j = at // STRIDE - r
            ok = (j >= 0) & (j < x.regular[item]) & (at - STRIDE * j <= REGION - x.q)
            found.append((p[ok], x.base[item[ok]] + 1 + j[ok], at[ok] - STRIDE * j[ok]))
        size = x.size[x.base[item]]
        ok = (x.regular[item] > 0) & (at >= size - REGION)
        found.append((p[ok], x.base[item[ok]] + 1 + x.regular[item[ok]], at[ok] - size[ok] + REGION))
    p, piece, at = (np.concatenate(v) for v in zip(*found))
    ok = x.live[piece]
    p, piece, at = p[ok], piece[ok], at[ok]
    strip = (p - at + len(code)) // x.step[piece]
    wide = 2 * len(code) + 2
    key = piece * wide + strip
    order = np.argsort(key, kind="stable")
    key, p, at = key[order], p[order], at[order]
    own, n = np.unique(key, return_counts=True)
    piece = own // wide
    both = n.copy()
    both[:-1] += np.where(own[1:] == own[:-1] + 1, n[1:], 0)
    # A lone upper strip may make up the band that begins one strip lower.
    alone = np.concatenate([[True], own[1:] != own[:-1] + 1])[: len(own)]
    keep, low = np.flatnonzero(both >= x.bound[piece]), np.flatnonzero(alone & (n >= x.bound[piece]))
    chosen = np.concatenate([own[keep], own[low] - 1])
    # A q-gram of the item counts once, however often the text has it.
    a, b = np.searchsorted(key, chosen), np.searchsorted(key, chosen + 2)
    bound = x.bound[chosen // wide]
    full = [k for k in range(len(chosen)) if len(set(at[a[k] : b[k]].tolist())) >= bound[k]]
    chosen, where = chosen[full], p[a[full]]
    piece = chosen // wide
    return list(zip(piece.tolist(), (chosen % wide * x.step[piece] - len(code)).tolist(), where.tolist()))


def alignment_ends(item: np.ndarray, text: np.ndarray, most: int) -> list[int]:
    """Ends of stretches of ``text`` within ``most`` edits of the item: the
    best one of each half length, by Myers' bit-parallel columns."""
    n, where, pv, mv, score = len(item), {}, (1 << len(item)) - 1, 0, len(item)
    for i, c in enumerate(item.tolist()):
        where[c] = where.get(c, 0) | 1 << i
    full, top, half, best = pv, 1 << (n - 1), max(1, n // 2), {}
    for j, c in enumerate(text.tolist()):
        eq = where.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score <= most and score < best.get(j // half, (most + 1, 0))[0]:
            best[j // half] = (score, j + 1)
    return [j for _, j in best.values()]


def candidates(x: SimpleNamespace, code: np.ndarray, ends: np.ndarray, items: tuple[int, int] | None = None, origin: int = 0) -> list[tuple[int, int, int]]:
    """(piece, band, position) of a block of documents that end at ``ends``."""
    items = items or (0, len(x.ids))
    p, first, n = shared(x, code, items)
    if n.sum() <= MOST_HITS:
        return [(k, band + origin, at + origin) for k, band, at in band_candidates(x, code, p, first, n)]
    if len(ends) > 1:
        cut = int(ends[len(ends) // 2 - 1])
        left = candidates(x, code[:cut], ends[: len(ends) // 2], items, origin)
        return left + candidates(x, code[cut:], ends[len(ends) // 2 :] - cut, items, origin + cut)
    if items[1] - items[0] > 1:
        mid = sum(items) // 2
        return candidates(x, code, ends, (items[0], mid), origin) + candidates(x, code, ends, (mid, items[1]), origin)
    out, k = [], items[0]
    last = x.base[k + 1] if k + 1 < len(x.base) else len(x.own)
    for piece in range(int(x.base[k]), int(last)):
        if x.live[piece]:
            need = x.texts[k][x.begin[piece] : x.begin[piece] + x.size[piece]]
            for j in alignment_ends(need, code, int(x.edits[piece])):
                start = max(0, j - len(need))
                out.append((piece, start - int(x.step[piece]) + origin, start + origin))
    return out


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int]:
    """(edits, start, end) of the best alignment of the whole item with a
    stretch of ``text`` on the diagonals low to high; edits over ``most`` end it."""
    unit, far = 1 << 32, 1 << 50
    d = np.arange(low, high + 1)
    row = np.where((d >= 0) & (d <= len(text)), np.maximum(d, 0), far)  # edits * unit + start
    c = d + np.arange(1, len(item) + 1)[:, None]  # the text's characters used so far
    wall = np.where((c < 0) | (c > len(text)), far, 0)
    known = (c >= 1) & (c <= len(text))
    same = known & (np.concatenate([text, [0]])[np.where(known, c - 1, -1)] == item[:, None])
    cost = np.where(same, 0, np.where(known, unit, far))
    ramp = np.arange(len(d)) * unit
    for r in range(len(item)):
        x = row + cost[r]
        np.minimum(x[:-1], row[1:] + unit, out=x[:-1])  # a character of the item left out
        x += wall[r] - ramp
        row = np.minimum.accumulate(x) + ramp  # characters of the text left out
        if r % 8 == 7 and row.min() >> 32 > most:
            return most + 1, 0, 0
    row = np.where(wall[-1] > 0, far, row)
    best = int(np.argmin(row >> 32))
    return int(row[best] >> 32), int(row[best] & (unit - 1)), int(d[best] + len(item))


def passages(found: list[tuple], item: np.ndarray, text: np.ndarray, rate: float) -> list[tuple]:
    """Regions (item start, item end, text start, text end, edits) of one item
    in one text, joined to passages while they overlap or touch in both on
    about one diagonal and the whole keeps to the rate."""
    out: list[tuple] = []
    open_: list[int] = []
    for a, b, p, q, edits in sorted(found, key=lambda x: (x[2], x[0])):
        open_ = [k for k in open_ if p <= out[k][3] + STRIDE]  # what ends before can grow no more
        for k in open_:
            a0, b0, p0, q0, e0 = out[k]
            if (a, b) == (a0, b0) and 2 * (p - p0) < b - a:
                break  # the same region again, in a run of one pattern
            drift = e0 + edits + 1
            if abs((p - a) - (p0 - a0)) > drift or a > b0 + STRIDE or a < a0:
                continue
            if b <= b0:  # inside of the passage
                break
            lo, most = max(0, p0 - drift), int(rate * (b - a0))
            got = banded(item[a0:b], text[lo : q + drift], p0 - lo - drift, p0 - lo + drift, most)
            if got[0] <= most:
                out[k] = (a0, b, lo + got[1], lo + got[2], got[0])
                break
        else:
            open_.append(len(out))
            out.append((a, b, p, q, edits))
    return out


def union_of(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    lo, hi = [], []
    for a, b in sorted(spans):
        if lo and a <= hi[-1]:
            hi[-1] = max(hi[-1], b)
        else:
            lo.append(a)
            hi.append(b)
    return lo, hi


def inside(cover: tuple[list[int], list[int]] | None, a: int, b: int) -> bool:
    k = bisect_right(cover[0], a) - 1 if cover else -1
    return k >= 0 and b <= cover[1][k]


def touches(cover: tuple[list[int], list[int]] | None, a: int, b: int) -> bool:
    k = bisect_right(cover[0], b - 1) - 1 if cover else -1
    return k >= 0 and a < cover[1][k]


def short_matches(x: SimpleNamespace, texts: list[str]) -> list[tuple]:
    """Items without grams: the first place in each text."""
    rows = []
    for d, text in enumerate(texts):
        code = None
        for i, need in zip(x.ids, x.texts):
            most, n = int(x.rate * len(need)), len(need)
            if most == 0:
                a = text.find(need.tobytes().decode("utf-32-le", "surrogatepass"))
                if a >= 0:
                    rows.append((d, i, a, a + n, 0, n, 0, n))
                continue
            code = codes(text) if code is None else code
            for j in alignment_ends(need, code, most)[:1]:
                lo = max(0, j - n - most)
                got = banded(need, code[lo:j], -most, 2 * most + 1, most)
                if got[0] <= most:
                    rows.append((d, i, lo + got[1], lo + got[2], got[0], n, 0, n))
    return rows


def gram_matches(x: SimpleNamespace, texts: list[str]) -> list[tuple]:
    size = np.array([len(t) + 1 for t in texts])
    end = np.cumsum(size)
    code = codes(GAP.join([*texts, ""]))
    out, whole, cover, parts = {}, {}, {}, {}
    # The bands come by what they look for: an item comes before its regions.
    for piece, band, p in sorted(candidates(x, code, end)):
        k, step, n = int(x.edits[piece]), int(x.step[piece]), int(x.size[piece])
        item, begin = int(x.own[piece]), int(x.begin[piece])
        need, full = x.texts[item][begin : begin + n], piece == x.base[item]
        # A band at the end of a document may belong to the one behind it.
        first = int(np.searchsorted(end, p, "right"))
        for d in range(first, min(first + 2, len(texts))):
            start, stop = int(end[d] - size[d]), int(end[d]) - 1
            lo, hi = max(start, band - k), min(stop, band + 2 * step + n + k)
            low, high = max(band, start) - k - lo, band + 2 * step + k - lo
            if hi <= lo or high < low:
                continue
            if not full:
                if (d, item) not in cover:
                    cover[d, item] = union_of(whole.get((d, item), []))
                if inside(cover[d, item], lo + k + step - start, hi - k - step - start):
                    continue  # in copies of the whole item
            edits, a, b = banded(need, code[lo:hi], low, high, k)
            if edits > k:
                continue
            a, b = lo + a - start, lo + b - start
            if not full:
                parts.setdefault((d, item), set()).add((begin, begin + n, a, b, edits))
                continue
            where = (d, item, a // max(1, n // 2))
            if where not in out or edits < out[where][4]:
                out[where] = (d, x.ids[item], a, b, edits, n, 0, n)
            whole.setdefault((d, item), []).append((a, b))
    rows = list(out.values())
    for (d, item), found in parts.items():
        found = [y for y in found if not touches(cover[d, item], y[2], y[3])]
        start, stop = int(end[d] - size[d]), int(end[d]) - 1
        for a, b, p, q, edits in passages(found, x.texts[item], code[start:stop], x.rate):
            rows.append((d, x.ids[item], p, q, edits, len(x.texts[item]), a, b))
    return rows


def matches(parts: list[SimpleNamespace], texts: list[str]) -> list[tuple]:
    """(number of the text, item_id, first, last, distance, item_chars,
    item_first, item_last) of texts that are normal already."""
    rows: list[tuple] = []
    for x in parts:
        overlap = 2 * max(len(c) for c in x.texts) + REGION
        short = [d for d, t in enumerate(texts) if len(t) <= STRETCH]
        find = gram_matches if x.q else short_matches
        rows += [(short[r[0]], *r[1:]) for r in find(x, [texts[d] for d in short])] if short else []
        for d, t in enumerate(texts):
            if len(t) > STRETCH:
                some = {}
                for at in range(0, len(t), STRETCH):
                    for r in find(x, [t[at : at + STRETCH + overlap]]):
                        r = (d, r[1], r[2] + at, r[3] + at, *r[4:])
                        some[r[1], r[2], r[6]] = r
                rows += some.values()
    return rows


def blocks_of(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first row, normal texts) of about a million characters at a time."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to] or "") < 1 << 20):
            held += len(texts[to] or "")
            to += 1
        yield at, [normal(t or "") for t in texts[at:to]]
        at = to


def _match_batches(batches: Iterator[pa.RecordBatch], parts: list[SimpleNamespace]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), *[pa.int32()] * 6)
    names = [x.split()[0] for x in KIND.split(", ")]
    for b in batches:
        ids = b["doc_id"].to_pylist()
        for at, texts in blocks_of(b["text"].to_pylist()):
            rows = [(ids[at + r[0]], *r[1:]) for r in matches(parts, texts)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def index_parts(benchmark: DataFrame, rate: float = RATE, part_chars: int = PART_CHARS) -> Iterator:
    """Broadcast indexes of the benchmark, one part after the other."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-total // part_chars))
    for k in range(parts):
        some = items if parts == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == k)
        # Lists of plain arrays: workers need nothing but numpy to read them.
        yield benchmark.sparkSession.sparkContext.broadcast(part_index([(x.item_id, x.text) for x in some.collect()], rate))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """(doc_id, item_id, first, last, distance, item_chars, item_first,
    item_last): the stretches, and what part of the item each is a copy of, in
    characters of the texts as they are compared."""
    d, out = docs_of(docs), None
    for index in index_parts(benchmark, rate, part_chars):
        found = d.mapInArrow(lambda it, index=index: _match_batches(it, index.value), KIND)
        out = found if out is None else out.unionByName(found)
    return out


def clean_flags(index):
    """A function of text columns: whether no item is found."""

    def flags(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in column:
            keep = np.ones(len(s), bool)
            for at, texts in blocks_of(s.tolist()):
                for r in matches(index.value, texts):
                    keep[at + r[0]] = False
            yield pd.Series(keep)

    return F.pandas_udf(flags, "boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` without the contaminated rows.  Each row is judged where it
    lies: no id is compared and nothing is exchanged."""
    for index in index_parts(benchmark, rate, part_chars):
        docs = docs.where(clean_flags(index)(F.col("text")))
    return docs


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
