"""Exact dedup with Patricia-trie owners.

Texts are compared without the characters of ``[\\x20\\x09-\\x0D]``.  Every task
first inserts its texts into compressed radix tries and passes on one row for
each different text, so a text that a third of all rows share moves once for
each task.  Those rows are dealt by length and content hash and inserted into
tries again; a terminal node holds the owner so far (most code points in the
original, then smallest doc_id) and the number of rows.  A trie over its
memory bound spills subtrees and goes on: what is in them leaves the task as
rows, which are dealt again over as many parts as they need, so memory is
bounded and nothing is kept on a machine's own disk.  A row finds its class by
the SHA-256 of its text.

Cases: null counts as empty, and empty texts are equal to one another; rows
that share a doc_id are counted one by one, and of rows that tie in code points
and id exactly one stays; a null doc_id comes last among equals; a text over
the memory bound is held alone; other columns are not read, so their names
cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST, docs_of, join_counted, materialize, table

#: Bytes of labels (and an allowance for each node) that a trie holds.
SPILL = 64 << 20
NODE = 300

Value = tuple[int, int, int, int]


class PatriciaTrie:
    """Byte strings with (code points, id, row, rows) at their terminal nodes.

    A node is [label, children by first byte, value or None]; a child that is
    None stands for a subtree that was spilled."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.weight = self.strings = 0

    @staticmethod
    def better(a: Value | None, b: Value) -> Value:
        if a is None:
            return b
        top = a if (-a[0], *a[1:3]) <= (-b[0], *b[1:3]) else b
        return (*top[:3], a[3] + b[3])

    def insert(self, key: bytes, value: Value) -> bool:
        """False where the key belongs to a spilled subtree."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                self.strings += node[2] is None
                node[2] = self.better(node[2], value)
                return True
            if key[at] not in node[1]:
                node[1][key[at]] = [key[at:], {}, value]
                self.weight += len(key) - at + NODE
                self.strings += 1
                return True
            child = node[1][key[at]]
            if child is None:
                return False
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            # Split the edge at the first different byte, found by halving.
            low, high = 1, min(len(label), len(key) - at)
            while low < high:
                mid = (low + high + 1) // 2
                if key.startswith(label[:mid], at):
                    low = mid
                else:
                    high = mid - 1
            upper = [label[:low], {label[low]: child} if low < len(label) else {}, None]
            child[0] = label[low:]
            node[1][key[at]] = upper
            self.weight += NODE
            node, at = upper, at + low

    @staticmethod
    def walk(node: list, prefix: bytes = b"") -> Iterator[tuple[bytes, Value]]:
        todo = [(node, prefix)]
        while todo:
            node, prefix = todo.pop()
            prefix += node[0]
            if node[2] is not None:
                yield prefix, node[2]
            todo += [(child, prefix) for child in node[1].values() if child is not None]

    def spill(self, stub: bool) -> Iterator[tuple[bytes, Value]]:
        """Takes out subtrees of a quarter of the weight and more together,
        found below the heaviest path, so that strings with a common opening
        come apart where they differ.  With ``stub`` the trie remembers where
        they were.  The last string stays."""
        if self.strings < 2:
            return
        order, todo = [], [self.root]
        while todo:
            order.append(todo.pop())
            todo += [c for c in order[-1][1].values() if c is not None]
        weight: dict[int, int] = {}
        for node in reversed(order):
            weight[id(node)] = NODE + len(node[0]) + sum(weight[id(c)] for c in node[1].values() if c is not None)
        of = lambda node: sorted(((weight[id(c)], k) for k, c in node[1].items() if c is not None), reverse=True)
        path, prefix, total = [self.root], b"", weight[id(self.root)]
        while (below := of(path[-1])) and 2 * below[0][0] > total and of(path[-1][1][below[0][1]]):
            path.append(path[-1][1][below[0][1]])
        if len(path) > 1 and 4 * sum(w for w, _ in below) < total and 2 * (weight[id(path[-1])] - len(path[-1][0])) < weight[id(path[-1])]:
            # The weight is in the path's own label: the node goes as a whole.
            below = [(weight[id(path[-1])], path[-1][0][0])]
            path.pop()
        prefix = b"".join(node[0] for node in path)
        freed, node = 0, path[-1]
        for w, k in below:
            if 4 * freed >= total or self.strings < 2:
                break
            child = node[1][k]
            for key, value in self.walk(child, prefix):
                self.strings -= 1
                yield key, value
            if stub:
                node[1][k] = None
            else:
                del node[1][k]
            freed += w
        self.weight = max(0, total - freed)


KEYED = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("sha", pa.binary()), ("norm", pa.binary()), ("cp", pa.int64()), ("n", pa.int64())])
KIND = "uid long, id long, sha binary, norm binary, cp long, n long"


class Rows:
    """Rows of KEYED, passed on some megabytes at a time."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, key: bytes, value: Value, done: bool) -> None:
        cp, i, uid, n = value
        self.rows.append((uid, i, hashlib.sha256(key).digest() if done else None, None if done else key, cp, n))
        self.size += len(key) + 100

    def full(self, least: int = 4 << 20) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), KEYED)], schema=KEYED)
            self.rows, self.size = [], 0


def hashed_rows(batches: Iterator[pa.RecordBatch], limit: int = SPILL) -> Iterator[pa.RecordBatch]:
    """(uid, id, cp, norm) to a row for each with its digest, and a row for
    each different text of the task with owner and count so far (norm set)."""
    trie, out = PatriciaTrie(), Rows()
    for b in batches:
        digests = []
        for text, cp, i, uid in zip(b["norm"], b["cp"].to_pylist(), b["id"].to_pylist(), b["uid"].to_pylist()):
            raw = text.as_py()
            digests.append(hashlib.sha256(raw).digest())
            trie.insert(raw, (cp, i, uid, 1))
            while trie.weight > limit and trie.strings > 1:
                for key, value in trie.spill(stub=False):  # counted so far; the rest is counted after the exchange
                    out.add(key, value, False)
                    yield from out.full()
        none = pa.nulls(b.num_rows, pa.binary())
        zero = pa.nulls(b.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b["uid"], b["id"], pa.array(digests, pa.binary()), none, zero, zero], schema=KEYED)
    for key, value in trie.walk(trie.root):
        out.add(key, value, False)
        yield from out.full()
    yield from out.full(0)


def owned_texts(batches: Iterator[pa.RecordBatch], limit: int = SPILL) -> Iterator[pa.RecordBatch]:
    """One row for each different text of a task: owner, count and digest.
    What was spilled comes out as it came in (norm set), for another round."""
    trie, out = PatriciaTrie(), Rows()
    for b in batches:
        for text, cp, i, uid, n in zip(b["norm"], b["cp"].to_pylist(), b["id"].to_pylist(), b["uid"].to_pylist(), b["n"].to_pylist()):
            raw = text.as_py()
            if not trie.insert(raw, (cp, i, uid, n)):
                out.add(raw, (cp, i, uid, n), False)
            while trie.weight > limit and trie.strings > 1:
                for key, value in trie.spill(stub=True):
                    out.add(key, value, False)
                    yield from out.full()
            yield from out.full()
    for key, value in trie.walk(trie.root):
        out.add(key, value, True)
        yield from out.full()
    yield from out.full(0)


def exact_dedup(docs: DataFrame, spill_bytes: int = SPILL) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    norm = F.encode(F.regexp_replace("text", r"[\x20\x09-\x0D]+", ""), "UTF-8")
    row = docs_of(docs).select(F.monotonically_increasing_id().alias("uid"), F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.length("text").cast("long").alias("cp"), norm.alias("norm"))
    first = materialize(row.mapInArrow(lambda it: hashed_rows(it, spill_bytes), KIND), "exact-rows")
    todo, done, rounds = first.where("norm IS NOT NULL"), None, 0
    while True:
        # The first deal is by length and content; what was spilled is dealt again, over parts that fit.
        deal = [F.octet_length("norm"), F.xxhash64("norm", F.lit(rounds))]
        if rounds:
            size = todo.agg(F.sum(F.octet_length("norm").cast("long") + NODE)).first()[0]
            todo = todo.repartition(max(1, -(-4 * size // spill_bytes)), *deal)
        else:
            todo = todo.repartition(*deal)
        part = materialize(todo.mapInArrow(lambda it: owned_texts(it, spill_bytes), KIND), "exact-owners")
        own = part.where("norm IS NULL").select("sha", F.col("id").alias("keep"), F.col("uid").alias("keep_uid"), F.col("n").alias("group_size"))
        done = own if done is None else done.unionByName(own)
        todo, rounds = part.where("norm IS NOT NULL"), rounds + 1
        if not todo.head(1):
            break
    many = done.where("group_size > 1")
    own = first.where("norm IS NULL").select("uid", "id", "sha")
    j = join_counted(own, many, ["sha"], "group_size", "left")
    keep = F.coalesce("keep", "id")
    return j.select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"),
        F.when(keep != LAST, keep).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_uid", "uid") == F.col("uid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
"""
