"""Line dedup by content-defined chunks of lines, extended to single windows.

A rolling hash over the hashes of ``min_lines`` neighbouring lines chooses
where a chunk of lines ends, so an insertion moves at most the borders next to
it.  A chunk of several lines that an earlier place holds too goes as a whole.
What chunks cannot see (passages that lie across borders, or are shorter than
a chunk) is found line by line: every window of ``min_lines`` lines outside of
the chunks that go is looked up in the same way.  So of a run of two lines and
more that occurs more than once in the corpus all lines go, but for the first
occurrence (smallest doc_id, then first line).  A chunk or window that overlaps
its own first occurrence stays.  Whether two of them are equal is decided on
their bytes: they are grouped by their whole text; hashes (SHA-256 for chunks)
only say which need that, and a SHA-256 carries the verdict back.  Texts are
exchanged once, for chunks and windows together.

Cases: a null or empty text has no window of two lines; each row is judged on
its own, rows that share a doc_id in the order of their texts' hashes, null
doc_ids last in the same way; of rows with equal id and text all but one lose
all their windows; of equal windows at equal places of rows whose id and hash
agree though their texts differ both stay; a very long text costs in proportion
to its lines; other columns of the input are not read, so their names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, join_counted, materialize, place_of, release, repeated_rows, row_order, table

SPANS = "array<struct<first:int,last:int>>"
#: Lines of a chunk on average.
MEAN_LINES = 8


def lined(docs: DataFrame, min_lines: int = 2) -> DataFrame:
    """A written table: (uid, doc_id, ord, th, digest, n_lines, lines, h) of
    every row.  lines are the text, h has the hash of each window and is null
    for texts with fewer lines."""
    d = docs_of(docs).select(F.monotonically_increasing_id().alias("uid"), "doc_id", *row_order(), F.unhex(F.md5("text")).alias("digest"), F.split("text", "\n", -1).alias("l"))
    # One pass over each document: a look-up by place in a lambda would split the text again for each line.
    h, *more = [F.slice("l", F.lit(k + 1), F.size("l") - (min_lines - 1)) for k in range(min_lines)]
    for x in more:
        h = F.zip_with(h, x, lambda a, b: F.xxhash64(a, b))
    d = d.select("uid", "doc_id", "ord", "th", "digest", F.size("l").cast("long").alias("n_lines"), F.col("l").alias("lines"), F.when(F.size("l") >= min_lines, h).alias("h"))
    return materialize(d, "lined")


def line_chunks(rows: DataFrame, min_lines: int = 2, mean_lines: int = MEAN_LINES) -> DataFrame:
    """(uid, first, last, place, h) of the content-defined chunks of min_lines
    lines and more; a chunk ends before a line where the rolling hash says so.
    h is the SHA-256 of its text."""
    n = F.col("n_lines").cast("int")
    cuts = F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.pmod(F.get("h", i - 1), F.lit(mean_lines)) == 0)
    d = rows.where("h IS NOT NULL").select("uid", "ord", "th", "lines", F.concat(F.array(F.lit(0)), cuts).alias("a"), F.concat(cuts, F.array(n)).alias("b"))
    long = F.filter(F.arrays_zip("a", "b"), lambda x: x["b"] - x["a"] >= min_lines)
    named = F.transform(long, lambda x: F.struct(x["a"].alias("first"), x["b"].alias("last"), F.unhex(F.sha2(F.array_join(F.slice("lines", x["a"] + 1, x["b"] - x["a"]), "\n"), 256)).alias("h")))
    d = d.select("uid", "ord", "th", F.explode(named).alias("x"))
    return d.select("uid", "x.first", "x.last", "x.h", "ord", "th").select("uid", "first", "last", "h", place_of("first").alias("place"))


def line_windows(rows: DataFrame, gone: DataFrame, min_lines: int = 2) -> DataFrame:
    """(uid, first, last, h) of the windows that are in no chunk of ``gone``
    (uid, at): what is in one has an earlier copy, and is no first occurrence."""
    d = rows.where("h IS NOT NULL").select("uid", "h").join(gone.hint("merge"), "uid", "left")
    inside = F.flatten(F.transform("at", lambda x: F.sequence(x["first"], x["last"] - min_lines)))
    # A hash set, not a search for each window.
    left = F.array_except(F.sequence(F.lit(0), F.size("h") - 1), F.coalesce(inside, F.array().cast("array<int>")))
    d = d.select("uid", F.explode(F.transform(left, lambda i: F.struct(i.alias("first"), F.get("h", i).alias("h")))).alias("x"))
    return d.select("uid", "x.first", (F.col("x.first") + min_lines).alias("last"), "x.h")


def at_of(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("at"))


def repeated(pieces: DataFrame, *more) -> DataFrame:
    """Those of a hash that comes more than once."""
    again = materialize(pieces.groupBy("h").agg(F.count("*").alias("n"), *more).where("n > 1"), "line-hashes")
    return join_counted(pieces, again, ["h"])


def later_copies(rows: DataFrame, min_lines: int = 2) -> DataFrame:
    """(uid, at: array of first, last), a written table: the chunks and windows
    whose text an earlier place holds."""
    chunks = materialize(repeated(line_chunks(rows, min_lines), F.min("place").alias("owner")).select("uid", "first", "last", (F.col("place") - F.col("owner") >= F.col("last") - F.col("first")).alias("later")), "line-chunks")
    windows = repeated(line_windows(rows, at_of(chunks.where("later")), min_lines))
    hit = at_of(chunks.select("uid", "first", "last").unionByName(windows.select("uid", "first", "last")))
    # The one exchange of texts.
    d = rows.select("uid", "ord", "th", "lines").join(hit.hint("merge"), "uid")
    text = F.transform("at", lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), F.array_join(F.slice("lines", x["first"] + 1, x["last"] - x["first"]), "\n").alias("text")))
    d = d.select("uid", "ord", "th", F.explode(text).alias("x")).select("uid", "ord", "th", "x.first", "x.last", "x.text")
    written = materialize(d, "line-pieces")
    place, name = place_of("first"), F.unhex(F.sha2("text", 256)).alias("digest")
    # The hash aggregate compares whole texts; copies of one task become one row before they move.
    texts = written.groupBy("text").agg(F.count("*").alias("copies"), F.min(place).alias("owner")).where("copies > 1")
    by_name = texts.select(name, "copies", "owner").groupBy("digest").agg(F.count("*").alias("texts"), F.max("copies").alias("copies"), F.min("owner").alias("owner"))
    # No two texts with one SHA-256 are known; were there any, their pieces would stay.
    by_name = materialize(by_name.where("texts = 1").select("digest", "copies", "owner"), "line-owners")
    occ = written.select("uid", "first", "last", place.alias("place"), name)
    later = join_counted(occ, by_name, ["digest"], "copies").where(F.col("place") - F.col("owner") >= F.col("last") - F.col("first"))
    out = materialize(at_of(later), "line-copies")
    release(chunks, written, by_name)
    return out


def removed_lines(rows: DataFrame, min_lines: int = 2) -> DataFrame:
    """(uid, removed): the line ranges to remove, as long as possible, for
    rows with any."""
    copies = repeated_rows(rows.select("uid", "ord", "digest"))
    own = rows if copies is None else rows.join(copies, "uid", "left_anti")
    both = later_copies(own, min_lines)
    # No piece is inside of another, so both ends are in order; those that overlap or touch are one range.
    begins = F.filter("at", lambda x, i: (i == 0) | (x["first"] > F.get("at", i - 1)["last"]))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1)["first"] > x["last"]))
    spans = F.zip_with(begins, ends, lambda a, b: F.struct(a["first"].alias("first"), b["last"].alias("last")))
    out = both.select("uid", spans.cast(SPANS).alias("removed"))
    if copies is not None:
        again = rows.join(copies, "uid", "left_semi").where(F.col("n_lines") >= min_lines)
        out = out.unionByName(again.select("uid", F.array(F.struct(F.lit(0).alias("first"), F.col("n_lines").cast("int").alias("last"))).cast(SPANS).alias("removed")))
    return out


def line_dedup(docs: DataFrame, min_lines: int = 2) -> DataFrame:
    """(doc_id, n_lines, removed) of every row."""
    rows = lined(docs, min_lines)
    gone = removed_lines(rows, min_lines)
    r = rows.select("uid", "doc_id", "n_lines").join(gone, "uid", "left")
    return r.select("doc_id", "n_lines", F.coalesce("removed", F.array().cast(SPANS)).alias("removed"))


def cleaned_lines(docs: DataFrame, min_lines: int = 2) -> DataFrame:
    """(doc_id, text) with the repeated ranges taken out."""
    rows = lined(docs, min_lines)
    gone = F.flatten(F.transform("removed", lambda x: F.sequence(x["first"], x["last"] - 1)))
    # Line numbers less those that go: a hash set, not a search for each line.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    r = rows.join(removed_lines(rows, min_lines), "uid", "left")
    text = F.array_join(F.when(F.col("removed").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i))), "\n")
    return r.select("doc_id", text.alias("text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many go, and the ranges that go."""
    r = line_dedup(table(spark, sf_dir, "documents"))
    ranges = F.transform("removed", lambda x: F.concat_ws(":", x["first"].cast("string"), x["last"].cast("string")))
    return r.select(
        "doc_id", "n_lines",
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"]).alias("n_removed_lines"),
        F.size("removed").cast("long").alias("n_removed_chunks"),
        F.array_join(ranges, ",").alias("removed"),
    )
