"""Secret scan: key patterns, and random tokens found by a test battery.

Patterns give the base spans.  For tokens outside of them, a battery of
randomness tests (chi-squared uniformity over the alphabet of the inferred
encoding, Wald-Wolfowitz runs about the alphabet's middle, lag-1 serial
correlation) gives one p-value under "the characters are drawn evenly"; its
cut is set for each encoding, mix of character classes and length band so that
the estimated share of ordinary tokens among the reported ones stays under
``fdr``.  The estimate counts distinct tokens; bands with few of them borrow
from the nearest lengths of their encoding.  An encoding with few in all is cut
at a fixed level where its tokens mix letters and digits; where they do not,
they are words for all that can be told, and none is reported.  Everything is a
SQL expression.

Candidates are tokens of ``CANDIDATE``: 20 characters and more of one encoding.
Shorter ones say too little: the battery cannot tell them from words.

Cases: a null or empty text has no spans; each row is judged on its own, so
shared ids do no harm; a null doc_id is kept; repeated rows are reported once
each; a very long text costs in proportion to its length, its spans are put in
place by blocks, and where many candidates meet many base spans they are
compared by an equality join instead of one by one; other columns are not read,
so their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The last letter of a keyword and what stands between it and the value.
ASSIGN_TAIL = r"""[dtnyDTNY]["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Encodings by the class of characters that a token keeps to, narrowest first.
ENCODINGS = (
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
BINS = 100
#: Distinct tokens that the estimate needs; under that p >= 0.01 is reported.
FEW, LEVEL = 200, 1
#: Matches that are put in place together.
BLOCK = 256
#: Pairs of candidates and base spans of a text that are compared within its row.
IN_ROW = 100_000
SPAN = "struct<start:int,ord:int,kind:string,end:int,token:string>"


def match_spans(text: Column, pattern: str, kind: str, order: int, first: Column | None = None) -> Column:
    """Code point spans of all leftmost non-overlapping matches: what
    ``split`` leaves between matches and the matches themselves alternate.
    Places are summed up within blocks, then over the blocks, so the time is
    in proportion to the matches but for their number squared over BLOCK squared.
    ``first`` is a cheaper test that holds for every text with a match."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(gaps.alias("g"), hits.alias("m"))

    def within(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
            lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(
                F.struct(
                    (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"),
                    F.concat(
                        acc["out"],
                        F.array(
                            F.struct(
                                (acc["at"] + F.length(x["g"])).alias("start"),
                                F.lit(order).alias("ord"),
                                F.lit(kind).alias("kind"),
                                (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("end"),
                                x["m"].alias("token"),
                            )
                        ),
                    ).alias("out"),
                )
            ),
        )

    def walked(parts: Column) -> Column:
        begins = F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"])))
        moved = lambda x, at: F.transform(x["out"], lambda y: F.struct((y["start"] + at).alias("start"), y["ord"].alias("ord"), y["kind"].alias("kind"), (y["end"] + at).alias("end"), y["token"].alias("token")))
        return F.flatten(F.zip_with(parts, F.slice(begins, F.lit(1), F.size(parts)), moved))

    once = lambda c, f: F.transform(F.array(c), f)[0]  # noqa: E731  c is worked out once, however often f names it
    blocks = once(both, lambda z: F.transform(F.sequence(F.lit(0), F.size(z) - 1, F.lit(BLOCK)), lambda k: within(F.slice(z, k + 1, F.lit(BLOCK)))))
    none = F.array().cast(f"array<{SPAN}>")
    test = text.rlike(pattern)
    if first is not None:
        test = first & test
    return F.when(test, once(blocks, walked)).otherwise(none)


def normal_tail(z: Column) -> Column:
    """P(Z > z): the logistic form of the normal distribution function with a
    cubic term, within 2e-4 everywhere and monotone."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.070566 * z * z * z)))


def battery(token: Column) -> Column:
    """struct(enc, n, p) of a token: p is Fisher's combination of the three
    tests.  enc is null where the token fits no encoding or mixes no classes."""
    body = F.rtrim(token, F.lit("="))
    enc = F.coalesce(*[F.when(body.rlike(rx), F.lit(i)) for i, (_, rx, _) in enumerate(ENCODINGS)])
    # Words are of one class of letters; encoded bytes of this length hardly ever.
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    alphabet = F.element_at(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), enc + 1)
    k, n = F.length(alphabet).cast("double"), F.length(body).cast("double")
    chars = F.split(body, "")
    values = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.instr(alphabet, c).cast("double"))
    squares = F.aggregate(F.array_distinct(F.filter(chars, lambda c: c != "")), F.lit(0.0), lambda acc, c: acc + F.pow((F.length(body) - F.length(F.replace(body, c, F.lit("")))).cast("double"), F.lit(2.0)))
    chi = k / n * squares - n
    df = k - 1
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    runs = F.aggregate(
        values,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("r"), F.lit(0.0).alias("hi"), F.lit(0.0).alias("prev"), F.lit(0.0).alias("lag")),
        lambda a, v: F.struct(
            F.when(v > k / 2, 1).otherwise(0).alias("last"),
            (a["r"] + F.when(a["last"] != F.when(v > k / 2, 1).otherwise(0), 1.0).otherwise(0.0)).alias("r"),
            (a["hi"] + F.when(v > k / 2, 1.0).otherwise(0.0)).alias("hi"),
            (v - (k + 1) / 2).alias("prev"),
            (a["lag"] + a["prev"] * (v - (k + 1) / 2)).alias("lag"),
        ),
    )
    return F.struct(enc.alias("enc"), mixed.alias("mixed"), n.alias("n"), z_chi.alias("z_chi"), runs["r"].alias("r"), runs["hi"].alias("hi"), runs["lag"].alias("lag"), k.alias("k"))


def p_value(b: Column) -> Column:
    n, hi = b["n"], b["hi"]
    mean = 2 * hi * (n - hi) / n + 1
    var = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
    z_runs = F.when((hi == 0) | (hi == n), F.lit(8.0)).otherwise(F.abs(b["r"] - mean) / F.sqrt(var))
    # Under evenness lag-1 products have mean 0 and variance ((k^2-1)/12)^2 each.
    z_lag = F.abs(b["lag"]) / (F.sqrt(n - 1) * (b["k"] * b["k"] - 1) / 12)
    floor = F.lit(1e-300)
    x = -2 * (
        F.log(F.greatest(normal_tail(b["z_chi"]), floor))
        + F.log(F.greatest(2 * normal_tail(z_runs), floor))
        + F.log(F.greatest(2 * normal_tail(z_lag), floor))
    )
    return F.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def bare(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end")))


def outside(rows: DataFrame, in_row: int = IN_ROW) -> DataFrame:
    """``rows`` (uid, doc_id, base, r), a written table, with r less the spans
    that meet a base span.  Rows with up to ``in_row`` pairs have been seen to;
    the others go by way of an equality join on blocks of 4096 characters."""
    pairs = F.size("base").cast("long") * F.size("r")
    light, heavy = rows.where(pairs <= in_row), rows.where(pairs > in_row)
    if not heavy.head(1):
        return light
    cells = lambda x: F.sequence(F.shiftright(x["start"], 12), F.shiftright(x["end"] - 1, 12))
    base = heavy.select("uid", F.explode("base").alias("y")).select("uid", "y", F.explode(cells(F.col("y"))).alias("cell"))
    cand = heavy.select("uid", F.posexplode("r").alias("i", "x")).select("uid", "i", "x", F.explode(cells(F.col("x"))).alias("cell"))
    met = cand.join(base, ["uid", "cell"]).where("y.start < x.end AND x.start < y.end").select("uid", "i").distinct()
    kept = heavy.select("uid", F.posexplode("r").alias("i", "x")).join(met, ["uid", "i"], "left_anti")
    kept = kept.groupBy("uid").agg(F.array_sort(F.collect_list("x")).alias("k"))
    kind = heavy.schema["r"].dataType
    heavy = heavy.join(kept, "uid", "left").select("uid", "doc_id", "base", F.coalesce("k", F.array().cast(kind)).alias("r"))
    return light.unionByName(heavy)


def secret_spans(docs: DataFrame, fdr: float = 0.05, in_row: int = IN_ROW) -> DataFrame:
    """(doc_id, base, random): arrays of struct(start, ord, kind, end).

    Two passes: the spans with p-values go to a scratch table without the
    texts; a bounded histogram of it gives the cuts."""
    d = docs_of(docs)
    # The longest legal stretch is one match, so a too short value is dropped, not skipped over.
    assign = F.filter(match_spans(F.col("text"), ASSIGN, "assign", 0, F.col("text").rlike(ASSIGN_TAIL)), lambda x: F.length(F.regexp_extract(x["token"], ASSIGN, 1)) >= 12)
    access = match_spans(F.col("text"), ACCESS, "access", 1, F.contains(F.col("text"), F.lit("AKIA")))
    hexes = match_spans(F.col("text"), HEX, "hex", 2)
    cand = match_spans(F.col("text"), CANDIDATE, "random", 3)
    d = d.select(F.monotonically_increasing_id().alias("uid"), "doc_id", bare(F.concat(assign, access, hexes)).alias("base"), cand.alias("r"))
    pairs = F.size("base").cast("long") * F.size("r")
    free = F.filter("r", lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    d = d.withColumn("r", F.when(pairs <= in_row, free).otherwise(F.col("r")))
    tested = F.transform("r", lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"), F.unhex(F.md5(x["token"])).alias("digest"), battery(x["token"]).alias("b")))
    known = F.filter(tested, lambda x: x["b"]["enc"].isNotNull())
    final = F.transform(
        known,
        lambda x: F.struct(
            x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"),
            ((x["b"]["enc"] * 2 + F.when(x["b"]["mixed"], 1).otherwise(0)) * 64 + F.floor(F.log2(x["b"]["n"]) * 2).cast("int")).alias("stratum"),
            F.least(F.floor(p_value(x["b"]) * BINS).cast("int"), F.lit(BINS - 1)).alias("bin"),
            x["digest"].alias("digest"),
        ),
    )
    rows = materialize(d.select("uid", "doc_id", "base", final.alias("r")), "secret-spans")
    spans = outside(rows, in_row)
    cuts = false_discovery_cuts(spans, fdr)
    cut = F.create_map(*[F.lit(v) for kv in cuts.items() for v in kv]) if cuts else F.create_map().cast("map<int,int>")
    found = F.filter("r", lambda x: x["bin"] >= F.coalesce(F.element_at(cut, x["stratum"]), F.lit(BINS)))
    return spans.select("doc_id", "base", bare(found).alias("random"))


def false_discovery_cuts(spans: DataFrame, fdr: float) -> dict[int, int]:
    """The lowest p-value bin to report, by stratum (encoding, class mix and
    half octave of length).  Copies of a token count once.  The histogram has
    at most strata x BINS rows, whatever the size of the corpus."""
    tokens = spans.select(F.explode("r").alias("x")).select("x.stratum", "x.bin", "x.digest").distinct()
    rows = tokens.groupBy("stratum", "bin").count().collect()
    strata: dict[int, list[int]] = {}
    for stratum, b, n in rows:
        strata.setdefault(stratum, [0] * BINS)[b] += n
    # Encodings are numbered so that odd strata (over 64) mix classes.
    return {s: evident_cut(pooled(strata, s), fdr, s // 64 % 2 == 1) for s in strata}


def pooled(strata: dict[int, list[int]], stratum: int) -> list[int]:
    """The stratum's histogram; with under FEW tokens, with the nearest
    lengths of its encoding added until there are as many."""
    hist = [0] * BINS
    for far in range(64):
        for s in {stratum - far, stratum + far}:
            if s in strata and s // 64 == stratum // 64:
                hist = [x + y for x, y in zip(hist, strata[s])]
        if sum(hist) >= FEW:
            break
    return hist


def evident_cut(hist: list[int], fdr: float, mixed: bool = True) -> int:
    """The lowest bin such that of the tokens from there on an estimated
    share of at most ``fdr`` is ordinary; BINS (nothing is reported) if none.

    Random tokens fill all bins alike.  Ordinary ones thin out towards high p,
    but not to nothing: what is left of them in the last quarters is carried
    on from how the counts fall from quarter to quarter (a + k, a r + k,
    a r^2 + k for the last three), as far as that is more than chance."""
    if sum(hist) < FEW:
        return LEVEL if mixed else BINS
    quarter = BINS // 4
    a, b, c = (sum(hist[i * quarter : (i + 1) * quarter]) for i in (1, 2, 3))
    falls = a - b > 2 * math.sqrt(a + b) or b - c > 2 * math.sqrt(b + c)
    if not falls:
        level = (a + b + c) / 3
    else:
        bend = a + c - 2 * b
        level = min(c, max(0.0, (a * c - b * b) / bend)) if bend > 0 else c
    even = level / quarter  # random tokens a bin
    above, best = 0, BINS
    for i in range(BINS - 1, -1, -1):
        above += hist[i]
        if above and 1 - even * (BINS - i) / above <= fdr:
            best = i
    return best


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secret_spans(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return s.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.size("random").cast("long").alias("n_random"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "random")).alias("spans"),
    )
