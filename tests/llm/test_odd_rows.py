"""Shared and missing ids, repeated rows, clashing names, long and empty texts:
no row may lose text, or its place, for another's sake."""

import random
from collections import Counter

import numpy as np
import pytest

from spotgrain.llm import chunk_dedup, decontaminate, exact_dedup, line_dedup, mixing, secret_scan, sharding, simhash, suffix_dedup, toxicity
from spotgrain.llm.common import join_counted, materialize, place_of, repeated_rows

KIND = "doc_id long, text string, source string, uid long, key string, n long, row string, th long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def lines(rng, n):
    return "\n".join(words(rng, 6) for _ in range(n))


RNG = random.Random(21)
A, B, C, D = (lines(RNG, 30) for _ in range(4))
#: (1, A) again without an id; B and C only once; D in equal rows, and under an id of two texts.
ROWS = [(1, A), (None, A), (None, B), (5, C), (5, D), (7, D), (8, D), (8, D), (None, None), (None, ""), (9, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", 3, "k", 1, "r", 2) for i, t in ROWS], KIND).repartition(3).cache()


def kept_once(kept: Counter, least: float = 1.0):
    """Of each text one row keeps (almost) all, the others nothing."""
    for t in (A, B, C, D):
        whole = [n for (text, n), k in kept.items() if text == t for _ in range(k)]
        assert sum(n >= least * len(t) for n in whole) == 1
        assert all(n == 0 or n >= least * len(t) or n <= (1 - least) * len(t) + 64 for n in whole)


def test_chunks(docs):
    # Chunks of one text are cut alike, so copies lose every byte.
    rows = chunk_dedup.cleaned_bytes(docs).collect()
    assert len(rows) == len(ROWS)
    text_of = {i: [t for j, t in ROWS if j == i] for i, _ in ROWS}
    for t in (A, B, C, D):
        assert sum(bytes(r.kept) == t.encode() for r in rows) == 1
    assert sum(len(r.kept) for r in rows) == sum(map(len, (A, B, C, D)))
    assert all(r.doc_id in text_of for r in rows)
    got = chunk_dedup.substring_dedup(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)


def test_lines(docs):
    rows = line_dedup.cleaned_lines(docs).collect()
    assert len(rows) == len(ROWS)
    assert Counter(r.text for r in rows) == Counter([A, B, C, D] + [""] * 7)


def test_suffix(docs):
    for hot in (1, 4096):
        rows = suffix_dedup.suffix_dedup(docs, hot_from=hot).collect()
        assert len(rows) == len(ROWS)
        assert sum(r.n_bytes - r.n_removed for r in rows) == sum(map(len, (A, B, C, D)))
        assert sum(r.n_removed == 0 and r.n_bytes > 0 for r in rows) == 4


def test_exact(docs):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(ROWS)
    assert sum(r.kept for r in rows) == 5
    assert all(sum(r.kept for r in rows if r.text_sha256 == h) == 1 for h in {r.text_sha256 for r in rows})


def test_near_dedup(docs):
    rows = simhash.near_dedup(docs).collect()
    assert Counter(r.text or "" for r in rows) == Counter([A, B, C, D, ""])
    assert simhash.near_dedup(docs).columns == docs.columns
    assert simhash.near_dedup(docs.where("false")).count() == 0
    assert len(simhash.simhash_components(docs).collect()) == len(ROWS)


def test_near_dedup_of_a_large_group(spark, monkeypatch):
    """More near copies than centres of a round: all but one go."""
    rng, base = random.Random(2), words(random.Random(1), 300).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(300)] = words(rng, 1)
        rows.append((k, " ".join(w)))
    rows += [(100 + k, words(rng, 50)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "CENTRES", 4)
    got = {r.doc_id for r in simhash.near_dedup(df, part_bytes=4096).collect()}
    sets, stay = {i: simhash.shingle_set(t, 5) for i, t in rows}, []
    for i, _ in rows:
        if not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in stay):
            stay.append(i)
    assert got == set(stay)


def test_decontaminate(spark, docs):
    bench = spark.createDataFrame([(1, D), (2, None), (3, "")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter([A, A, B, C, "", "", ""])
    # The benchmark in many parts is the same benchmark.
    items = [(k, words(RNG, 30)) for k in range(12)]
    rows = [(k, f"{words(RNG, 20)} {t} {words(RNG, 20)}") for k, t in items]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(decontaminate.contaminated(df, bench, part_chars=n).collect()) for n in (1 << 20, 500))
    assert one == many
    assert [(r.doc_id, r.item_id) for r in one] == [(k, k) for k in range(12)]


def edits(item, text):
    """The fewest edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i] + [0] * len(text)
        for j, y in enumerate(text, 1):
            row[j] = min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1)
    return min(row)


def test_decontaminate_against_edit_distance():
    rng = random.Random(12)
    small = lambda n: "".join(rng.choice("ab c") for _ in range(n))  # noqa: E731  repetitive: bands overlap
    items = [(k, decontaminate.normal(words(rng, 1 + k % 8) if k % 2 else small(3 + 4 * k))) for k in range(24)]
    texts = []
    for k in range(200):
        t = list(rng.choice(items)[1])
        for _ in range(rng.randrange(7)):
            p = rng.randrange(len(t) + 1)
            t[p : p + rng.randrange(2)] = rng.choice(["", "x", "é", "zz"])
        texts.append(decontaminate.normal(words(rng, 3) + " " + "".join(t) + " " + (words(rng, 3) if k % 2 else small(30))))
    index = decontaminate.part_index(items)
    found = {(r[0], r[1]) for r in decontaminate.matches(index, texts) if r[6] == 0 and r[7] == r[5]}
    for d, t in enumerate(texts):
        for i, item in items:
            if item:
                assert ((d, i) in found) == (edits(item, t) <= int(0.1 * len(item))), (item, t)


def test_decontaminate_repetitive_text(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_HITS", 20_000)
    index = decontaminate.part_index([(1, "a" * 200), (2, "xy")])
    got = decontaminate.matches(index, ["a" * 20_000, "b" * 300 + "a" * 200 + "b" * 300, "b" * 500, "wxyz"])
    assert {(r[0], r[1]) for r in got if r[5] == r[7] - r[6]} == {(0, 1), (1, 1), (3, 2)}
    assert {r[0] for r in got} == {0, 1, 3}
    monkeypatch.setattr(decontaminate, "STRETCH", 1000)
    item = words(random.Random(3), 40)
    long = words(random.Random(4), 400) + " " + item + " " + words(random.Random(5), 400)
    got = decontaminate.matches(decontaminate.part_index([(1, item)]), [decontaminate.normal(long)])
    assert {r[2:] for r in got} == {(long.index(item), long.index(item) + len(item), 0, len(item), 0, len(item))}


def test_mix_does_not_depend_on_the_partitioning(spark):
    rng = random.Random(6)
    rows = [(7, f"t{k} " + words(rng, 1 + k % 5), "a" if k % 4 else "b") for k in range(400)] + [(None, words(rng, 3), "a") for _ in range(300)] + [(3, "equal row", "b")] * 500
    got = []
    for n in (1, 5, 16):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        mixed = mixing.mix(df, columns=["doc_id", "text", "source"]).collect()
        got.append(sorted(map(str, mixed)))
    assert got[0] == got[1] == got[2]


def test_sharding_of_equal_rows(spark):
    rows = [(3, "equal row")] * 3000 + [(None, None)] * 50 + [(k, "w" * (k % 90)) for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.histogram_shards(df, 4, piece=64).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 0.02 * sum(size.values())
    for s in size:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    import zlib

    want = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == want


def test_secret_spans_by_either_way(spark, docs):
    rng = random.Random(14)
    token = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(20))
    texts = [" ".join(rng.choice([hexes(), token(30), "token=" + token(24), token(10) + hexes() + token(10), words(rng, 4)]) for _ in range(700)) for _ in range(3)]
    df = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2])], "doc_id long, text string")
    a, b = (sorted(map(str, secret_scan.secret_spans(df, in_row=n).collect())) for n in (1 << 30, 0))
    assert a == b
    assert secret_scan.secret_spans(docs).count() == len(ROWS)


def subsequence_kernel(a, b):
    """The kernel by its definition: gapped triples, ends included."""

    def feature(w):
        x, out = [-1, *w, -2], Counter()
        for i in range(len(x)):
            for k in range(2, toxicity.SPAN):
                for j in range(1, k):
                    if i + k < len(x):
                        out[x[i], x[i + j], x[i + k]] += toxicity.DECAY ** (k + 1)
        return out

    f, g = feature(a), feature(b)
    norm = lambda w: np.sqrt(toxicity.self_value(np.array([len(w)])))[0]
    return sum(f[t] * g[t] for t in f) / norm(a) / norm(b)


def test_kernel_by_its_definition():
    rng = random.Random(3)
    some = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 90))) for _ in range(30)]
    marks = toxicity.Landmarks(some[:12])
    got = marks.kernel(some)
    # The two ends are one class in the table; no word has them at the same place of a triple but these two.
    for i, a in enumerate(some):
        for j, b in enumerate(some[:12]):
            if min(len(a), len(b)) >= toxicity.SPAN:
                assert got[i, j] == pytest.approx(subsequence_kernel(a, b), rel=1e-4, abs=1e-5)


def test_toxicity_without_labels_or_with_one_class(spark, docs):
    labels = spark.createDataFrame([(1, 0), (5, 0), (7, None), (77, 1)], "doc_id long, toxic int")
    for some, want in ((labels, 0.0), (labels.where("false"), 0.0), (labels.where("doc_id = 1").selectExpr("doc_id", "1 AS toxic"), 1.0)):
        model = toxicity.train(docs, some)
        assert {r.score for r in toxicity.toxicity_scores(docs, model).collect()} == {want}


def test_hot_keys_are_joined_whole(spark):
    left = spark.createDataFrame([(k % 7 if k % 3 else 99, k) for k in range(5000)], "k long, v long").cache()
    right = materialize(left.groupBy("k").count().withColumnRenamed("count", "n").where("k <> 5"), "test")
    plain = sorted(left.join(right, "k").collect())
    assert sorted(join_counted(left, right, ["k"], most=4).collect()) == plain
    assert sorted(map(str, join_counted(left, right, ["k"], how="left", most=4).collect())) == sorted(map(str, left.join(right, "k", "left").collect()))


def test_places_are_in_order(spark):
    rows = [(-5, 9, 3), (-5, 10, 0), (0, 0, 0), (0, 0, 1), (0, 2**31 - 1, 2**31 - 1), (1, 0, 0), (2**63 - 1, 2**31 - 1, 2**31 - 1)]
    df = spark.createDataFrame(rows, "ord long, th long, at int" if False else "ord long, th long, at long")
    got = [tuple(r)[:3] for r in df.withColumn("p", place_of("at")).orderBy("p").collect()]
    assert got == rows


def test_repeated_rows(spark):
    rows = materialize(spark.createDataFrame([(0, 1, b"a"), (1, 1, b"a"), (2, 1, b"b"), (3, 2, b"a"), (4, 1, b"a")], "uid long, ord long, digest binary"), "test")
    assert sorted(r.uid for r in repeated_rows(rows).collect()) == [1, 4]
    assert repeated_rows(rows.where("uid = 2")) is None
