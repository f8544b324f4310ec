"""Chunk dedup and mixing against brute force; toxicity, and the pipeline stage by stage."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from spotgrain.llm import chunk_dedup, mixing, toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in "ka lo mi nu pe ra so ti ve wu".split() for b in "bar den fil gos han jum kel".split()]
INSULTS = "blorgface snottwit grubhead"


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def brute_chunks(data):
    out, last = [], 0
    for c in range(1, len(data)):
        h = sum(int(chunk_dedup.GEAR[data[c - 1 - k]]) << k for k in range(min(32, c))) & 0xFFFFFFFF
        if c < 32 or h >> 26:
            continue
        while c - last > 1024:
            out.append((last, last + 1024))
            last += 1024
        if c - last >= 24:
            out.append((last, c))
            last = c
    while len(data) - last > 1024:
        out.append((last, last + 1024))
        last += 1024
    return out + [(last, len(data))] if len(data) > last else out


def test_chunks(spark):
    rng = random.Random(3)
    shared = prose(rng, 120)
    texts = {1: shared, 2: "ab " + shared, 3: None, 4: "", 5: "z" * 5000, 6: prose(rng, 60) + " é " + shared, 7: prose(rng, 30), None: shared + " end"}
    docs = spark.createDataFrame([(i, t, "l", "s", 1, "x", 2) for i, t in texts.items()], COLUMNS + ", digest string, place long")
    seen, want = set(), {}
    for i in sorted(texts, key=lambda x: (x is None, x)):
        raw = (texts[i] or "").encode()
        spans = []
        for a, b in brute_chunks(raw):
            if raw[a:b] in seen:
                if spans and spans[-1][1] == a:
                    spans[-1] = (spans[-1][0], b)
                else:
                    spans.append((a, b))
            seen.add(raw[a:b])
        want[i] = [s for s in spans if s[1] - s[0] >= 64]
    got = {r.doc_id: [(s["first"], s["last"]) for s in r.spans or ()] for r in chunk_dedup.substring_dedup(docs).collect()}
    assert got == want
    assert sum(map(bool, got.values())) >= 4
    for r in chunk_dedup.cleaned_bytes(docs).collect():
        raw, at, kept = (texts[r.doc_id] or "").encode(), 0, b""
        for a, b in want[r.doc_id]:
            kept, at = kept + raw[at:a], b
        assert bytes(r.kept) == kept + raw[at:]
    assert chunk_dedup.substring_dedup(docs.where("false")).count() == 0


def exponent(shares, target, limit):
    """The smallest exponent that keeps to both, by plain bisection."""

    def good(a):
        w = [p**a for p in shares]
        w = [x / sum(w) for x in w]
        return -sum(x * math.log(x) for x in w) <= target + 1e-12 and max(x / p for x, p in zip(w, shares)) <= limit + 1e-12

    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (low, mid) if good(mid) else (mid, high)
    return high


def test_mix(spark):
    rng = random.Random(5)
    rows = [(k, prose(rng, 1 + k % 40), "l", "a" if k % 3 else ("b" if k % 2 else None), 1) for k in range(3000)]
    rows += [(3000 + k, prose(rng, 20), "l", "rare", 1) for k in range(5)] + [(4000, None, "l", "mute", 1), (4001, "", "l", "mute", 1), (None, "x y", "l", "a", 1), (7, "again me", "l", "a", 1)]
    docs = spark.createDataFrame([(*r, "h") for r in rows], COLUMNS + ", mix_h string")
    tokens, count = Counter(), Counter((r[0], r[3]) for r in rows)
    for r in rows:
        tokens[r[3]] += len((r[1] or "").split())
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items() if t}
    own = -sum(p * math.log(p) for p in share.values())
    a = exponent(list(share.values()), own + 0.5 * (math.log(len(share)) - own), 4.0)
    z = sum(p**a for p in share.values())
    got = mixing.mix(docs).collect()
    used, epochs = Counter(), defaultdict(list)
    for r in got:
        used[r.source] += r.mix_tokens
        epochs[r.source, r.doc_id, r.mix_block, r.mix_slot].append(r.mix_epoch)
        assert r.mix_weight == pytest.approx(share[r.source] ** a / z if r.source in share else 0.0, abs=1e-5)
    for s, p in share.items():  # the budget is met to one document
        assert -1e-3 * total <= used[s] - p**a / z * total <= 40 + 1e-3 * total
        assert used[s] <= 4.0 * tokens[s] + 40
    assert all(sorted(e) == list(range(len(e))) for e in epochs.values())
    # Rows of a source differ by one epoch at most.
    for s in share:
        full = math.floor(p_quota) if (p_quota := share[s] ** a / z / share[s]) else 0
        assert {len(e) for k, e in epochs.items() if k[0] == s} <= {full, full + 1}
        assert full == 0 or sum(k[0] == s for k in epochs) == sum(n for k, n in count.items() if k[1] == s)
    assert sorted(r.doc_id for r in got if r.source == "mute") == [4000, 4001]
    assert mixing.mix(docs.where("false")).count() == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, rows by id, ids planted as toxic, copies, leaks)."""
    rng = random.Random(11)
    rows = {k: prose(rng, 30 + k % 50) for k in range(600)}
    toxic = {k for k in rows if k % 10 == 3}
    for k in toxic:
        w = rows[k].split()
        w[len(w) // 2] = INSULTS.split()[k // 10 % 3]
        rows[k] = " ".join(w)
    copies = {1000 + k: k for k in range(0, 200, 10)}
    for c, k in copies.items():  # half of them with a word changed
        w = rows[k].split()
        rows[c] = " ".join([*w[: c % 20 // 10], *["other"] * (c % 20 // 10), *w[2 * (c % 20 // 10) :]])
    items = {k: prose(rng, 25) for k in range(5)}
    leaks = {2000 + k for k in items}
    for k, t in items.items():
        rows[2000 + k] = prose(rng, 40) + " " + t + " " + prose(rng, 40)
    rows |= {3000: "", 3001: None, 3002: "one"}
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, None, "big" if i % 4 else "small", 1) for i, t in rows.items()], COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in rows if i < 600], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, toxic, copies, leaks


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}


def test_pipeline(spark, corpus):
    import corpus_pipeline as p

    d, rows, toxic, copies, leaks = corpus
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stage = dict(p.STAGES)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert set(rows) - ids(stage["toxicity"](spark, docs, d)) == toxic
    # Brute force: rows that are like no row before them that stays.
    sets, stay = {i: shingles(t) for i, t in rows.items()}, []
    for i in sorted(rows):
        if not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in stay):
            stay.append(i)
    assert len(stay) < len(rows) - len(copies)
    assert ids(stage["simhash"](spark, docs, d)) == set(stay)
    assert set(rows) - ids(stage["decontamination"](spark, docs, d)) == leaks
    kept = set(stay) - toxic - leaks
    # As a whole: what is left is in the mix or out of budget, and all mixed rows have a shard.
    got = p.run(spark, d).collect()
    assert {r.doc_id for r in got} <= kept
    # Whole passes over a source that gains share leave none of it out.
    assert {r.doc_id for r in got if r.doc_id % 4 == 0} == {i for i in kept if i % 4 == 0}
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.size == len((rows[r.doc_id] or "").encode()) + 1 for r in got)


def test_toxicity(spark, corpus):
    d, rows, toxic, _, _ = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    odd = [(None, "blorgface"), (1, None), (2, ""), (3, "blo-rg_face " + "pebar " * 50_000), (3, "again")]
    more = spark.createDataFrame([(i, t, "x", "y", 1, 0.1, 1) for i, t in odd], COLUMNS + ", score double, toxic int")
    got = toxicity.toxicity_scores(more, model).collect()
    assert len(got) == len(odd)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score < 0.5 for r in got if r.doc_id in (1, 2))
    assert toxicity.toxicity_scores(more.where("false"), model).count() == 0


def test_planted_passages(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    own = lambda n: " ".join(word() for _ in range(n))
    shared = [own(50) for _ in range(300)]
    rows = [(k + 1000 * c, f"{own(40 + c)} {p} {own(40)}") for k, p in enumerate(shared) for c in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_removed for r in chunk_dedup.op3_substring_dedup(spark, str(tmp_path)).collect()}
    assert not any(got[k] for k in range(300))
    assert sum(got[1000 + k] == 0 for k in range(300)) <= 9
    assert sum(got[1000 + k] for k in range(300)) >= 0.65 * sum(len(p) for p in shared)
