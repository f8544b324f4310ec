"""Models against plain numpy or brute force, and odd tables: none, one, constant."""

import math
from collections import Counter

import numpy as np
import pytest

from spotgrain.operators import joins, matrix, metrics, modelling, reports, statistics, summaries, visitors
from spotgrain.streaming.metrics import first_of_key, visited, windowed_metrics

MATRIX = "feature long, barcode long, umis long"


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(4)
    x = rng.poisson(rng.gamma(1.0, 1.0, (6, 1)) * rng.gamma(2.0, 1.0, (1, 40)))
    x[3] = x[2] + (rng.random(40) < 0.2)
    return x


def rows_of(x):
    return [(f, b, int(x[f, b])) for f in range(x.shape[0]) for b in range(x.shape[1]) if x[f, b]]


def test_components(spark, counts):
    m = spark.createDataFrame(rows_of(counts), MATRIX)
    got = modelling.principal_components(m, m.select("feature").distinct(), counts.shape[1], 3).collect()
    y = np.log2(1 + counts)
    y = (y - y.mean(1, keepdims=True)) / y.std(1, keepdims=True)
    value, vector = np.linalg.eigh(y @ y.T / y.shape[1])
    for j in range(3):
        v = vector[:, -1 - j]
        v = v * np.sign(v[np.argmax(np.abs(v))])
        mine = [r for r in got if r.component == j + 1]
        assert mine[0].variance == pytest.approx(value[-1 - j])
        assert [r.weight for r in sorted(mine, key=lambda r: r.feature)] == pytest.approx(v.tolist(), abs=1e-6)


def test_exact_p(spark):
    # Two Poisson sides are a binomial split.
    total, a, share = 20, 4, 3 / 8
    p = [math.comb(total, k) * share**k * (1 - share) ** (total - k) for k in range(total + 1)]
    assert modelling.exact_p(a, total - a, 3.0, 5.0, 0.0) == pytest.approx(sum(x for x in p if x <= p[a] + 1e-12))
    assert modelling.exact_p(0, 0, 1.0, 1.0, 0.1) == 1.0
    assert modelling.exact_p(10, 10, 5.0, 5.0, 0.2) == pytest.approx(1.0)
    few, many = modelling.exact_p(30, 2, 5.0, 5.0, 0.01), modelling.exact_p(30, 2, 5.0, 5.0, 1.0)
    assert few < 1e-5 < many
    df = spark.createDataFrame([(30, 2, 5.0, 5.0, 0.01), (40_000, 38_000, 5.0, 5.0, 0.01)], "a long, b long, mean_a double, mean_b double, dispersion double")
    got = [r.p for r in modelling.with_exact_p(df).collect()]
    assert got[0] == pytest.approx(few) and 0 < got[1] <= 1


def test_merged_clusters():
    centres = {1: ([0.0, 0.0], 2), 2: ([0.0, 1.0], 2), 3: ([10.0, 0.0], 1)}
    got = modelling.merged_clusters(centres)
    assert [(a, b, n) for a, b, _, n in got] == [(1, 2, 4), (3, 4, 5)]
    assert got[0][2] == pytest.approx(math.sqrt(2 * 2 * 2 / 4))


def test_recovered_cells(spark):
    # 500 cells with some 1000 molecules each, and 5000 droplets with 5.
    df = spark.range(5500).selectExpr("id AS barcode", "IF(id < 500, 900 + id % 200, 5L) AS umis")
    n, loss = modelling.recovered_cells(df, "umis")
    assert 0.9 * 500 <= n <= 1.1 * 500 and loss < 5
    assert modelling.recovered_cells(df.where("false"), "umis") == (0, 0.0)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)).round(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(4)
    got = modelling.nearest(df.where("id % 10 = 0"), df, 5, part=7).collect()
    for q in range(0, 300, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = sorted((round(float(d[i]), 6), i) for i in range(300) if i != q)[:5]
        assert [(round(r.distance, 6), r.neighbour) for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == q] == want


def test_odd_tables(spark):
    none = spark.createDataFrame([], MATRIX)
    one = spark.createDataFrame([(1, 1, 3)], MATRIX)
    zero = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], MATRIX)
    for m in (none, one, zero):
        for f in (
            lambda m: matrix.dispersion(m, 1), lambda m: matrix.normalised(m, 10.0), statistics.size_factors, modelling.median_normalised, modelling.unit_length,
            lambda m: metrics.effective_diversity(m, "barcode", "feature", m["umis"]), lambda m: summaries.moments(m, "barcode", "umis"),
            lambda m: modelling.normalised_dispersion(matrix.dispersion(m, 1)), lambda m: modelling.log_moments(m, 1), lambda m: modelling.by_controls(m, m["feature"] == 1, 2.0, 5),
        ):
            assert f(m).collect() is not None
    flat = spark.createDataFrame([(r, c, 4) for r in range(3) for c in range(3)], "row long, col long, umis long")
    assert math.isnan(matrix.morans_i(flat).first()[0])
    assert math.isnan(reports.correlation(flat, "row", "umis").first().r)


def test_tags_that_never_meet(spark):
    c = spark.createDataFrame([(1, "a", 2), (2, "b", 2)], "barcode long, tag string, umis long")
    got = summaries.tag_correlations(c, 4).collect()
    assert [(r.a, r.b, round(r.r, 6)) for r in got] == [("a", "b", round(float(np.corrcoef([2, 0, 0, 0], [0, 2, 0, 0])[0, 1]), 6))]


def test_last_before_with_ties(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 5)], "k long, at long")
    right = spark.createDataFrame([(1, 5, "x", 1), (1, 5, "y", 2), (1, 4, "z", 9)], "k long, at long, v string, t long").repartition(3)
    got = {(r.k, r.at): r.last_v for r in joins.last_before(left, right, "k", "at", "v", "t").collect()}
    assert got == {(1, 5): "y", (1, 1): None, (2, 5): None}


def test_benjamini_hochberg(spark):
    p = [0.01, 0.04, 0.04, 0.03, 0.5]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(p)], "g long, i long, p double")
    got = {r.i: r.adjusted for r in metrics.benjamini_hochberg(df, "p", "g").collect()}
    order = sorted(range(5), key=lambda i: p[i])
    want, low = {}, 1.0
    for rank in range(5, 0, -1):
        low = min(low, p[order[rank - 1]] * 5 / rank)
        want[order[rank - 1]] = low
    assert got == pytest.approx(want)


def test_visitors(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(50)], "k long, v long")
    got = visitors.by_group(rows, "k", ["v"], lambda k, it: ({"k": k, "first": next(it)["v"]} for _ in range(1)), "k long,first long").collect()
    assert {(r.k, r.first) for r in got} == {(0, 0), (1, 1), (2, 2)}
    s = visitors.Strategies("corrector")
    s.add("none", lambda x: x)
    assert s.choose("none")(3) == 3
    with pytest.raises(ValueError, match="corrector"):
        s.choose("other")
    from pyspark.sql import functions as F

    df, seen = visited(rows, "rows", n=F.count("*"), most=F.max("v"))
    assert df.count() == 50 and seen.get == {"n": 50, "most": 49}


def test_stream_agrees_with_batch(spark, tmp_path):
    rows = [(f"2024-01-01 00:{m:02d}:00", "a" if m % 3 else "b", m) for m in range(30)]
    df = spark.createDataFrame(rows, "at string, g string, v long").selectExpr("CAST(at AS TIMESTAMP) AS at", "g", "v")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = windowed_metrics(stream, "at", "g", "10 minutes", "5 minutes", "v").writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.group, r.start.minute): (r.n, r.total, r.least, r.most) for r in spark.table("windows").collect()}
    want: dict = {}
    for m in range(30):
        want.setdefault(("a" if m % 3 else "b", m // 10 * 10), []).append(m)
    assert got == {k: (len(v), sum(v), min(v), max(v)) for k, v in want.items()}
    q = first_of_key(stream, "at", "5 minutes", "g").writeStream.format("memory").queryName("firsts").option("checkpointLocation", f"{tmp_path}/d").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert Counter(r.g for r in spark.table("firsts").collect()) == {"a": 1, "b": 1}


def test_component_variances(spark, counts):
    m, n = spark.createDataFrame(rows_of(counts), MATRIX), counts.shape[1]
    names = m.select("feature").distinct()
    want = np.linalg.eigvalsh(np.corrcoef(np.log2(1 + counts)))[::-1]
    got = modelling.component_variances(m, names, n).orderBy("first").collect()
    assert [(r.first, r.last) for r in got] == [(j, j) for j in range(1, 7)] and [r.variance for r in got] == pytest.approx(want.tolist())
    # More features than can be taken one by one: none is left out.
    (r,) = modelling.component_variances(m, names, n, most=5).collect()
    assert (r.first, r.last) == (1, 6) and r.variance == pytest.approx(want.sum())
    # Features that are the same everywhere are in neither.
    flat = m.union(spark.createDataFrame([(9, b, 2) for b in range(n)], MATRIX))
    names = flat.select("feature").distinct()
    for most in (5, 100):
        got = modelling.component_variances(flat, names, n, most).collect()
        assert sum(r.last - r.first + 1 for r in got) == 6 and sum(r.variance for r in got) == pytest.approx(6)
    assert {r.feature for r in modelling.principal_components(flat, names, n, 1).collect()} == set(range(6))
    assert modelling.component_variances(m.where("false"), names, n).collect() == []


def test_component_variances_of_many_features(spark, tmp_path):
    """2500 features, one of them in all barcodes."""
    from spotgrain.plans.queries import QUERIES

    spark.range(2500).selectExpr("id AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    part = "CASE WHEN id < 2500 THEN id * 20 + 3 ELSE 3 END AS l_partkey"
    spark.range(1, 5000).selectExpr("id % 2500 AS l_orderkey", part, "1L AS l_suppkey", "id AS l_linenumber", "1.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    r = QUERIES["component_variances"](spark, str(tmp_path)).first()
    assert (r.total, r.components) == (2499.0, 2499)
