"""Clonotypes against brute force."""

import random

import pytest

from spotgrain.operators import repertoire


def brute(sets):
    known = set(sets)
    return {a for a in known if any(b < a and a - b in known for b in known if b)}


def found(spark, sets, **settings):
    rows = [(";".join(sorted(s)), sorted(s)) for s in set(sets)]
    df = spark.createDataFrame(rows, "clonotype string, contigs array<string>").repartition(3)
    return sorted(r.clonotype for r in repertoire.doublets(df, **settings).collect())


@pytest.mark.parametrize("most", [1, 3, 10])
def test_doublets(spark, most):
    rng = random.Random(most)
    sets = [frozenset(rng.sample("abcdefghij", rng.randint(1, 7))) for _ in range(150)]
    want = sorted(";".join(sorted(s)) for s in brute(sets))
    assert want and len(want) < len(set(sets))
    assert found(spark, sets, most=most) == want


def test_doublets_of_many_contigs(spark):
    """Some with over 10 and over 100 contigs, made of two others or but for one contig."""
    rng = random.Random(5)
    names = [f"c{i}" for i in range(300)]
    sets = []
    for size in [11, 12, 25, 40, 101, 150] * 4:
        a = rng.sample(names, size)
        cut = rng.choice([1, 2, 3, size // 2, size - 1])
        sets += [frozenset(a), frozenset(a[:cut]), frozenset(a[cut : size - rng.choice([0, 0, 1])])]
    sets = [s for s in sets if s]
    want = sorted(";".join(sorted(s)) for s in brute(sets))
    assert sum(x.count(";") >= 10 for x in want) > 5 and sum(x.count(";") >= 100 for x in want) > 1
    assert found(spark, sets) == want


def rows_made(node):
    """The rows of each step of a plan that has run."""
    out = [node.metrics().get("numOutputRows").get().value()] if node.metrics().contains("numOutputRows") else []
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        below = [node.executedPlan()]
    elif kind.endswith("QueryStageExec"):
        below = [node.plan()]
    else:
        below = [node.children().apply(i) for i in range(node.children().size())]
    return out + [n for x in below for n in rows_made(x)]


@pytest.mark.parametrize("most", [2, 10])
def test_doublets_make_no_pairs_that_share_contigs(spark, most):
    """3000 clonotypes over 26 contigs: the pairs that share one are millions."""
    rng = random.Random(2)
    sets = {frozenset(rng.sample("abcdefghijklmnopqrstuvwxyz", rng.randint(1, 6))) for _ in range(3000)}
    df = spark.createDataFrame([(";".join(sorted(s)), sorted(s)) for s in sets], "clonotype string, contigs array<string>")
    df = repertoire.doublets(df, **({} if most == 10 else {"most": most}))
    assert sorted(r.clonotype for r in df.collect()) == sorted(";".join(sorted(s)) for s in brute(sets))
    assert max(rows_made(df._jdf.queryExecution().executedPlan())) < 30 * len(sets)


def test_doublets_of_none(spark):
    assert found(spark, []) == [] and found(spark, [frozenset("a"), frozenset("ab")]) == []
