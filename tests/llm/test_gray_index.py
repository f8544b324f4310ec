"""The Gray-order index against all pairs, on scattered and on dense groups."""

import numpy as np
import pytest

from spotgrain.llm import simhash


def brute(fps: np.ndarray) -> np.ndarray:
    root = np.arange(len(fps))
    for k in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[k]) <= simhash.RADIUS)
        root = simhash.joined(root, np.full(len(near), k), near)
    return root


def scattered(n: int, flips: int) -> np.ndarray:
    rng = np.random.default_rng(n + flips)
    out, count = np.full(n, np.uint64(0x0123456789ABCDEF)), rng.integers(0, flips + 1, n)
    for k in range(flips):
        bit = np.uint64(1) << rng.integers(0, 38, n).astype(np.uint64)
        out = np.where(k < count, out ^ bit, out)
    return np.unique(out)


@pytest.mark.parametrize(("n", "flips"), [(1, 0), (20, 3), (300, 4), (900, 8), (900, 14)])
def test_group_edges_connect_what_links(n, flips):
    fps = scattered(n, flips)
    src, dst = simhash.group_edges(fps)
    place = {int(x): i for i, x in enumerate(fps)}
    i, j = (np.array([place[int(x)] for x in side], np.int64) for side in (src, dst))
    assert (np.bitwise_count(src ^ dst) >= 1).all()
    assert (simhash.joined(np.arange(len(fps)), i, j) == brute(fps)).all()


@pytest.mark.parametrize("dense", [8, 32, 1 << 20])
def test_dense_buckets_lose_no_link(spark, monkeypatch, dense):
    """Buckets cut by further bits, once or twice, give the same classes."""
    fps = scattered(400, 6)
    monkeypatch.setattr(simhash, "DENSE", dense)
    rows = spark.createDataFrame([(0, int(x)) for x in fps.view(np.int64)], "g int, fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = simhash.fingerprint_edges(rows).collect()
    i, j = (np.array([place[r[k]] for r in got], np.int64) for k in ("src", "dst"))
    assert (simhash.joined(np.arange(len(fps)), i, j) == brute(fps)).all()
