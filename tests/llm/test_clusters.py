"""Clustering over approximations against plain arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from matchweave.llm import va_clusters

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, k=8, rounds=10, width=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    found = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i is None, i or 0, c, d, sum(e for _, e, o in found if o == c), total, sha[c]) for i, d, c in found)


def got(spark, rows, **options):
    found = va_clusters.clusters(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted((r.vec_id is None, r.vec_id or 0, *r[1:]) for r in found)


def near_groups(seed, n, width=64):
    dice = np.random.default_rng(seed)
    middle = dice.normal(size=(5, width))
    return [(i, [float(x) for x in middle[i % 5] * (0 if i % 7 == 0 else 0.3) + dice.normal(size=width) * 0.2]) for i in range(n)]


@pytest.mark.parametrize("bits", [2, 8])
def test_same_as_plain_arithmetic(spark, bits):
    rows = near_groups(1, 400)
    rows += rows[:30]  # repeated rows
    assert got(spark, rows, bits=bits) == plain(rows)


def test_odd_vectors_and_few_of_them(spark):
    good = [[float(i)] * 64 for i in range(3)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    rows = list(enumerate(good + bad)) + [(None, good[1]), (None, good[1])]
    assert got(spark, rows) == plain(rows)
    assert got(spark, [(1, v) for v in bad]) == []


def test_equal_vectors_leave_clusters_empty(spark):
    rows = [(i, [0.25] * 64) for i in range(20)] + [(20, [0.5] * 64)]
    assert got(spark, rows) == plain(rows)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert va_clusters.clusters(empty).collect() == []
    rows = near_groups(2, 30)
    wide = spark.createDataFrame([(*r, 1, "x", [1]) for r in rows], SCHEMA + ", row int, cluster string, v array<int>")
    assert sorted((False, r.vec_id, *r[1:]) for r in va_clusters.clusters(wide).collect()) == plain(rows)


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        va_clusters.clusters(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)).collect()


def test_intervals_hold_the_distances():
    dice = np.random.default_rng(3)
    x = dice.integers(-900, 900, (300, 6))
    borders = [sorted(dice.integers(-800, 800, 7).tolist()) for _ in range(6)]
    cells = va_clusters.Cells(borders, x.min(axis=0).tolist(), x.max(axis=0).tolist())
    centroids = dice.integers(-500, 500, (4, 6))
    low, high = cells.tables(centroids)
    own, middle = cells.of(x), centroids.sum(axis=0) // 4
    exact = np.stack([((x - c) ** 2).sum(axis=1) - ((x - middle) ** 2).sum(axis=1) for c in centroids], axis=1)
    assert (sum(t[own[:, d]] for d, t in enumerate(low)) <= exact).all() and (sum(t[own[:, d]] for d, t in enumerate(high)) >= exact).all()
    said = cells.decide(own, (low, high))
    best, _ = va_clusters.nearest(x, centroids)
    assert (said >= 0).any() and (said[said >= 0] == best[said >= 0]).all()
