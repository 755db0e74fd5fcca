import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from laptrace.llm import covertree


def brute(rows, k, scale=64):
    clean = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in clean:
        if q % 20 == 0:
            fits = lambda s: s if -(1 << 63) <= s < 1 << 63 else None
            own = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(a) == len(b)]
            out += [(q, n, i, fits(-s)) for n, (s, i) in enumerate(sorted(own)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "clusters"])
def test_against_brute_force(spark, kind):
    rng = random.Random(kind)
    def vector(i):
        if kind == "ties":
            return [rng.choice([0.0, 0.5]) for _ in range(3)]
        if kind == "clusters":
            return [(i % 5) + rng.gauss(0, 0.01) for _ in range(8)]
        return [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, vector(i)) for i in range(700)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = covertree.top_k(docs, F.col("vec_id") % 20 == 0, k=7, block_rows=150, leaf=8).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 7)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (20, [1.0]), (21, [2.0]), (None, [1.0, 1.0]), (40, []), (41, []), (7, [-1.0, 1e6]),
            (60, [1e6, 2e6]), (100, [1e12, 1.0]), (120, [1e300, 1.0]), (80, [0.5, 0.5, 0.5])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("clash") for c in ("id", "point", "dim", "block", "score", "rank", "raw")})
    found = covertree.top_k(docs, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 20)


@pytest.mark.parametrize("leaf", [2, 64])
def test_long_vectors_are_ranked_exactly(spark, leaf):
    rng = random.Random(leaf)
    rows = [(0, [1.0, 2.0]), (1, [1e9, 1.0]), (2, [3.0, 1.0]), (20, [1e9, 1.0]), (40, [1.7e308, -1e300]),
            (41, [-1.7e308, 5.0]), (42, [1.7e308, 5.0]), (60, [2.0 ** 57, 1.0]), (61, [2.0 ** 57, 2.0]), (62, [2.0 ** 57, 1.5])]
    rows += [(100 + i, [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-3, 25) for _ in range(2)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = covertree.top_k(docs, F.col("vec_id") % 20 == 0, k=5, block_rows=9, leaf=leaf).collect()
    assert sorted(map(tuple, found)) == brute(rows, 5)
    assert sum(r.score is None for r in found) > 10 and len({r.query_id for r in found}) == 7


def test_floors_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    queries, points = (rng.normal(size=(64, 4)) * 20).round(), (rng.normal(size=(3000, 4)) * 20).round()
    qt, dt = covertree.build(queries, 16), covertree.build(points, 16)
    ids, own = np.arange(3000), np.arange(-64, 0)
    none = np.full(64, -np.inf)
    plain = covertree.dual_search(qt, queries, own, dt, points, ids, 5, none)
    kth = np.array([sorted(points @ q)[-5] for q in queries])
    primed = covertree.dual_search(qt, queries, own, dt, points, ids, 5, kth)
    as_rows = lambda found: sorted(zip(*map(list, found)))
    assert as_rows(plain) == as_rows(primed) and len(plain[0]) == 64 * 5


def test_repeated_rows_are_candidates_one_by_one(spark):
    rows = [(0, [1.0]), (0, [1.0]), (3, [1.0]), (3, [1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = covertree.top_k(docs, F.col("vec_id") == 0).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 3, 4096), (0, 2, 3, 4096)]


def test_empty(spark):
    docs = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert covertree.top_k(docs, F.col("vec_id") % 20 == 0).count() == 0


def test_tree_covers_its_points():
    points = np.random.default_rng(1).normal(size=(500, 6))
    tree = covertree.build(points, 16)
    assert sorted(tree.order.tolist()) == list(range(500))
    for n in range(len(tree.radius)):
        below = points[tree.order[tree.lo[n]:tree.hi[n]]]
        assert np.linalg.norm(below - points[tree.center[n]], axis=1).max() <= tree.radius[n] + 1e-9
        parts = [(tree.lo[c], tree.hi[c]) for c in tree.children(n)]
        if parts:
            assert parts[0][0] == tree.lo[n] and parts[-1][1] == tree.hi[n]
            assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
