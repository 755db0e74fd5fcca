import numpy as np
import pytest
from pyspark.sql import functions as F

from laptrace.llm import pigeonhole


def brute(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) for rows of (vec_id, embedding, label)."""
    good = []
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((k, i, np.array(v, float), label))
    links, parent = {}, {i: i for _, i, _, _ in good}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i, v, label in good:
        for other, j, w, second in good:
            if k != other and label == second and len(v) == len(w):
                if v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold or (v == w).all():
                    links[k] = links.get(k, 0) + 1
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    took = {k for k, *_ in good}
    out = []
    for k, (i, _, _) in enumerate(rows):
        component = find(i) if k in took else i
        out.append((i, links.get(k, 0), component, i is None or i == component))
    return sorted(out, key=repr)


def found(frame, **how):
    return sorted(map(tuple, pigeonhole.near_copies(frame, **how).collect()), key=repr)


def near(rng, base, cosine):
    """A vector with this cosine to the base."""
    other = rng.standard_normal(len(base))
    other -= other @ base / (base @ base) * base
    return cosine * base / np.linalg.norm(base) + np.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other)


def families(rng, dim, n, labels=3):
    rows = []
    for family in range(n):
        base = rng.standard_normal(dim) * 10.0 ** rng.integers(-3, 4)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), (near(rng, base, rng.uniform(0.96, 1)) * rng.uniform(0.1, 9)).tolist(), family % labels))
    order = rng.permutation(len(rows))
    return [(int(order[i]), v, label) for i, v, label in rows]


@pytest.mark.parametrize("dim", [1, 3, 16, 64, 100])
def test_families(spark, dim):
    rows = families(np.random.default_rng(dim), dim, 60)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(frame) == brute(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_edge_rows(spark, kind):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0, -1.0], [1.0, 2.0, 3.125, -1.0]
    rows = [(5, a, 1), (3, a, 1), (3, b, 1), (9, [2 * x for x in a], 1), (4, a, 2), (6, a, None), (7, None, 1), (8, [], 1),
            (10, [0.0] * 4, 1), (11, [1.0, None, 3.0, 0.0], 1), (12, [1.0, nan, 3.0, 0.0], 1), (13, [inf, 2.0, 3.0, 0.0], 1),
            (None, a, 1), (None, None, None), (14, a[:3], 1), (15, [-x for x in a], 1), (20, [1.0, 0.0, 0.0, 0.0], 2),
            (20, [0.0, 1.0, 0.0, 0.0], 2), (21, [1.0, 0.0, 0.0, 0.0], 2), (22, [0.0, 1.0, 0.0, 0.0], 2), (5, a, 1),
            (23, [0.0, 1.0, 0.0, -0.0], 2)]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    clashes = ["dim", "digest", "vector", "cid", "rep", "n", "axes", "chunks", "own", "i", "j", "family", "kept", "odd.name"]
    assert found(frame.withColumns({c: F.lit("clash") for c in clashes})) == brute(rows)


def test_cuts_and_chunks(spark):
    """One label above the size of a cell, with a family above the size of a chunk in it."""
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    vectors = [near(rng, base, rng.uniform(0.985, 1)) for _ in range(2300)] + list(rng.standard_normal((6500, 16)))
    vectors = np.array(vectors)
    assert pigeonhole.CELL_ROWS < len(vectors) and pigeonhole.CHUNK_ROWS < 2300
    rows = [(i, v, 0) for i, v in enumerate(vectors.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hit = unit @ unit.T >= 0.98
    np.fill_diagonal(hit, False)
    component = np.arange(len(rows))
    x, y = np.nonzero(hit)
    while True:
        before = component.copy()
        np.minimum.at(component, x, component[y])
        if (before == component).all():
            break
    want = sorted(((i, int(hit[i].sum()), int(c), i == c) for i, c in enumerate(component)), key=repr)
    assert found(frame) == want


def test_cuts_lose_no_pair():
    """Two vectors within the radius of a cut meet on one of its sides."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal(5000) / 8
    axes = [{"axis": 0, "q": np.quantile(x, np.arange(1, pigeonhole.STEPS) / pigeonhole.STEPS).tolist()}]
    cuts = pigeonhole.chosen_cuts(axes, 10 ** 6, (0, 1), 0.02)
    assert len(cuts) == 1
    side = x - cuts[0][1]
    sides = [{True} if s >= 0 else {False, True} if s + 0.02 >= 0 else {False} for s in side]
    pairs = rng.integers(0, len(x), (200000, 2))
    assert all(sides[i] & sides[j] for i, j in pairs if abs(x[i] - x[j]) <= 0.02)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pigeonhole.near_copies(frame).count() == 0
