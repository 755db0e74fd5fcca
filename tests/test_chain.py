"""The imputation chain against plain Python on a few athletes."""

import statistics

import pytest
from pyspark.sql import functions as F

from laptrace.operators import chain, impute, quantiles, reshape
from laptrace.vocab import PROGRESSION_FACTORS, YOUTH_AGES

MARKS = "name string, event string, course string, age int, time_seconds double"


def marks_of(seed, athletes):
    import random

    rng, rows = random.Random(seed), {}
    for a in range(athletes):
        for _ in range(rng.randrange(1, 12)):
            key = (f"a{a}", rng.choice(["50mFree", "100mFly", "9mOdd"]), rng.choice(["LCM", "SCY"]), rng.choice([9, 10, 14, 18, 19, 20, 25, 50]))
            rows[key] = round(rng.uniform(20, 90), 2)
    return [(*k, v) for k, v in rows.items()]


def brute(rows, body, split, structural, baselines):
    """(fills, cells): fill by feature, and (name, feature) to (value, estimated)."""
    def feature(e, c, a):
        return f"{e}_{c}_Age{a}_FastestTime"

    kept = {feature(e, c, a): (e, c, a) for e, c, a in structural}
    for n, e, c, a, _ in rows:
        if n in split and (YOUTH_AGES[0] <= a <= YOUTH_AGES[1] or split[n] == "train"):
            kept[feature(e, c, a)] = (e, c, a)
    cells = {(n, feature(e, c, a)): (v, 0) for n, e, c, a, v in rows if n in split and feature(e, c, a) in kept}
    for f, (e, c, a) in kept.items():
        for n in split:
            grown = [v for m, e2, c2, b, v in rows if (m, e2, c2) == (n, e, c) and 20 <= b <= 49]
            if YOUTH_AGES[0] <= a <= YOUTH_AGES[1] and grown and (n, f) not in cells:
                cells[n, f] = min(grown) * PROGRESSION_FACTORS[a - YOUTH_AGES[0]], 1
    cells |= {(n, f): (v, 0) for n, f, v in body if n in split}
    fills = {}
    for f in {*kept, *(f for _, f, _ in body)}:
        own = [v for (n, g), (v, _) in cells.items() if g == f and split[n] == "train"]
        if own:
            fills[f] = ("median", statistics.median(own))
        elif f in kept and YOUTH_AGES[0] <= kept[f][2] <= YOUTH_AGES[1]:
            fills[f] = ("baseline", baselines[f])
    return fills, {k: v for k, v in cells.items() if k[1] in fills}


@pytest.fixture(scope="module")
def structural(spark):
    grid = reshape.structural_features(spark)
    rows = grid.collect()
    base = impute.baseline(grid.withColumn("n_observed", F.lit(0))).collect()
    return [(r.event, r.course, r.age) for r in rows], {r.feature: r.fill for r in base}


def made(spark, rows, body, split):
    return chain.fit(spark.createDataFrame(rows, MARKS), spark.createDataFrame(body, "name string, feature string, value double"),
                     spark.createDataFrame(list(split.items()), "name string, split string"))


@pytest.mark.parametrize("seed", [1, 2])
def test_chain(spark, structural, seed):
    rows = marks_of(seed, 12)
    names = sorted({r[0] for r in rows})
    split = {n: "test" if i % 4 == 0 else "train" for i, n in enumerate(names[:-1])}  # the last one takes no part
    body = [(n, "BMI", 20.0 + i) for i, n in enumerate(names) if i % 3] + [(names[0], "Odd", 1.0)]
    grid, base = structural
    base = base | {f"9mOdd_{c}_Age{a}_FastestTime": None for c in ("LCM", "SCY") for a in range(10, 19)}
    found = made(spark, rows, body, split)
    fills, cells = brute(rows, body, split, grid, base)
    got = {r.feature: (r.source, r.fill) for r in found.fills.collect()}
    assert got.keys() == fills.keys()
    assert all(got[f][0] == s and (v is None or got[f][1] == pytest.approx(v, abs=1e-9)) for f, (s, v) in fills.items())
    assert "Odd" not in got  # seen in a test row only
    fill = {f: v for f, (_, v) in got.items()}
    for r in chain.profile(found).collect():
        own = [cells[n, r.feature] for n in split if split[n] == r.split and (n, r.feature) in cells]
        rest = sum(s == r.split for s in split.values()) - len(own)
        assert (r.n_own, r.n_estimated, r.n_filled) == (sum(not e for _, e in own), sum(e for _, e in own), rest)
        assert r.total == pytest.approx(sum(v for v, _ in own) + rest * fill[r.feature], abs=1e-4)
    for r in chain.filled_rows(found).collect():
        own = {f: cells[n, f] for n, f in cells if n == r.name}
        assert (r.n_own, r.n_estimated) == (sum(not e for _, e in own.values()), sum(e for _, e in own.values()))
        assert r.n_filled == len(fill) - len(own)
        assert r.total == pytest.approx(sum(own[f][0] if f in own else v for f, v in fill.items()), abs=1e-3)


def test_test_rows_change_no_fill(spark):
    rows = marks_of(3, 10)
    names = sorted({r[0] for r in rows})
    split = {n: "test" if i < 3 else "train" for i, n in enumerate(names)}
    changed = [(*r[:4], r[4] * 2) if split[r[0]] == "test" else r for r in rows]
    body = [(n, "BMI", 20.0) for n in names]
    other = [(n, "BMI", 90.0 if split[n] == "test" else 20.0) for n in names]
    first, second = (sorted(map(tuple, made(spark, m, b, split).fills.collect())) for m, b in ((rows, body), (changed, other)))
    assert first == second


def test_nobody(spark):
    found = made(spark, [], [], {})
    assert {r.source for r in found.fills.collect()} == {"baseline"} and chain.filled_rows(found).count() == 0


def test_weighted_median(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 2), ("a", 9.0, 1), ("b", 2.0, 1), ("b", 4.0, 1), (None, 7.0, 5), ("c", None, 4)]
    frame = spark.createDataFrame(rows, "g string, v double, n long")
    found = {r.g: r.median for r in quantiles.exact_median(frame, ["g"], "v", weight="n").collect()}
    assert found == {"a": 3.0, "b": 3.0, None: 7.0}
