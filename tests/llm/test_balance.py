import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from laptrace.llm import balance


def brute_targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = budget - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in rest) for s in order}
        over = {s for s in rest if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_targets_and_copies(edge_docs, edge):
    rows = balance.mix(edge_docs).collect()
    assert len(rows) == len(edge)
    sizes = defaultdict(int)
    for _, text, _, source, _ in edge:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken = brute_targets(sizes, (3, 1, 2), 1.5, 2.0), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        assert r.copies in (int(r.rate), int(r.rate) + 1)
        taken[r.source] += r.taken
    largest = defaultdict(int)
    for r in rows:
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1.5 * largest[s]


def test_reruns_agree(edge_docs):
    def run():
        return sorted((tuple(r) for r in balance.mix(edge_docs).collect()), key=repr)
    assert run() == run()


def test_repeated_rows_of_the_mix(spark):
    docs = spark.createDataFrame([(i, "a b c", "s" if i % 2 else "t", i) for i in range(40)],
                                 "doc_id long, text string, source string, size long")
    mixed = balance.mix(docs)
    out = balance.repeated(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == mixed.selectExpr("sum(copies)").first()[0]


def test_newton_meets_small_and_large_targets(spark):
    rows = [(s, 1000, 1, 1000, float(t)) for s, t in [("a", 2000), ("b", 1), ("c", 999), ("d", 1e-6), ("e", 0)]]
    found = balance.rates(spark.createDataFrame(
        rows, "source string, size long, docs long, source_size long, target double")).collect()
    for r in found:
        assert r.rate * 1000 == pytest.approx(r.target, rel=1e-6, abs=1e-9)


def brute_multiplier(sizes, target, most):
    """Newton on the dual in numpy, halving where a step leaves the bracket."""
    sizes, low, high = np.array(sizes, float), -1e3, 1e3
    m = 0.0
    for _ in range(400):
        rate = np.minimum(most, np.exp(np.minimum(m * sizes, 50)))
        gap = (sizes * rate).sum() - target
        low, high = (m, high) if gap < 0 else (low, m)
        bend = (sizes ** 2 * rate)[rate < most].sum()
        step = m - gap / bend if bend else low
        m = step if low < step < high else (low + high) / 2
    return m


def test_rates_are_tilted_by_size_as_in_numpy(spark):
    rng, rows = random.Random(8), []
    for k, (source, share) in enumerate([("a", 1.97), ("b", 1.3), ("c", 1.0), (None, 0.4), ("e", 0.003)]):
        sizes = [rng.choice([0, 1, 7, 90, rng.randrange(1, 30000)]) for _ in range(60 + 40 * k)]
        rows += [(source, z, sizes.count(z), sum(sizes), share * sum(sizes)) for z in sorted(set(sizes))]
    found = balance.rates(spark.createDataFrame(
        rows, "source string, size long, docs long, source_size long, target double")).collect()
    assert len(found) == len(rows)
    for source in {r[0] for r in rows}:
        mine = [r for r in found if r.source == source]
        sizes, target = [r.size for r in mine for _ in range(r.docs)], mine[0].target
        assert sum(r.rate * r.size * r.docs for r in mine) == pytest.approx(target, rel=1e-6)
        m = brute_multiplier(sizes, target, 2.0)
        for r in mine:
            assert r.rate == pytest.approx(min(2.0, math.exp(min(m * r.size, 50))), rel=1e-5, abs=1e-12)
        assert len({r.rate for r in mine}) > 3 or target == sum(sizes)


def test_taken_words_are_within_one_document_of_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = balance.mix(docs)
    free = mixed.filter("size > 0 and target < 2 * source_size").groupBy("source").agg(
        F.countDistinct("rate").alias("rates"), F.countDistinct("size").alias("sizes"))
    assert free.count() > 3 and free.filter("rates = 1 and sizes > 1").count() == 0
    off = mixed.groupBy("source").agg((F.sum("taken") - F.first("target")).alias("off"), F.max("size").alias("most"))
    assert off.filter("abs(off) > most + 1").count() == 0
    assert mixed.filter("copies not in (floor(rate), floor(rate) + 1)").count() == 0


def test_empty(no_docs):
    assert balance.mix(no_docs).count() == 0


def test_hot_source_is_sliced(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "'a b' as text", "'hot' as source")
    rows = balance.mix(docs).selectExpr("sum(taken)", "max(target)").first()
    assert rows[0] == pytest.approx(rows[1], rel=1e-3)
