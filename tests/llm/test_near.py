import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from laptrace.llm import near, setsketch
from laptrace.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(ws) < width:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)}


def brute(rows, width, percent=80):
    """(doc_id, n_shingles, component) for rows of (doc_id, text)."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_edge_rows(edge_docs, edge, width):
    rows = near.near_duplicates(edge_docs, width=width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == brute(
        [(i, t) for i, t, *_ in edge], width)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_families_of_edits(spark):
    """Chains and stars of edited copies around the threshold, where pivots do not link all members."""
    rng, rows = random.Random(5), []
    for family in range(12):
        text = [f"f{family}w{rng.randrange(300)}" for _ in range(100)]
        for _ in range(15):
            rows.append((len(rows) * 3 % 541, " ".join(text)))
            if rng.random() < 0.8:
                text = text.copy()
            for _ in range(rng.randrange(1, 7)):
                text[rng.randrange(100)] = f"e{rng.randrange(10 ** 6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near.near_duplicates(docs, width=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows, 2)


def test_empty(no_docs):
    assert near.near_duplicates(no_docs).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        both = round(2 * 2000 * share / (1 + share))
        h = rng.integers(0, 2 ** 63, 4000 - both).astype(np.uint64)
        a, b = h[:2000], h[2000 - both:]
        ra, rb = (setsketch.registers(setsketch.minima(x)) for x in (a, b))
        assert (setsketch.merge(ra, rb) == setsketch.registers(setsketch.minima(h))).all()
        estimate = setsketch.likely_jaccard(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))[0]
        assert abs(estimate - share) < 0.15


@pytest.mark.parametrize("local", [20, 10 ** 6])
@pytest.mark.parametrize("kind", ["path", "cycle", "star", "random"])
def test_components(spark, kind, local):
    rng, n = random.Random(kind), 300
    if kind == "path":
        edges = [(i, i + 1) for i in range(n)]
        rng.shuffle(edges)
    elif kind == "cycle":
        edges = [(i, (i + 7) % n) for i in range(n)]
    elif kind == "star":
        edges = [(n, i) for i in range(n)]
    else:
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)]
    low = {x: x for e in edges for x in e}
    for _ in range(n):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    want = {x: c for x, c in low.items() if any(x in e and e[0] != e[1] for e in edges)}
    found = components(spark.createDataFrame([*edges, (None, 1), (1, 1)], "a long, b long"), local).collect()
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


def test_more_ids_than_a_broadcast_holds(spark, monkeypatch):
    """Only a bitmap is broadcast, which lets all wanted ids through and few others; the texts are the same."""
    monkeypatch.setattr(near, "BROADCAST_IDS", 10)
    docs = spark.range(20_000).select((F.col("id") * 7919 - 5000).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    wanted = docs.where("pmod(doc_id, 9) = 2").select("doc_id")
    n = wanted.count()
    possible = near._possible(docs, wanted, n)
    assert wanted.join(possible, "doc_id", "left_anti").isEmpty() and n <= possible.count() < n + 0.1 * 20_000
    plan = possible.join(wanted.hint("merge"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    found = near._texts(docs, wanted)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.where("pmod(doc_id, 9) = 2").collect()))


def test_joins_do_not_broadcast_what_grows(spark, monkeypatch):
    """Small tables are merged like large ones: no relation of ids, classes or components is built in the driver."""
    plans, old = [], near.stored

    def spy(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return old(df, label)

    monkeypatch.setattr(near, "stored", spy)
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i % 4} i j k l m n o {i % 7}") for i in range(40)], "doc_id long, text string")
    out = near.near_duplicates(docs, width=2)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("BroadcastHashJoin" in p for p in plans) == 2  # the wanted texts, counted before
