"""Exact top-k search by integer inner product with two cover trees.

Data and queries are dealt into blocks and every block gets its own cover tree.  A query block meets
a data block in one task: node pairs are walked best bound first, and a pair is pruned when no point
below the data node can reach the worst kth score that any query below the query node holds.  Every
query block meets one data block first; the kth scores found there are where all other pairs start.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laptrace.llm.tables import stored

#: Each level's covering radius is this much smaller than the one above.
SHRINK = 1.5
#: Sums below this are exact in double precision.
EXACT = 2.0 ** 52

#: Vectors of this squared norm and above may have scores that no long holds; they get Python's integers.
WIDE = 2.0 ** 62
#: Added to such a score, so that its bytes sort like numbers; two doubles have a product below it.
OFFSET, OFFSET_BYTES = 1 << 4200, 526

BLOCK = "dim int, wide boolean, block int, ids binary, points binary, tree binary, big boolean"
FOUND = "dim int, q_wide boolean, q_block int, floors binary, query_id long, vec_id long, beyond int, score long, " \
        "digits binary"


class Tree:
    """A cover tree over distinct points, nodes in preorder.

    ``lo[n]:hi[n]`` are the points below node n (in the tree's order), ``center[n]`` one of them and
    ``radius[n]`` the largest distance from it to any of them; ``last[n]`` is the node after n's
    subtree.  Children of a node cover its points with a smaller radius and have centers further
    apart than that radius.
    """

    def __init__(self, order: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.order, self.radius = order, radius
        self.lo, self.hi, self.center, self.last = nodes.T

    def children(self, node: int) -> list[int]:
        found, child = [], node + 1
        while child < self.last[node]:
            found.append(child)
            child = int(self.last[child])
        return found


def build(points: np.ndarray, leaf: int) -> Tree:
    """Nets of shrinking radius, top down; a set of at most ``leaf`` points, or of equal ones, is a leaf.

    So is one with points so far apart that a double does not hold the distance.
    """
    order, nodes, radii = [], [], []

    def distances(rows: np.ndarray, center: int) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            far = np.linalg.norm(points[rows] - points[center], axis=1)
        return np.where(np.isnan(far), np.inf, far)

    # (rows, center, distances to the center) or the number of a node that is complete
    stack: list = [(np.arange(len(points)), 0, None)]
    while stack:
        item = stack.pop()
        if isinstance(item, int):
            nodes[item][1], nodes[item][3] = len(order), len(nodes)
            continue
        rows, center, far = item
        far = distances(rows, center) if far is None else far
        radius = float(far.max(initial=0.0))
        number = len(nodes)
        nodes.append([len(order), 0, center, 0])
        radii.append(radius)
        stack.append(number)
        if len(rows) <= leaf or radius == 0 or math.isinf(radius):
            order.extend(rows.tolist())
            nodes[number][1] = len(order)
            continue
        cover, parts, rest, left = radius / SHRINK, [], rows, far
        pick = center
        while len(rest):
            near = left <= cover if pick == center else distances(rest, pick) <= cover
            if pick == center:
                parts.append((rest[near], pick, left[near]))
            else:
                parts.append((rest[near], pick, None))
            rest, left = rest[~near], left[~near]
            pick = int(rest[0]) if len(rest) else -1
        # small nets are packed into leaves, so that no leaf holds a single point
        loose = [p for p in parts if len(p[0]) <= leaf // 4]
        parts = [p for p in parts if len(p[0]) > leaf // 4]
        packed: list = []
        for part in loose:
            if packed and len(packed[-1][0]) + len(part[0]) <= leaf:
                packed[-1] = (np.concatenate([packed[-1][0], part[0]]), packed[-1][1], None)
            else:
                packed.append(part)
        stack.extend(reversed(parts + packed))
    return Tree(np.array(order, np.int64), np.array(nodes, np.int64).reshape(-1, 4), np.array(radii))


def _pack(tree: Tree) -> bytes:
    head = np.array([len(tree.order), len(tree.radius)], np.int64)
    nodes = np.stack([tree.lo, tree.hi, tree.center, tree.last], axis=1)
    return head.tobytes() + tree.order.tobytes() + nodes.tobytes() + tree.radius.tobytes()


def _unpack(data: bytes) -> Tree:
    n, m = np.frombuffer(data, np.int64, 2)
    order = np.frombuffer(data, np.int64, n, 16)
    nodes = np.frombuffer(data, np.int64, 4 * m, 16 + 8 * n).reshape(m, 4)
    return Tree(order, nodes, np.frombuffer(data, np.float64, m, 16 + 8 * n + 32 * m))


def scaled(raw: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as doubles, infinite where the product is too large for one."""
    with np.errstate(over="ignore"):
        return np.floor(raw * scale)


def exact(raw: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as Python integers, of any size."""
    def whole(x: float, product: float) -> int:
        return int(product) if math.isfinite(product) else math.floor(Fraction(x) * Fraction(scale))
    return np.frompyfunc(whole, 2, 1)(raw, scaled(raw, scale)).astype(object)


def _blocks(leaf: int, scale: float):
    def make(key: tuple, rows: pa.Table) -> pa.Table:
        dim, wide, block = (k.as_py() for k in key)
        ids = rows["id"].to_numpy().astype(np.int64)
        flat = rows["point"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        raw = flat.reshape(len(ids), dim)
        by_id = np.argsort(ids, kind="stable")
        ids, raw = ids[by_id], raw[by_id]
        points = scaled(raw, scale)
        big = not wide and bool(len(flat)) and float(np.abs(points).max()) ** 2 * max(dim, 1) >= EXACT
        return pa.table([[dim], [wide], [block], [ids.tobytes()], [raw.tobytes()], [_pack(build(points, leaf))], [big]],
                        schema=pa.schema([("dim", pa.int32()), ("wide", pa.bool_()), ("block", pa.int32()),
                                          ("ids", pa.binary()), ("points", pa.binary()), ("tree", pa.binary()),
                                          ("big", pa.bool_())]))
    return make


class Best:
    """The k best (score, position of the candidate by id) of each query of a block.

    ``floors`` are scores that each query's kth best is known to reach.
    """

    def __init__(self, floors: np.ndarray, k: int, number: type):
        shape = len(floors), k
        self.score = np.zeros(shape, object if number is object else np.int64)
        self.place = np.full(shape, -1)
        self.kth = floors.astype(object if number is object else np.float64)

    def offer(self, lo: int, hi: int, scores: np.ndarray, places: np.ndarray, allowed: np.ndarray) -> None:
        good = allowed & (scores >= self.kth[lo:hi, None]).astype(bool)
        for q in np.flatnonzero(good.any(axis=1)):
            row = lo + q
            new = np.flatnonzero(good[q])
            held = self.place[row] >= 0
            s = np.concatenate([self.score[row][held], scores[q, new]])
            p = np.concatenate([self.place[row][held], places[new]])
            top = np.lexsort((p, -s))[: self.score.shape[1]]
            self.score[row, : len(top)], self.place[row, : len(top)] = s[top], p[top]
            if len(top) == self.score.shape[1]:
                self.kth[row] = max(self.kth[row], s[top[-1]])


def doubles(points: np.ndarray) -> np.ndarray:
    """Points as doubles, infinite where they are too large."""
    def near(x) -> float:
        try:
            return float(x)
        except OverflowError:
            return math.inf if x > 0 else -math.inf
    return np.frompyfunc(near, 1, 1)(points).astype(np.float64) if points.dtype == object else points.astype(np.float64)


def dual_search(qt: Tree, qp: np.ndarray, qi: np.ndarray, dt: Tree, dp: np.ndarray, di: np.ndarray, k: int,
                floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query row: its k best candidates below the data tree, as (query row, data row, score).

    Points are doubles (sums stay below 2**52, so the fast product is exact), longs or Python integers;
    scores are exact in all three.  Bounds are doubles, widened by their rounding error; a bound that
    is too large for a double prunes nothing.  Candidates below a query's floor may be left out.  A candidate with
    the query's own id takes no part.  Equal scores go to the smaller id.
    """
    number = qp.dtype.type if qp.dtype != object else object
    best = Best(floors[qt.order], k, number)
    q_sorted, d_sorted = qp[qt.order], dp[dt.order]
    q_ids, d_ids = qi[qt.order], di[dt.order]
    q_center, d_center = doubles(qp[qt.center]), doubles(dp[dt.center])
    with np.errstate(over="ignore"):
        q_norm, d_norm = np.linalg.norm(q_center, axis=1), np.linalg.norm(d_center, axis=1)

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            reach = qt.radius[a] * d_norm[b] + dt.radius[b] * q_norm[a] + qt.radius[a] * dt.radius[b]
            inner = np.einsum("ij,ij->i", q_center[a], d_center[b])
            bound = inner + reach + 1e-9 * (reach + q_norm[a] * d_norm[b]) + 1e-6
        return np.where(np.isfinite(bound), bound, np.inf)

    top = bounds(np.array([0]), np.array([0]))
    heap = [(-float(top[0]), 0, 0)]
    leaf_q, leaf_d = qt.last == np.arange(len(qt.last)) + 1, dt.last == np.arange(len(dt.last)) + 1
    while heap:
        minus, a, b = heapq.heappop(heap)
        if -minus < best.kth[qt.lo[a]:qt.hi[a]].min():
            continue
        if leaf_q[a] and leaf_d[b]:
            ql, qh, dl, dh = qt.lo[a], qt.hi[a], dt.lo[b], dt.hi[b]
            scores = (q_sorted[ql:qh] @ d_sorted[dl:dh].T).astype(object if number is object else np.int64)
            best.offer(ql, qh, scores, dt.order[dl:dh], q_ids[ql:qh, None] != d_ids[None, dl:dh])
            continue
        # the larger node is split
        if leaf_d[b] or (not leaf_q[a] and qt.radius[a] * d_norm[b] > dt.radius[b] * q_norm[a]):
            some = np.array(qt.children(a))
            a_side, b_side = some, np.full(len(some), b)
        else:
            some = np.array(dt.children(b))
            a_side, b_side = np.full(len(some), a), some
        for bound, x, y in zip(bounds(a_side, b_side), a_side, b_side, strict=True):
            if bound >= best.kth[qt.lo[x]:qt.hi[x]].min():
                heapq.heappush(heap, (-float(bound), int(x), int(y)))
    rows, cols = np.nonzero(best.place >= 0)
    return qt.order[rows], best.place[rows, cols], best.score[rows, cols]


def _floor(scores: np.ndarray) -> float:
    """A double no larger than the smallest of some exact scores."""
    return float(np.nextafter(min(doubles(scores).min(), np.finfo(np.float64).max), -np.inf))


def _search(k: int, scale: float, keep_floors: bool):
    """Pairs of blocks to their best pairs of rows; with ``keep_floors`` a row with each query's kth score as well."""
    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                qi, di = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                qp = np.frombuffer(r.q_points, np.float64).reshape(len(qi), r.dim)
                dp = np.frombuffer(r.points, np.float64).reshape(len(di), r.dim)
                wide = r.wide or r.q_wide
                if wide:
                    qp, dp = exact(qp, scale), exact(dp, scale)
                else:
                    number = np.int64 if r.big or r.q_big else np.float64
                    qp, dp = scaled(qp, scale).astype(number), scaled(dp, scale).astype(number)
                floors = np.frombuffer(r.floors, np.float64) if r.floors is not None else np.full(len(qi), -np.inf)
                q, d, score = dual_search(_unpack(r.q_tree), qp, qi, _unpack(r.tree), dp, di, k, floors)
                key = {"dim": r.dim, "q_wide": r.q_wide, "q_block": r.q_block}
                out = pd.DataFrame({"floors": None, "query_id": qi[q], "vec_id": di[d], "beyond": 0, "digits": None, **key})
                if wide:
                    low, high = -(1 << 63), (1 << 63) - 1
                    out["beyond"] = [(s > high) - (s < low) for s in score]
                    out["digits"] = [None if low <= s <= high else (s + OFFSET).to_bytes(OFFSET_BYTES, "big") for s in score]
                    score_column = pd.array([s if low <= s <= high else None for s in score], "Int64")
                else:
                    score_column = score
                yield out.assign(score=score_column)
                if keep_floors:
                    reached = np.full(len(qi), -np.inf)
                    full = np.flatnonzero(np.bincount(q, minlength=len(qi)) == k)
                    order = np.argsort(q, kind="stable")
                    starts = np.searchsorted(q[order], full)
                    for row, at in zip(full, starts, strict=True):
                        reached[row] = _floor(score[order[at:at + k]])
                    yield pd.DataFrame({"floors": [reached.tobytes()], "query_id": None, "vec_id": None, "beyond": None,
                                        "score": None, "digits": None, **key})
    return pairs


def top_k(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: float = 64.0, block_rows: int = 8192, leaf: int = 64) -> DataFrame:
    """The ``k`` rows with the highest integer inner product for every query: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vectors``.  Components become floor(scale * x).  A query's own
    row, and any row with its id, is no candidate; rows repeated under one id are candidates one by one,
    and as queries share one list.  Ties go to the smaller id.  Null ids, null vectors and vectors with a null or
    non-finite component take no part; vectors of different length never meet.  Scores are exact whatever
    their size and ranked by it; one that no long holds is returned as null.  Fewer than ``k`` candidates give them
    all; an empty table gives an empty result; other columns are not looked at.

    The search is exact.  Blocks hold at most about ``block_rows`` rows of a length, dealt by a hash
    of the row, so equal vectors and a hot id spread.  A data block travels once for each query block.
    Vectors of 2**31 and more after scaling have blocks of their own, so that the others keep the fast product.
    """
    x = F.col("raw")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    clean = vectors.select(F.col(vec_id).cast("long").alias("id"),
                           F.transform(F.col(embedding), lambda v: v.cast("double")).alias("raw"),
                           F.coalesce(is_query, F.lit(False)).alias("asks")).filter(
        F.col("id").isNotNull() & x.isNotNull() & whole)
    # below this norm a long holds every score
    norm = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v * scale) * (v * scale))
    points = stored(clean.select("id", "asks", x.alias("point"), F.size(x).alias("dim"), (norm >= WIDE).alias("wide")),
                    "points")
    kind = ["dim", "wide"]

    def blocked(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy(*kind).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("id", "point", F.lit(7)), F.col("blocks")).cast("int")
        dealt = rows.join(counts, kind).select(*kind, block.alias("block"), "id", "point")
        # a number of partitions that stays: by their bytes alone all trees would be built in one task
        return dealt.repartition(parts, *kind, "block").groupBy(*kind, "block").applyInArrow(_blocks(leaf, scale), BLOCK)

    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    data = stored(blocked(points), "data_blocks")
    asked = stored(blocked(points.filter("asks").dropDuplicates(["id", "point"])), "query_blocks")
    tasks = asked.select("dim", F.col("wide").alias("q_wide"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                         F.col("points").alias("q_points"), F.col("tree").alias("q_tree"), F.col("big").alias("q_big"))
    listed = tasks.groupBy("dim").agg(F.collect_list(F.struct("q_wide", "q_block")).alias("asking"))
    first = data.groupBy("dim").agg(F.min(F.struct("wide", "block")).alias("first")).select("dim", "first.*")

    def search(blocks: DataFrame, queries: DataFrame, keep_floors: bool) -> DataFrame:
        spread = blocks.join(listed, "dim").withColumn("q", F.explode("asking")).select(*blocks.columns, "q.*")
        met = spread.join(queries, ["dim", "q_wide", "q_block"]).repartition(
            parts, "dim", "q_wide", "q_block", "wide", "block")
        return met.mapInPandas(_search(k, scale, keep_floors), FOUND)

    near = stored(search(data.join(first, [*kind, "block"]), tasks.withColumn("floors", F.lit(None).cast("binary")),
                         True), "first_pairs")
    floors = near.filter("floors is not null").select("dim", "q_wide", "q_block", "floors")
    rest = search(data.join(first, [*kind, "block"], "left_anti"),
                  tasks.join(floors, ["dim", "q_wide", "q_block"], "left"), False)
    found = near.filter("floors is null").unionAll(rest)
    best = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), F.desc("digits"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
