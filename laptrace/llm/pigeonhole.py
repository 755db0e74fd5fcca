"""Near copies among vectors by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of coordinates.  Two vectors whose squared distance is within a
budget are within the block's share of it in at least one block, so a range join in each block finds them all.
Its candidates are joined to families, and every pair of a family is verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laptrace.llm.components import components
from laptrace.llm.tables import stored
from laptrace.operators.joins import lookup_join

#: Vectors a cell should hold, and how many of a cell or a family two sides of a task hold at most.
CELL_ROWS, CHUNK_ROWS = 4096, 2048
#: A cut is made if it halves the work for at most this much more copies, all cuts of a block for at most COPIES.
CUT_SHARE, COPIES = 0.4, 8.0
#: Steps of the quantiles from which cuts are chosen.
STEPS = 32
#: Coordinates are kept in a byte each, up to this many times their root mean square; further ones are clipped,
#: which only brings vectors nearer to each other.
CLIP = 6.0
GROUP = ("label", "dim")


@cache
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, so that no block holds more of the distance than its share by the data's making."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def spans(dim: int, blocks: int) -> list[tuple[int, int]]:
    """Coordinates of each block, as equal as they can be."""
    edges = np.linspace(0, dim, min(blocks, dim) + 1).round().astype(int).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def _budget(threshold: float, part: float = 1.0) -> float:
    """Radius of a block with this part of the coordinates, widened against rounding."""
    return math.sqrt((2 - 2 * threshold) * part) * (1 + 1e-9) + 1e-9


def _rotated(vectors: list[bytes], dim: int, kind: str) -> np.ndarray:
    return units(vectors, dim, kind) @ rotation(dim)


def units(vectors: list[bytes], dim: int, kind: str) -> np.ndarray:
    values = np.frombuffer(b"".join(vectors), kind).reshape(-1, dim).astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _read(kind: str):
    """vec_id, label, dim, digest and bytes of each vector; without digest where it takes no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["embedding"]
            lists = lists.cast(pa.large_list(lists.type.value_type))
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(kind)  # null components become NaN
            sound = lists.is_valid().to_numpy(zero_copy_only=False) & batch["label"].is_valid().to_numpy(zero_copy_only=False)
            sound &= batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)
            dims, digests, vectors = [], [], []
            for at, ok in enumerate(sound.tolist()):
                own = values[ends[at]: ends[at + 1]]
                ok = ok and bool(np.isfinite(own).all()) and bool(own.any())
                vectors.append(own.tobytes() if ok else None)
                dims.append(len(own) if ok else None)
                digests.append(blake2b(vectors[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(dims, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(vectors, pa.binary())], names=["vec_id", "label", "dim", "digest", "vector"])
    return run


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a batch by dimension, at most a few MB of vectors each."""
    dims = np.asarray(batch["dim"])
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        step = max(1, (1 << 20) // dim)
        for a in range(0, len(rows), step):
            yield dim, rows[a: a + step]


def _axes(kind: str):
    """label, dim, axis, x: every rotated coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _groups(batch):
                x = _rotated(batch["vector"].take(pa.array(rows)).to_pylist(), dim, kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.asarray(batch["label"])[rows], dim)), pa.array(np.full(x.size, dim, np.int32)),
                     pa.array(np.tile(np.arange(dim, dtype=np.int32), len(rows))), pa.array(x.ravel())],
                    names=["label", "dim", "axis", "x"])
    return run


def chosen_cuts(axes: list[dict], n: int, span: tuple[int, int], radius: float) -> list[tuple[int, float]]:
    """(axis, value) of a block's cuts: those that halve the rows for the fewest copies, as many as ``n`` calls for."""
    best = []
    for a in axes:
        q, p = np.array(a["q"]), np.arange(1, STEPS) / STEPS
        if span[0] <= a["axis"] < span[1]:
            share = p - np.interp(q - radius, q, p, left=0.0)  # rows that the cut copies to its upper side
            gain = -np.log2(p ** 2 + (1 - p) ** 2) / np.log2(1 + np.maximum(share, 1e-3))
            at = int(np.argmax(gain))
            if share[at] <= CUT_SHARE:
                best.append((-gain[at], a["axis"], q[at], share[at]))
    out, copies = [], 1.0
    for _, axis, value, share in sorted(best)[: max(0, math.ceil(math.log2(n / CELL_ROWS)))]:
        copies *= 1 + share
        if copies <= COPIES:
            out.append((axis, float(value)))
    return out


def _spots(kind: str, threshold: float, blocks: int):
    """label, dim, block, cell, cid, bytes: each vector once for every cell of every block that it may meet others in.

    A cut sends what is on its lower side, but within the radius, to both sides: of two vectors that near, both
    are then on the side of the upper one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, cids = np.asarray(batch["label"]), np.asarray(batch["cid"])
            for dim, rows in _groups(batch):
                x = _rotated(batch["vector"].take(pa.array(rows)).to_pylist(), dim, kind)
                coded = np.rint(np.clip(x * (math.sqrt(dim) / CLIP), -1, 1) * 127).astype(np.int8)
                for label in np.unique(labels[rows]).tolist():
                    own = np.flatnonzero(labels[rows] == label)
                    first = rows[own[0]]
                    axes, n = batch["axes"][first].as_py(), batch["n_group"][first].as_py()
                    for b, span in enumerate(spans(dim, blocks)):
                        radius = _budget(threshold, (span[1] - span[0]) / dim)
                        at, cell = own, np.zeros(len(own), np.int64)
                        for axis, value in chosen_cuts(axes, n, span, radius) if axes else []:
                            side = x[at, axis] - value
                            both = (side < 0) & (side + radius >= 0)
                            at = np.concatenate([at, at[both]])
                            cell = np.concatenate([cell * 2 + (side >= 0), cell[both] * 2 + 1])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), label, np.int64)), pa.array(np.full(len(at), dim, np.int32)),
                             pa.array(np.full(len(at), b, np.int32)), pa.array(cell), pa.array(cids[rows[at]]),
                             pa.array([coded[i].tobytes() for i in at.tolist()], pa.binary())],
                            names=["label", "dim", "block", "cell", "cid", "coded"])
    return run


def _in_pairs(rows: DataFrame, key: list[str], crowded: DataFrame) -> DataFrame:
    """Adds ``own, i, j``: members of a key are dealt to chunks, and every two chunks meet in one group.

    ``crowded`` has the keys with more members than a chunk holds, and their number of chunks.
    """
    dealt = lookup_join(rows, crowded, key).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    met = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "chunks")


def _crowded(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK_ROWS).select(
        *key, F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"))


class Joined:
    """Members of a task that hang together, kept as the smallest number of each group."""

    def __init__(self, n: int):
        self.low = np.arange(n)

    def join(self, row: int, members: np.ndarray) -> None:
        low = np.unique(np.append(self.low[members], self.low[row]))
        if len(low) > 1:
            self.low[np.isin(self.low, low)] = low[0]


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    side = np.asarray(rows["own"])
    return np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())


def _candidates(threshold: float, blocks: int):
    """Links (a, b) that hold together what the range join of a cell finds, at most one for each member.

    The block decides within its radius and the whole vectors, in a byte a coordinate, within theirs, both
    widened by what rounding to bytes can move two vectors apart.
    """
    def run(rows: pa.Table) -> pa.Table:
        cids, (left, right) = np.asarray(rows["cid"]), _sides(rows)
        dim = rows["dim"][0].as_py()
        a, b = spans(dim, blocks)[rows["block"][0].as_py()]
        codes = np.frombuffer(b"".join(rows["coded"].to_pylist()), np.int8).reshape(-1, dim).astype(np.float32)
        scale = 127 * math.sqrt(dim) / CLIP
        near = (_budget(threshold, (b - a) / dim) * scale + math.sqrt(b - a)) ** 2
        whole = (_budget(threshold) * scale + math.sqrt(dim)) ** 2
        joined = Joined(len(cids))
        for at in range(0, len(left), 512):
            part = left[at: at + 512]
            hit = _squared(codes[part, a:b], codes[right, a:b]) <= near
            if hit.any():
                hit &= _squared(codes[part], codes[right]) <= whole
            for r in np.flatnonzero(hit.any(axis=1)).tolist():
                joined.join(part[r], right[hit[r]])
        moved = np.flatnonzero(joined.low != np.arange(len(cids)))
        return pa.table({"a": cids[moved], "b": cids[joined.low[moved]]})
    return run


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)


def _verified(threshold: float, kind: str):
    """cid, links, low: for every member with a link, the vectors it is linked to and what holds it to others."""
    def run(rows: pa.Table) -> pa.Table:
        cids, n, (left, right) = np.asarray(rows["cid"]), np.asarray(rows["n"]), _sides(rows)
        x = units(rows["vector"].to_pylist(), rows["dim"][0].as_py(), kind)
        same = len(left) == len(cids)
        links, joined = np.zeros(len(cids), np.int64), Joined(len(cids))
        for at in range(0, len(left), 512):
            part = left[at: at + 512]
            hit = x[part] @ x[right].T >= threshold
            hit &= cids[part][:, None] != cids[right][None, :]
            links[part] += hit @ n[right]
            if not same:
                links[right] += n[part] @ hit
            for r in np.flatnonzero(hit.any(axis=1)).tolist():
                joined.join(part[r], right[hit[r]])
        some = np.flatnonzero(links)
        return pa.table({"cid": cids[some], "links": links[some], "low": cids[joined.low[some]]})
    return run


def near_copies(vectors: DataFrame, threshold: float = 0.98, blocks: int = 4) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Vectors of one label, which is not null, are linked where their cosine in double precision is at least the
    threshold.  ``n_links`` counts the other rows a row is linked to, ``component_id`` is the smallest vec_id
    reachable.  Vectors that are null, empty or zero or hold null or non-finite components, and rows without
    label or vec_id, link with nothing and are kept, whoever shares their id; without vec_id component_id is null.  Vectors of
    different length are not compared.  Rows that share a vec_id are one node of a component and count each
    as a link.  Equal vectors are one class before anything is compared, and are linked.  An empty table gives
    an empty result; other columns are not looked at.

    The range join ships a byte a coordinate and sends on, for each cell, no more links than members.  A label
    with many vectors is cut into cells where a cut copies few of them, a full cell is dealt to chunks, every
    two of which meet in one task.  A family, which is what candidates join, is dealt out in the same way, with
    its whole vectors: counting the links of a large family takes work that grows with its square, in tasks
    of bounded size.
    """
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    element = "float" if kind == "<f4" else "double"
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                            F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    rows = narrow.mapInArrow(_read(kind), "vec_id long, label long, dim int, digest binary, vector binary")
    classes = stored(rows.filter("digest is not null").groupBy("label", "dim", "digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")).withColumn(
        "cid", F.monotonically_increasing_id()), "classes")

    sizes = classes.groupBy(*GROUP).agg(F.count("*").alias("n_group")).filter(F.col("n_group") > CELL_ROWS)
    large = stored(sizes, "large")
    steps = F.array(*[F.lit(k / STEPS) for k in range(1, STEPS)])
    quantiles = lookup_join(classes.select(*GROUP, "vector"), large.select(*GROUP), list(GROUP), "inner").mapInArrow(
        _axes(kind), "label long, dim int, axis int, x double").groupBy(*GROUP, "axis").agg(
        F.percentile_approx("x", steps, 1000).alias("q"))
    axes = stored(quantiles.groupBy(*GROUP).agg(F.collect_list(F.struct("axis", "q")).alias("axes")).join(
        large, list(GROUP)), "axes")
    spots = lookup_join(classes.select(*GROUP, "cid", "vector"), axes, list(GROUP)).mapInArrow(
        _spots(kind, threshold, blocks), "label long, dim int, block int, cell long, cid long, coded binary")
    cell = [*GROUP, "block", "cell"]
    found = _in_pairs(spots, cell, stored(_crowded(spots, cell), "crowded")).groupBy(*cell, "i", "j").applyInArrow(
        _candidates(threshold, blocks), "a long, b long")

    family = components(found).withColumnRenamed("node", "cid").withColumnRenamed("component", "family")
    kin = stored(classes.select("cid", "dim", "n", "vector").join(family, "cid"), "kin")
    checked = stored(_in_pairs(kin, ["family"], stored(_crowded(kin, ["family"]), "crowded")).groupBy(
        "family", "i", "j").applyInArrow(_verified(threshold, kind), "cid long, links long, low long"), "verified")

    # rows that share an id are one node
    ids = rows.filter("digest is not null").select("vec_id", "label", "digest").distinct().join(
        classes.select("label", "digest", "cid"), ["label", "digest"])
    shared = ids.groupBy("vec_id").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high")
    same = ids.join(shared, "vec_id").select(F.col("cid").alias("a"), F.col("low").alias("b"))
    star = stored(components(checked.select(F.col("cid").alias("a"), F.col("low").alias("b")).unionAll(same)), "stars")
    member = classes.join(star, F.col("cid") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "cid"))
    lowest = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    total = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    answer = member.join(lowest, "component").join(total, "cid", "left").select(
        "label", "digest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.filter("digest is not null").select("vec_id", "label", "digest").join(
        answer, ["label", "digest"], "left").select("vec_id", "n_links", "component_id")
    alone = rows.filter("digest is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
