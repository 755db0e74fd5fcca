"""Near-duplicate documents: SetSketch bands give candidates, a likelihood estimate thins them out,
and the full shingle sets of both texts confirm every link."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laptrace.llm import setsketch
from laptrace.llm.components import components
from laptrace.llm.tables import giving_back, stored
from laptrace.llm.words import Words, mixed, pair_hash, slices

#: Six standard deviations of the estimate at a similarity of 0.8: true links stay candidates.
MARGIN = 0.16
#: Documents and shingles of a family that a block holds; two blocks meet in a task.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 500_000


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts, and with one more where each text's shingles begin.

    A text with fewer words than ``width`` has its whole sequence as one shingle, without words none.
    """
    hashes, counts = words.hashes(), words.counts
    n = len(hashes)
    rolled, have = mixed(hashes), np.minimum(counts, width)
    for k in range(1, width):
        at = np.arange(n - k)
        rolled[at] = pair_hash(rolled[at], hashes[k:])
    number = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(number)])
    keep = np.repeat(words.first[:-1] - offsets[:-1], number) + np.arange(offsets[-1])
    out = rolled[keep]
    for d in np.flatnonzero((counts > 0) & (counts < width)):  # short texts must not take in the next one's words
        h = mixed(hashes[words.first[d]: words.first[d] + 1])
        for k in range(1, have[d]):
            h = pair_hash(h, hashes[words.first[d] + k: words.first[d] + k + 1])
        out[offsets[d]] = mixed(h ^ np.uint64(int(have[d])))[0]
    return out, offsets


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    hashes, offsets = shingle_hashes(Words(column, lower=True), width)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield np.unique(hashes[a:b])


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, registers (null for empty sets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, digests, regs = [], [], []
                for own in _sets(part["text"], width):
                    sizes.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    regs.append(setsketch.registers(setsketch.minima(own)).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "digest", "registers"])

    return docs.mapInArrow(giving_back(run), "doc_id long, n_shingles long, digest binary, registers binary")


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            regs = np.frombuffer(b"".join(part["registers"].to_pylist()), "<u2").reshape(-1, setsketch.REGISTERS)
            keys = setsketch.bands(regs)
            rep = np.repeat(part["doc_id"].to_numpy(), setsketch.BANDS)
            size = np.repeat(part["n_shingles"].to_numpy(), setsketch.BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep), pa.array(size)],
                                             names=["key", "rep", "size"])


def _likely(least: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 1000):
                f = frame[at: at + 1000]
                a = np.frombuffer(b"".join(f["regs_a"]), "<u2").reshape(len(f), -1)
                b = np.frombuffer(b"".join(f["regs_b"]), "<u2").reshape(len(f), -1)
                j = setsketch.likely_jaccard(a, b, f["size_a"].to_numpy(float), f["size_b"].to_numpy(float))
                yield f.loc[j >= least, ["a", "b"]]
    return run


def _verified(width: int, percent: int):
    """Rows (pair, texts) to the pairs whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                keep = [_similar(x, y, percent) for x, y in
                        zip(_sets(part["text_a"], width), _sets(part["text_b"], width), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Words are lower-cased (A-Z); a set is the distinct shingles of ``width`` words, or the whole
    sequence where there are fewer; texts are linked where 100 * common >= percent * united, checked
    on the full sets.  ``component_id`` is the smallest doc_id reachable over links, itself included.

    Texts that are null, empty or without words have empty sets, link with nothing and are kept.
    Rows with equal sets form one class before anything is compared.  Rows that share an id are one
    node with the links of all of them.  Rows with a null id take no part: component_id is null and
    kept is true.  An empty table gives an empty result; other columns are not looked at.

    Banding misses a pair at the threshold with a chance below 3e-6, falling fast above it, and the
    estimate's margin is six standard deviations; components are mostly held by many links at once.
    Every bucket's members meet its smallest one first.  What that leaves in different components is
    compared across components, block by block inside a task, which passes on no more links than hold
    the components together; a large group of near copies is spread over many tasks that way.

    Joins are merged from shuffles: a table that grows with the corpus may be small on disk but not in the driver's
    memory, where a broadcast of it would be built.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketched = stored(sketches(narrow, width), "sketches")
    known = sketched.filter("digest is not null and doc_id is not null")
    classes = stored(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    # one row per class; an id that stands for several sets keeps them all
    reps = stored(known.alias("k").join(classes.alias("c").hint("merge"), (F.col("k.digest") == F.col("c.digest"))
                                        & (F.col("k.doc_id") == F.col("c.rep")))
                  .select("doc_id", "n_shingles", "registers").distinct(), "reps")

    rows = reps.select("doc_id", "n_shingles", "registers").mapInArrow(giving_back(_band_rows), "key long, rep long, size long")
    pivots = rows.groupBy("key").agg(F.min(F.struct("rep", "size")).alias("p"), F.count("*").alias("n")).filter("n > 1")
    members = stored(rows.join(pivots.hint("merge"), "key").select("key", "rep", "size", F.col("p.rep").alias("pivot"),
                                                     F.col("p.size").alias("pivot_size")), "members")
    fits = "100 * least(size_a, size_b) >= {0} * greatest(size_a, size_b) and a < b".format(percent)
    first = members.select(F.col("pivot").alias("a"), F.col("rep").alias("b"), F.col("pivot_size").alias("size_a"),
                           F.col("size").alias("size_b")).filter(fits).distinct()
    confirmed = _confirm(narrow, reps, first, width, percent)

    # ids that stand for more than one set are one node
    doubles = known.select("doc_id", "digest").distinct().join(classes.hint("merge"), "digest")
    several = doubles.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    own = doubles.join(several.hint("merge"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    star = stored(components(confirmed.unionAll(own)), "stars")

    # buckets that still hold more than one component are put together where they share members, and
    # the members of such a family are compared in blocks, across components only
    held = members.select("key", "rep", "size").join(star.hint("merge"), F.col("rep") == F.col("node"), "left").withColumn(
        "comp", F.coalesce("component", "rep")).drop("node", "component")
    split = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("rep").alias("head"))
    open_ = stored(held.join(split.filter("lo < hi").select("key", "head").hint("merge"), "key"), "open")
    family = components(open_.select(F.col("rep").alias("a"), F.col("head").alias("b")))
    joined = open_.select("rep", "comp", "size").distinct().join(family.hint("merge"), F.col("rep") == F.col("node"))
    kin = stored(joined.select(F.col("component").alias("family"), "rep", "comp", "size"), "kin")
    blocks = kin.groupBy("family").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_ROWS, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = kin.join(blocks.hint("merge"), "family").withColumn("own", own).withColumn("other", other).select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
        F.col("rep").alias("doc_id"), "comp")
    texts = _texts(narrow, kin.select(F.col("rep").alias("doc_id")))
    more = met.join(texts.hint("merge"), "doc_id").select("family", "i", "j", "own", "doc_id", "comp", "text").groupBy(
        "family", "i", "j").applyInArrow(_across(width, percent), "a long, b long")
    links = star.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)
    star = stored(components(links), "stars")

    labels = classes.join(star.hint("merge"), classes["rep"] == star["node"], "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    joined = sketched.join(labels.hint("merge"), "digest", "left")
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", label.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _confirm(narrow: DataFrame, reps: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose full sets are similar enough."""
    pairs = stored(pairs, "pairs")
    sketch = reps.select("doc_id", "registers")
    with_a = pairs.join(sketch.withColumnsRenamed({"doc_id": "a", "registers": "regs_a"}).hint("merge"), "a")
    with_b = with_a.join(sketch.withColumnsRenamed({"doc_id": "b", "registers": "regs_b"}).hint("merge"), "b")
    likely = stored(with_b.mapInPandas(_likely(percent / 100 - MARGIN), "a long, b long").distinct(), "likely")
    ends = likely.select(F.explode(F.array("a", "b")).alias("doc_id"), "a", "b")
    texts = ends.join(_texts(narrow, ends.select("doc_id").distinct()).hint("merge"), "doc_id")
    sides = texts.groupBy("a", "b").agg(
        F.max(F.when(F.col("doc_id") == F.col("a"), F.col("text"))).alias("text_a"),
        F.max(F.when(F.col("doc_id") == F.col("b"), F.col("text"))).alias("text_b"))
    return stored(sides.mapInArrow(giving_back(_verified(width, percent)), "a long, b long"), "confirmed")


#: Ids that a broadcast may hold (each takes some 100 bytes of the driver's memory while it is built); of more only a
#: bitmap is broadcast, of as many bits an id, 16 MB at most.
BROADCAST_IDS, BITS_EACH, MOST_BITS = 100_000, 16, 1 << 27
#: Bits of a row of Spark's bitmaps.
BITMAP = 32768


def _texts(narrow: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the wanted ids, with what stands beside the ids, in a table of their own."""
    wanted = stored(wanted, "wanted")
    n = wanted.count()
    if n <= BROADCAST_IDS:
        return stored(narrow.join(F.broadcast(wanted), "doc_id"), "texts")
    return stored(_possible(narrow, wanted, n).join(wanted.hint("merge"), "doc_id"), "texts")


def _possible(narrow: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The rows whose id a bitmap of hashed ids can't rule out, so that few other texts are shuffled."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP * -(-min(n * BITS_EACH, MOST_BITS) // BITMAP)))
    part, bit = F.floor(place / BITMAP).cast("int"), F.pmod(place, F.lit(BITMAP)).cast("int")
    # the aggregate takes the byte and bit of a position as they are, so the same numbers find them again
    maps = wanted.groupBy(part.alias("part_")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("bits_"))
    byte = F.conv(F.hex(F.substring("bits_", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = narrow.withColumn("part_", part).join(F.broadcast(stored(maps, "bitmaps")), "part_")
    return kept.where(F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1).select(*narrow.columns)


def _across(width: int, percent: int):
    """The links between components in a pair of blocks, as few as hold the same components together."""
    def run(rows: pa.Table) -> pa.Table:
        side, comp, ids = (np.asarray(rows[c]) for c in ("own", "comp", "doc_id"))
        left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
        found = []
        if len(np.unique(comp)) > 1:
            sets = list(_sets(rows["text"], width))
            size = np.array([len(x) for x in sets])
            common = _common(sets, left, right)
            hit = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
            hit &= (common > 0) & (comp[left][:, None] != comp[right][None, :])
            parent = {c: c for c in comp.tolist()}

            def root(c: int) -> int:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for x, y in zip(*np.nonzero(hit), strict=True):
                a, b = root(int(comp[left[x]])), root(int(comp[right[y]]))
                if a != b:
                    parent[a] = b
                    found.append((int(ids[left[x]]), int(ids[right[y]])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})
    return run


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each left set shares with each right set, by products of 0/1 matrices."""
    keys, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    rank = np.cumsum(times > 1) - 1  # only elements of more than one set can be shared
    doc, column = doc[times[column] > 1], rank[column[times[column] > 1]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, (a, a + 4096))
        matrix = np.zeros((len(sets), 4096), np.float32)
        matrix[doc[lo:hi], column[lo:hi] - a] = 1
        out += matrix[left] @ matrix[right].T
    return np.rint(out).astype(np.int64)
