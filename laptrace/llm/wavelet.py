"""Token ids in shards, each a wavelet matrix: succinct bit planes with rank and select.

A shard holds the ids of consecutive documents in ascending id order.  Its planes are stored from the
highest bit down; behind each plane the symbols are stably parted, zeros first.  One row of a
Parquet table (zstd) is one shard and answers access, counting and occurrence lookup by itself.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laptrace.llm.bpe import Codec, checked, model_of
from laptrace.llm.tables import partitions
from laptrace.llm.words import slices

#: Tokens after which a shard is closed; a longer document makes a longer shard.
SHARD_TOKENS = 1 << 20
#: Bits between stored rank counts.
STEP = 512

SHARDS = "part int, seq int, n_tokens long, n_docs long, doc_ids binary, null_ids binary, lengths binary, matrix binary"
MAGIC = b"WVM1"


class WaveletMatrix:
    """n symbols of ``bits`` bits; planes as packed bits, ranks as ones before every STEP bits."""

    def __init__(self, n: int, bits: int, planes: np.ndarray, zeros: np.ndarray, ranks: np.ndarray):
        self.n, self.bits, self.planes, self.zeros, self.ranks = n, bits, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        n = len(ids)
        bits = max(int(ids.max(initial=0)).bit_length(), 1)
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        width = -(-max(n, 1) // STEP) * STEP // 8
        planes, zeros = np.zeros((bits, width), np.uint8), np.zeros(bits, np.int64)
        for p in range(bits):
            one = (now >> (bits - 1 - p)) & 1 == 1
            packed = np.packbits(one, bitorder="little")
            planes[p, : len(packed)] = packed
            low = now[~one]
            zeros[p] = len(low)
            now = np.concatenate([low, now[one]])
        return cls(n, bits, planes, zeros, cls._ranks(planes))

    @staticmethod
    def _ranks(planes: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(planes.reshape(len(planes), -1, STEP // 8)).sum(axis=2, dtype=np.int64)
        return np.concatenate([np.zeros((len(planes), 1), np.int64), np.cumsum(ones, axis=1)], axis=1).astype("<u4")

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<QII", self.n, self.bits, self.planes.shape[1])
        return head + self.zeros.astype("<i8").tobytes() + self.ranks.astype("<u4").tobytes() + self.planes.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits, width = struct.unpack_from("<QII", data, 4)
        at = 20
        zeros = np.frombuffer(data, "<i8", bits, at)
        steps = width * 8 // STEP + 1
        ranks = np.frombuffer(data, "<u4", bits * steps, at + 8 * bits).reshape(bits, steps)
        planes = np.frombuffer(data, np.uint8, bits * width, at + 8 * bits + 4 * bits * steps).reshape(bits, width)
        return cls(n, bits, planes, zeros, ranks)

    def _ones(self, plane: int, upto: np.ndarray) -> np.ndarray:
        """Ones in a plane before each position."""
        block, rest = upto // STEP, upto % STEP
        whole = self.ranks[plane, block].astype(np.int64)
        bytes_ = self.planes[plane].reshape(-1, STEP // 8)
        block = np.minimum(block, len(bytes_) - 1)
        rows = bytes_[block]
        at = np.arange(STEP // 8) * 8
        full = np.bitwise_count(rows) * (at[None, :] + 8 <= rest[:, None])
        part = np.take_along_axis(rows, np.minimum(rest // 8, STEP // 8 - 1)[:, None], 1)[:, 0]
        partial = np.bitwise_count(part & ((1 << (rest % 8)) - 1).astype(np.uint8))
        return np.where(rest > 0, whole + full.sum(axis=1, dtype=np.int64) + partial, whole)

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The symbols at the given positions."""
        at, out = np.asarray(positions, np.int64), np.zeros(len(positions), np.uint32)
        for p in range(self.bits):
            one = (self.planes[p, at // 8] >> (at % 8).astype(np.uint8)) & 1
            before = self._ones(p, at)
            out = (out << 1) | one
            at = np.where(one == 1, self.zeros[p] + before, at - before)
        return out

    def rank(self, symbol: int, upto: int) -> int:
        """How often the symbol stands before position ``upto``."""
        lo, hi = self._range(symbol, 0, upto)
        return hi - lo

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol >> self.bits or self.n == 0:
            return 0, 0
        for p in range(self.bits):
            a, b = (int(x) for x in self._ones(p, np.array([lo, hi], np.int64)))
            one = symbol >> (self.bits - 1 - p) & 1
            lo, hi = (int(self.zeros[p]) + a, int(self.zeros[p]) + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, which: np.ndarray) -> np.ndarray:
        """Positions of the occurrences numbered ``which``, from 0, in order."""
        lo, hi = self._range(symbol, 0, self.n)
        at = lo + np.asarray(which, np.int64)
        if len(at) and (at.min() < lo or at.max() >= hi):
            raise IndexError("no such occurrence")
        for p in reversed(range(self.bits)):
            bits = np.unpackbits(self.planes[p], bitorder="little")[: self.n]
            one = symbol >> (self.bits - 1 - p) & 1
            places = np.flatnonzero(bits == one)
            at = places[at - int(self.zeros[p])] if one else places[at]
        return at

    def occurrences(self, symbol: int) -> np.ndarray:
        return self.select(symbol, np.arange(self.count(symbol)))

    def symbols(self) -> np.ndarray:
        """All symbols in order, by undoing one plane after the other."""
        now = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for p in reversed(range(self.bits)):
            one = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(now)
            before[~one] = now[: self.zeros[p]]
            before[one] = now[self.zeros[p]:] | now.dtype.type(1 << (self.bits - 1 - p))
            now = before
        return now.astype(np.uint32)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, doc_id: str = "doc_id",
          text: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes whole texts and writes them as shards, in ascending doc_id order, null ids first.

    ``end_id`` is appended to every document.  Null texts count as empty; rows with equal ids are
    ordered by text; an empty table writes an empty set of shards; other columns are not looked at.
    Rows are dealt by ranges of the id, so shards of part p hold smaller ids than those of part p + 1.
    """
    model = docs.sparkSession.sparkContext.broadcast(model_of(tokenizer))
    checked(model.value)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = partitions(narrow, mb_each=64)
    order = ("doc_id", F.xxhash64("text"))
    ranged = narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "part", F.spark_partition_id())
    end = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, seq, full = Codec.of(model.value), 0, 0, 0
        held, ids_of, nulls, lengths = [], [], [], []

        def shard() -> pa.RecordBatch:
            whole = np.concatenate(held)
            row = {"part": [part], "seq": [seq], "n_tokens": [len(whole)], "n_docs": [len(lengths)],
                   "doc_ids": [np.array(ids_of, "<i8").tobytes()], "null_ids": [bytes(nulls)],
                   "lengths": [np.array(lengths, "<i8").tobytes()],
                   "matrix": [WaveletMatrix.build(whole).to_bytes()]}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)],
                                              names=list(row))

        for batch in batches:
            part = batch["part"][0].as_py() if batch.num_rows else part
            for piece in slices(batch):
                ids, offsets = codec.encode(pc.fill_null(piece["text"], ""), 0)
                for k, given in enumerate(piece["doc_id"].to_pylist()):
                    held.append(np.append(ids[offsets[k]: offsets[k + 1]], np.array(end, np.uint32)))
                    ids_of.append(given or 0)
                    nulls.append(given is None)
                    lengths.append(len(held[-1]))
                    full += lengths[-1]
                    if full >= shard_tokens:
                        yield shard()
                        seq, full, held, ids_of, nulls, lengths = seq + 1, 0, [], [], [], []
        if lengths:
            yield shard()

    ranged.mapInArrow(run, SHARDS).write.option("compression", "zstd").parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """part, seq and ``start`` of every shard, the tokens in all shards before it.

    Sums run within a part and over the parts, so no task sees a row for every shard.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).select(
        "part", F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("base"))
    return sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("ahead")).join(
        parts, "part").select("part", "seq", (F.col("base") + F.col("ahead")).alias("start"))


def documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, read from the shards."""
    shards = spark.read.schema(SHARDS).parquet(path)
    kind = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["matrix"]).symbols().astype("<u4")
                size = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(size)
                given = np.frombuffer(row["doc_ids"], "<i8")
                each = [ids[a:b] for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
                n = len(size)
                columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                           pa.array(given, pa.int64(), mask=np.frombuffer(row["null_ids"], np.uint8) == 1),
                           pa.array(ends - size), pa.array(size),
                           pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                names = ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # a batch is one shard: rows are megabytes each
    found = shards.select("part", "seq", "doc_ids", "null_ids", "lengths", "matrix").mapInArrow(run, kind)
    out = found.join(starts(spark, path), ["part", "seq"])
    return out.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      *["ids"] * with_ids)


def occurrences(spark: SparkSession, path: str, symbol: int) -> DataFrame:
    """Every place of a token id, as (position in the corpus, doc_id), by lookup in each shard."""
    shards = spark.read.schema(SHARDS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = WaveletMatrix.from_bytes(row["matrix"]).occurrences(symbol)
                doc = np.searchsorted(np.cumsum(np.frombuffer(row["lengths"], "<i8")), at, side="right")
                n, null = len(at), np.frombuffer(row["null_ids"], np.uint8)[doc] == 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                     pa.array(at), pa.array(np.frombuffer(row["doc_ids"], "<i8")[doc], mask=null)],
                    names=["part", "seq", "at", "doc_id"])

    found = shards.mapInArrow(run, "part int, seq int, at long, doc_id long")
    return found.join(starts(spark, path), ["part", "seq"]).select(
        (F.col("start") + F.col("at")).alias("position"), "doc_id")
