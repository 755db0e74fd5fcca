"""Questions from groups of documents to hash buckets, and the answers back.

Documents are dealt to chunks.  A chunk works out distinct 64-bit keys of its own content and sends
them, packed and sorted, to the buckets the keys belong to; a bucket sees each key once per chunk, so
a key that stands in a third of all rows weighs no more than any other.  Answers come back packed in the
same order.  One shuffle carries texts, one the packed keys, one the packed answers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laptrace.llm.tables import partitions


def chunked(docs: DataFrame, *key: str, mb_each: int = 16, measured: bool = False) -> tuple[DataFrame, int]:
    """Adds ``chunk`` by the hash of the key columns and deals rows by it; also the number of partitions.

    There are as many chunks as partitions, of about ``mb_each`` MB of files or, if ``measured``, of text.  Spark runs the shuffle once for all uses in one query.
    """
    parts = partitions(docs, mb_each, measured)
    chunk = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
    return docs.withColumn("chunk", chunk).repartition(parts, "chunk"), parts


class Buckets:
    """Equal ranges of the 64-bit keys, and keys cut to the high bits that tell them apart.

    A key keeps ``kept`` bits beyond those that name its bucket, so the chance that two keys of a
    bucket are taken for one does not rise with the number of buckets; 64 keeps all.
    """

    def __init__(self, count: int, kept: int = 64):
        self.count = count
        self.shift = np.uint64(max(0, 64 - kept - max(count.bit_length() - 1, 0)))

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> self.shift

    def split(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(bucket, begin, end) for runs of sorted cut keys."""
        high = keys >> (np.uint64(32) - self.shift)
        own = (high * np.uint64(self.count) >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        return list(zip(own[begin].tolist(), begin.tolist(), np.append(begin[1:], len(keys)).tolist(), strict=True)
                    ) if len(own) else []

    def base(self, bucket: int) -> np.uint64:
        """No key of the bucket is smaller."""
        return np.uint64(-(-(bucket << 32) // self.count) << (32 - int(self.shift)))


def narrow(values: np.ndarray) -> tuple[bytes, int]:
    """Unsigned numbers in as few bytes each as the largest needs, with that width."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes(), width


def widened(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8")[:, 0]
