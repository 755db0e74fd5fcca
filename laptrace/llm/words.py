"""Words of whole texts as numpy arrays, without a Python object per word.

A slice of documents is one byte buffer; words are spans in it and carry 64-bit hashes.  A hash is
a polynomial over random byte values modulo 2**64, mixed at the end; all of it is fixed, so every
executor and every rerun gets the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
WORD_VALUES = np.where(SPACE, np.uint64(0), VALUES)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


POWERS, INVERSES = _powers(BASE, BLOCK), _powers(INVERSE, BLOCK)


def span_hashes(buf: np.ndarray, starts: np.ndarray, values: np.ndarray = WORD_VALUES) -> np.ndarray:
    """Hash of the bytes from each start to the next, blanks counting 0 under WORD_VALUES."""
    out = np.zeros(len(starts), np.uint64)
    for a in range(0, len(buf), BLOCK):
        b = min(a + BLOCK, len(buf))
        lo, hi = np.searchsorted(starts, (a, b))
        terms = values[buf[a:b]] * POWERS[: b - a]
        inside = starts[lo:hi] - a
        if lo:  # the rest of a span that began in an earlier block
            part = int(terms[: inside[0] if len(inside) else b - a].sum())
            if part:
                moved = part * pow(BASE, a - int(starts[lo - 1]), 1 << 64) + int(out[lo - 1])
                out[lo - 1] = moved % (1 << 64)
        if hi > lo:
            out[lo:hi] = np.add.reduceat(terms, inside) * INVERSES[inside]
    return mixed(out)


def slices(batch: pa.RecordBatch | pa.Table, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text, a longer text alone."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch[text]), 0))
    ends = np.cumsum(lengths, dtype=np.int64)
    at, done = 0, 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        done, at = int(ends[to - 1]), to


class Words:
    """The words of a column of texts; a null text has none.

    ``buf`` holds all texts behind each other, text d from ``offsets[d]``; word w is
    ``buf[starts[w]:ends[w]]``; text d has the words ``first[d]`` up to ``first[d + 1]``.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = False):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
        if len(ends) == 0:
            ends = np.zeros(1, np.int64)
        buf = np.frombuffer(data, np.uint8)[ends[0]: ends[-1]] if data is not None and ends[-1] else np.zeros(0, np.uint8)
        self.buf = LOWER[buf] if lower else buf
        self.offsets = ends - ends[0]
        n = len(self.buf)
        blank = SPACE[self.buf]
        heads = np.ones(n + 1, bool)  # a word may start or the one before has ended
        heads[1:n] = blank[: n - 1] if n else heads[1:n]
        heads[self.offsets] = True
        self.starts = np.flatnonzero(~blank & heads[:n])
        tails = np.ones(n, bool)
        if n:
            tails[: n - 1] = blank[1:]
            cut = self.offsets[self.offsets > 0] - 1
            tails[cut] = True
        self.ends = np.flatnonzero(~blank & tails) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts)

    def text(self, doc: int) -> bytes:
        return self.buf[self.offsets[doc]: self.offsets[doc + 1]].tobytes()


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two things in order, from their hashes."""
    return mixed(left * np.uint64(0xD6E8FEB86659FD93) + mixed(right ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
