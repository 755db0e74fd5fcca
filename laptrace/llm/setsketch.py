"""SetSketch registers of shingle sets, their banding, and joint estimation by likelihood.

Register j of a set is the exponentially spaced, truncated minimum floor(1 - log_b(min E_j / A)) of
unit exponentials E_j drawn by hashing its elements.  Registers of a union are the larger ones of its
parts, and with b close to 1 two sets share a register almost as often as their similarity says.
"""

from __future__ import annotations

import math

import numpy as np

from laptrace.llm.words import mixed

#: Base of the spacing, scale of the minima, and the largest register.
B, SCALE, TOP = 1.02, 20.0, 4000
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS

_SEEDS = mixed(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
_FLIP = (_SEEDS[:REGISTERS] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_SEEDS[REGISTERS:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest 32-bit draw of each register over a set's 64-bit hashes."""
    low = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(small), 1024):
        np.minimum(low, ((small[a: a + 1024, None] ^ _FLIP) * _TIMES).min(axis=0), out=low)
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """Registers from the minima of uniform draws: the draws are turned into exponentials only here."""
    exponential = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 32)
    return np.clip(np.floor(1 - np.log(exponential / SCALE) / math.log(B)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def bands(regs: np.ndarray) -> np.ndarray:
    """One key for each band of registers, for rows of registers."""
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(regs), BANDS))
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        key = mixed(key ^ (parts[:, :, r] + np.uint64(0x9E3779B97F4A7C15)))
    return key.view(np.int64)


def _above(x: np.ndarray) -> np.ndarray:
    """Chance that one register is above the other, for the share x of the union only the first set has."""
    return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / math.log(B)


def likely_jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
                   steps: int = 100) -> np.ndarray:
    """The similarity under which the numbers of larger, smaller and equal registers are likeliest.

    Rows of ``a`` and ``b`` are registers of two sets whose sizes are known.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = REGISTERS - more - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = most * np.linspace(0, 1, steps + 1)[None, :]
    up, down = _above(u - v * j), _above(v - u * j)
    tiny = 1e-12
    score = (more * np.log(up + tiny) + less * np.log(down + tiny)
             + same * np.log(np.maximum(1 - up - down, 0) + tiny))
    return np.take_along_axis(j, score.argmax(axis=1)[:, None], 1)[:, 0]
