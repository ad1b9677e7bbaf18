"""Words of whole Arrow text columns as arrays: places, 64-bit hashes, hashes of word sequences.

A word is a run of bytes other than space and the controls 9 to 13. Hashes depend on the bytes only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from emberlog.llm.common import mix

_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_SPAN = 1 << 20


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, base % 2**64, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(base, -1, 2**64), np.uint64)])
    return up, down


def _room(n: int) -> int:
    return max(_SPAN, 1 << int(n).bit_length())


@dataclass
class Words:
    """Word ``k`` is ``data[starts[k]:ends[k]]``; text ``d`` has the words ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, k: int) -> np.ndarray:
        return np.arange(self.first[k], self.first[k + 1])


def words_of(column: pa.Array) -> Words:
    """The words of each row; null rows have none."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint8), none, none, np.zeros(1, np.int64), none.astype(np.uint64))
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    closes[lasts] = inside[lasts]
    starts, ends = np.nonzero(opens)[0], np.nonzero(closes)[0] + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), _hashes(data, starts, ends))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(starts):
            stop = max(k + 1, int(np.searchsorted(ends, starts[k] + _SPAN, side="right")))
            a, b = starts[k], ends[stop - 1]
            up, down = _powers(_BASE, _room(b - a))
            sums = np.empty(b - a + 1, np.uint64)
            sums[0] = 0
            np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=sums[1:])
            s, e = starts[k:stop] - a, ends[k:stop] - a
            out[k:stop] = (sums[e] - sums[s]) * down[s]
            k = stop
    return mix(out ^ (ends - starts).astype(np.uint64))


class Sequences:
    """Hashes of runs of consecutive words, from running sums of their hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.up, self.down = _powers(_STEP, _room(len(hashes)))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.up[: len(hashes)])])

    def of(self, start: np.ndarray, stop: np.ndarray, seed: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64), seed)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from those of powers of two."""
    n, have, out = len(values) - width + 1, 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have :][:n])
