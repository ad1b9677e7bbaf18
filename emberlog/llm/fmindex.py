"""A compressed full-text index over sequences of words: Burrows-Wheeler transform in a wavelet tree of bit vectors.

Built for one shard inside a task. Bit vectors are packed with a running count for every 64 bits. Searches run for many
sequences at once: each step extends all of them by one word to the left.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8").astype(np.uint64)
        counts = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & low).astype(np.int64)


class Wavelet:
    """Rank of any symbol in a sequence of integers, one bit vector a level, highest bit first."""

    def __init__(self, values: np.ndarray, levels: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(levels - 1, -1, -1):
            bit = (values >> shift) & 1
            zeros = int(len(bit) - bit.sum())
            self.levels.append((shift, Bits(bit), zeros))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def ranks(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``symbol`` before ``lo`` and before ``hi``, as places in the last level."""
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(lo), bits.rank(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return lo, hi


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols at least, by doubling."""
    rank = text.astype(np.int64)
    have, n = 1, len(text)
    order = np.argsort(rank, kind="stable")
    while have < depth:
        later = np.zeros(n, np.int64)
        later[: n - have] = rank[have:] + 1
        key = rank * np.int64(rank.max() + 2) + later
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        have *= 2
        if fresh[-1] == n - 1:
            break
    return order


class FMIndex:
    """Index of weighted sequences. ``texts``: symbols of all sequences in a row; ``first``: where each begins, and the end."""

    def __init__(self, texts: np.ndarray, first: np.ndarray, weights: np.ndarray, depth: int) -> None:
        symbols, dense = np.unique(texts, return_inverse=True)
        sizes = np.diff(first)
        n = len(texts) + len(sizes)
        at = np.arange(len(texts)) + np.repeat(np.arange(len(sizes)), sizes)  # a separator, 0, after each sequence
        text = np.zeros(n, np.int64)
        text[at] = dense + 1
        weight = np.zeros(n, np.int64)
        weight[at] = np.repeat(weights, sizes)
        order = suffix_order(text, depth)
        last = text[order - 1]
        self.dense = dense + 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(symbols) + 1))])
        self.tree = Wavelet(last, max(1, int(len(symbols)).bit_length()))
        # where a symbol's places begin in the last level
        zero = np.zeros(len(symbols) + 1, np.int64)
        self.base, _ = self.tree.ranks(np.arange(len(symbols) + 1), zero, zero)
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])
        self.n = n

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``symbol`` followed by what the intervals stand for."""
        a, b = self.tree.ranks(symbol, lo, hi)
        return self.starts[symbol] + a - self.base[symbol], self.starts[symbol] + b - self.base[symbol]

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weight[hi] - self.weight[lo]


def repeated_spans(texts: np.ndarray, first: np.ndarray, weights: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each sequence the spans (start, end) that windows occurring twice or more, by weight, cover.

    From an end, backward search extends a sequence to the left while it still occurs twice. A match of ``window`` words or
    more is a span. The next end is the last one that could still give a new match.
    """
    index = FMIndex(texts, first, weights, int(np.diff(first).max(initial=1)) + 1)
    out: list[list[tuple[int, int]]] = [[] for _ in weights]
    row = np.arange(len(weights))
    begin, end = first[:-1].copy(), first[1:].copy()
    keep = end - begin >= window
    row, begin, end = row[keep], begin[keep], end[keep]
    at, lo, hi = end.copy(), np.zeros(len(row), np.int64), np.full(len(row), index.n, np.int64)
    while len(row):
        more = at > begin
        symbol = index.dense[np.where(more, at - 1, 0)]
        new_lo, new_hi = index.extend(symbol, lo, hi)
        on = more & (index.count(new_lo, new_hi) >= 2)
        at, lo, hi = np.where(on, at - 1, at), np.where(on, new_lo, lo), np.where(on, new_hi, hi)
        stop = np.nonzero(~on)[0]
        if not len(stop):
            continue
        for k in stop[end[stop] - at[stop] >= window].tolist():
            base = first[row[k]]
            out[row[k]].append((int(at[k] - base), int(end[k] - base)))
        # the word before ``at`` can't join; a word seen once ends every match
        s = at[stop] - 1
        alone = index.weight[index.starts[symbol[stop] + 1]] - index.weight[index.starts[symbol[stop]]] < 2
        next_end = np.where(alone, s, np.minimum(end[stop] - 1, s + window))
        end[stop], at[stop], lo[stop], hi[stop] = next_end, next_end, 0, index.n
        keep = np.ones(len(row), bool)
        keep[stop] = more[stop] & (next_end - begin[stop] >= window)
        row, begin, end, at, lo, hi = (x[keep] for x in (row, begin, end, at, lo, hi))
    return out
