"""A compressed full-text index over integer sequences: wavelet tree, backward search, suffix order."""

from __future__ import annotations

import numpy as np

WORD = 64


class RankBits:
    """Bits packed into 64-bit words with a running count before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        n = -(-(len(bits) + 1) // WORD) * WORD
        padded = np.zeros(n, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))[:-1].astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Rank of any symbol in any prefix, in one step for each bit of the symbols (levels stored as one matrix)."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.levels, self.zeros = [], []
        current = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (current >> level) & 1
            self.levels.append(RankBits(bit.astype(np.uint8)))
            self.zeros.append(len(current) - int(bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        # where each symbol's run begins on the last level
        self.first = np.zeros(size + 1, np.int64)
        run = np.zeros(size, np.int64)
        at = np.flatnonzero(np.concatenate(([True], current[1:] != current[:-1]))) if len(current) else np.zeros(0, np.int64)
        run[current[at]] = at
        self.first[:size] = run

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each pair how often the symbol (which must occur) stands before the position."""
        at = at.astype(np.int64)
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            bit = (symbols >> (self.bits - 1 - i)) & 1
            ones = level.rank(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
        return at - self.first[symbols]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling up to `depth` symbols.

    Each 0 counts as a symbol of its own, in the order of their positions, so
    suffixes are told apart at the end of their part at the latest.
    """
    n, ends = len(text), text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    rank, k = rank.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        ahead = np.zeros(n, np.int64)
        ahead[: n - k] = rank[k:] + 1
        pair = rank * (n + 1) + ahead
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])))
        k *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def agreeing(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order whether its first `depth` symbols are those of the one before it (its longest common prefix, cut off)."""
    n = len(text)
    same = np.zeros(n, bool)
    alive = np.arange(1, n)
    for d in range(depth):
        a, b = order[alive - 1] + d, order[alive] + d
        ok = (a < n) & (b < n)
        alive, a, b = alive[ok], a[ok], b[ok]
        alive = alive[(text[a] == text[b]) & (text[a] != 0)]
    same[alive] = True
    return same


class FMIndex:
    """Backward search over a sequence of symbols 1 and up, in which a 0 ends every part.

    What is kept is compressed: the wavelet tree of the Burrows-Wheeler
    transform, a bit for each suffix that tells where runs of suffixes with the
    same first `size` symbols begin, and one value for each such run.  The text
    and its suffix order are dropped once these are made.

    depth: at least the length of the longest part with its 0.
    value: for each place of the text a number, of which a run gets the least;
    weight: for each place a number, of which a run gets the sum.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int, size: int = 1, value: np.ndarray | None = None, weight: np.ndarray | None = None) -> None:
        order = suffix_order(text, depth)
        self.n = len(text)
        self.last = WaveletTree(text[order - 1], symbols)  # the symbol before each suffix
        self.start = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.size = size
        first = ~agreeing(text, order, size)
        self.runs = RankBits(first.astype(np.uint8))
        starts = np.flatnonzero(first)
        self.bounds = np.append(starts, self.n).astype(np.int32)
        self.least = np.minimum.reduceat(value[order], starts) if value is not None else None
        self.total = np.add.reduceat(weight[order], starts) if weight is not None else None

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern from those of patterns; empty where that doesn't occur."""
        base = self.start[symbols]
        return base + self.last.rank(symbols, low), base + self.last.rank(symbols, high)

    def run(self, low: np.ndarray) -> np.ndarray:
        """The run in which suffix number `low` lies."""
        return self.runs.rank(low + 1) - 1

    def windows(self, text: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, offset, run) for every place of the given parts whose matching statistic reaches `size`.

        Parts are streamed from their last symbols to their first, all at once.
        A match grows to the left by backward search and is held at `size`
        symbols, the run's own interval.  If it can't grow, no window that holds
        all of it and the next symbol occurs, so the search goes on with a match
        that ends one symbol before.  Symbol -1 occurs nowhere, nor does a window
        that holds it.
        """
        parts, offsets, runs = [], [], []
        end, at = lengths.copy(), lengths.copy()  # the match is from `at` to `end`
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n)
        active = np.flatnonzero(lengths >= self.size)
        while len(active):
            symbol = text[begin[active] + at[active] - 1]
            known = symbol > 0
            lo, hi = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64)
            lo[known], hi[known] = self.extend(symbol[known], low[active][known], high[active][known])
            good = hi > lo
            on, off = active[good], active[~good]
            at[on] -= 1
            low[on], high[on] = lo[good], hi[good]
            full = on[end[on] - at[on] >= self.size]
            if len(full):
                r = self.run(low[full])
                low[full], high[full] = self.bounds[r], self.bounds[r + 1]
                end[full] = at[full] + self.size
                parts.append(full)
                offsets.append(at[full].copy())
                runs.append(r)
            end[off] = np.where(known[~good], end[off], at[off]) - 1
            at[off] = end[off]
            low[off], high[off] = 0, self.n
            # a window must still fit in front of the match's end
            active = active[(end[active] >= self.size) & (at[active] > 0)]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) if x else none for x in (parts, offsets, runs))
