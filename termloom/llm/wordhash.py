"""Words of many texts as 64-bit hashes, computed over whole Arrow buffers.

Words are [^\\x20\\x09-\\x0D]+ of the UTF-8 bytes, which split where the code
points do.  A word's hash is a polynomial over the ring of 64-bit integers,
read off a running sum, so the cost is a few numpy passes per byte and none per
word in Python.  Memory is bounded: work goes in chunks of whole texts, and a
text beyond a chunk is cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Bytes taken at once, and length in bytes from which a word gets a digest.
LANE, LONG = 8, 128
_R = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([0xD6E8FEB86659FD93, 0xA5CB9243F3A6E2AB, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    def __init__(self, lower: bool = False) -> None:
        self.table = bytes(b + 32 if lower and 65 <= b <= 90 else b for b in range(256))
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[[32, 9, 10, 11, 12, 13]] = False

    def _piece(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words in data; a word also starts at each of firsts."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        word = self.is_word[data]
        before = np.empty(n, dtype=bool)
        before[0] = False
        before[1:] = word[:-1]
        before[firsts] = False
        starts = np.flatnonzero(word & ~before)
        # a word ends where the next byte is none of it: a separator, the end, or the next text's start
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = word[1:]
        cut = firsts[firsts > 0] - 1
        after[cut] = False
        ends = np.flatnonzero(word & ~after) + 1
        return self._hashes(data, starts, ends), starts, ends

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's hash: eight bytes after eight go through a bijection; words of many bytes have a digest of their own."""
        padded = data.tobytes().translate(self.table) + bytes(LANE)
        lanes = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))  # the eight bytes from each place on
        left = ends - starts
        hashes = mix(left.astype(np.uint64) + _R)
        rows = np.flatnonzero(left <= LONG)
        at, left = starts[rows], left[rows]
        with np.errstate(over="ignore"):
            while len(rows):
                lane = lanes[at]
                last = left < LANE
                lane[last] &= (np.uint64(1) << (left[last].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
                hashes[rows] = mix(hashes[rows] * _R + lane)
                more = left > LANE
                rows, at, left = rows[more], at[more] + LANE, left[more] - LANE
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            hashes[i] = int.from_bytes(blake2b(padded[starts[i] : ends[i]], digest_size=8).digest(), "little")
        return hashes

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, hashes of its words) for each row in order; null counts as empty."""
        for lo, hi, hashes, counts, _, _ in self.chunks(column):
            at = np.concatenate(([0], np.cumsum(counts)))
            for i in range(lo, hi):
                yield i, hashes[at[i - lo] : at[i - lo + 1]]

    def chunks(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, end row, hashes, words per row, byte starts, byte ends) for runs of rows.

        Starts and ends count from the first byte of the run's first row.
        """
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        column = column.fill_null("")
        n = len(column)
        _, raw, body = column.buffers()
        offsets = np.frombuffer(raw, dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
        data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
            j = min(j, n)
            a, b = int(offsets[i]), int(offsets[j])
            piece = data[a:b]
            if b - a > 4 * CHUNK:
                hashes, starts, ends = self._long(piece)
                counts = np.array([len(hashes)])
            else:
                firsts = np.unique(offsets[i:j] - a)
                hashes, starts, ends = self._piece(piece, firsts[firsts < b - a])
                counts = np.diff(np.searchsorted(starts, offsets[i : j + 1] - a, side="left"))
            yield i, j, hashes, counts, starts, ends
            i = j

    def _long(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One very long text, cut after a separator at about every CHUNK bytes."""
        out, a, first = [], 0, np.array([0])
        while a < len(data):
            b = min(a + CHUNK, len(data))
            while b < len(data) and self.is_word[data[b - 1]]:
                b += 1
            h, s, e = self._piece(data[a:b], first)
            out.append((h, s + a, e + a))
            a = b
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words, in order; the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(n, k)
    with np.errstate(over="ignore"):
        total = np.full(n - k + 1, np.uint64(k))
        for i in range(k):
            total = mix(total * np.uint64(3) + words[i : n - k + 1 + i] * _SEEDS[i % 5] + np.uint64(i)) if i % 5 == 4 else total * _R + words[i : n - k + 1 + i] * _SEEDS[i % 5]
        return mix(total)
