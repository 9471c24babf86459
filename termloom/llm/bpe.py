"""Operator 7: byte-level BPE encoding and decoding of whole texts.

Pre-tokenisation uses no regex.  Code points become classes (one table lookup),
each class is a transition function on eight states, and since composing such
functions is associative, a blocked scan over numpy arrays gives the state
before every code point, hence every boundary.  The slices between boundaries
go through a cache of merged pairs; the slice offsets stay with the ids, so a
caller can map tokens back to the text.

Splitting follows the pattern of the public 50k byte-level vocabulary:
contractions after an apostrophe, letters, numbers and other signs with one
space before them, and white space of which the last character goes with what
follows.

Defined results: a null text counts as empty; an empty text has no tokens; rows
are encoded independently, so repeated ids or texts stay repeated; an empty
table gives an empty result; further columns are ignored.  Text length is
bounded only by memory for one text.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.codepoints import kinds
from termloom.llm.common import arrow_map, only

#: Code points a scan works on at once, and bytes that the merge cache may take.
CHUNK, CACHE = 1 << 18, 40_000_000
#: Bytes up to which pieces are merged together, round by round; what no rank reaches.
LONG, NEVER = 96, 1 << 40

# The White_Space property of Unicode.
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters that may follow an apostrophe as a token of their own.
ONE, TWO = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, OTHER, SPACE, HEAD, ALONE, APO1, APO2, RESET = range(9)
# States: inside letters, numbers, other signs or white space; after a space that goes with what follows; with one or two letters of a contraction to come; after a contraction or before a text.
IN_L, IN_N, IN_O, IN_W, TIED, ONE_MORE, TWO_MORE, FRESH = range(8)


def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for every code point."""
    table = kinds(LETTER, NUMBER, OTHER)
    table[WHITE] = SPACE
    return table


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class] and begins[state, class]: whether a token begins at that code point."""
    step, begins = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    for state in range(8):
        step[state] = [IN_L, IN_N, IN_O, IN_W, TIED, IN_W, ONE_MORE, TWO_MORE, FRESH]
    for cls, own in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O)):
        begins[[own, TIED], cls] = False
    begins[IN_W, SPACE] = False
    for cls in (APO1, APO2):  # inside other signs, or behind a tied space, an apostrophe is one of them
        step[[IN_O, TIED], cls] = IN_O
        begins[[IN_O, TIED], cls] = False
    step[TWO_MORE, LETTER], step[ONE_MORE, LETTER] = ONE_MORE, FRESH
    begins[[TWO_MORE, ONE_MORE], LETTER] = False
    return step, begins


class Scanner:
    """States before each position, by an associative scan over transition functions."""

    WIDTH = 64

    def __init__(self) -> None:
        self.step, self.begins = automaton()
        functions = [tuple(range(8)), *map(tuple, self.step.T.tolist())]
        known = {f: i for i, f in enumerate(dict.fromkeys(functions))}
        queue = list(known)
        while queue:  # close the set under composition; most members are constant, so it is small
            f = queue.pop()
            for g in list(known):
                for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                    if h not in known:
                        known[h] = len(known)
                        queue.append(h)
        self.values = np.array(list(known), dtype=np.uint8)
        n = len(known)
        self.compose = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], dtype=np.uint16 if n > 255 else np.uint8)
        self.of_class = np.array([known[tuple(f)] for f in self.step.T.tolist()], dtype=self.compose.dtype)

    def _prefixes(self, f: np.ndarray) -> np.ndarray:
        """The composition of all functions before each position."""
        n, width = len(f), self.WIDTH
        if n <= width:
            out, total = np.zeros(n, f.dtype), 0
            for i, x in enumerate(f.tolist()):
                out[i] = total
                total = int(self.compose[total, x])
            return out
        padded = np.zeros(-(-n // width) * width, f.dtype)
        padded[:n] = f
        columns = np.ascontiguousarray(padded.reshape(-1, width).T)
        total = columns[0]
        for row in columns[1:]:
            total = self.compose[total, row]
        at = self._prefixes(total)
        out = np.empty_like(columns)
        for j, row in enumerate(columns):
            out[j] = at
            at = self.compose[at, row]
        return out.T.reshape(-1)[:n]

    def starts(self, classes: np.ndarray) -> np.ndarray:
        before = self.values[self._prefixes(self.of_class[classes]), FRESH]
        return self.begins[before, classes]


class PairTable:
    """Id of the token that two adjacent tokens join into, for arrays of pairs: nested hash tables of fixed size."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        get, left, right, joined = ranks.get, [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        keys, values = self._key(np.array(left), np.array(right)), np.array(joined, dtype=np.int64)
        self.levels, shift, odd = [], 44, np.uint64(0x9E3779B97F4A7C15)
        while len(keys):
            slots = (keys * odd) >> np.uint64(shift)
            at, first = np.unique(slots, return_index=True)
            table = np.full(1 << (64 - shift), np.uint64(0xFFFFFFFFFFFFFFFF)), np.full(1 << (64 - shift), NEVER)
            table[0][at], table[1][at] = keys[first], values[first]
            self.levels.append((odd, np.uint64(shift), *table))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, shift, odd = keys[rest], values[rest], min(shift + 2, 52), np.uint64(int(odd) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        out = np.full(len(keys), NEVER)
        for odd, shift, known, values in self.levels:
            slots = (keys * odd) >> shift
            found = known[slots] == keys
            out[found] = values[slots[found]]
        return out


class Encoder:
    """ranks: token bytes to id.  The cache of merged pieces is bounded and may be passed on between tasks."""

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray) -> None:
        self.ranks, self.classes, self.scanner, self.pairs = ranks, classes, Scanner(), PairTable(ranks)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.cache: dict[str, bytes] = {}
        self.room = CACHE

    def boundaries(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the code point offsets where tokens' pieces begin, and its length at the end."""
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) < CHUNK):
                size += len(texts[j]) + 1
                j += 1
            points = np.frombuffer("\n".join([*texts[i:j], ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            ends = np.cumsum([len(t) + 1 for t in texts[i:j]]) - 1  # where the joining character of each text stands
            begins = self.scanner.starts(self._classified(points, ends))
            begins[ends] = True
            at = np.flatnonzero(begins)
            cut = np.searchsorted(at, ends)
            a = first = 0
            for end, b in zip(ends.tolist(), cut.tolist(), strict=True):
                yield at[a : b + 1] - first
                a, first = b + 1, end + 1
            i = j

    def _classified(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Classes that already know the next code points, so that the automaton need not look ahead."""
        base = self.classes[points]
        base[ends] = RESET
        out = base.copy()
        follows = np.zeros(len(base), bool)
        follows[:-1] = (base[1:] != SPACE) & (base[1:] != RESET)
        space = np.flatnonzero((base == SPACE) & follows)
        out[space] = np.where(points[space] == 32, HEAD, ALONE)
        apostrophe = np.flatnonzero(points == 39)
        if len(apostrophe):
            ahead = np.zeros(len(points) + 2, dtype=np.uint32)
            ahead[: len(points)] = points
            ahead[ends] = 0
            one, two = ahead[apostrophe + 1], ahead[apostrophe + 2]
            out[apostrophe[np.isin(one, [ord(c) for c in ONE])]] = APO1
            for a, b in TWO:
                out[apostrophe[(one == ord(a)) & (two == ord(b))]] = APO2
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces that the cache lacks into it."""
        if self.room < 0:
            self.cache.clear()
            self.room = CACHE
        short, get, cache = [], self.ranks.get, self.cache
        for piece in [p for p in pieces if p not in cache]:
            raw = piece.encode("utf-8", "surrogatepass")
            self.room -= len(raw) + 200
            if (own := get(raw)) is not None:
                cache[piece] = own.to_bytes(4, "little")
            elif len(raw) > LONG:
                cache[piece] = np.array(self._merged_long(raw), dtype="<u4").tobytes()
            else:
                short.append((piece, raw))
        for i in range(0, len(short), 8192):
            some = short[i : i + 8192]
            cache.update(zip([p for p, _ in some], self._merged([raw for _, raw in some]), strict=True))

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many pieces at once: in each round every piece joins its pair of least rank, the leftmost first."""
        ids = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        sizes = np.array([len(p) for p in pieces])
        own = np.repeat(np.arange(len(pieces)), sizes)
        out: list[bytes] = [b""] * len(pieces)

        def costs(at: np.ndarray) -> np.ndarray:
            cost = np.full(len(at), NEVER)
            inner = np.flatnonzero(at + 1 < len(ids))
            inner = inner[own[at[inner]] == own[at[inner] + 1]]
            cost[inner] = self.pairs.join(ids[at[inner]], ids[at[inner] + 1])
            return cost

        rank = costs(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            least = np.minimum.reduceat(rank, starts)
            done = least == NEVER
            if done.any():
                ends = np.r_[starts[1:], len(ids)]
                raw = ids.astype("<u4").tobytes()
                for piece, a, b in zip(own[starts[done]].tolist(), starts[done].tolist(), ends[done].tolist(), strict=True):
                    out[piece] = raw[4 * a : 4 * b]
                stay = np.repeat(~done, ends - starts)
                ids, own, rank, least = ids[stay], own[stay], rank[stay], least[~done]
                if not len(ids):
                    break
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            spread = np.repeat(least, np.diff(np.r_[starts, len(ids)]))
            at = np.flatnonzero(rank == spread)
            at = at[np.r_[True, own[at[1:]] != own[at[:-1]]]]
            ids[at] = least
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, own, rank = ids[stay], own[stay], rank[stay]
            at = at - np.arange(len(at))
            rank[at] = costs(at)
            prior = at[at > 0] - 1
            rank[prior] = costs(prior)
        return out

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same for long pieces, with a heap: n log n instead of n squared."""
        ranks = self.ranks
        n = len(piece)
        after = list(range(1, n + 1))  # where the part that starts here ends
        prior = list(range(-1, n - 1))  # where the part before this one starts
        alive = bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or after[j] != end:
                continue  # one of the two has been joined meanwhile
            after[i] = end
            alive[j] = 0
            if end < n:
                prior[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (p := prior[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        """(offsets of pieces, ids as little-endian unsigned 32-bit integers) of each text."""
        waiting, size = [], 0
        for text, at in zip(texts, self.boundaries(texts), strict=True):
            waiting.append((at, [text[a:b] for a, b in pairwise(at.tolist())]))
            size += len(text)
            if size > CHUNK:
                yield from self._ids(waiting)
                waiting, size = [], 0
        yield from self._ids(waiting)

    def _ids(self, waiting: list[tuple[np.ndarray, list[str]]]) -> Iterator[tuple[np.ndarray, bytes]]:
        self._learn(set().union(*(pieces for _, pieces in waiting)))
        get = self.cache.__getitem__
        for at, pieces in waiting:
            yield at, b"".join(map(get, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def encode_documents(docs: DataFrame, vocabulary: str, keep_ids: bool = True, keep_offsets: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (binary, little-endian unsigned 32-bit), piece_offsets.

    vocabulary: the path of a file of ranks, read on the driver and broadcast;
    its size is that of the vocabulary, whatever the corpus.  keep_ids and
    keep_offsets tell whether the last two columns are wanted.  Needs columns doc_id and text.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), code_point_classes()))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids + ", piece_offsets array<int>" * keep_offsets

    def make():
        content, classes = shared.value
        kept = sys.__dict__.setdefault("_termloom_encoders", {})  # a worker runs many tasks: its cache stays warm
        if (key := sha256(content).digest()) not in kept:
            kept.clear()
            kept[key] = Encoder(read_ranks(content), classes)
        encoder = kept[key]

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, hashes, decoded, ids, offsets = [], [], [], [], []
            for at, out in encoder.encode([x or "" for x in batch.column("text").to_pylist()]):
                n.append(len(out) // 4)
                hashes.append(sha256(out).hexdigest())
                decoded.append(sha256(encoder.decode(out)).hexdigest())
                if keep_ids:
                    ids.append(out)
                if keep_offsets:
                    offsets.append(at.astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashes), pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            if keep_offsets:
                columns.append(pa.array(offsets, pa.list_(pa.int32())))
                names.append("piece_offsets")
            return pa.RecordBatch.from_arrays(columns, names)

        return each

    return arrow_map(only(docs, "doc_id", "text"), make, schema)
