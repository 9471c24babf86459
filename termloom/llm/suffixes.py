"""Operator 12: removal of repeated byte strings, by a logarithmic family of suffix arrays.

A string is `size` consecutive UTF-8 bytes of one document.  Every byte under a
string that also starts anywhere else goes, its first occurrence included.

1. Each string is anchored at the run of SEED bytes in it with the least hash
   (the leftmost of equal ones).  Equal strings have equal anchors, so a document
   falls into segments of strings that start one after another and share one
   anchor's place.  Anchors that occur once in the corpus end there: their strings
   are unique.  The others are found by a filter of bits.
2. Equal segments (anchor and content) are counted before their bytes move.  An
   anchor with a single content is settled by that count.  An anchor with very
   many contents is cut finer: its strings are regrouped by where the anchor
   stands in them and by the bytes that all strings of such a group share, at last
   by single strings, which equal ones share whole, so no anchor's contents grow
   without bound in one task.
3. The different contents of an anchor meet in one shard.  They come in batches.
   A batch gets a suffix array (prefix doubling up to `size` bytes), is scanned
   in merge order against the levels that are there for matches of `size` bytes,
   and becomes a level; two levels of equal rank merge into one of the next, so
   each string takes part in as many merges as there are ranks.
4. Each occurrence of a segment learns which of its strings start elsewhere, and
   each document loses the bytes under them.

Defined results: a null text counts as empty; an empty or short text loses
nothing; rows that repeat doc_id and text are places of their own, so they lose
all that they share, and get equal results; rows that share a doc_id only are
told apart by a hash of the text; a null doc_id is an id like others; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.bitfilter import bit_filter
from termloom.llm.common import arrow_map, discard, materialise, tidied
from termloom.llm.wordhash import mix

#: Bytes of an anchor, and bytes that are hashed at once.
SEED, CHUNK = 64, 1 << 20
#: Contents of one anchor from which it is cut finer, and strings of a segment then.
SPLIT, FINER = 4000, (12, 1)
#: How much wider than others the filter of anchors to be cut is.
HOT_BITS = 16
#: Bytes of a batch, and bytes of a family of levels from which the next anchor begins a new one.
BATCH, FAMILY = 1 << 18, 1 << 23
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base, powers of its inverse, and a random number for each byte."""
    n = CHUNK + 1
    up, down = np.full(n, np.uint64(_BASE)), np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Hashes:
    """Hashes of any stretches of some bytes, off a running sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down, value = _powers()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def runs(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def least_in_windows(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each w keys in a row: block by block from both ends, then one comparison."""
    n = len(key) - w + 1
    held = np.full(-(-len(key) // w) * w, np.iinfo(key.dtype).max)
    held[: len(key)] = key
    held = held.reshape(-1, w)
    ahead = np.minimum.accumulate(held, axis=1).reshape(-1)
    back = np.minimum.accumulate(held[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchored(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(row, first string, strings, bytes from there to the anchor, anchor's hash, hash of the content) of each segment.

    offsets: where each row begins in data, and the end; places count from the row's begin.
    """
    seed = min(SEED, size)
    if len(data) < size:
        return tuple(np.zeros(0, kind) for kind in (np.int64,) * 4 + (np.uint64,) * 2)
    hashes = Hashes(data)
    seeds = hashes.runs(seed)
    at = (least_in_windows(seeds & ~_PLACE | np.arange(len(seeds), dtype=np.uint64), size - seed + 1) & _PLACE).astype(np.int64)
    n = len(at)
    edge = np.zeros(n + 1, np.int64)  # strings that would cross the end of a row are none
    ends = offsets[1:]
    np.add.at(edge, np.minimum(np.maximum(offsets[:-1], ends - size + 1), n), 1)
    np.add.at(edge, np.minimum(ends, n), -1)
    valid = np.cumsum(edge[:n]) == 0
    change = np.ones(n + 1, bool)
    change[1:n] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
    bounds = np.flatnonzero(change)
    first, end = bounds[:-1], bounds[1:]
    keep = valid[first]
    first, end = first[keep], end[keep]
    row = np.searchsorted(offsets, first, side="right") - 1
    return row, first - offsets[row], end - first, at[first] - first, seeds[at[first]], hashes.of(first, end + size - 1)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each row begins; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, raw, body = column.buffers()
    offsets = np.frombuffer(raw, np.int64, len(column) + 1 + column.offset)[column.offset :]
    return np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8), offsets


def segments_of(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """anchored() for runs of rows; a very long text goes in pieces that overlap by a string but one byte."""
    data, offsets = texts_of(column)
    i, n = 0, len(column)
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1), n)
        a, b = int(offsets[i]), int(offsets[j])
        for start in range(a, max(a + 1, b - size + 1), CHUNK - size + 1):
            end = min(b, start + CHUNK)
            own = offsets[i : j + 1] - a if j > i + 1 else np.array([0, end - start])
            row, first, *rest = anchored(data[start:end], own, size)
            yield row + i, first + (start - a), *rest
        i = j


def suffix_array(text: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of the strings at starts: by prefix doubling, ranks of 8 bytes give those of 16, and so on up to size."""
    lanes = lanes_of(text)
    width = min(8, size)
    rank = np.unique(lanes[: len(text)].byteswap() >> np.uint64(64 - 8 * width), return_inverse=True)[1]
    while width < size:
        step = min(width, size - width)
        last = width + step == size
        at = starts if last else np.arange(len(text))
        rank = np.unique(rank[at] * np.int64(len(text) + 1) + rank[np.minimum(at + step, len(text) - 1)], return_inverse=True)[1]
        if last:
            break
        width += step
    else:
        rank = np.unique(rank[starts], return_inverse=True)[1]
    return np.argsort(rank, kind="stable"), rank


def lanes_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number."""
    return np.ndarray((len(text) + 1,), np.uint64, text.tobytes() + bytes(8), strides=(1,))


class Level:
    """Different strings of `size` bytes in order: their places in a text, and a number of each."""

    def __init__(self, text: np.ndarray, at: np.ndarray, number: np.ndarray, size: int, rank: int = 0) -> None:
        self.text, self.at, self.number, self.size, self.rank = text, at, number, size, rank
        self.lanes = lanes_of(text)
        self.words = self.word(at, 0)

    def word(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Up to eight bytes of strings from depth on, as a number that sorts as they do."""
        left = min(8, self.size - depth)
        return self.lanes[at + depth].byteswap() >> np.uint64(64 - 8 * left)

    def _bisect(self, depth: int, low: np.ndarray, high: np.ndarray, key: np.ndarray, after: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while len(some := np.flatnonzero(low < high)):
            middle = (low[some] + high[some]) >> 1
            held = self.word(self.at[middle], depth)
            less = held <= key[some] if after else held < key[some]
            low[some] = np.where(less, middle + 1, low[some])
            high[some] = np.where(less, high[some], middle)
        return low

    def scanned(self, other: Level) -> tuple[np.ndarray, np.ndarray]:
        """For each string of other its place in this order, and whether this level holds it: in merge order, eight bytes after eight."""
        low, high = np.searchsorted(self.words, other.words, "left"), np.searchsorted(self.words, other.words, "right")
        active = np.flatnonzero(low < high)
        for depth in range(8, self.size, 8):
            if not len(active):
                break
            key = other.word(other.at[active], depth)
            a = self._bisect(depth, low[active], high[active], key, False)
            b = self._bisect(depth, a, high[active], key, True)
            low[active], high[active] = a, b
            active = active[a < b]
        return low, low < high

    def without(self, gone: np.ndarray) -> Level:
        return Level(self.text, self.at[~gone], self.number[~gone], self.size, self.rank) if gone.any() else self

    def merged(self, other: Level) -> Level:
        """Both, which share no string, as one of the next rank."""
        place, _ = self.scanned(other)
        at = np.insert(self.at, place, other.at + len(self.text))
        return Level(np.concatenate((self.text, other.text)), at, np.insert(self.number, place, other.number), self.size, max(self.rank, other.rank) + 1)


class Family:
    """Levels of geometric sizes that batches of contents are scanned against and join."""

    def __init__(self, size: int) -> None:
        self.size, self.levels = size, []
        self.repeated: list[np.ndarray] = []  # for each batch, of each string whether it starts elsewhere
        self.strings = 0

    def add(self, contents: list[bytes]) -> None:
        """A batch; strings are numbered in the order in which they come."""
        lengths = np.array([len(c) for c in contents], np.int64)
        strings = lengths - self.size + 1
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        first = np.concatenate(([0], np.cumsum(strings)[:-1]))
        text = np.frombuffer(b"".join(contents), np.uint8)
        starts = np.arange(int(strings.sum())) + np.repeat(begin - first, strings)
        order, rank = suffix_array(text, starts, self.size)
        often = np.bincount(rank) > 1
        self.repeated.append(often[rank])
        one = order[np.concatenate(([True], rank[order[1:]] != rank[order[:-1]]))]
        level = Level(text, starts[one], one + self.strings, self.size)
        self.strings += len(starts)
        marks = np.concatenate(self.repeated)
        for held in self.levels:
            place, found = held.scanned(level)
            marks[level.number[found]] = True
            marks[held.number[place[found]]] = True
            level = level.without(found)
        self.repeated = [marks]
        while self.levels and self.levels[-1].rank <= level.rank:
            level = self.levels.pop().merged(level)
        self.levels.append(level)


SEGMENTS = "doc_id long, t long, starts array<int>, strings array<int>, leads array<int>, seeds array<long>, contents array<long>"
_KINDS = [pa.list_(pa.int32())] * 3 + [pa.list_(pa.int64())] * 2


def _lists(batch: pa.RecordBatch, found: list[tuple[np.ndarray, ...]], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch | None:
    """Arrays (row, values, ...) in the order of rows as a list for each row that has any, beside its doc_id and t."""
    row, *values = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),)
    if not len(row):
        return None
    order = np.argsort(row, kind="stable")
    row, values = row[order], [v[order] for v in values]
    rows, at = np.unique(row, return_index=True)
    offsets = pa.array(np.append(at, len(row)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v.view(np.int64) if v.dtype == np.uint64 else v).cast(k.value_type)) for v, k in zip(values, kinds, strict=True)]
    keep = pa.array(rows)
    return pa.RecordBatch.from_arrays([batch.column("doc_id").take(keep), batch.column("t").take(keep), *lists], [c.split()[0] for c in schema.split(", ")])


def _cut(data: np.ndarray, offsets: np.ndarray, part: tuple[np.ndarray, ...], width: int, size: int) -> tuple[np.ndarray, ...]:
    """Segments cut so that the anchor's distance from a string's start falls into one stretch of `width`.

    Strings of a piece share the bytes from the last one's start to the first
    one's end, so those, with the stretch, are the piece's new anchor.
    """
    row, start, strings, lead, seed, _ = part
    # the string at start + k has its anchor lead - k bytes in; stretches are those of equal (lead - k) // width
    low, high = (lead - strings + 1) // width, lead // width
    own = np.repeat(np.arange(len(row)), high - low + 1)
    stretch = np.arange(len(own)) - np.repeat(np.cumsum(high - low + 1) - high - 1, high - low + 1)
    most, least = np.minimum(lead[own], stretch * width + width - 1), np.maximum(lead[own] - strings[own] + 1, stretch * width)
    first, n = start[own] + lead[own] - most, most - least + 1
    # the widest piece that any segment can have here, whatever its own length
    ahead = start[own] + lead[own] - stretch * width
    base = offsets[row[own]]
    anchors, contents = np.zeros(len(own), np.uint64), np.zeros(len(own), np.uint64)
    for j, (a, b, c, d, x, s) in enumerate(zip(*(v.tolist() for v in (base + ahead, base + ahead - width + 1 + size, base + first, base + first + n + size - 1, stretch, seed[own])), strict=True)):
        anchors[j] = _digest(data[a:b].tobytes() + x.to_bytes(2, "little") + s.to_bytes(8, "little"))
        contents[j] = _digest(data[c:d].tobytes())
    return row[own], first, n, ahead - first, anchors, contents


def _segments(docs: DataFrame, size: int, shared: Broadcast, cuts: tuple[tuple[int, Broadcast], ...] = ()) -> DataFrame:
    """Of each document the segments whose anchor may recur; those of the anchors that a filter of `cuts` holds are cut to its width.

    Pieces meet the next filter.  All segments of an anchor are cut or none, so
    what a filter lets through in error is only cut finer.
    """

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            data, offsets = texts_of(batch.column("text"))
            found = []
            for part in segments_of(batch.column("text"), size):
                hit = shared.value.holds(part[4])
                part = tuple(x[hit] for x in part)
                for width, often in cuts:
                    hot = often.value.holds(part[4])
                    found.append(tuple(x[~hot] for x in part))
                    part = _cut(data, offsets, tuple(x[hot] for x in part), width, size)
                found.append(part)
            return _lists(batch, found, SEGMENTS, _KINDS)

        return each

    return arrow_map(docs, make, SEGMENTS)


def _recurring(docs: DataFrame, size: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in segments_of(batch.column(0), size):
                yield pa.RecordBatch.from_arrays([pa.array(part[4].view(np.int64))], ["seed"])

    again = docs.select("text").mapInArrow(tidied(anchors), "seed long").groupBy("seed").count().where("count > 1").select("seed")
    again = materialise(again, "anchors")
    held = bit_filter(again, again.count())
    discard(again)
    return held


def _placed(rows: DataFrame) -> DataFrame:
    """A row for each segment: doc_id, t, start, strings, lead, seed, content."""
    names = {"starts": "start", "strings": "strings", "leads": "lead", "seeds": "seed", "contents": "content"}
    each = rows.select("doc_id", "t", F.explode(F.arrays_zip(*names)).alias("s"))
    return each.select("doc_id", "t", *[F.col(f"s.{a}").alias(b) for a, b in names.items()])


def _with_texts(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """docs with the column `spots` of (d, h, spots), for documents that have any."""
    return docs.join(spots, docs["doc_id"].eqNullSafe(spots["d"]) & (docs["t"] == spots["h"])).select("doc_id", "t", "text", "spots")


def _digest(held: bytes) -> int:
    return int.from_bytes(sha256(held).digest()[:8], "little")


def _contents(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seed, content, n, strings and one occurrence of each content; seed and its number of contents)."""
    spot = [F.first(c).alias(c) for c in ("doc_id", "t", "start")]  # of one row, whichever it is
    different = materialise(places.groupBy("seed", "content").agg(F.count(F.lit(1)).alias("n"), F.max("strings").alias("strings"), *spot), "contents")
    # written too: then a join deals both sides out and may split an anchor that has many
    return different, materialise(different.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds")), "anchor-kinds")


def _bytes_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """seed, content, n and the bytes of wanted contents, read at one occurrence of each."""
    spot = F.struct("seed", "content", "n", "start", "strings")
    spots = wanted.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("h")).agg(F.collect_list(spot).alias("spots"))  # at most the segments of one document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            ids, ts = batch.column("doc_id").to_pylist(), batch.column("t").to_pylist()
            for i, spots in enumerate(batch.column("spots").to_pylist()):
                if (ids[i], ts[i]) in seen:
                    continue  # a repeated row
                seen.add((ids[i], ts[i]))
                body = data[int(offsets[i]) : int(offsets[i + 1])].tobytes()
                for k in range(0, len(spots), 5000):
                    rows = [(s["seed"], s["content"], s["n"], body[s["start"] : s["start"] + s["strings"] + size - 1]) for s in spots[k : k + 5000]]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["seed", "content", "n", "bytes"])

    return _with_texts(docs, spots).mapInArrow(tidied(run), "seed long, content long, n long, bytes binary")


FOUND = "seed long, content long, offsets array<int>, lengths array<int>"


def _scanned(contents: DataFrame, size: int) -> DataFrame:
    """Of each content the stretches of strings that start elsewhere: an anchor's contents go through one family of suffix arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, keys, waiting = Family(size), [], []  # keys: seed, content, n and strings of what the family holds
        held = queued = 0
        last = None

        def flush():
            nonlocal waiting, queued
            if waiting:
                family.add(waiting)
            waiting, queued = [], 0

        def finish():
            flush()
            marks, rows, at = family.repeated[0] if family.repeated else np.zeros(0, bool), [], 0
            for seed, content, n, strings in keys:
                own = marks[at : at + strings] | (n > 1)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
                at += strings
                if len(edge):
                    rows.append((seed, content, edge[::2], edge[1::2] - edge[::2]))
            for a in range(0, len(rows), 5000):
                seeds, found, offsets, lengths = zip(*rows[a : a + 5000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds, pa.int64()), pa.array(found, pa.int64()), *[pa.array(list(x), pa.list_(pa.int64())).cast(pa.list_(pa.int32())) for x in (offsets, lengths)]], ["seed", "content", "offsets", "lengths"])

        for batch in batches:
            for seed, content, n, body in zip(*[batch.column(c).to_pylist() for c in ("seed", "content", "n", "bytes")], strict=True):
                if seed != last and held > FAMILY:
                    yield from finish()
                    family, keys, held = Family(size), [], 0
                last = seed
                keys.append((seed, content, n, len(body) - size + 1))
                waiting.append(body)
                held, queued = held + len(body), queued + len(body)
                if queued >= BATCH:
                    flush()
        yield from finish()

    return contents.repartition("seed").sortWithinPartitions("seed").mapInArrow(tidied(run), FOUND)


def repeated_strings(docs: DataFrame, size: int = 200) -> DataFrame:
    """doc_id, t (hash of the text), at, length: stretches of strings of `size` bytes that also start elsewhere.

    Rows that repeat a document give one set of stretches.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    shared = context.broadcast(_recurring(docs, size))  # 2**MOST bits at most
    segments, cuts = materialise(_segments(docs, size, shared), "segments"), []
    different, kinds = _contents(_placed(segments))
    for width in FINER:
        hot = materialise(kinds.where(F.col("kinds") > SPLIT).select("seed"), "hot-anchors")
        if hot.isEmpty():
            break
        # cut where the texts are read, so none is dealt out for it; a filter of 2**MOST bits at most
        cuts.append((width, context.broadcast(bit_filter(hot, HOT_BITS * hot.count()))))
        discard(segments, different, kinds, hot)
        segments = materialise(_segments(docs, size, shared, tuple(cuts)), "segments")
        different, kinds = _contents(_placed(segments))
    places = _placed(segments)
    joined = different.join(kinds, "seed")
    alone = joined.where("kinds = 1 and n > 1").select("seed", "content", F.array(F.lit(0)).alias("offsets"), F.array("strings").alias("lengths"))
    among = _scanned(_bytes_of(docs, joined.where("kinds > 1"), size), size)
    found = materialise(alone.unionByName(among), "repeats")
    discard(different, kinds)
    each = places.join(found, ["seed", "content"]).select("doc_id", "t", "start", F.explode(F.arrays_zip("offsets", "lengths")).alias("w"))
    return each.select("doc_id", "t", (F.col("start") + F.col("w.offsets")).alias("at"), F.col("w.lengths").alias("length")).groupBy("doc_id", "t", "at").agg(F.max("length").alias("length"))


def remove_strings(docs: DataFrame, size: int = 200, keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with keep_text kept bytes and spans."""
    if size < 9:
        raise ValueError("strings of less than 9 bytes have no anchor worth the name")
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    gone = repeated_strings(docs, size).groupBy(F.col("doc_id").alias("d"), F.col("t").alias("h")).agg(F.collect_list(F.struct("at", "length")).alias("runs"))
    joined = rows.join(gone, rows["doc_id"].eqNullSafe(gone["d"]) & (rows["t"] == gone["h"]), "left").select("doc_id", "text", "runs")

    def make():
        def cut(body: bytes, runs: list[dict] | None) -> tuple[bytes, list[dict]]:
            if not runs:
                return body, []
            at, length = (np.array([r[c] for r in runs], np.int64) for c in ("at", "length"))
            order = np.argsort(at)
            start, end = at[order], np.maximum.accumulate((at + length + size - 1)[order])
            new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
            first, last = start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist()
            kept = [body[a:b] for a, b in zip([0, *last], [*first, len(body)], strict=True)]
            return b"".join(kept), [{"start": a, "end": b} for a, b in zip(first, last, strict=True)]

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            bodies = batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
            done = [cut(b, r) for b, r in zip(bodies, batch.column("runs").to_pylist(), strict=True)]
            kept, spans = [k for k, _ in done], [s for _, s in done]
            n, left = np.array([len(b) for b in bodies], np.int64), np.array([len(k) for k in kept], np.int64)
            columns = [batch.column("doc_id"), pa.array(n), pa.array(n - left), pa.array([len(s) for s in spans], pa.int64()), pa.array([sha256(k).hexdigest() for k in kept], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:  # what is left may end inside a code point
                columns += [pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                names += ["kept", "spans"]
            return pa.RecordBatch.from_arrays(columns, names)

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(joined, make, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start:bigint,end:bigint>>" * keep_text)
