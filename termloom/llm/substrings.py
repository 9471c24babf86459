"""Operator 8: removal of repeated word sequences, by an FM-index per shard.

A window is `size` consecutive words of one document.  A word goes if a window
over it has the same words as one that starts earlier.

1. Every window is anchored at the rarest of its runs of SEED words (by a sketch
   of fixed size over all documents, then by hash; the leftmost of equal ones).
   Equal windows have equal anchors, and neighbouring windows mostly share one,
   so a document falls into segments of consecutive windows with one anchor.
2. Anchors that occur once in the corpus end there: their windows are unique.
   The others are found by a filter of bits; what it lets through in error is
   only more work.
3. Equal segments collapse to one, with its first occurrence and its number.
   Segments that recur, and all of an anchor that has several, are dealt to
   shards by the anchor.  A shard builds a compressed FM-index over them (wavelet
   tree over the Burrows-Wheeler transform, run bits, the earliest place of each
   run) and documents' segments are streamed through it: backward search, a step
   a word, gives the matching statistic of every position, and where it reaches
   `size` the interval's run tells the earliest start.  An anchor with very many
   segments is split into blocks, each with an index of its own through which
   the segments of all its blocks are streamed.
4. Each occurrence of a segment learns which of its windows started earlier
   elsewhere, and each document loses the words under them.

Equal segments are counted before the shuffle, so a passage that a third of all
documents share is one entry of a shard; and because anchors are rare runs, a
window that crosses the edge of such a passage is anchored outside it.

Defined results: a null or wordless text has no words and the hash of no bytes;
rows that repeat doc_id and text count as one document and get the same result;
rows that share a doc_id only are ordered by a hash of the text; a null doc_id
comes after all others; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from termloom.llm.common import arrow_map, materialise, tidied
from termloom.llm.fmindex import FMIndex
from termloom.llm.sketch import rarest_first, sketch
from termloom.llm.wordhash import WordHasher, mix, shingles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Words of an anchor; words of one index at most, if its anchors allow.
SEED, INDEX = 5, 600_000
#: Segments of one anchor from which it is dealt into blocks, and segments that are streamed at once.
SPLIT, STREAMED = 8000, 8000
#: Bits of the filter for each recurring anchor, and its least and greatest size as powers of two.
BITS_EACH, LEAST_BITS, MOST_BITS, BLOCK = 8, 20, 28, 4096


def anchored(words: np.ndarray, size: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor's hash) of each segment of one document."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = shingles(words, SEED)
    key = rarest_first(seeds, cells)
    at, have, want = np.arange(len(seeds)), 1, size - SEED + 1
    while have < want:  # the leftmost least key of ever longer runs
        step = min(have, want - have)
        a, b = at[: len(at) - step], at[step:]
        at, have = np.where(key[a] <= key[b], a, b), have + step
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return first, np.diff(np.append(first, n)), seeds[at[first]]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text")


def recurring(docs: DataFrame, size: int, shared) -> tuple[np.ndarray, int]:
    """The filter of anchors that occur more than once, as bits, and its size as a power of two."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, cells = WordHasher(), shared.value
        for batch in batches:
            out = [anchored(words, size, cells)[2] for _, words in hasher.texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], ["seed"])

    again = docs.select("text").mapInArrow(tidied(anchors), "seed long").groupBy("seed").count().where("count > 1").select("seed")
    again = materialise(again, "anchors")
    power = min(MOST_BITS, max(LEAST_BITS, int(again.count() * BITS_EACH).bit_length()))

    def emit(rows: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = sorted(rows)
        for a in range(0, len(keys), 256):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + 256], pa.int32()), pa.array([np.packbits(rows[k]).tobytes() for k in keys[a : a + 256]], pa.binary())], ["row", "bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        bits = np.zeros(1 << power, bool)
        for batch in batches:
            bits[(np.asarray(batch.column(0)).view(np.uint64) >> np.uint64(64 - power)).astype(np.int64)] = True
        table = bits.reshape(-1, BLOCK)
        for i in np.flatnonzero(table.any(axis=1)).tolist():
            rows[i] = table[i]
        yield from emit(rows)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
                rows[row] = rows[row] | own if row in rows else own
        yield from emit(rows)

    out = np.zeros(((1 << power) // BLOCK, BLOCK // 8), np.uint8)
    for r in again.mapInArrow(tidied(mark), "row int, bits binary").repartition("row").mapInArrow(tidied(merge), "row int, bits binary").toLocalIterator():
        out[r["row"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1), power


SEGMENTS = "doc_id long, t long, starts array<int>, windows array<int>, seeds array<long>, contents array<long>"


def content_hashes(words: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each first to its end."""
    held = memoryview(words.tobytes())
    return np.array([xxh3_64_intdigest(held[8 * a : 8 * b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)], np.uint64)


def _segments(docs: DataFrame, size: int, shared, bits) -> DataFrame:
    """For each document the segments whose anchor may recur: starts, numbers of windows, anchors, hashes of content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, cells, (table, power) = WordHasher(), shared.value, bits.value
        for batch in batches:
            rows, out = [], []
            for i, words in hasher.texts(batch.column("text")):
                first, windows, seeds = anchored(words, size, cells)
                at = (seeds >> np.uint64(64 - power)).astype(np.int64)
                hit = np.flatnonzero(table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
                if len(hit):
                    first, windows = first[hit], windows[hit]
                    out.append((first.astype(np.int32), windows.astype(np.int32), seeds[hit].view(np.int64), content_hashes(words, first, first + windows + size - 1).view(np.int64)))
                    rows.append(i)
            if rows:
                kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 2
                keep = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(keep), batch.column("t").take(keep), *[pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], [c.split()[0] for c in SEGMENTS.split(", ")])

    return docs.mapInArrow(tidied(run), SEGMENTS)


def _words_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The words of wanted segments (seed, content, n, windows and first occurrence), read at that occurrence."""
    spots = wanted.select(F.col("first.d").alias("d"), F.col("first.t").alias("h"), F.struct("seed", "content", "n", "windows", "parts", F.col("first.s").alias("s")).alias("x")).groupBy("d", "h").agg(F.collect_list("x").alias("spots"))  # at most the segments of one document
    once = docs.join(spots, docs["doc_id"].eqNullSafe(spots["d"]) & (docs["t"] == spots["h"])).select("doc_id", "t", "text", "spots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = WordHasher(), set()
        for batch in batches:
            ids, ts = batch.column("doc_id").to_pylist(), batch.column("t").to_pylist()
            spots, out = batch.column("spots").to_pylist(), []
            for i, words in hasher.texts(batch.column("text")):
                if (ids[i], ts[i]) in seen:
                    continue  # a repeated row
                seen.add((ids[i], ts[i]))
                out += [(x["seed"], x["content"], words[x["s"] : x["s"] + x["windows"] + size - 1].tobytes(), ids[i], ts[i], x["s"], x["n"], x["parts"]) for x in spots[i]]
                if len(out) > 5000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["seed", "content", "words", "doc_id", "t", "first", "n", "parts"])

    return once.mapInArrow(tidied(run), "seed long, content long, words binary, doc_id long, t long, first int, n long, parts long")


RESULTS = "seed long, content long, offsets array<int>, lengths array<int>, docs array<long>, ts array<long>, places array<int>"
_KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]


class Shard:
    """An FM-index over segments (seed, content, words, doc_id, t, first, n), through which segments are streamed."""

    def __init__(self, parts: list[tuple], size: int) -> None:
        self.size = size
        arrays = [np.frombuffer(p[2], np.uint64) for p in parts]
        self.vocabulary, symbols = np.unique(np.concatenate(arrays), return_inverse=True)
        self.text, self.begin, self.lengths = self._joined(symbols + 1, [len(a) for a in arrays])
        # places in the order of the corpus: document, then word
        keys = [(p[3] is None, p[3] or 0, p[4]) for p in parts]
        self.documents = sorted(set(keys))
        rank = {k: i for i, k in enumerate(self.documents)}
        code = np.array([(rank[k] << 32) + p[5] for k, p in zip(keys, parts, strict=True)], np.int64)
        owner = np.repeat(np.arange(len(parts)), self.lengths + 1)
        offset = np.arange(len(self.text)) - self.begin[owner]
        window = offset + size <= self.lengths[owner]
        value = np.where(window, code[owner] + offset, np.iinfo(np.int64).max)
        weight = np.where(window, np.array([p[6] for p in parts], np.int64)[owner], 0)
        self.index = FMIndex(self.text, len(self.vocabulary) + 1, int(self.lengths.max()) + 1, size, value, weight)

    @staticmethod
    def _joined(symbols: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts one after another, a 0 behind each; where they begin, and their lengths."""
        lengths = np.array(lengths, np.int64)
        text = np.zeros(len(symbols) + len(lengths), np.int64)
        text[np.arange(len(symbols)) + np.repeat(np.arange(len(lengths)), lengths)] = symbols
        return text, np.concatenate(([0], np.cumsum(lengths + 1)[:-1])), lengths

    def stream(self, parts: list[tuple] | None = None) -> list[tuple]:
        """For each segment (the shard's own, or others) its windows that the index holds, in stretches, with their earliest places there.

        Of own segments only windows that occur more than once count.
        """
        if parts is None:
            text, begin, lengths = self.text, self.begin, self.lengths
        else:
            arrays = [np.frombuffer(p[2], np.uint64) for p in parts]
            words = np.concatenate(arrays)
            at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
            symbols = np.where(self.vocabulary[at] == words, at + 1, -1)
            text, begin, lengths = self._joined(symbols, [len(a) for a in arrays])
        part, offset, run = self.index.windows(text, begin, lengths)
        if parts is None:
            often = self.index.total[run] > 1
            part, offset, run = part[often], offset[often], run[often]
        if not len(part):
            return []
        order = np.lexsort((offset, part))
        part, offset, place = part[order], offset[order], self.index.least[run[order]]
        new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (offset[1:] != offset[:-1] + 1) | (place[1:] != place[:-1] + 1))))
        length = np.diff(np.append(new, len(part)))
        return list(zip(part[new].tolist(), offset[new].tolist(), length.tolist(), (place[new] >> 32).tolist(), (place[new] & 0xFFFFFFFF).tolist(), strict=True))

    def results(self, parts: list[tuple], own: bool) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[list]] = {}
        for p, offset, length, document, place in self.stream(None if own else parts):
            late, doc, t = self.documents[document]
            row = rows.setdefault(p, [[], [], [], [], []])
            for held, x in zip(row, (offset, length, None if late else doc, t, place), strict=True):
                held.append(x)
        if rows:
            out = [(parts[p][0], parts[p][1], *row) for p, row in rows.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)], [c.split()[0] for c in RESULTS.split(", ")])


def _indexed(segments: DataFrame, size: int) -> DataFrame:
    """Segments (seed, parts, ...) streamed through the indexes of their anchors.

    An anchor of few segments shares an index with others, and its segments are
    streamed through the index they are in.  The segments of an anchor with very
    many are dealt into `parts` blocks, and each block is streamed through the
    index of each, every pair of blocks in a task of its own.
    """
    part = F.pmod(F.xxhash64("content"), F.col("parts")).cast("int")
    turn = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    every = F.sequence(F.lit(0), F.col("parts").cast("int") - 1)
    many = F.concat(F.transform(every, lambda j: turn(F.col("part"), j, 0)), F.transform(every, lambda i: turn(i, F.col("part"), 1)))
    turns = F.when(F.col("parts") > 1, many).otherwise(F.array(turn(F.lit(0), F.lit(0), 2)))
    names = ["seed", "content", "words", "doc_id", "t", "first", "n"]
    dealt = segments.withColumn("part", part).select(*names, F.explode(turns).alias("x")).select(*names, "x.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of whole anchors, or the index side of one pair of blocks
        passing: list[tuple] = []
        words, last, pair, shard = 0, None, None, None

        def finish():
            if pair is None:
                if held:
                    yield from Shard(held, size).results(held, own=True)
            elif passing:
                yield from (shard or Shard(held, size)).results(passing, own=False)

        for batch in batches:
            for *row, i, j, side in zip(*[batch.column(c).to_pylist() for c in (*names, "i", "j", "side")], strict=True):
                key = None if side == 2 else (row[0], i, j)
                if key != pair or (key is None and row[0] != last and words > INDEX):
                    yield from finish()
                    held, passing, shard, words, pair = [], [], None, 0, key
                last = row[0]
                if side == 1:
                    passing.append(tuple(row))
                    if len(passing) >= STREAMED:
                        shard = shard or Shard(held, size)
                        yield from shard.results(passing, own=False)
                        passing = []
                else:
                    held.append(tuple(row))
                    words += len(row[2]) // 8
        yield from finish()

    keys = ["seed", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(tidied(run), RESULTS)


def remove_repeats(docs: DataFrame, size: int = 20, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with keep_text the kept words as text and removed windows' starts."""
    docs = _documents(docs)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(sketch(docs, SEED, lower=False))  # 2**CELLS counts, whatever the corpus
    bits = context.broadcast(recurring(docs, size, shared))  # 2**MOST_BITS bits at most
    rows = materialise(_segments(docs, size, shared, bits), "segments")
    places = rows.select("doc_id", "t", F.explode(F.arrays_zip("starts", "windows", "seeds", "contents")).alias("s")).select("doc_id", "t", F.col("s.starts").alias("start"), F.col("s.windows").alias("windows"), F.col("s.seeds").alias("seed"), F.col("s.contents").alias("content"))
    spot = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("d"), F.col("t").alias("t"), F.col("start").alias("s"))
    different = places.groupBy("seed", "content").agg(F.min(spot).alias("first"), F.count(F.lit(1)).alias("n"), F.max("windows").alias("windows"))
    different = materialise(different, "contents")
    # written first: then the join deals both sides out and may split an anchor that has very many
    per_seed = materialise(different.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds")), "anchor-kinds")
    marked = different.join(per_seed, "seed").where("kinds > 1 or n > 1").withColumn("parts", F.ceil(F.col("kinds") / SPLIT))
    results = materialise(_indexed(_words_of(docs, marked, size), size), "matches")
    each = F.arrays_zip("offsets", "lengths", "docs", "ts", "places")
    order = lambda doc, t, at: F.struct(doc.isNull().alias("late"), F.coalesce(doc, F.lit(0)).alias("d"), t.alias("t"), at.alias("at"))
    own = lambda w: order(F.col("doc_id"), F.col("t"), F.col("start") + w["offsets"])
    later = F.filter(each, lambda w: order(w["docs"], w["ts"], w["places"]) < own(w))
    gone = places.join(results, ["seed", "content"]).select("doc_id", "t", "start", F.explode(later).alias("w")).select("doc_id", "t", (F.col("start") + F.col("w.offsets")).alias("at"), F.col("w.lengths").alias("length"))
    # rows that repeat a document say the same, so what is collected is one document's stretches
    gone = gone.groupBy("doc_id", "t", "at").agg(F.max("length").alias("length")).groupBy("doc_id", "t").agg(F.collect_list(F.struct("at", "length")).alias("windows"))
    gone = gone.select(F.col("doc_id").alias("d"), F.col("t").alias("h"), "windows")
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["d"]) & (docs["t"] == gone["h"]), "left").select("doc_id", "text", "windows")

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, removed, hashes, kept, starts = [], [], [], [], []
            for text, windows in zip(batch.column("text").to_pylist(), batch.column("windows").to_pylist(), strict=True):
                words = WORDS.findall(text or "")
                cut = np.zeros(len(words) + 1, np.int64)
                if windows:
                    at, length = (np.array([w[c] for w in windows]) for c in ("at", "length"))
                    np.add.at(cut, at, 1)
                    np.add.at(cut, at + length + size - 1, -1)
                keep = np.cumsum(cut)[:-1] == 0
                left = " ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k] if windows else words)
                n.append(len(words))
                removed.append(len(words) - int(keep.sum()))
                hashes.append(sha256(left.encode("utf-8", "surrogatepass")).hexdigest())
                kept.append(left)
                starts.append(sorted({i for w in windows or [] for i in range(w["at"], w["at"] + w["length"])}) if keep_text else None)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns += [pa.array(kept, pa.string()), pa.array(starts, pa.list_(pa.int32()))]
                names += ["kept", "windows"]
            return pa.RecordBatch.from_arrays(columns, names)

        return each

    return arrow_map(joined, make, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string, windows array<int>" * keep_text)
