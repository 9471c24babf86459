"""Operator 13: phrases whose words belong together, from position bitmaps.

Texts fall into pieces, pieces into words; a phrase is a run of 2 to `longest`
words of one piece, counted in each language apart.

1. Words are counted over the corpus; those of at least `least` occurrences go on,
   as a filter of bits, and so do the phrases of each length after that: every part
   of a phrase is at least as frequent as the phrase.
2. A shard is about SHARD words of a task's texts.  Every word has a compressed
   bitmap of its positions there: blocks of 64 positions, those without the word
   left out.  Between pieces one position stays empty.  A phrase's bitmap, shifted
   by one and cut (AND) with the bitmaps of the words that have a bit in the same
   blocks, gives the bitmaps of the phrases one word longer; their popcounts are
   summed over the shards by Spark.  A shard is mined depth first, a bounded group
   of phrases at a time, along phrases that the filters let pass; what a filter
   lets through in error is only more work, as the sums are exact.
3. Lengths 2 and 3 take a pass of their own each, further ones come together.
4. Prefix and suffix counts are joined to each phrase by keys.  A cut into two parts
   scores 1000 * a * n / (l * r), rounded down, in decimals of 38 digits.  The
   lowest cut counts.  A phrase goes if a longer one that holds it is (nearly) as
   frequent.

Defined results: a null language counts as `und`; a null, empty or wordless text
has no phrase; repeated rows and equal ids count as often as they are there; a
language without a phrase is not in the result; equal scores are ordered by count,
then phrase; an empty table gives an empty result; further columns are ignored.
Shards end where runs of whole texts do, so a very long text counts whole, in a
shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from termloom.llm.bitfilter import BitFilter, bit_filter
from termloom.llm.common import arrow_map, materialise, only, tidied
from termloom.llm.wordhash import WordHasher, mix

#: Positions of a shard, and blocks of bitmaps of phrases that are extended at once.
SHARD, GROUP = 1 << 20, 1 << 15
#: Parts into which a language's phrases are dealt before the last ranking.
SALTS = 64
#: Bytes between pieces; words are what lies between these, spaces and tabs.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_R = np.uint64(0x9E3779B97F4A7C15)


def extended(parents: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys of phrases from those of all words but the last, and of the last word."""
    return mix(parents * _R + last)


class Words:
    """Keys and positions of the words of many texts."""

    def __init__(self) -> None:
        self.hasher = WordHasher(lower=True)
        self.hasher.is_word[:] = True
        self.hasher.is_word[[32, 9, *BREAKS]] = False
        self.breaks = np.zeros(256, bool)
        self.breaks[list(BREAKS)] = True
        self.langs: dict[str, np.uint64] = {}

    def lang(self, name: str) -> np.uint64:
        return self.langs.setdefault(name, np.uint64(xxh3_64_intdigest(name)))

    def runs(self, batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of rows: languages of rows, row of each word, keys, positions, lower-case bytes, starts and ends of words."""
        text = batch.column("text").cast(pa.large_string()).fill_null("")
        langs = ["und" if x is None else x for x in batch.column("lang").to_pylist()]
        _, raw, body = text.buffers()
        offsets = np.frombuffer(raw, np.int64, len(text) + 1 + text.offset)[text.offset :]
        for low, high, hashes, counts, starts, ends in self.hasher.chunks(text):
            if not len(hashes):
                continue
            data = np.frombuffer(body, np.uint8)[offsets[low] : offsets[high]]
            row = np.repeat(np.arange(low, high), counts)
            keys = mix(hashes * _R + np.array([self.lang(x) for x in langs[low:high]], np.uint64)[row - low])
            seen = np.concatenate(([0], np.cumsum(self.breaks[data], dtype=np.int32)))
            apart = (seen[starts[1:]] > seen[ends[:-1]]) | (row[1:] != row[:-1])
            yield langs, row, keys, np.arange(len(keys)) + np.concatenate(([0], np.cumsum(apart))), data, starts, ends


class Bitmaps:
    """Position bitmaps of the words of a shard: for each block of 64 positions the words in it and their bits."""

    def __init__(self, keys: np.ndarray, positions: np.ndarray) -> None:
        self.keys, word = np.unique(keys, return_inverse=True)
        block = positions >> 6
        entry = block * len(self.keys) + word
        order = np.argsort(entry, kind="stable")
        entry, bit = entry[order], np.left_shift(np.uint64(1), (positions[order] & 63).astype(np.uint64))
        new = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
        self.bits = np.bitwise_or.reduceat(bit, new)
        self.block, self.word = np.divmod(entry[new], len(self.keys))
        self.begin = np.searchsorted(self.block, np.arange(int(self.block[-1]) + 3))

    def roots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, block, bits) by word."""
        order = np.argsort(self.word, kind="stable")
        return self.word[order], self.block[order], self.bits[order]

    def shifted(self, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which, block, bits) one position on: a block's last bit moves to the next block."""
        moved, carried = np.left_shift(bits, np.uint64(1)), np.right_shift(bits, np.uint64(63))
        stay, go = np.flatnonzero(moved), np.flatnonzero(carried)
        return np.concatenate((stay, go)), np.concatenate((block[stay], block[go] + 1)), np.concatenate((moved[stay], carried[go]))

    def cut(self, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, word, block, bits) of all words that follow the given phrases: shift, then AND with the words of each block."""
        which, block, bits = self.shifted(block, bits)
        first = self.begin[block]
        n = self.begin[block + 1] - first
        own = np.repeat(np.arange(len(block)), n)
        entry = np.arange(len(own)) + np.repeat(first - np.cumsum(n) + n, n)
        both = bits[own] & self.bits[entry]
        hit = np.flatnonzero(both)
        own = own[hit]
        return phrase[which[own]], self.word[entry[hit]], block[own], both[hit]


def mined(bitmaps: Bitmaps, lengths: range, filters: list[BitFilter]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key of all words but the last, key of the last word, occurrences) of a shard's phrases of the given lengths.

    filters[k - 1] holds phrases of k words; a phrase is looked at only if all
    its parts of known lengths pass.
    """
    words, block, bits = bitmaps.roots()
    new = np.concatenate(([True], words[1:] != words[:-1]))
    node = np.cumsum(new) - 1
    # a group: words of each phrase, keys, and the bitmaps as (phrase, block, bits) by phrase
    stack = list(_groups(words[new][:, None], bitmaps.keys[words[new]], node, block, bits))[::-1]
    while stack:
        path, keys, node, block, bits = stack.pop()
        node, word, block, bits = bitmaps.cut(node, block, bits)
        if not len(node):
            continue
        child, order = node * len(bitmaps.keys) + word, None
        order = np.argsort(child, kind="stable")
        child, block, bits = child[order], block[order], bits[order]
        first = np.flatnonzero(np.concatenate(([True], child[1:] != child[:-1])))
        parent, word = np.divmod(child[first], len(bitmaps.keys))
        length = path.shape[1] + 1
        # the parts that end with the new word, the longest of a known length first
        keep = np.ones(len(first), bool)
        last = bitmaps.keys[word]
        known = min(length - 1, len(filters))
        if known > 1:
            tail = bitmaps.keys[path[parent, length - known]]
            for i in range(length - known + 1, length - 1):
                tail = extended(tail, bitmaps.keys[path[parent, i]])
            keep = filters[known - 1].holds(extended(tail, last))
        own = extended(keys[parent], last)
        if length <= len(filters):
            keep &= filters[length - 1].holds(own)
        if not keep.any():
            continue
        size = np.diff(np.append(first, len(child)))
        if length in lengths:
            count = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), first)
            yield keys[parent[keep]], last[keep], count[keep]
        if length + 1 in lengths or length + 1 < lengths.start:
            entries = np.repeat(keep, size)
            node = np.repeat(np.cumsum(keep) - 1, size)[entries]
            path = np.concatenate((path[parent[keep]], word[keep][:, None]), axis=1)
            stack += list(_groups(path, own[keep], node, block[entries], bits[entries]))[::-1]


def _groups(path, keys, node, block, bits) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole phrases, as many as have GROUP blocks together, or one with more."""
    begin = np.searchsorted(node, np.arange(len(keys) + 1))
    i = 0
    while i < len(keys):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + GROUP, side="right")) - 1)
        a, b = begin[i], begin[j]
        yield path[i:j], keys[i:j], node[a:b] - i, block[a:b], bits[a:b]
        i = j


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, key, a: occurrences of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for langs, row, keys, _, data, starts, ends in words.runs(batch):
                different, at, n = np.unique(keys, return_index=True, return_counts=True)
                body = data.tobytes().translate(words.hasher.table)
                spelt = pa.array([body[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], pa.binary())
                names = pa.array([langs[i] for i in row[at].tolist()])
                yield pa.RecordBatch.from_arrays([names, spelt.cast(pa.string()), pa.array(different.view(np.int64)), pa.array(n)], ["lang", "word", "key", "n"])

    return docs.mapInArrow(tidied(run), "lang string, word string, key long, n long").groupBy("lang", "word", "key").agg(F.sum("n").alias("a"))


def phrase_counts(docs: DataFrame, lengths: range, shared: list, least: int) -> DataFrame:
    """parent (key of all words but the last), last, a: phrases of these lengths with at least `least` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, filters = Words(), [s.value for s in shared]
        held, size, end = [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, positions = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(keys):
                for parent, last, n in mined(Bitmaps(keys, positions), lengths, filters):
                    yield pa.RecordBatch.from_arrays([pa.array(parent.view(np.int64)), pa.array(last.view(np.int64)), pa.array(n)], ["parent", "last", "n"])

        for batch in batches:
            for _, _, keys, positions, *_ in words.runs(batch):
                keep = filters[0].holds(keys)
                held.append((keys[keep], positions[keep] + end))
                size, end = size + len(keys), end + int(positions[-1]) + 2
                if size >= SHARD:
                    yield from flush()
                    held, size, end = [], 0, 0
        if held:
            yield from flush()

    counted = docs.mapInArrow(tidied(run), "parent long, last long, n long").groupBy("parent", "last").agg(F.sum("n").alias("a"))
    return counted.where(F.col("a") >= least)


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (parent, last, a) with the phrase's own key."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            parent, last = (np.asarray(batch.column(c)).view(np.uint64) for c in ("parent", "last"))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(extended(parent, last).view(np.int64))], [*batch.schema.names, "key"])

        return each

    return arrow_map(rows, make, "parent long, last long, a long, key long")


def _parts(rows: DataFrame) -> DataFrame:
    """rows with the key of the phrase without its first word, and the keys of all its shorter phrases."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            tails, inner = [], []
            for keys in batch.column("keys").to_pylist():
                keys = np.array(keys, np.int64).view(np.uint64)
                own, part = [], None
                for i in range(len(keys)):
                    part = keys[i : i + 1]
                    for j in range(i + 1, len(keys)):
                        part = extended(part, keys[j : j + 1])
                        own.append((i, j, int(part.view(np.int64)[0])))
                tails.append(next((k for i, j, k in own if (i, j) == (1, len(keys) - 1)), int(keys[-1:].view(np.int64)[0])))
                inner.append(sorted({k for i, j, k in own if j - i + 1 < len(keys)}))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64()))], [*batch.schema.names, "tail", "inner"])

        return each

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return arrow_map(rows, make, f"{fields}, tail long, inner array<long>")


def _best_cut(a: Column, n: Column, prefixes: Column, suffixes: Column) -> Column:
    """struct(score, k, l, r) of the lowest cut; the first of equal ones."""
    exact = lambda x: x.cast("decimal(38,0)")

    def one(k: Column) -> Column:
        left, right = F.element_at(prefixes, k), F.element_at(suffixes, k + 1)
        return F.struct(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (a.cast("decimal(15,0)") * n.cast("decimal(18,0)")), exact(left.cast("decimal(18,0)") * right.cast("decimal(18,0)"))).cast("long").alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size(prefixes) - 1), one))


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, share: int = 100) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every phrase that no longer one stands for.

    least: occurrences of a phrase; share: percent of a phrase's occurrences from
    which a longer one stands for it.
    """
    docs = only(docs, "lang", "text")
    context = docs.sparkSession.sparkContext
    words = materialise(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = words.where(F.col("a") >= least)
    shared = [context.broadcast(bit_filter(frequent.select("key"), frequent.count()))]  # 2**MOST bits at most, like the next
    found = []
    for lengths in (range(2, 3), range(3, 4), range(4, longest + 1)):
        if lengths.start <= min(longest, lengths.stop - 1):
            rows = materialise(_keyed(phrase_counts(docs, lengths, shared, least)), "phrases")
            found.append(rows)
            if lengths.start < longest:
                shared.append(context.broadcast(bit_filter(rows.select("key"), rows.count())))
    by_key = frequent.select("key", "lang", F.array("word").alias("words"), F.array("key").alias("keys"), F.array("a").alias("prefixes"), F.array("a").alias("suffixes"))
    ends = frequent.select(F.col("key").alias("last"), F.col("word").alias("end"))
    every = []
    for length in range(2, longest + 1):
        rows = found[min(length, 4) - 2]
        rows = rows.join(by_key.select(F.col("key").alias("parent"), "lang", "words", "keys", "prefixes"), "parent").join(ends, "last")
        rows = rows.select("key", "a", "lang", F.array_append("words", F.col("end")).alias("words"), F.array_append("keys", F.col("last")).alias("keys"), F.array_append("prefixes", F.col("a")).alias("prefixes"))
        rows = _parts(rows).join(by_key.select(F.col("key").alias("tail"), F.col("suffixes").alias("rest")), "tail")
        by_key = materialise(rows.select("key", "a", "lang", "words", "keys", "prefixes", F.concat(F.array("a"), "rest").alias("suffixes"), "inner"), "phrases-of-one-length")
        every.append(by_key)
    every = reduce(DataFrame.unionByName, every)
    longer = every.select(F.explode("inner").alias("key"), "a").groupBy("key").agg(F.max("a").alias("longer"))
    rows = every.join(longer, "key", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).join(totals, "lang")
    rows = rows.withColumn("cut", _best_cut(F.col("a"), F.col("n"), F.col("prefixes"), F.col("suffixes")))
    return rows.select("lang", F.array_join("words", " ").alias("phrase"), "words", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(phrases: DataFrame, most: int = 2000) -> DataFrame:
    """Each language's first `most` phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases are ranked in parts of each language first, so a language of any size
    brings at most SALTS times `most` rows together.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    rows = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", place("lang", "salt")).where(F.col("rank") <= most)
    rows = rows.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= most)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
