"""Operator 10: n-gram Jaccard join by grouped prefixes.

A document's set holds its distinct shingles of k words (hashed to 64 bits; of
fewer words the whole sequence).  Shingles are ordered by how often they occur,
rarest first; the order comes from a sketch of fixed size that counts all
shingles of all documents in hashed cells.  Any total order is right; this one
keeps common shingles out of the prefixes.  Sets of similarity t share a shingle
within the first n - ceil(t n) + 1 of each.

1. Equal sets become one node, and nodes with the same prefix and size one group.
2. Groups that share a prefix shingle are paired under the size and position
   filters.  In a large corpus most such pairs share it by chance, so each set has
   a parity sketch of about a bit a shingle: sketches differ in no more bits than
   sets differ in shingles, so pairs whose sketches differ in too many are dropped
   and no link is.  What is left is kept; a shingle that stands in more than HOT
   prefixes is judged by sketches in tasks of its own and keeps the lists of groups
   that hang together instead of their pairs.
3. Groups expand to their nodes, which lie in blocks of bounded size.  Two
   blocks meet, in a task of their own, if a kept pair, a frequent shingle or a
   group reaches from one into the other and their sizes allow a link; a pair of
   documents is in just one pair of blocks.  There all pairs are verified
   exactly, on sets made anew from the texts: no link is lost, whatever blocks
   hold, and no list of pairs is written for a large group of near copies.
4. Verified links give the components, and every document gets its node's.

Rows are told apart by numbers of their own, never by doc_id, so rows without or
with the same doc_id cost what others do.

Defined results: a null or wordless text has an empty set, n_shingles 0, and is
linked with nothing; rows are judged one by one, so rows that repeat a doc_id or
a text are linked as equal sets are; a null doc_id stays null and counts as no
smallest doc_id unless all of a component are null; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.llm.bitfilter import bit_filter
from termloom.llm.common import discard, materialise, only, tidied
from termloom.llm.components import components
from termloom.llm.sketch import rarest_first, sketch
from termloom.llm.wordhash import WordHasher, mix, shingles

#: Prefixes that share a shingle beyond which it pairs blocks instead of groups; nodes of a block.
HOT, BLOCK = 24, 384
#: Groups of a frequent shingle that meet in one task, on each side; bytes of a sketch at least.
PART, LEAST = 1024, 16
#: Matrix columns at a time while verifying.
COLUMNS = 8192
#: Bytes of sets that go to Spark at once.
SHIPPED = 1 << 23


def _sets(column: pa.Array, hasher: WordHasher, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for i, words in hasher.texts(column):
        s = shingles(words, k)
        s.sort()
        yield i, s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def parity(s: np.ndarray) -> bytes:
    """A bit for each cell that holds an odd number of the set's hashes; as many cells as hashes, up to a power of two."""
    cells = max(8 * LEAST, 1 << (len(s) - 1).bit_length())
    odd = np.bincount((mix(s ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(rows: np.ndarray, size: int) -> np.ndarray:
    """Sketches (one a row) as they are with `size` bytes."""
    while rows.shape[-1] > size:
        half = rows.shape[-1] // 2
        rows = rows[..., :half] ^ rows[..., half:]
    return rows


def alike(x: bytes | None, y: bytes | None, total: int, num: int, den: int) -> bool:
    """Whether sets of `total` hashes together may be linked by their sketches; without one they may."""
    if x is None or y is None:
        return True
    a, b = (folded(np.frombuffer(v, np.uint8), min(len(x), len(y))) for v in (x, y))
    return (num + den) * int(np.bitwise_count(a ^ b).sum()) <= (den - num) * total


def near(n: np.ndarray, pos: np.ndarray, sketches: list[bytes | None], sides: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of sets that share a shingle (at place pos of each) may be linked, as a matrix; pairs within one of two sides are left out."""
    order = np.argsort(n, kind="stable")
    n, pos, sides, sketches = n[order], pos[order], sides[order], [sketches[i] for i in order]
    some = np.array([x is not None for x in sketches])
    size = np.array([max(LEAST, (1 << int(m - 1).bit_length()) // 8) for m in n])
    last = np.searchsorted(n, n * den // num, side="right")
    out = np.zeros((len(n), len(n)), bool)
    for own in np.unique(size):
        first, end = np.searchsorted(size, [own, own + 1])
        top = last[end - 1]
        held = np.array([folded(np.frombuffer(x, np.uint8), own) if x is not None else np.zeros(own, np.uint8) for x in sketches[first:top]]).view(np.uint64)
        for i in range(first, end):
            j = np.arange(i + 1, last[i])
            ok = (num + den) * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= num * (n[i] + n[j])
            j = j[ok & ((sides[i] == 2) | (sides[j] != sides[i]))]
            if len(j):
                differ = np.bitwise_count(held[j - first] ^ held[i - first]).sum(axis=1, dtype=np.int64)
                j = j[~(some[i] & some[j]) | ((num + den) * differ <= (den - num) * (n[i] + n[j]))]
                out[order[i], order[j]] = out[order[j], order[i]] = True
    return out


def roots(nodes: np.ndarray, link: np.ndarray) -> np.ndarray:
    """For each node the least one that it hangs together with."""
    root, todo = nodes.copy(), np.ones(len(nodes), bool)
    for i in np.argsort(nodes):
        if todo[i]:
            todo[i], front = False, [i]
            while front:
                root[front] = nodes[i]
                new = np.flatnonzero(link[front].any(axis=0) & todo)
                todo[new], front = False, new.tolist()
    return root


def _described(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """A row for each document: its own number, set size and signature, prefix and the prefix's hash, and all columns as they are.

    Columns beyond doc_id and text stand in the struct `rest`.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = ["rest"] if others else []
    docs = docs.select("doc_id", "text", *[F.struct(*[docs[c] for c in others]).alias(c) for c in rest])
    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs, k, lower=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, cells, row = WordHasher(lower=True), counts.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            n, s1, s2, g, prefixes, sketches = [], [], [], [], [], []
            for _, s in _sets(batch.column("text"), hasher, k):
                n.append(len(s))
                order = np.argsort(rarest_first(s, cells), kind="stable")
                prefix = s[order[: prefix_size(len(s), num, den)]] if len(s) else s
                with np.errstate(over="ignore"):
                    s1.append(mix(s + np.uint64(1)).sum(dtype=np.uint64))
                    s2.append(mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64))
                    g.append(mix(prefix + np.uint64(7)).sum(dtype=np.uint64))
                prefixes.append(prefix.view(np.int64))
                sketches.append(parity(s) if len(s) else None)
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + size)), batch.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (s1, s2, g)], pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), *[batch.column(c) for c in ("text", *rest)]],
                ["row", "doc_id", "n", "s1", "s2", "g", "prefix", "sketch", "text", *rest],
            )
            row += size

    schema = StructType.fromDDL("row long, doc_id long, n long, s1 long, s2 long, g long, prefix array<long>, sketch binary, text string")
    return docs.mapInArrow(tidied(run), StructType([*schema.fields, *[docs.schema[c] for c in rest]]))


def _postings(groups: DataFrame) -> DataFrame:
    """(token, m, gid, n, pos) of shingles that stand in m > 1 prefixes."""
    often = groups.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    often = materialise(often, "often")
    held = groups.sparkSession.sparkContext.broadcast(bit_filter(often.select(F.xxhash64("token")), often.count()))  # 32 MB at most

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(held.value.holds(np.asarray(batch.column("h")).view(np.uint64)))
            yield batch.take(pa.array(at)).drop_columns(["h"])

    rows = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token")).withColumn("h", F.xxhash64("token"))
    rows = rows.mapInArrow(tidied(explode), "gid long, n long, pos int, token long")
    # dealt out at every size: only what the filter lets through
    shared = materialise(rows.hint("merge").join(often, "token"), "postings")
    discard(often)
    return shared


def _candidates(groups: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of groups that pass the filters, and (key, gid, m, hub): m groups that hang together over a frequent shingle, hub the least."""
    shared = _postings(groups)
    few = shared.where(F.col("m") <= HOT)
    a, b = (few.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("gid", "n", "pos")]) for side in "ab")
    fits = (F.col("gid_a") < F.col("gid_b")) & (den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & ((num + den) * F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= num * (F.col("n_a") + F.col("n_b")))
    pairs = a.join(b, "token").where(fits).select(F.col("gid_a").alias("a"), F.col("gid_b").alias("b"), (F.col("n_a") + F.col("n_b")).alias("total")).distinct()
    sketches = groups.select("gid", "sketch")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, total = (batch.column(c).to_pylist() for c in ("x", "y", "total"))
            at = pa.array([i for i, t in enumerate(total) if alike(x[i], y[i], t, num, den)], pa.int64())
            yield batch.select(["a", "b"]).take(at)

    for c, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sketches.select(F.col("gid").alias(c), F.col("sketch").alias(name)), c)
    pairs = materialise(pairs.mapInArrow(tidied(judged), "a long, b long"), "pairs")
    parts = F.ceil(F.col("m") / PART).cast("int")
    hot = shared.where(F.col("m") > HOT).join(sketches, "gid").withColumn("c", F.pmod(F.xxhash64("gid"), parts).cast("int"))
    hot = hot.select("token", "gid", "n", "pos", "sketch", "c", F.explode(F.sequence(F.lit(0), parts - 1)).alias("o"))
    side = F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).alias("side")
    keys = ["token", "i", "j"]
    hot = hot.select("token", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), side, "gid", "n", "pos", "sketch")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for *own, side, gid, n, pos, sketch in zip(*[batch.column(c).to_pylist() for c in (*keys, "side", "gid", "n", "pos", "sketch")], strict=True):
                if own != key:
                    if held:
                        yield from together(key, held)
                    key, held = own, []
                held.append((side, gid, n, pos, sketch))
        if held:
            yield from together(key, held)

    def together(key: list, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        sides, gids, n, pos = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[:4])
        link = near(n, pos, [r[4] for r in held], sides, num, den)
        at = np.flatnonzero(link.any(axis=1))
        if len(at):
            root = roots(gids, link)[at]
            _, which, m = np.unique(root, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(np.full(len(at), k), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)], pa.array(gids[at]), pa.array(m[which]), pa.array(root)], [*keys, "gid", "m", "hub"])

    hot = hot.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidied(gathered), "token long, i int, j int, gid long, m long, hub long")
    hot = materialise(hot.select(F.xxhash64(*keys, "hub").alias("key"), "gid", "m", "hub"), "hot")
    discard(shared)
    return pairs, hot


def _labels(pairs: DataFrame, hot: DataFrame) -> DataFrame:
    """(gid, label) of groups with a candidate: groups that should lie in one block mostly share a label.

    Labels only decide what is shipped together, never what is compared.  A group
    with frequent shingles takes the hub of its most frequent one, others the
    least start among their partners, and their partners' in turn.
    """
    own = hot.groupBy("gid").agg(F.max_by("hub", F.struct("m", "key")).alias("fixed"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    every = both.select(F.col("a").alias("gid")).distinct().join(own, "gid", "full").select("gid", "fixed", F.coalesce("fixed", "gid").alias("label"))
    every = materialise(every, "labels")
    for _ in range(2):
        near = both.join(every.select(F.col("gid").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        label = F.coalesce("fixed", F.least("label", "near"))
        every = materialise(every.join(near, every["gid"] == near["a"], "left").select("gid", "fixed", label.alias("label")), "labels")
    return every.select("gid", "label")


def _blocks(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """nodes (label, n, ...) with block and band: blocks of BLOCK nodes at most about; large labels are split by set size and hash."""
    band = F.floor(F.log(F.col("n").cast("double")) / (math.log(den / num) * 1.0000001)).cast("int")
    nodes = nodes.withColumn("band", band)
    sizes = nodes.groupBy("label", "band").agg(F.count(F.lit(1)).alias("c"))
    totals = sizes.groupBy("label").agg(F.sum("c").alias("total"))
    plan = sizes.join(totals, "label").select("label", "band", (F.col("total") > BLOCK).alias("split"), F.ceil(F.col("c") / BLOCK).alias("parts"))
    plan = materialise(plan, "block-sizes")  # written first: then the join deals both sides out and may split a large label
    placed = nodes.join(plan, ["label", "band"])
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    name = F.when(F.col("split"), F.concat_ws("-", "label", "band", part)).otherwise(F.col("label").cast("string"))
    return placed.withColumn("block", name).withColumn("band", F.when(F.col("split"), F.col("band"))).drop("split", "parts")


def _block_pairs(placed: DataFrame, pairs: DataFrame, hot: DataFrame) -> DataFrame:
    """Pairs of different blocks (x < y) that hold a candidate pair; no pair of documents is written for a frequent shingle."""
    of = materialise(placed.select("gid", "block", "band").distinct(), "group-blocks")
    near = (F.col("x") < F.col("y")) & (F.col("band_x").isNull() | F.col("band_y").isNull() | (F.abs(F.col("band_x") - F.col("band_y")) <= 1))
    side = lambda df, c, *keys: df.select(*keys, F.col("block").alias(c), F.col("band").alias(f"band_{c}"))
    one = pairs.join(side(of, "p", F.col("gid").alias("a")), "a").join(side(of, "q", F.col("gid").alias("b")), "b")
    flip = F.col("p") < F.col("q")
    pick = lambda u, v, c: F.when(flip, F.col(u)).otherwise(F.col(v)).alias(c)
    one = one.select(pick("p", "q", "x"), pick("band_p", "band_q", "band_x"), pick("q", "p", "y"), pick("band_q", "band_p", "band_y"))
    # blocks with a frequent shingle in common, and blocks of one group
    keyed = hot.select(F.concat(F.lit("t"), "key").alias("k"), "gid").join(of, "gid").select("k", "block", "band").unionByName(of.select(F.concat(F.lit("g"), "gid").alias("k"), "block", "band"))
    keyed = materialise(keyed.distinct(), "block-keys")
    many = side(keyed, "x", "k").join(side(keyed, "y", "k"), "k").drop("k")
    return one.unionByName(many).where(near).select("x", "y").distinct()


def linked(sets: list[np.ndarray], sides: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs are linked, as a matrix; pairs within one of two different blocks are left to that block's own task."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts > 1)
    place = np.full(len(tokens), -1)
    place[often] = np.arange(len(often))
    at = place[inverse]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for a in range(0, len(often), COLUMNS):
        lo, hi = np.searchsorted(at, [a, a + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, len(often) - a)), np.float32)
        m[owner[lo:hi], at[lo:hi] - a] = 1
        both += m @ m.T
    both = both.astype(np.int64)
    out = den * both >= num * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(out, False)
    out &= (sides[:, None] == 2) | (sides[:, None] != sides[None, :])
    return out


def _verify(rows: list[tuple], num: int, den: int) -> list[tuple[int, int, int]]:
    """(node, least node it is linked with through others here, documents linked with it)."""
    nodes = np.array([r[0] for r in rows])
    copies = np.array([r[3] for r in rows], dtype=np.int64)
    link = linked([np.frombuffer(r[2], np.uint64) for r in rows], np.array([r[1] for r in rows]), num, den)
    return list(zip(nodes.tolist(), roots(nodes, link).tolist(), (link @ copies).tolist(), strict=True))


def _joined(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(all rows as described, and row, doc_id, n, c, n_links of those with a set): c names a row's component."""
    rows = materialise(_described(docs, k, num, den), "sets")
    full = rows.where("n > 0")
    nodes = full.groupBy("s1", "s2", "n", "g").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(nodes, "nodes")
    groups = materialise(nodes.groupBy("n", "g").agg(F.min("node").alias("gid"), F.count(F.lit(1)).alias("members")), "groups")
    # a sketch is of one set: groups of several have none, and no filter drops their pairs
    sketch = F.when(F.col("members") == 1, F.col("sketch")).alias("sketch")
    heads = materialise(groups.join(full.select(F.col("row").alias("gid"), "prefix", "sketch"), "gid").select("gid", "n", "prefix", sketch), "heads")
    pairs, hot = _candidates(heads, num, den)
    discard(heads)
    labels = groups.join(_labels(pairs, hot), "gid", "left").where("label is not null or members > 1").select("n", "g", "gid", F.coalesce("label", "gid").alias("label"))
    placed = nodes.join(labels, ["n", "g"]).select("gid", "label", "node", "n", "copies")
    placed = materialise(_blocks(placed, num, den), "placed")
    between = materialise(_block_pairs(placed, pairs, hot), "block-pairs")
    inside = placed.groupBy("block").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("block").alias("x"), F.col("block").alias("y"))
    tasks = between.unionByName(inside)
    turn = F.struct("x", "y", F.when(F.col("x") == F.col("y"), 2).otherwise(0).alias("side"))
    turns = tasks.select(F.col("x").alias("block"), turn.alias("turn")).unionByName(between.select(F.col("y").alias("block"), F.struct("x", "y", F.lit(1).alias("side")).alias("turn")))
    turns = turns.groupBy("block").agg(F.collect_list("turn").alias("turns"))  # as many as a block has partners
    chosen = bit_filter(placed.select(F.xxhash64("node")), placed.count())
    held = docs.sparkSession.sparkContext.broadcast(chosen)  # 32 MB at most

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(held.value.holds(np.asarray(batch.column("h")).view(np.uint64)))
            yield batch.select(["node", "text"]).take(pa.array(at))

    # texts are dealt out by row at every size, those that the filter of wanted rows lets through
    texts = full.select(F.col("row").alias("node"), F.xxhash64("row").alias("h"), "text").mapInArrow(tidied(kept), "node long, text string")
    wanted = placed.join(turns, "block").select("node", "copies", "turns").hint("merge").join(texts, "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower=True)
        for batch in batches:
            out, size = [], 0
            names, copies, turns = (batch.column(c).to_pylist() for c in ("node", "copies", "turns"))
            for i, s in _sets(batch.column("text"), hasher, k):
                held = s.tobytes()
                alone = all(t["side"] == 2 for t in turns[i])
                for t in turns[i]:
                    out.append((t["x"], t["y"], t["side"], alone, names[i], copies[i], held))
                    size += len(held)
                    if size > SHIPPED:
                        yield shipment(out)
                        out, size = [], 0
            if out:
                yield shipment(out)

    def shipment(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], ["x", "y", "side", "only", "node", "copies", "set"])

    keys = ["x", "y"]
    shipped = wanted.mapInArrow(tidied(sets), "x string, y string, side int, only boolean, node long, copies long, set binary")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done, only = None, [], [], False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "only", "node", "side", "set", "copies")]
            for x, y, alone, *row in zip(*columns, strict=True):
                if (x, y) != key:
                    if held:
                        done += [(*r, only) for r in _verify(held, num, den)]
                    key, held, only = (x, y), [], alone
                held.append(row)
            if len(done) > 5000:
                yield batch_of(done)
                done = []
        if held:
            done += [(*r, only) for r in _verify(held, num, den)]
        if done:
            yield batch_of(done)

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done, strict=True)], ["node", "root", "links", "only"])

    checked = shipped.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidied(verify), "node long, root long, links long, only boolean")
    checked = materialise(checked, "links")
    split = components(checked.where("not only and node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "split")
    joined = checked.where("only").select("node", F.col("root").alias("c")).unionByName(split.select(F.col("id").alias("node"), F.col("component").alias("c")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    labels = nodes.join(joined, "node", "left").join(links, "node", "left").select("s1", "s2", "n", "copies", F.coalesce("c", "node").alias("c"), F.coalesce("links", F.lit(0)).alias("links"))
    labels = materialise(labels, "labels")
    keyed = full.select("row", "doc_id", "n", "s1", "s2").join(labels, ["s1", "s2", "n"])
    return rows, materialise(keyed.select("row", "doc_id", "n", "c", (F.col("links") + F.col("copies") - 1).alias("n_links")), "members")


def similar(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component), n_links (rows linked with it).

    Two rows are linked if den * intersection >= num * union of their sets.
    """
    rows, keyed = _joined(only(docs, "doc_id", "text"), k, num, den)
    # written first: then the join deals both sides out itself and may split a large component
    least = materialise(keyed.groupBy("c").agg(F.min("doc_id").alias("component_id")), "least")
    out = keyed.join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(empty)


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component, that of the smallest doc_id; rows without words all stay; all columns as they are.

    Rows are told apart by their own numbers: of equal ids in a component one row
    stays, a row of another component stays whatever its id, and a null id comes
    after all others.
    """
    rows, keyed = _joined(docs, k, num, den)
    first = keyed.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("m"))
    first = materialise(first.where("m > 1").select("c", F.col("first.row").alias("first")), "first")
    # written first: its size is known then, and texts are dealt out only where it is too large to be sent around
    gone = materialise(keyed.join(first, "c").where("row <> first").select("row"), "gone")
    names = [F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return rows.join(gone, "row", "left_anti").select(*names)
