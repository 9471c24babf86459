"""Operator 1: approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample by k-means whose distances grow with a
list's size, so lists stay balanced.  A graph of neighbouring centroids is kept
in memory and searched best first, for a whole batch of vectors at once.  Every
vector of the table goes to the list of its nearest centroid, and vectors near
a boundary also to the lists beyond it, each in another direction (a centroid
close to one already taken adds nothing and is passed over).  A query
reads the lists whose centroids are at most `ratio` times as far as the nearest
one, however many these are, and the nearest ones that hold ENOUGH times k
entries; distances to what they hold are exact, in double precision.  A query
that still lacks candidates meets all rows, stretch by stretch.

Lists are split into chunks by hash, and these dealt over GROUPS groups: a vector
that a third of all rows repeat is dealt over many tasks.  A group meets the
queries in blocks; it goes through its chunks one by one, keeps the nearest found
so far for each query of the block, and returns these once, however many lists
the query reads in it.  Spark ranks them, before and after the shuffle.

There is a list for each PER_LIST rows up to MOST_LISTS; of larger tables the
lists grow, and so does what a query reads.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; neither does a null vec_id.
Rows that repeat a vec_id count once, by the nearest of their vectors; ties go
to the smaller vec_id; a query with fewer candidates than k gets them all; an
empty table gives an empty result; further columns are ignored.  Vectors whose
squares leave the range of double are infinitely far, ties as above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import materialise, only, tidied

#: Rows the centroids are fitted on for each list, most lists, and rows that are taken at least.
SAMPLE, MOST_LISTS, LEAST_SAMPLE = 8, 16_384, 20_000
#: Rows of a list on average; neighbours in the graph; lists that a vector may be in, and length of the queue that finds them.
PER_LIST, DEGREE, COPIES, PLACES = 40, 24, 4, 12
#: Length of the queue of a query's search; it goes on with twice as many while the queue's last list is still wanted.
QUEUE = 96
#: A vector joins, and a query reads, lists up to so many times the nearest's distance; entries that a query's lists hold at least, in multiples of k.
NEAR, RATIO, ENOUGH = 1.15, 1.18, 40
#: Share of the vector's distance that lists of one vector lie apart at least, squared.
APART = 0.1
#: Where the shortest vector's largest component is below this share of the longest one's, lists are searched in double precision.
FLOOR = 1e-12
#: Entries and queries of a task's matrix, and rows of a stretch where queries meet all rows.
CHUNK, QUERIES, STRETCH = 2000, 500, 50_000
#: Groups that chunks are dealt over, and queries of a block, about.
GROUPS, BLOCK = 64, 20_000


@dataclass
class Lists:
    centroids: np.ndarray
    graph: np.ndarray

    def search(self, x: np.ndarray, queue: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) near each row of x, nearest first; -1 fills up. Best first over the graph, for all rows at once."""
        n, k = len(x), len(self.centroids)
        queue = min(queue, k)
        x = x.astype(self.centroids.dtype)
        entry = np.unique(np.linspace(0, k - 1, 16).astype(np.int32))
        seen = np.zeros((n, k), bool)
        seen[:, entry] = True
        norms = (self.centroids**2).sum(axis=1)
        ids = np.repeat(entry[None, :], n, axis=0)
        far = norms[ids] - 2 * (x @ self.centroids[entry].T)
        done = np.zeros(ids.shape, bool)
        at = np.arange(n)
        while len(at):
            best = np.where(done[at], np.inf, far[at]).argmin(axis=1)
            going = ~done[at, best] & np.isfinite(far[at, best])
            at, best = at[going], best[going]
            if not len(at):
                break
            done[at, best] = True
            new = self.graph[ids[at, best]]
            fresh = ~seen[at[:, None], new]
            seen[at[:, None], new] = True
            more = np.full(new.shape, np.inf, x.dtype)
            row, col = np.nonzero(fresh)
            which = new[row, col]
            more[row, col] = norms[which] - 2 * np.einsum("ij,ij->i", x[at[row]], self.centroids[which])
            if ids.shape[1] < queue:
                pad = queue - ids.shape[1]
                ids, far, done = np.pad(ids, ((0, 0), (0, pad))), np.pad(far, ((0, 0), (0, pad)), constant_values=np.inf), np.pad(done, ((0, 0), (0, pad)))
            all_far = np.hstack([far[at], more])
            keep = np.argpartition(all_far, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
            far[at] = np.take_along_axis(all_far, keep, 1)
            ids[at] = np.take_along_axis(np.hstack([ids[at], new]), keep, 1)
            done[at] = np.take_along_axis(np.hstack([done[at], np.zeros(new.shape, bool)]), keep, 1)
        order = np.argsort(far, axis=1, kind="stable")[:, :queue]
        far, ids = np.take_along_axis(far, order, 1), np.take_along_axis(ids, order, 1)
        fine = np.isfinite(far)
        far = np.sqrt(np.maximum(0, np.where(fine, far, 0) + (x**2).sum(axis=1)[:, None]))
        return np.where(fine, ids, -1), np.where(fine, far, np.inf)

    def wanted(self, x: np.ndarray, ratio: float, held: np.ndarray, least: int, queue: int = QUEUE) -> tuple[np.ndarray, np.ndarray]:
        """(row of x, list) of all lists within `ratio` of the nearest, and of the nearest that hold `least` entries together."""
        rows, lists, todo = [], [], np.arange(len(x))
        while len(todo):
            ids, far = self.search(x[todo], queue)
            count = np.where(ids >= 0, held[ids], 0)
            before = np.cumsum(count, axis=1) - count
            take = (ids >= 0) & ((far <= ratio * far[:, :1]) | (before < least))
            # where the queue ends with a wanted list there may be more
            short = take[:, -1] & (queue < len(self.centroids))
            at, place = np.nonzero(take & ~short[:, None])
            rows.append(todo[at])
            lists.append(ids[at, place])
            todo, queue = todo[short], 2 * queue
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *lists])


def clustered(x: np.ndarray, k: int, seed: int = 5, rounds: int = 10, kind: type = np.float32) -> np.ndarray:
    """At most k centroids, by k-means whose distances grow with a list's size."""
    rng = np.random.default_rng(seed)
    x = x.astype(kind)
    unique = np.unique(x, axis=0)
    k = max(1, min(k, len(unique)))
    c = unique[rng.choice(len(unique), k, replace=False)]
    load = np.zeros(k, np.float32)
    for _ in range(rounds):
        penalty = 1 + 0.01 * load / np.float32(max(1.0, len(x) / k))
        norms, own = (c**2).sum(1), np.empty(len(x), np.int64)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            own[a : a + 4096] = (((part**2).sum(1)[:, None] - 2 * part @ c.T + norms) * penalty).argmin(axis=1)
        count = np.bincount(own, minlength=k)
        load = (0.5 * load + 0.5 * count).astype(np.float32)
        order = np.argsort(own, kind="stable")
        full = np.flatnonzero(count)
        new = unique[rng.integers(0, len(unique), k)]
        new[full] = np.add.reduceat(x[order], np.cumsum(count)[full] - count[full], axis=0) / count[full][:, None]
        c = new.astype(kind)
    return c


def fit(x: np.ndarray, k: int, seed: int = 5, rounds: int = 10, kind: type = np.float32) -> Lists:
    c = clustered(x, k, seed, rounds, kind)
    k = len(c)
    near = np.zeros((k, min(DEGREE, k - 1)), np.int32)
    for a in range(0, k, 1024):
        part = c[a : a + 1024]
        far = (c**2).sum(1)[None, :] - 2 * part @ c.T
        far[np.arange(len(part)), np.arange(a, a + len(part))] = -np.inf
        near[a : a + 1024] = np.argsort(far, axis=1)[:, 1 : DEGREE + 1]
    ring = np.roll(np.arange(k, dtype=np.int32), -1)[:, None]  # so that every centroid can be reached
    return Lists(c, np.hstack([near, ring]))


def places(lists: Lists, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, list): the nearest list of each vector, and those near a boundary in other directions."""
    ids, far = lists.search(x, PLACES)
    taken = np.zeros(ids.shape, bool)
    taken[:, 0] = True
    for j in range(1, ids.shape[1]):
        ok = (ids[:, j] >= 0) & (far[:, j] <= NEAR * far[:, 0]) & (taken.sum(axis=1) < COPIES)
        own = lists.centroids[ids[:, j]]
        for t in range(j):
            rows = np.flatnonzero(ok & taken[:, t])
            between = ((own[rows] - lists.centroids[ids[rows, t]]) ** 2).sum(axis=1)
            ok[rows] &= between > APART * far[rows, j] ** 2
        taken[:, j] = ok
    at, place = np.nonzero(taken)
    return at, ids[at, place]


def usable(v: Column) -> Column:
    numbers = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(v.isNotNull() & numbers & F.exists(v, lambda e: e != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, ratio: float = RATIO) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows where `queries` holds, their k nearest others by Euclidean distance."""
    spark = vectors.sparkSession
    rows = only(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    longest = F.array_max(F.transform("embedding", lambda e: F.abs(e.cast("double"))))
    counts = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("count"), F.max(longest).alias("most"), F.min(longest).alias("least"))
    sizes = counts.orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    dim, n = sizes[0]["d"], sizes[0]["count"]
    # lists are searched on vectors times a power of two, so that no square leaves the range; distances are of the vectors as they are
    down = -int(np.frexp(sizes[0]["most"])[1])
    precision = np.float32 if np.ldexp(sizes[0]["least"], down) > FLOOR else np.float64
    rows = rows.where(F.size("embedding") == dim)
    k_lists = max(1, min(MOST_LISTS, n // PER_LIST))
    sample = max(LEAST_SAMPLE, SAMPLE * k_lists)
    place = F.shiftrightunsigned(F.xxhash64(F.lit("centroids"), "vec_id"), 1)
    share = rows if n <= sample else rows.where(place < int(1.1 * sample / n * (1 << 63)))
    # the sample doesn't depend on the order of rows: those that come first by hash, of a few more than are wanted
    chosen = share.orderBy(place, "vec_id", "embedding").limit(sample).select("vec_id", "embedding").toArrow()
    lists = fit(np.ldexp(_matrix(chosen["embedding"].combine_chunks(), dim), down), k_lists, kind=precision)
    shared = spark.sparkContext.broadcast((lists.centroids, lists.graph))  # MOST_LISTS centroids at most
    kind = vectors.schema["embedding"].dataType.simpleString()

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(*shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                some = batch.slice(a, 2000)
                at, own = places(lists, np.ldexp(_matrix(some.column("embedding"), dim), down))
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), some.column("vec_id").take(at), some.column("embedding").take(at)], ["list", "id", "v"])

    posted = materialise(rows.mapInArrow(tidied(post), f"list int, id long, v {kind}"), "postings")
    sizes = posted.groupBy("list").agg(F.count(F.lit(1)).alias("n"))  # one row a list
    held = np.zeros(len(lists.centroids), np.int64)
    for r in sizes.collect():
        held[r["list"]] = r["n"]
    count = spark.sparkContext.broadcast(held)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(*shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                some = batch.slice(a, 1000)
                at, own = lists.wanted(np.ldexp(_matrix(some.column("embedding"), dim), down), ratio, count.value, ENOUGH * k)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), some.column("vec_id").take(at), some.column("embedding").take(at)], ["list", "id", "v"])

    asked = materialise(rows.where(queries).mapInArrow(tidied(probe), f"list int, id long, v {kind}"), "probes")
    found = _compared(posted, asked, dim, k)
    found = materialise(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), "found")
    # queries whose lists hold too few others meet all rows, stretch by stretch: none in a table of any size, unless ids repeat
    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    short = rows.where(queries).join(enough, F.col("vec_id") == F.col("query_id"), "left_anti").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    short = materialise(short, "short")
    if not short.isEmpty():
        stretches = max(1, -(-n // STRETCH))
        every = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(stretches)).cast("int").alias("list"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
        again = short.select(F.explode(F.sequence(F.lit(0), F.lit(stretches - 1))).alias("list"), "id", "v")
        found = found.unionByName(_compared(every, again, dim, k)).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def closest(ids: np.ndarray, vectors: np.ndarray, own: int, query: np.ndarray, near: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The k nearest different ids but own, ties to the smaller; near: places of those that can be among them, or more."""
    near = near[ids[near] != own]
    far = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
    out: dict[int, float] = {}
    for j in np.lexsort((ids[near], far)):
        out.setdefault(int(ids[near[j]]), float(far[j]))
        if len(out) == k:
            break
    return list(out.items())


def merged(old: list[tuple[int, float]], new: list[tuple[int, float]], k: int) -> list[tuple[int, float]]:
    """The k nearest different ids of both, ties to the smaller."""
    out: dict[int, float] = {}
    for far, j in sorted((far, j) for j, far in [*old, *new]):
        out.setdefault(j, far)
        if len(out) == k:
            break
    return list(out.items())


def _compared(left: DataFrame, right: DataFrame, dim: int, k: int) -> DataFrame:
    """query_id, vec_id, score: for each query (right: list, id, v) the k nearest of its lists' entries (left) in each group.

    Lists are dealt by hash into chunks, chunks into groups and queries into blocks;
    a chunk goes to the blocks with queries of its list.
    """
    keys = ["group", "block"]
    blocks = max(1, -(-right.select("id").distinct().count() // BLOCK))
    right = right.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / CHUNK)).cast("int").alias("chunks")
    asked = right.groupBy("list").agg(F.collect_set("block").alias("blocks"))  # as many as there are blocks
    plan = materialise(left.groupBy("list").agg(chunks).join(asked, "list"), "list-parts")  # one row a list
    group = F.pmod(F.xxhash64("list", "chunk"), F.lit(GROUPS)).cast("int").alias("group")
    columns = ["group", "block", "list", "chunk", "side", "id", "v"]
    entries = left.join(F.broadcast(plan), "list").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).withColumn("block", F.explode("blocks")).withColumns({"group": group, "side": F.lit(0)}).select(columns)
    asking = right.join(F.broadcast(plan), "list").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"group": group, "side": F.lit(1)}).select(columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, held, waiting, best = None, None, [], [], {}
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            *parts, side, ids = (np.asarray(batch.column(c)) for c in columns[:-1])
            new = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in parts]))))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(ids)], strict=True):
                if (own := tuple(int(c[a]) for c in parts)) != place:
                    nearer(best, held, waiting)
                    place, held, waiting = own, [], []
                    if own[:2] != key:
                        yield from answers(best)
                        key, best = own[:2], {}
                for s, where in ((0, held), (1, waiting)):
                    rows = a + np.flatnonzero(side[a:b] == s)
                    if len(rows):
                        where.append((ids[rows], x[rows]))
        nearer(best, held, waiting)
        yield from answers(best)

    def nearer(best: dict[int, list[tuple[int, float]]], held: list, waiting: list) -> None:
        if not held or not waiting:
            return
        (ids, vectors), (asked, queries) = ([np.concatenate(c) for c in zip(*part, strict=True)] for part in (held, waiting))
        norms = (vectors**2).sum(axis=1)
        for a in range(0, len(asked), QUERIES):
            q, own_ids = queries[a : a + QUERIES], asked[a : a + QUERIES].tolist()
            rough = norms[None, :] - 2 * q @ vectors.T
            m = min(k + 1, len(ids))
            rough = np.where(np.isfinite(rough), rough, -np.inf)  # beyond double's squares: to be compared itself
            # all that rounding could put among the k nearest others; the distances themselves come from the vectors
            squares = (q**2).sum(axis=1)
            slack = 1e-9 * (norms.max() + squares)
            edge = np.partition(rough, m - 1, axis=1)[:, m - 1] + slack
            edge = np.where(np.isnan(edge), np.inf, edge)
            # nothing that is farther than the k found so far
            known = np.array([best[own][-1][1] if len(best.get(own, ())) == k else np.inf for own in own_ids])
            bound = known**2 - squares + slack + 1e-9 * known**2
            bound = np.where(np.isfinite(bound), bound, np.inf)
            for i, own in enumerate(own_ids):
                some = np.flatnonzero(rough[i] <= min(edge[i], bound[i]))
                if not len(some):
                    continue
                found = closest(ids, vectors, own, q[i], some, k)
                if len(found) < k and m < len(ids) and edge[i] < bound[i]:  # ids repeat
                    found = closest(ids, vectors, own, q[i], np.arange(len(ids)), k)
                best[own] = merged(best.get(own, []), found, k)

    def answers(best: dict[int, list[tuple[int, float]]]) -> Iterator[pa.RecordBatch]:
        rows = [(own, j, far) for own, found in best.items() for j, far in found]
        for a in range(0, len(rows), 50_000):
            q_ids, v_ids, scores = zip(*rows[a : a + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids, pa.int64()), pa.array(v_ids, pa.int64()), pa.array(scores, pa.float64())], ["query_id", "vec_id", "score"])

    return entries.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys, "list", "chunk", "side").mapInArrow(tidied(compare), "query_id long, vec_id long, score double")
