"""Connected components of links between long ids, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import materialise, tidied


def local_forest(links: DataFrame) -> DataFrame:
    """Links (a, b) of the same components, at most one for each id of a partition's batches.

    Each task joins what it sees; nothing is lost, and links that repeat what
    others say fall away before any shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.asarray(batch.column(i)) for i in (0, 1))
            ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            x, y = at[: len(a)], at[len(a) :]
            label = np.arange(len(ids))
            while True:  # hook roots onto smaller ones, then shorten all paths
                lx, ly = label[x], label[y]
                low = np.minimum(lx, ly)
                before = label.copy()
                np.minimum.at(label, lx, low)
                np.minimum.at(label, ly, low)
                while True:
                    shorter = label[label]
                    if (shorter == label).all():
                        break
                    label = shorter
                if (label == before).all():
                    break
            move = label != np.arange(len(ids))
            if move.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[move]), pa.array(ids[label[move]])], ["a", "b"])

    return links.mapInArrow(tidied(run), "a long, b long")


def _with(links: DataFrame, low: DataFrame) -> DataFrame:
    """links with the m of their a; by the complement of a, as rows already grouped by a would all stay in its one task."""
    key = lambda df: df.withColumn("_key", F.bitwise_not("a"))
    return key(links).join(key(low).drop("a"), "_key").drop("_key")


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, component) for every id in links (a, b); the component is its smallest id.

    Every round's links are written to the shared folder, so lost executors cost
    no more than a round.  Minima are aggregated before the shuffle and joined
    back on a key that both sides are dealt out by anew, so the links of an id
    that has very many may be split over tasks.
    """
    links = materialise(local_forest(links).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _with(both.where("b > a"), low).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = local_forest(large).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _with(large, low).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        links = materialise(small.distinct(), f"{name}-links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.countDistinct("a")).first()
        if now[0] == now[2] and now == mark:
            break
        mark = now
    tops = links.select(F.col("b").alias("id")).distinct().join(links.select(F.col("a").alias("id")), "id", "left_anti")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops.select("id", F.col("id").alias("component")))
