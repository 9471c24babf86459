"""Duplicates by name and by content, overlaps of containers, hashes of batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What separates fields and records in a batch's key, and its length.
UNIT, RECORD, KEY_CHARS = "\x1f", "\x1e", 8


def rank_dedup(files: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first file of each key in the given order; ranks are cut down before the shuffle."""
    return files.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rank = 1").drop("_rank")


def name_conflicts(files: DataFrame, key: str = "basename", content: str = "md5") -> DataFrame:
    """Keys in several containers, and whether their contents differ."""
    return files.groupBy(key).agg(F.count_distinct("container").alias("n_containers"), F.count_distinct(content).alias("n_contents")).where("n_containers > 1").withColumn("kind", F.when(F.col("n_contents") > 1, "content_differs").otherwise("same_content"))


def container_overlap(members: DataFrame, container: str, name: str) -> DataFrame:
    """Pairs of containers that share names: a, b, shared, relation (subset, superset, equal, partial)."""
    have = members.select(F.col(container).alias("c"), F.col(name).alias("k")).distinct()
    sizes = have.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    pairs = have.select(F.col("c").alias("a"), "k").join(have.select(F.col("c").alias("b"), "k"), "k").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    pairs = pairs.join(sizes.select(F.col("c").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("c").alias("b"), F.col("n").alias("n_b")), "b")
    inside, around = F.col("shared") == F.col("n_a"), F.col("shared") == F.col("n_b")
    return pairs.select("a", "b", "shared", F.when(inside & around, "equal").when(inside, "subset").when(around, "superset").otherwise("partial").alias("relation"))


def content_dedup(files: DataFrame, content: Column, name: str) -> DataFrame:
    """files with the digest of their content and the representative: the least name with the same digest.

    The least name is aggregated before the shuffle and joined back, so a content that very many files share is split.
    """
    keyed = files.withColumn("digest", content)
    return keyed.join(keyed.groupBy("digest").agg(F.min(name).alias("representative"), F.count(F.lit(1)).alias("copies")), "digest")


def fan_out(rows: DataFrame, files: DataFrame, digest: str = "digest") -> DataFrame:
    """Rows made for a representative, once for each file of the same content."""
    return files.join(rows, digest)


def collisions(files: DataFrame, out_name: str = "out_name") -> DataFrame:
    """Output names that several files would write; must be empty before a run."""
    return files.groupBy(out_name).agg(F.count(F.lit(1)).alias("n_files"), F.array_sort(F.collect_set("basename")).alias("files")).where("n_files > 1")


def batch_key(pairs: Column) -> Column:
    """Key of an array of struct(pos, src, tgt), in its order."""
    records = F.transform(pairs, lambda p: F.concat_ws(UNIT, p["pos"].cast("string"), p["src"], p["tgt"]))
    return F.substring(F.sha2(F.array_join(records, RECORD), 256), 1, KEY_CHARS)
