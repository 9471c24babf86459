"""Which sentences go out, and in which batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.dedup import batch_key

# Planning constants.
BATCH, CONCURRENCY, FULL_CONCURRENCY, SECONDS_PER_BATCH, PER_1000, MARGIN, MOST_HOURS = 10, 8, 40, 42.0, 2.73, 1.5, 3.0


def select_files(files: DataFrame, contains: str | None = None, layer: str | None = None, limit: int | None = None) -> DataFrame:
    """By a part of the name, by layer, and at most so many in order of names."""
    if contains:
        files = files.where(F.col("basename").contains(contains))
    if layer:
        files = files.where(F.col("layer") == layer)
    return files.orderBy("basename").limit(limit) if limit else files


def per_file_limit(sentences: DataFrame, k: int) -> DataFrame:
    return sentences.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("pos"))).where(F.col("_n") <= k).drop("_n")


def stratified_head(sentences: DataFrame, m: int) -> DataFrame:
    """The first m sentences of each layer in the order of files; the rank is cut down before the shuffle."""
    return sentences.withColumn("_n", F.row_number().over(Window.partitionBy("layer").orderBy("file", "pos"))).where(F.col("_n") <= m).drop("_n")


def batches(sentences: DataFrame, size: int = BATCH) -> DataFrame:
    """file, batch_idx, n, batch_key and pairs in order; a batch never spans files."""
    numbered = sentences.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("pos")) - 1).withColumn("batch_idx", F.floor(F.col("_n") / size).cast("int"))
    grouped = numbered.groupBy("file", "batch_idx").agg(F.array_sort(F.collect_list(F.struct("pos", "src", "tgt"))).alias("pairs"))
    return grouped.select("file", "batch_idx", F.size("pairs").alias("n"), batch_key(F.col("pairs")).alias("batch_key"), "pairs")


def auto_budget(sentences: int, size: int = BATCH) -> float:
    """Spend cap in USD for so many sentences."""
    return round(max(1.0, sentences / 1000 * PER_1000 * max(1.0, 10 / size if size else 1.0) * MARGIN), 2)


def eta_hours(n_batches: int, concurrency: int) -> float:
    return n_batches * SECONDS_PER_BATCH / max(1, concurrency) / 3600


def too_slow(n_batches: int, concurrency: int) -> bool:
    """Full runs of many hours below full concurrency don't start."""
    return concurrency < FULL_CONCURRENCY and eta_hours(n_batches, concurrency) > MOST_HOURS
