"""Conversations as a stream (an addition of this engine): new files become batches and terms once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from termloom.operators.provider import Provider, RuleProvider
from termloom.plans.run import offline
from termloom.sources.corpus import conversation_pairs

SCHEMA = "conv_id long, turn long, role string, text string"


def stream_terms(spark: SparkSession, path: str, out: str, checkpoint: str, make: Callable[[], Provider] = RuleProvider, available_now: bool = True) -> StreamingQuery:
    """Read conversation files as they come; each micro-batch is written under its own number, so a replay overwrites itself."""

    def each(part: DataFrame, number: int) -> None:
        pairs = conversation_pairs(part).selectExpr("cast(conv_id as string) as file", "cast(turn + 1 as int) as pos", "src", "tgt")
        offline(pairs, make).terms.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(SCHEMA).option("pathGlobFilter", "*.parquet").parquet(path)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
