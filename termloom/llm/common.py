"""What the operators share: reading tables, and plumbing of Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termloom.sources.scratch import discard, materialise

__all__ = ["arrow_map", "discard", "materialise", "only", "table", "tidied"]

#: Rows that a function over Arrow data sees at once: few, as their texts may be long.
ROWS = 1000

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone: extra columns can't clash with an operator's own."""
    return df.select(*[df[n] for n in names])


def tidied(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, and then what it freed goes back to the system: workers live on and run many tasks."""

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return whole


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema) -> DataFrame:
    """mapInArrow with state made once a task: make() returns the function for each slice of ROWS rows."""

    def run(batches: Batches) -> Batches:
        each = make()
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                if (out := each(batch.slice(a, ROWS))) is not None:
                    yield out

    return df.mapInArrow(tidied(run), schema)
