"""How often runs of words occur in a corpus, counted in hashed cells of a fixed number."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.common import tidied
from termloom.llm.wordhash import WordHasher, shingles

#: Cells of the sketch (as a power of two) and cells of one of its rows.
CELLS, ROW = 22, 4096


def sketch(docs: DataFrame, k: int, lower: bool) -> np.ndarray:
    """Levels of the occurrences of all shingles in 2**CELLS hashed cells: rows are summed in tasks and then across them."""
    rows = 1 << CELLS - ROW.bit_length() + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, hasher = np.zeros(1 << CELLS, np.uint32), WordHasher(lower)
        for batch in batches:
            for _, words in hasher.texts(batch.column(0)):
                np.add.at(cells, (shingles(words, k) >> np.uint64(64 - CELLS)).astype(np.int64), np.uint32(1))
        yield from emit(cells.reshape(rows, ROW), range(rows))

    def emit(cells, which) -> Iterator[pa.RecordBatch]:
        full = [i for i in which if cells[i].any()]
        for a in range(0, len(full), 256):
            some = full[a : a + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([cells[i].astype(np.min_scalar_type(cells[i].max())).tobytes() for i in some], pa.binary())], ["row", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = numbers(cells.as_buffer()).astype(np.uint64)
                sums[row] = sums[row] + counts if row in sums else counts
        top = np.uint64(0xFFFFFFFF)
        yield from emit({i: np.minimum(c, top).astype(np.uint32) for i, c in sums.items()}, sorted(sums))

    schema = "row int, cells binary"
    out = np.zeros((rows, ROW), np.uint32)
    for r in docs.select("text").mapInArrow(tidied(count), schema).repartition("row").mapInArrow(tidied(add), schema).toLocalIterator():
        out[r["row"]] = numbers(r["cells"])
    return levels_of(out.reshape(-1))


def numbers(row: bytes) -> np.ndarray:
    """A row's counts, written with as many bytes each as its largest needs."""
    return np.frombuffer(row, f"u{memoryview(row).nbytes // ROW}")


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Counts as sixteenths of powers of two: no large count is cut off, so what is frequent stands out at any size."""
    return np.floor(16 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint16)


def rarest_first(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sort keys by the level of the cell's count, then by the hash."""
    return levels[(hashes >> np.uint64(64 - CELLS)).astype(np.int64)].astype(np.uint64) << np.uint64(54) | hashes >> np.uint64(10)
