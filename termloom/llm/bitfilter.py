"""A set of 64-bit hashes as bits of bounded number: what it lets through in error is only more work."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.common import tidied

#: Bits for each hash, least and greatest number of bits as powers of two, and bytes of a row in transit.
BITS_EACH, LEAST, MOST, ROW = 8, 20, 28, 4096


class BitFilter:
    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.shift = bits, np.uint64(64 - (8 * len(bits)).bit_length() + 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bit_filter(hashes: DataFrame, n: int) -> BitFilter:
    """The filter of a table of n hashes (one column of longs); bits are set in tasks and joined by row across them."""
    power = min(MOST, max(LEAST, int(n * BITS_EACH).bit_length()))
    schema = "row int, bits binary"

    def emit(which, table) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(which), 256):
            some = which[a : a + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([table[i].tobytes() for i in some], pa.binary())], ["row", "bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << power - 3, np.uint8)
        for batch in batches:
            at = (np.asarray(batch.column(0)).view(np.uint64) >> np.uint64(64 - power)).astype(np.int64)
            np.bitwise_or.at(bits, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        table = bits.reshape(-1, ROW)
        yield from emit(np.flatnonzero(table.any(axis=1)).tolist(), table)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, bits in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(bits.as_buffer(), np.uint8)
                rows[row] = rows[row] | own if row in rows else own
        yield from emit(sorted(rows), rows)

    out = np.zeros(((1 << power - 3) // ROW, ROW), np.uint8)
    for r in hashes.mapInArrow(tidied(mark), schema).repartition("row").mapInArrow(tidied(merge), schema).toLocalIterator():
        out[r["row"]] = np.frombuffer(r["bits"], np.uint8)
    return BitFilter(out.reshape(-1))
