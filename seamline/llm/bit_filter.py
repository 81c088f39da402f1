"""A fixed number of bits that tells most numbers outside a table from those in it.

It drops rows before they are exchanged for a join. Its size does not grow: with more numbers than bits it lets
through more rows, and the join decides as before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import releasing

PART = 1 << 16  # bytes


def _place(numbers: np.ndarray, bits: int) -> np.ndarray:
    x = numbers.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def bits_of(numbers: DataFrame, bits: int) -> Broadcast:
    """The filter of a frame of one long column: ``1 << bits`` bits, sent to all executors."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            at = _place(np.asarray(batch.column(0)), bits)
            np.bitwise_or.at(marks, at >> 3, (1 << (at & 7)).astype(np.uint8))
        parts = marks.reshape(-1, min(PART, len(marks)))
        have = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in have], pa.binary())], ["part", "marks"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marks = np.frombuffer(zlib.decompress(marks), np.uint8)
                sums[part] = sums[part] | marks if part in sums else marks
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(s.tobytes(), 1) for s in sums.values()], pa.binary())],
                                         ["part", "marks"])

    schema = "part int, marks binary"
    out = np.zeros(1 << bits - 3, np.uint8)
    parts = out.reshape(-1, min(PART, len(out)))
    for row in numbers.mapInArrow(releasing(mark), schema).repartition("part").mapInArrow(releasing(together), schema).collect():  # a row per part of the filter
        parts[row["part"]] = np.frombuffer(zlib.decompress(row["marks"]), np.uint8)
    return numbers.sparkSession.sparkContext.broadcast(out.tobytes())


def may_hold(marks: bytes, numbers: np.ndarray) -> np.ndarray:
    """False where a number is certainly not in the table."""
    held = np.frombuffer(marks, np.uint8)
    at = _place(numbers, len(held).bit_length() + 2)
    return held[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def held_rows(df: DataFrame, column: str, marks: Broadcast) -> DataFrame:
    """The rows whose ``column`` may be in the filter's table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marks.value, np.asarray(batch.column(column)))))

    return df.mapInArrow(releasing(run), df.schema)
