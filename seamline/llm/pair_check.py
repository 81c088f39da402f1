"""Exact overlaps of pairs of documents' sets.

Texts meet the pairs that they are wanted for, their sets are made after that, and only those are dealt to where they are
compared. The members of a node that many pairs share are dealt to blocks of ``BLOCK`` pairs, each of which gets that
node's set once, so no task holds all pairs of a node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bbit_minhash import Shingler
from .common import releasing

BLOCK = 256


def overlaps(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``a, b, na, nb, both, lacks, adds`` of every pair (a, b) of nodes: the sizes of their sets of ``words``-word shingles, of
    what both hold, and what a lacks of b and adds to it. ``texts``: ``node, text``."""
    fans = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    left = pairs.select("a", "b").join(fans, "b").select(
        F.col("a").alias("node"), F.col("b").alias("unit"), F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("side"))
    right = fans.select(F.col("b").alias("node"), F.col("b").alias("unit"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"))
    asked = left.unionByName(right)
    met = texts.join(asked, "node").select("unit", "block", "side", "node", "text").mapInArrow(
        releasing(_with_sets(words)), "unit long, block int, side int, node long, shingles binary")
    dealt = met.repartition("unit", "block").sortWithinPartitions("unit", "block", "side")
    return dealt.mapInArrow(releasing(_compare), "a long, b long, na int, nb int, both int, lacks binary, adds binary")


def _with_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                flat, ends = shingler.sets(batch.column("text"))
                raw = flat.tobytes()
                sets = pa.array([raw[8 * a:8 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], sets], [*batch.schema.names[:4], "shingles"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit, block and side: the set of side 0 with each after it."""
    shared = np.empty(0, np.uint64)
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            rows = []
            for unit, side, node, raw in zip(*[batch.column(c).to_pylist() for c in ("unit", "side", "node", "shingles")]):
                x = np.frombuffer(raw, np.uint64)
                if side == 0:
                    shared = x
                    continue
                to = np.searchsorted(shared, x)
                held = np.zeros(len(x), bool)
                inside = to < len(shared)
                held[inside] = shared[to[inside]] == x[inside]
                left = np.ones(len(shared), bool)
                left[to[held]] = False
                rows.append((node, unit, len(x), len(shared), int(held.sum()), shared[left].tobytes(), x[~held].tobytes()))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 2 + [pa.int32()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["a", "b", "na", "nb", "both", "lacks", "adds"])


def overlaps_by_deltas(pairs: DataFrame) -> DataFrame:
    """``a, b, na, nb, both`` of pairs whose sets were both compared with the same third set of ``size`` elements.

    Rows ``a, b, size, a_lacks, a_adds, b_lacks, b_adds``: what the two share is the third set without what either
    lacks, and what both add to it.
    """
    return pairs.mapInArrow(releasing(_derive), "a long, b long, na int, nb int, both int")


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for size, *deltas in zip(*[batch.column(c).to_pylist() for c in ("size", "a_lacks", "a_adds", "b_lacks", "b_adds")]):
            a_lacks, a_adds, b_lacks, b_adds = (np.frombuffer(d, np.uint64) for d in deltas)
            gone = len(a_lacks) + len(b_lacks) - len(np.intersect1d(a_lacks, b_lacks, assume_unique=True))
            more = len(np.intersect1d(a_adds, b_adds, assume_unique=True))
            rows.append((size - len(a_lacks) + len(a_adds), size - len(b_lacks) + len(b_adds), size - gone + more))
        cols = list(zip(*rows)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *[pa.array(c, pa.int32()) for c in cols]],
                                         ["a", "b", "na", "nb", "both"])
