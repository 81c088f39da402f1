"""Best-fit packing improved by a swap-based local search.

Documents are tokenised, cut into pieces only where longer than a sequence, and dealt at random to
groups of about ``GROUP_PIECES`` pieces; every group is packed on its own, so the work spreads
over the cluster. The bins that are filled to less than ``REPACKED`` of a sequence are opened again: their pieces
are dealt to new groups and packed once more, until one group holds them all or a round leaves more than half of
its pieces in such bins. Within a group,
best-fit decreasing is followed by a local search over the underfull bins: documents of the
emptiest bin move, or are exchanged one-for-one or two-for-one, into fuller bins whenever that
raises the sum of squared fills, until the bin is empty or nothing helps.

Null text counts as empty (only the end id); repeated rows are packed one by one; a null
``doc_id`` is packed like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_encode import ChunkEncoder
from .common import Scratch, arrow_rows, documents, ship, text_of

CAPACITY = 2048
GROUP_PIECES = 4096
BATCH_DOCS = 1024  # texts passed to a Python worker at once
REPACKED = 15 / 16
FULL_SEQUENCE = 1 << 62  # sequences of one whole piece are numbered from here
PLACED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def _pieces(vocab: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.get(vocab, False)
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                flat, ends = encoder.encode(batch.column(1), end_id)
                sizes = np.diff(ends)
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                begin = ends[doc] + start
                crc = [zlib.crc32(flat[a:a + n]) for a, n in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Best-fit decreasing: bins of indexes into ``lengths``; open bins are found by their free space."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    spaces: list[int] = []  # free spaces that some bin has, sorted
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = lengths[i]
        at = bisect_left(spaces, need)
        if at == len(spaces):
            b, free = len(bins), capacity
            bins.append([])
        else:
            free = spaces[at]
            b = by_free[free].pop()
            if not by_free[free]:
                del by_free[free], spaces[at]
        bins[b].append(i)
        left = free - need
        if left:
            if left not in by_free:
                by_free[left] = []
                insort(spaces, left)
            by_free[left].append(b)
    return bins


def local_search(lengths: list[int], bins: list[list[int]], capacity: int = CAPACITY) -> list[list[int]]:
    """Empty underfull bins by moves and exchanges that raise the sum of squared fills."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    items = [sorted((lengths[i], i) for i in b) for b in bins]

    def give(b: int, a: int, out: list[tuple[int, int]], back: tuple[int, int] | None) -> None:
        for x in out:
            items[b].remove(x)
            insort(items[a], x)
        if back:
            items[a].remove(back)
            insort(items[b], back)
        moved = sum(x[0] for x in out) - (back[0] if back else 0)
        fill[b] -= moved
        fill[a] += moved

    def improve(b: int, others: list[int]) -> bool:
        """One change that takes tokens from bin b to one of the others that is at least as full."""
        own = items[b]
        singles = [[x] for x in dict((x[0], x) for x in reversed(own)).values()]
        # documents of one length are alike: a bin has few lengths, and a pair of each sum is enough
        two = [x for k, x in enumerate(own) if k < 2 or own[k - 2][0] != x[0]]
        pairs = list({x[0] + y[0]: [x, y] for k, x in enumerate(two) for y in two[k + 1:]}.values())
        for out in singles:  # move a document
            for a in others:
                if fill[b] <= fill[a] and fill[a] + out[0][0] <= capacity:
                    give(b, a, out, None)
                    return True
        for out in singles + pairs:  # exchange one or two documents for one
            size = sum(x[0] for x in out)
            for a in others:
                if fill[b] <= fill[a] < capacity:
                    at = bisect_left(items[a], (size - (capacity - fill[a]), -1))
                    if at < len(items[a]) and items[a][at][0] < size:
                        give(b, a, out, items[a][at])
                        return True
        return False

    least = -(-sum(fill) // capacity)
    changed = True
    while changed and sum(f > 0 for f in fill) > least:
        changed = False  # every change raises the sum of squared fills, so this ends
        for b in sorted(range(len(bins)), key=lambda k: (fill[k], k)):
            if not 0 < fill[b] < capacity:
                continue
            others = sorted((a for a in range(len(bins)) if a != b and fill[b] <= fill[a] < capacity), key=lambda a: -fill[a])
            while fill[b] and improve(b, others):
                changed = True
            if not fill[b] and sum(f > 0 for f in fill) <= least:
                break
    return [[i for _, i in b] for b in items if b]


def pack_group(rows: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """Sequence and offset of each piece of a group; ``open`` where the sequence is underfull."""
    rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable").reset_index(drop=True)
    lengths = rows["length"].tolist()
    bins = local_search(lengths, best_fit(lengths, capacity), capacity)
    sequence, offset, fill = (np.empty(len(rows), np.int64) for _ in range(3))
    for k, members in enumerate(bins):
        at = 0
        for i in sorted(members):
            sequence[i], offset[i] = k, at
            at += lengths[i]
        fill[members] = at
    gid = rows["gid"].to_numpy(np.int64)
    return rows.assign(sequence_id=gid * (1 << 32) + sequence, offset=offset, open=fill < REPACKED * capacity)[
        [*PLACED, "uid", "open"]]


def pack_documents(docs: DataFrame, vocab: str, end_id: int, capacity: int = CAPACITY,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "pack")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    cut = rows.mapInArrow(_pieces(vocab, end_id, capacity),
                          "doc_id long, piece int, start long, length long, ids_crc32 long")
    with arrow_rows(spark, BATCH_DOCS):
        pieces = scratch.keep(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = pieces.filter(F.col("length") == capacity).select(
        *PLACED[:5], (F.col("uid") + F.lit(FULL_SEQUENCE)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, number = pieces.filter(F.col("length") < capacity), 0
    left = rest.count()
    while True:
        groups = max(1, -(-left // group_pieces))
        gid = F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(groups)) + F.lit(number)
        packed = scratch.keep(rest.withColumn("gid", gid).groupBy("gid").applyInPandas(
            lambda pdf: pack_group(pdf, capacity),
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, uid long, open boolean"),
            f"packed{number}")
        rest, had, number = packed.filter("open").select(*PLACED[:5], "uid"), left, number + groups
        left = rest.count() if groups > 1 else 0
        if not left or 2 * left > had:
            return placed.unionByName(packed.select(*PLACED))
        placed = placed.unionByName(packed.filter("not open").select(*PLACED))


def op8_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=0)
