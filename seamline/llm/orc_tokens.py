"""Token-id tables as ORC files: integer run-length encoding, row indexes, Bloom filters on ids.

``write_tokens`` puts one row per document, in ascending ``doc_id`` order across the files:
``doc_id, part, at, n, ids`` where ``part`` numbers the file, ``at`` counts the ids of the rows
before it in that file and ``n`` its own. ORC encodes the integer columns by run length, keeps minimum and maximum
per row group (``ROW_STRIDE`` rows) and stripe, and a Bloom filter on ``doc_id``; a filter on
``doc_id`` therefore skips stripes and row groups, and stripes are read in parallel by Spark's splits.

Null text counts as empty (only the end id); a null ``doc_id`` sorts first; rows with the same
``doc_id`` keep one row each, ordered by their text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunk_encode import ChunkEncoder
from .common import Scratch, documents, ship, text_of

STRIPE_BYTES = 32 << 20
ROW_STRIDE = 1000
BLOOM_FPP = 0.01
BATCH_TEXTS = 256
SCHEMA = "doc_id long, part int, at long, n long, ids array<int>"


def _encode(vocab: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = ChunkEncoder.get(vocab, True), TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(first, BATCH_TEXTS)
                flat, ends = encoder.encode(batch.column(1), end_id)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(at + ends[:-1]),
                     pa.array(np.diff(ends)), lists], ["doc_id", "part", "at", "n", "ids"])
                at += int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, vocab: str, end_id: int) -> None:
    """Encode whole texts and write them in ascending ``doc_id`` order as ORC files below ``path``."""
    ship(docs.sparkSession)
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("text"))
    (placed.mapInArrow(_encode(vocab, end_id), SCHEMA)
     .write.option("compression", "zstd")
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", ROW_STRIDE)
     .option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP)
     .orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; ``doc_ids`` is pushed down to stripe statistics, row index and Bloom filter."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin([int(d) for d in doc_ids]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ends = np.asarray(lists.offsets)
        flat = np.ascontiguousarray(np.asarray(lists.values), "<i4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "part", "at", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """From the files: ``doc_id, start, n_tokens, ids_crc32`` (start: ids of all documents before it)."""
    tokens = read_tokens(spark, path)
    rows = tokens.select("doc_id", "part", "at", "ids").mapInArrow(
        _digest, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    # one row per file: as many as the writing job had tasks, however long the texts are
    files = tokens.groupBy("part").agg(F.sum("n").alias("ids_in_file"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("ids_in_file").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = Scratch(spark, "op5").path("tokens")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_index(spark, path)
