"""Lint SQL files as they arrive in a folder (Structured Streaming).

Each file is one document; the file source reads it whole (``wholetext``), so every micro-batch
holds complete documents and the batch rules apply unchanged inside ``foreachBatch``. Findings of
batch ``n`` go to ``<out>/batch=<n>`` with overwrite, so a batch that is retried after a failure
replaces its own output instead of duplicating it (the checkpoint records which files were done).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lint import lint_texts


def file_documents(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(src_dir)
    path = F.col("_metadata.file_path")
    return raw.select(path.alias("doc_id"), F.col("value").alias("text"))


def lint_batch(batch: DataFrame, rule_ids: Iterable[str] | None = None) -> DataFrame:
    """Findings of one micro-batch; a document is named by its file path."""
    findings = lint_texts(batch.select("doc_id", "text"), rule_ids)
    return findings.withColumn("path", F.col("doc_id"))


def start_lint_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint_dir: str,
                      rule_ids: Iterable[str] | None = None, available_now: bool = True,
                      processing_time: str = "1 minute") -> StreamingQuery:
    ids = list(rule_ids) if rule_ids is not None else None

    def write(batch: DataFrame, batch_id: int) -> None:
        (lint_batch(batch, ids).sortWithinPartitions("rule_id")
         .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}"))

    writer = file_documents(spark, src_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
