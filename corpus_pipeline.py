"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before it kept as a table in the cluster's shared folder and writes its own, so a
lost executor costs no more than tasks of the running stage. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.bbit_minhash import drop_near_copies
from seamline.llm.block_names import drop_exact_copies
from seamline.llm.common import Scratch, documents
from seamline.llm.secret_scan import redact_live
from seamline.llm.segment_langid import drop_unidentified
from seamline.llm.swap_pack import pack_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, for which no language can be predicted, go."""
    return drop_unidentified(docs, public_tokenizers.path("piece_bpe_32k.model"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id`` stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, similarity 0.8) the smallest ``doc_id`` stays."""
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials and unclear findings are replaced in the texts; widely copied examples and all documents stay."""
    return redact_live(docs).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_pack", best_fit_pack),
]

ORACLE_SQL = None  # SQL expresses neither the language model nor the packing


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
