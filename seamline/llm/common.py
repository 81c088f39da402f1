"""Helpers shared by the operators: scratch tables in the cluster's shared folder, and shipping."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where it is unset on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="seamline-llm-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


class Scratch:
    """Tables written once to the shared folder, so that no lost executor makes a job start over.

    A table that a returned DataFrame still reads stays there; the cluster clears the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, tag: str) -> str:
        return f"{self.base}/{tag}"

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        df.write.parquet(self.path(tag))
        return self.spark.read.schema(df.schema).parquet(self.path(tag))

    def drop(self, tag: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(tag))
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def row_id(docs: DataFrame) -> Column:
    """A number for each row of a stored table, the same in every plan that reads it.

    Rows are numbered by their place in the table's files, so a frame whose rows an operation has moved
    has to be written first; it is refused here.
    """
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    moved = re.search(r"^[\s:+-]*(Repartition\w*|Rebalance\w*|Join|Aggregate|Sort|\w*Limit|Window|Sample|Union)\b", plan, re.M)
    if moved:
        raise ValueError(f"write the documents to a table first: their plan has {moved[1]}, and rows are numbered by place")
    return F.monotonically_increasing_id()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster without a shared source folder, install the package on the executors instead.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, have]))


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run inside pass at most ``most`` rows at once to Python; both sides hold a batch of whole texts per task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    if 0 < int(was) <= most:
        yield
        return
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, was)


_HELD: dict[Hashable, Any] = {}


def held_by_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under ``key``, made where it lacks it.

    Workers live on from stage to stage, so one thing is kept at a time: what another operator has left is freed first.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; after it the worker, which waits for its next task, gives its free memory back."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)  # what it held is freed with it
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; elsewhere the memory stays with the worker
        if trim is not None:
            trim(0)

    return wrapped


def text_of(col: str = "text") -> Column:
    """A text column where null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo ``mod`` (0 for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(mod), F.lit(0))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with its columns renamed by place, and those names: no name that an operator adds can clash."""
    names = [f"_column{k}_" for k in range(len(docs.columns))]
    return docs.toDF(*names), names
