"""Sinks: the findings report (S5) and table materialisation."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def write_findings(findings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the findings table as parquet partitioned by ``rule_id``.

    Rows are rebalanced by rule first: files get a useful size, and a rule with a huge share of the
    findings is split over several tasks.
    """
    (findings.hint("rebalance", "rule_id").sortWithinPartitions("rule_id", "doc_id", "line_no")
     .write.mode(mode).partitionBy("rule_id").parquet(path))


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whichever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a materialised table, oldest first: those whose write has left its mark of success."""
    where, fs = _folder(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    numbers = sorted(int(n[1:]) for n in names if re.fullmatch(r"v\d+", n))
    return [n for n in numbers if fs.exists(_folder(spark, f"{_version(path, n)}/_SUCCESS")[0])]


def _version(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/v{number:012d}"


def read_materialized(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version at ``path``."""
    have = versions(spark, path)
    if not have:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(_version(path, have[-1]))


def materialize(df: DataFrame, path: str, table: str | None = None, tags: Iterable[str] = (), keep: int = 2) -> DataFrame:
    """Store a model as a table (``materialized='table'``) and return it read back.

    Every call writes a new version into a folder of its own below ``path`` (a shared folder on a cluster), and only a
    complete one becomes current: readers never see a half-written table, a failed write leaves the old one, and a model may
    read the table that it replaces. The newest ``keep`` versions stay for readers that have begun. With ``table`` the version is
    also put into the catalog, by a change of location where the columns are the same, and ``tags`` become a table property.
    """
    spark = df.sparkSession
    target = urlparse(path).path.rstrip("/") + "/"
    own = [urlparse(f).path.removeprefix(target) for f in df.inputFiles() if urlparse(f).path.startswith(target)]
    if any(not re.match(r"v\d+/", f) for f in own):
        raise ValueError(f"{path} holds files of no version that the model reads")
    where, fs = _folder(spark, path)
    taken = [int(s.getPath().getName()[1:]) for s in fs.listStatus(where) if re.fullmatch(r"v\d+", s.getPath().getName())] if fs.exists(where) else []
    number = max(taken, default=0) + 1
    df.write.mode("errorifexists").parquet(_version(path, number))
    back = spark.read.parquet(_version(path, number))
    if table:
        _switch(spark, table, _version(path, number), back)
        tag_text = ",".join(tags).replace("\\", "\\\\").replace("'", "\\'")
        if tag_text:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('tags' = '{tag_text}')")
    for old in versions(spark, path)[:-max(keep, 1)]:
        fs.delete(_folder(spark, _version(path, old))[0], True)
    return spark.table(table) if table else back


def _switch(spark: SparkSession, table: str, location: str, data: DataFrame) -> None:
    """Point a catalog table at a complete version."""
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == data.schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=location, source="parquet")
