"""Session helpers: a local session for tests/bench and lineage cuts that use the
cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "seamline") -> SparkSession:
    """A local session configured like the tests and the bench expect.

    On a cluster, build the session with the cluster's own settings instead; nothing in the
    library depends on these values except that AQE is on.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SEAMLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture costs several JVM round trips per DataFrame call while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it and is refused without it; a local session gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="seamline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


# Rows that a task sorts or hashes after an exchange, at most (but for the lines of one chunk).
ROWS_PER_TASK = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions for an exchange of so many rows, so that a task's memory does not grow with the input.

    None: the session's own number is enough.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    Used between long multi-pass plans; never a machine-local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
