"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcast guard: a side is broadcast only when its row count is checked to
# be under this bound (dimension tables, policy rows, decided request keys).
BROADCAST_ROW_LIMIT = 1_000_000


def get_spark(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Local/test session. A running session, or the one of a submitted application, is used as it is.

    ``master`` asks for a session of one's own; SPARK_MASTER (local[8]) names it where nothing else does.
    """
    builder = SparkSession.builder.appName("wardlake")
    # spark-submit starts the JVM, with the submitter's master and settings, and hands its port to Python
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    if master is None and (submitted or SparkSession.getActiveSession() is not None):
        return SparkSession.builder.getOrCreate()
    builder = (
        builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    The session setting wins; only when it is unset (local tests) a folder is
    made under /tmp and registered, so later calls see the same value. The
    text is kept with its scheme (``file:``, ``hdfs:``), which names the file
    system; without one it is the session's default file system.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        d = tempfile.mkdtemp(prefix="wardlake-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-reused location under the shared folder for a written table."""
    return f"{shared_dir(spark)}/wardlake/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage"):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result survives executor loss (nothing upstream is replayed), its
    plan is a plain scan, and its size is known to AQE from the files. One
    compute + write, unlike an RDD checkpoint that computes twice when the
    input is not persisted.
    """
    spark = spark or df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # the schema is known: no job to read it from the files
