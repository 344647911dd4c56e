"""Session and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders of local sessions that were started without one.
_OWN: dict[str, str] = {}


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "tidemark") -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the cluster's own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A local session, whose executors share its disk, gets one folder of its own where
    that is unset; the setting can't be changed once a session runs.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        root = _OWN[context.applicationId]
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to scratch space and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A handful of driver-side rows as one partition, not one per core of the cluster."""
    return spark.createDataFrame(rows, schema).coalesce(1)
