"""A session for one machine, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_root: str | None = None


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """Session for tests and measurements. On a cluster the deployment makes the session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder.

    The folder is the one in ``spark.checkpoint.dir``, in which each application has a folder of its
    own that can go when it has ended. Only a session on one machine may go without
    that setting: executors elsewhere would not see a local temporary folder.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="millrace-")
        root = _local_root
    application = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/millrace-{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors cost
    nothing, and later joins see the true size."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
