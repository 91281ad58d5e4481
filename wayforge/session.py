"""Session settings and table loading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session that the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder (tests).

    Where neither is set, only a local master may take a folder of its own; on a cluster executors would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_made: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for tables that a plan reads until its result is written; see clear_work."""
    _made.append(f"{shared_folder(spark)}/wayforge/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def clear_work(spark: SparkSession) -> int:
    """Deletes what this process has written to paths of work_path; to be called when no result that reads them is needed
    any more. The number of paths."""
    jvm, n = spark.sparkContext._jvm, len(_made)
    while _made:
        at = jvm.org.apache.hadoop.fs.Path(_made.pop())
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return n
