"""Session helper: the settings every job and test here relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.conf import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "vocalstat",
    driver_memory: str = "8g",
) -> SparkSession:
    """Create (or reuse) a session; whatever the launcher has set is kept.

    ``spark-submit`` hands its settings over through SparkConf's defaults. Only
    keys that are unset get a value here, and the local addresses, memory and
    partition count apply to a local master only.
    """
    given = SparkConf()
    wanted = {
        "spark.app.name": app,
        "spark.master": master,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if _is_local(given.get("spark.master", master)):
        wanted |= {
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.memory": driver_memory,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
        }
    builder = SparkSession.builder
    for key, value in wanted.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """One JVM: ``local``, ``local[8]``, ``local[*]``, but not ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a scratch one only on a local master.

    On a cluster every executor must see the folder, so a missing setting is an
    error there rather than a folder on one machine's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="vocalstat-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's folder below the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vocalstat-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "mat", partition_by: Sequence[str] = ()) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet under the checkpoint folder and reading it back.

    Unlike an eager ``checkpoint()`` (which runs the plan once to count and again
    to write), this computes the plan a single time, stores it columnar and
    compressed, and keeps column statistics for the readers. ``partition_by`` columns become
    folders, so that a reader of one value skips the others. ``clear_scratch``
    removes what an application has written this way.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def clear_scratch(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote for this application; call it once its results are stored."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/vocalstat-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
