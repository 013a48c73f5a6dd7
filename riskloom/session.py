"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskloom") -> SparkSession:
    """Build (or reuse) a session tuned for the operators in this package.

    On a cluster the master, memory and checkpoint directory come from the
    submit configuration; locally we default to ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    elif not os.environ.get("SPARK_MASTER") and not os.environ.get("SPARK_REMOTE"):
        b = b.master("local[*]")
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` from the session (on a cluster it names a
    shared folder), else a directory already registered on the context. Where
    neither is set, a local master (one process) gets a scratch folder; a
    cluster raises, since a machine-local folder would lose rows there.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            d = None
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = f"file:///tmp/riskloom-ckpt-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(d)
    return d


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever store its URI names."""
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder in any store; empty where there is none."""
    p, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_cut(df) -> None:
    """Delete what ``cut_lineage`` stored for ``df``, which cannot be read afterwards."""
    stored = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if stored.isDefined():
        delete_path(df.sparkSession, stored.get())
