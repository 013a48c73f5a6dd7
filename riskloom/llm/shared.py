"""Lineage cuts and scratch tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the folder that the context already has.

    Raises where neither is set: a machine-local folder would be seen by one
    machine only.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = f"file:///tmp/riskloom-checkpoints-{uuid.uuid4().hex}"  # one process, one machine
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder where nothing is; it goes with the enclosing ``scratch``."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


def stored(df: DataFrame, name: str, most: int = 0) -> DataFrame:
    """Write ``df`` as Parquet under a fresh shared folder and read it again.

    Compressed columns, so cheaper on disk than a checkpoint of the same rows.
    ``most``: rows a file holds at most, for rows so long that a file's worth of them fills an
    executor: a file's rows are written from memory, and read into it, many at once.
    """
    path = fresh(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", most).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["stored_at"] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    _delete(df.sparkSession, df.__dict__["stored_at"])


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that ``stored`` writes in this block when it ends.

    The block gets a function that keeps a stored table, which whatever is
    returned and still to be computed must read. An enclosing block then owns
    it.
    """
    mine: list[str] = []
    kept: list[str] = []
    token = _SCOPE.set(mine)
    try:
        yield lambda df: kept.append(df.__dict__["stored_at"])
    finally:
        _SCOPE.reset(token)
        if (outer := _SCOPE.get()) is not None:
            outer.extend(kept)
        for path in set(mine) - set(kept):
            _delete(spark, path)
