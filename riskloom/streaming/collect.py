"""Incremental collection of scoring-chunk caches with Structured Streaming.

Chunk jobs drop parquet files into a directory while the array runs; the
collector picks them up as a file stream and keeps, per (row_id, format), the
row from the latest file (then latest position): the same answer as the
batch ``dedupe_keep_last`` over all files. The checkpoint location makes a
restarted collector resume without re-reading committed files.

The collected table lies in ``BUCKETS`` key-hash buckets, each a base and later
deltas. A micro-batch writes its own rows only, as a delta of the buckets it has
keys of. A bucket whose deltas outgrow its base is merged into a new base, so
each row is written a bounded number of times for each doubling of its bucket. What an
epoch consists of is in its manifest (a row for each part of a bucket), written last:
a crash before that leaves the previous epoch intact, and a replayed epoch
starts from the manifest of an earlier one and overwrites its own files. Files
that no manifest in use names can be deleted by ``vacuum``. Paths may be in any store
that Spark reads.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.scoring import CACHE_SCHEMA, dedupe_keep_last, parse_coverage
from riskloom.session import delete_path, list_names, path_exists

KEYS = ["row_id", "prompt_format"]
ORDER = ["file", "pos"]
BUCKETS = 64
TABLE_SCHEMA = f"{CACHE_SCHEMA}, file string, pos long"
PART_SCHEMA = "part string, bucket int, n long, base boolean"


def chunk_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(src_dir)
    return s.select("*", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("pos"))


def _manifest_path(out_dir: str, epoch: int) -> str:
    return f"{out_dir.rstrip('/')}/manifest/v={epoch:010d}"


def _manifest(spark: SparkSession, out_dir: str, before: int | None = None) -> list:
    """Parts of the newest committed epoch, of those before ``before`` if given: a few rows for each bucket."""
    epochs = [int(d[2:]) for d in list_names(spark, f"{out_dir.rstrip('/')}/manifest") if d.startswith("v=")]
    for e in sorted(epochs, reverse=True):
        path = _manifest_path(out_dir, e)
        if (before is None or e < before) and path_exists(spark, f"{path}/_SUCCESS"):
            return spark.read.schema(PART_SCHEMA).json(path).collect()
    return []


def _stored(spark: SparkSession, out_dir: str, parts: Iterable) -> DataFrame:
    """Rows of parts; a key may be in several."""
    paths = sorted({f"{out_dir.rstrip('/')}/data/{p['part']}/bucket={p['bucket']}" for p in parts})
    if not paths:
        return spark.createDataFrame([], TABLE_SCHEMA)
    return spark.read.schema(TABLE_SCHEMA).parquet(*paths)


def _write(rows: DataFrame, out_dir: str, part: str, n_buckets: int, base: bool) -> list[tuple]:
    """Write the last row of each key as a part of its bucket; the manifest rows of it.

    Rows cross the network once: keys are compared where their bucket is written.
    """
    path = f"{out_dir.rstrip('/')}/data/{part}"
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(n_buckets)).cast("int")
    dealt = rows.withColumn("bucket", bucket).repartition("bucket")
    dedupe_keep_last(dealt, ["bucket", *KEYS], ORDER, keep_order=True).write.mode("overwrite").partitionBy("bucket").parquet(path)
    counts = rows.sparkSession.read.schema(f"{TABLE_SCHEMA}, bucket int").parquet(path).groupBy("bucket").count().collect()
    return [(part, r["bucket"], r["count"], base) for r in counts]  # at most a row for each bucket


def upsert(batch: DataFrame, epoch: int, out_dir: str, n_buckets: int = BUCKETS) -> None:
    """Add one micro-batch as epoch ``epoch``; doing so again changes nothing."""
    spark = batch.sparkSession
    parts = [(p["part"], p["bucket"], p["n"], p["base"]) for p in _manifest(spark, out_dir, before=epoch)]
    known = {p[1] for p in parts}
    own = _write(batch, out_dir, f"delta-{epoch:010d}", n_buckets, False)
    parts += [(part, b, n, b not in known) for part, b, n, _ in own]
    size: dict[int, list[int]] = {}
    for _, b, n, base in parts:
        size.setdefault(b, [0, 0])[0 if base else 1] += n
    full = {b for b, (base, deltas) in size.items() if deltas > base}
    if full:
        rows = _stored(spark, out_dir, [{"part": p[0], "bucket": p[1]} for p in parts if p[1] in full])
        parts = [p for p in parts if p[1] not in full] + _write(rows, out_dir, f"base-{epoch:010d}", n_buckets, True)
    spark.createDataFrame(parts, PART_SCHEMA).coalesce(1).write.mode("overwrite").json(_manifest_path(out_dir, epoch))


def stream_collect(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                   max_files_per_trigger: int | None = None, n_buckets: int = BUCKETS) -> DataFrame:
    """Run the collector until all present files are processed; returns the collected table."""
    q = (chunk_stream(spark, src_dir, max_files_per_trigger).writeStream
         .foreachBatch(lambda batch, epoch: upsert(batch, epoch, out_dir, n_buckets)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return collected(spark, out_dir)


def collected(spark: SparkSession, out_dir: str) -> DataFrame:
    """The table of the newest committed epoch: one row for each key, with its ``file`` and ``pos``."""
    return dedupe_keep_last(_stored(spark, out_dir, _manifest(spark, out_dir)), KEYS, ORDER, keep_order=True)


def vacuum(spark: SparkSession, out_dir: str) -> list[str]:
    """Delete parts and manifests that the newest epoch doesn't need, while no collector or reader runs; their names."""
    keep = {p["part"] for p in _manifest(spark, out_dir)}
    root = out_dir.rstrip("/")
    manifests = [d for d in list_names(spark, f"{root}/manifest") if d.startswith("v=")]
    old = [f"data/{d}" for d in list_names(spark, f"{root}/data") if d not in keep] + [f"manifest/{d}" for d in manifests[:-1]]
    for name in old if keep else []:
        delete_path(spark, f"{root}/{name}")
    return old if keep else []


def stream_coverage(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed / total per format after all present chunks, from the keep-last
    table: a retried call counts by its latest response, and no state is held."""
    return parse_coverage(stream_collect(spark, src_dir, out_dir, checkpoint, max_files_per_trigger))
