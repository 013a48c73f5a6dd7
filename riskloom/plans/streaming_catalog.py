"""Catalogued streaming re-aims: incremental collection equals batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.plans.feature_catalog import _sql_parse_prob
from riskloom.plans.registry import query, r6
from riskloom.session import checkpoint_dir
from riskloom.sources.fixtures import cte, view
from riskloom.streaming.collect import stream_collect, stream_coverage


JOBS = 64  # chunk jobs of the array


def _write_chunks(spark, sf, root):
    """The responses cache as the chunk jobs would leave it, one folder and file per job, and a rerun of all errors, read leniently.

    The chunks are dealt out to a fixed number of jobs: more rows make larger files, not more of them.
    """
    r = view(spark, sf, "responses").withColumn("parsed_p", T.parse_prob("response"))
    columns = ["row_id", "prompt_format", "response", "parsed_p", "chunk_id"]
    src = f"{root}/chunks"
    dealt = r.select(*columns).withColumn("chunk_id", F.pmod("chunk_id", F.lit(JOBS))).repartition(JOBS, "chunk_id")
    dealt.write.mode("overwrite").partitionBy("chunk_id").parquet(src)
    again = r.where(F.col("response").startswith("Error")).withColumn("parsed_p", T.parse_prob("response", strict=False))
    again.select(*columns[:-1]).write.mode("overwrite").parquet(f"{src}/rerun")
    return src


# stream = batch: the later files hold the rerun, so its rows are kept
_LAST = f"case when starts_with(response, 'Error') then {_sql_parse_prob('response', False)} else {_sql_parse_prob('response', True)} end"


@query("stream_collect", cte("responses") + f"select row_id, prompt_format, {_LAST} as parsed_p from responses")
def q_stream_collect(spark, sf):
    """File-stream collector (availableNow, checkpointed) over all chunk files;
    returns the collected table: one row per (row_id, prompt_format)."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-collect-{uuid.uuid4().hex}"
    src = _write_chunks(spark, sf, root)
    return stream_collect(spark, src, f"{root}/out", f"{root}/ckpt", max_files_per_trigger=16).select("row_id", "prompt_format", "parsed_p")


@query("stream_coverage", cte("responses") + f"""select prompt_format, count(*)::BIGINT as n, count(p)::BIGINT as n_valid,
  {r6('count(p) * 1.0e0 / count(*)')} as coverage from (select prompt_format, {_LAST} as p from responses) x group by prompt_format""")
def q_stream_coverage(spark, sf):
    """Coverage per format from the collected keep-last table."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-cov-{uuid.uuid4().hex}"
    src = _write_chunks(spark, sf, root)
    return stream_coverage(spark, src, f"{root}/out", f"{root}/ckpt", max_files_per_trigger=16)
