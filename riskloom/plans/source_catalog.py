"""Catalogued scans: files that Spark writes from the tables with the sinks, and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.functions.vocab import DRUG_COLUMNS
from riskloom.operators import split as S
from riskloom.plans.cohort_catalog import cohort_df
from riskloom.plans.leaderboard_catalog import _RUNS, runs_df
from riskloom.plans.model_catalog import _SPLIT_SQL
from riskloom.plans.registry import query
from riskloom.session import checkpoint_dir
from riskloom.sources import files as FS
from riskloom.sources.fixtures import cte, view


def _place(spark, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_OWN = ["encounter_id", "patient_nbr", "race", "age", "admission_type_id", "diag_1", "diag_2", "max_glu_serum", "a1cresult", "metformin", "readmitted"]


@query("scan_encounters", cte("encounters") + f"select {', '.join(_OWN)} from encounters")
def q_scan_encounters(spark, sf):
    """The encounters as a CSV file of the study's columns in another order, read back by header name."""
    e = view(spark, sf, "encounters")
    have = {c.lower(): c for c in e.columns}
    drug = {d.replace("-", "_"): d for d in DRUG_COLUMNS}
    names = [f.name for f in FS.encounter_schema().fields][::-1]
    out = e.select(*[(F.col(have[n.lower().replace("-", "_")]) if n.lower().replace("-", "_") in have else F.lit("No")).alias(drug.get(n, n)) for n in names])
    path = _place(spark, "encounters-csv")
    FS.sink_csv(out, path)
    return FS.scan_encounters(spark, path).select(*_OWN)


@query("scan_id_list", _SPLIT_SQL + "\nselect row_id, y_30d from s2 where split = 'test'")
def q_scan_id_list(spark, sf):
    """Test ids and labels of the split, written by ``sink_split_ids`` and read back for one split only."""
    path = _place(spark, "split-ids")
    FS.sink_split_ids(S.split_stratified(cohort_df(spark, sf, []).select("row_id", "y_30d"), "row_id", "y_30d"), path)
    return FS.scan_id_list(spark, path).where("split = 'test'").select("row_id", "y_30d")


@query("scan_chunks", cte("responses") + """select row_id, prompt_format, response, cast(null as double) as parsed_p, concat('chunk_id=', chunk_id) as chunk
from responses""")
def q_scan_chunks(spark, sf):
    """Response caches, a folder for each chunk, read together with the chunk each row came from."""
    path = _place(spark, "chunks")
    r = view(spark, sf, "responses").withColumn("parsed_p", F.lit(None).cast("double"))
    r.select("row_id", "prompt_format", "response", "parsed_p", "chunk_id").write.partitionBy("chunk_id").parquet(path)
    return FS.scan_chunks(spark, path).select("row_id", "prompt_format", "response", "parsed_p", F.regexp_extract("file", "(chunk_id=[0-9]+)", 1).alias("chunk"))


def _states(spark, sf) -> str:
    """A session state for each phase of the run log, as JSON files."""
    runs = runs_df(spark, sf).where("status <> 'pending'")
    entry = F.struct("seq", F.struct("id", "phase", "cohort", "status", "metric_value").alias("r"))
    state = runs.groupBy("phase").agg(F.sort_array(F.collect_list(entry)).alias("h"))  # a test file's few hundred entries, as in a session
    state = state.select(F.col("phase").alias("scope_slug"), F.create_map(F.lit("phase"), F.array("phase"), F.lit("size"), F.array(F.lit("s"), F.lit("m"))).alias("axes"),
                         F.expr("transform(h, x -> struct(x.r.id as id, map('phase', x.r.phase, 'cohort', x.r.cohort) as axes, x.r.status as status, x.r.metric_value as metric_value))").alias("results_history"),
                         F.expr("transform(slice(h, 1, 2), x -> struct(x.r.id as id, map('lr', '0.1') as params, map('auc', x.r.metric_value) as metrics))").alias("hpo_runs"))
    path = _place(spark, "states")
    state.write.option("maxRecordsPerFile", 1).json(path)  # a file for each state
    return path


@query("scan_session_state", _RUNS + """select phase as scope_slug, (row_number() over (partition by phase order by seq) - 1)::INT as seq, id, phase, cohort, status, metric_value
from rr where status <> 'pending'""")
def q_scan_session_state(spark, sf):
    t = FS.scan_session_tables(spark, _states(spark, sf))["results"]
    return t.select("scope_slug", "seq", "id", F.col("axes")["phase"].alias("phase"), F.col("axes")["cohort"].alias("cohort"), "status", "metric_value")


@query("session_axes", _RUNS + """, p as (select distinct phase from rr where status <> 'pending')
select phase as scope_slug, 0 as axis_pos, 'phase' as axis, 0 as value_pos, phase as value, phase = 'PROMO' as scope_ok from p
union all select phase, 1, 'size', 0, 's', phase = 'PROMO' from p union all select phase, 1, 'size', 1, 'm', phase = 'PROMO' from p""")
def q_session_axes(spark, sf):
    """Declared axes of every state, and whether the state is of the scope asked for."""
    t = FS.scan_session_tables(spark, _states(spark, sf), scope="PROMO")
    ok = t["files"].where("readable").select("scope_slug", "scope_ok")
    return t["axes"].join(ok, "scope_slug").select("scope_slug", "axis_pos", "axis", "value_pos", "value", "scope_ok")
