"""File scans and sinks for the study's artefacts (CSV encounters, chunk
caches, metrics JSON, session state, run text).

Schemas are explicit — codes such as '250.83' or 'V58' must stay strings and
nothing is inferred — and only the empty field is null ('?' and 'None' are
categories).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.vocab import DRUG_COLUMNS


def encounter_schema() -> T.StructType:
    ints = ["admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
            "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
            "number_emergency", "number_inpatient", "number_diagnoses"]
    cols = ([("encounter_id", T.LongType()), ("patient_nbr", T.LongType()), ("race", T.StringType()),
             ("gender", T.StringType()), ("age", T.StringType()), ("weight", T.StringType())]
            + [(c, T.IntegerType()) for c in ints[:3]]
            + [("time_in_hospital", T.IntegerType()), ("payer_code", T.StringType()),
               ("medical_specialty", T.StringType())]
            + [(c, T.IntegerType()) for c in ints[4:]]
            + [("diag_1", T.StringType()), ("diag_2", T.StringType()), ("diag_3", T.StringType()),
               ("max_glu_serum", T.StringType()), ("A1Cresult", T.StringType())]
            + [(d, T.StringType()) for d in DRUG_COLUMNS[:15]]
            + [("examide", T.StringType()), ("citoglipton", T.StringType())]
            + [(d, T.StringType()) for d in DRUG_COLUMNS[15:]]
            + [("change", T.StringType()), ("diabetesMed", T.StringType()), ("readmitted", T.StringType())])
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def scan_encounters(spark: SparkSession, path: str) -> DataFrame:
    """Raw encounter CSV, bound by header name in whatever order the file has its
    columns; '-' in drug names -> '_'. A missing column fails, a further one is ignored."""
    raw = spark.read.option("header", True).option("nullValue", "").option("inferSchema", False).option("mode", "FAILFAST").csv(path)
    own = {c.lower().replace("-", "_"): c for c in raw.columns}
    names = [(f.name.lower().replace("-", "_"), f.dataType) for f in encounter_schema().fields]
    missing = [n for n, _ in names if n not in own]
    if missing:
        raise ValueError(f"columns not in {path}: {missing}")
    return raw.select(*[F.col(f"`{own[n]}`").cast(t).alias(n) for n, t in names])


def scan_id_list(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).option("header", True).load(path)


def scan_chunks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All chunk caches under ``path`` with provenance (file, position in file).

    ``fmt`` csv reads header-bound files; their position is the order of rows
    as one task reads a whole file.
    """
    from riskloom.operators.scoring import CACHE_SCHEMA
    if fmt == "csv":
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        df = raw.select(F.col("row_id").cast("long").alias("row_id"), "prompt_format", "response",
                        F.col("parsed_p").cast("double").alias("parsed_p"))
        return df.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))
    df = spark.read.schema(CACHE_SCHEMA).parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"))


METRICS_SCHEMA = ("config string, auc double, ci_lo double, ci_hi double, runtime_sec double, "
                  "n_test long, extra map<string,string>")


def scan_metrics_json(spark: SparkSession, glob: str) -> DataFrame:
    """``*/metrics.json`` files -> one row each, with the run directory name."""
    df = spark.read.schema(METRICS_SCHEMA).option("multiLine", True).json(glob)
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("run_dir"))


SESSION_SCHEMA = ("scope_slug string, target_metric string, axes map<string,array<string>>, "
                  "results_history array<struct<id:string, axes:map<string,string>, status:string, "
                  "metric_value:double, ci_lo:double, ci_hi:double, runtime_sec:double, notes:string>>, "
                  "candidate_queue array<struct<id:string, status:string, params:map<string,string>>>, "
                  "hpo_runs array<struct<id:string, params:map<string,string>, metrics:map<string,double>>>")


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path that exists, in whatever store; raises with all of them if none does."""
    from riskloom.session import path_exists
    for p in paths:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError("no session state; looked in " + ", ".join(paths))


def _states(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL(SESSION_SCHEMA).add("_broken", "string")
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    return raw.select("*", F.col("_metadata.file_path").alias("file"))


def scan_session_state(spark: SparkSession, path: str) -> DataFrame:
    """Session state JSON -> one row per results-history entry (seq = position)."""
    return _states(spark, path).select(F.posexplode("results_history").alias("seq", "r")).select("seq", "r.*")


def scan_session_tables(spark: SparkSession, path: str, scope: str | None = None) -> dict[str, DataFrame]:
    """One or many session states (files of nested JSON) as tables, each with its ``file`` and ``scope_slug``:

    * ``files``: ``readable`` (a broken file is a row here and nowhere else), ``scope_ok``
      (false where the state names another scope than ``scope``; no name is no contradiction);
    * ``axes``: axis, value, value_pos; Spark's maps keep the file's order of axes, axis_pos;
    * ``results``: seq and the entry; ``queue``: pos, id, status, params;
    * ``hpo``: pos, id, kind (param or metric), name, value as text.

    A missing list has no rows.
    """
    s = _states(spark, path)
    own = ["file", "scope_slug"]
    files = s.select(*own, F.col("_broken").isNull().alias("readable"),
                     F.lit(True).alias("scope_ok") if scope is None else
                     (F.coalesce("scope_slug", F.lit("")).isin("", scope)).alias("scope_ok"))
    good = s.where(F.col("_broken").isNull())
    axes = good.select(*own, F.posexplode(F.map_entries("axes")).alias("axis_pos", "e")).select(
        *own, "axis_pos", F.col("e.key").alias("axis"), F.posexplode("e.value").alias("value_pos", "value"))
    results = good.select(*own, F.posexplode("results_history").alias("seq", "r")).select(*own, "seq", "r.*")
    queue = good.select(*own, F.posexplode("candidate_queue").alias("pos", "r")).select(*own, "pos", "r.*")
    of = good.select(*own, F.posexplode("hpo_runs").alias("pos", "r")).select(*own, "pos", "r.id", "r.params", "r.metrics")
    named = [of.select(*own, "pos", "id", F.lit(kind).alias("kind"), F.explode(c).alias("name", "value")).withColumn("value", F.col("value").cast("string"))
             for kind, c in (("param", "params"), ("metric", "metrics"))]
    return {"files": files, "axes": axes, "results": results, "queue": queue, "hpo": named[0].unionByName(named[1])}


def scan_run_text(spark: SparkSession, glob: str) -> DataFrame:
    """Per-run summary text: iteration and candidate from the directory name
    ``iter-N_name``, metric/status lines ('—' when missing)."""
    from riskloom.operators.docs import extract_line_value
    t = spark.read.text(glob, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    d = F.regexp_extract("path", r"/iter-(\d+)_([^/]+)/[^/]+$", 0)
    return t.where(d != "").select(
        F.regexp_extract("path", r"/iter-(\d+)_([^/]+)/[^/]+$", 1).cast("int").alias("iter"),
        F.regexp_extract("path", r"/iter-(\d+)_([^/]+)/[^/]+$", 2).alias("candidate"),
        extract_line_value("value", "metric").alias("metric"),
        extract_line_value("value", "status").alias("status"),
        F.col("value").alias("summary"))


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sink_split_ids(df: DataFrame, path: str, key: str = "row_id", label: str = "y_30d") -> None:
    """Persist (row_id, y, split) so later stages score exactly the same rows."""
    df.select(key, label, "split").write.mode("overwrite").partitionBy("split").parquet(path)
