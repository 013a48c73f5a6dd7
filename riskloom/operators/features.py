"""Pre-vector feature columns and sparse long-form one-hot / interaction features.

The long form ``(row_id, feature, value)`` is what a distributed pipeline
needs at scale: only non-zero entries exist, the level vocabulary never
passes through the driver, and "drop first level" is an aggregate (min level
per column) joined back as a one-row broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.codes import icd9_bucket
from riskloom.functions.vocab import (ACTIVE_DRUGS, ADMISSION_SOURCE_BUCKETS, AGE_MIDPOINTS,
                                      DISCHARGE_BUCKETS, DRUG_COLUMNS, SPECIALTY_BUCKETS)
from riskloom.operators.cohort import normalize_col
from riskloom.operators.lookup import lookup

# fixed values: the study's feature columns
BASE_NUMERIC = ("age_midpoint", "time_in_hospital", "num_lab_procedures", "num_procedures",
                "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
                "number_diagnoses")
BASE_CATEGORICAL = ("race", "gender", "age", "admission_type_id", "discharge_disposition_id",
                    "admission_source_id", "payer_code", "medical_specialty", "max_glu_serum",
                    "a1cresult", "change", "diabetesmed")
LOG1P_COLS = ("number_outpatient", "number_emergency", "number_inpatient",
              "num_lab_procedures", "num_medications")
SLIM_NUMERIC = ("age_midpoint", "time_in_hospital", "num_procedures", "number_diagnoses",
                "num_drugs_active", "num_drugs_changed", "num_lab_procedures_log1p",
                "num_medications_log1p", "number_outpatient_log1p", "number_emergency_log1p",
                "number_inpatient_log1p")
SLIM_CATEGORICAL = ("race", "gender", "admission_type_id", "discharge_bucket", "adm_source_bucket",
                    "specialty_bucket", "max_glu_serum", "a1cresult", "change", "diabetesmed",
                    "diag_1_bucket", "diag_2_bucket", "diag_3_bucket")


def drug_col(name: str) -> str:
    return name.replace("-", "_")


def row_count_if(df: DataFrame, cols: Sequence[str] = DRUG_COLUMNS) -> DataFrame:
    """Per row: # drugs not 'No' and # drugs Up/Down. A null drug is active and not changed.

    Counted over an array: spelled out, the projection of all features becomes one Java method too long
    to be compiled by the JVM, and takes four times as long.
    """
    drugs = F.array(*[F.col(drug_col(c)) for c in cols])
    active = F.size(F.filter(drugs, lambda d: F.coalesce(d != "No", F.lit(True))))
    changed = F.size(F.filter(drugs, lambda d: F.coalesce(d.isin("Up", "Down"), F.lit(False))))
    return df.withColumn("num_drugs_active", active).withColumn("num_drugs_changed", changed)


def with_diag_buckets(df: DataFrame) -> DataFrame:
    for j in (1, 2, 3):
        df = df.withColumn(f"diag_{j}_bucket", icd9_bucket(f"diag_{j}"))
    return df


# fixed value: the codes of many levels that are target-encoded
TE_COLUMNS = ("diag_1", "diag_2", "diag_3", "medical_specialty", "payer_code")
DRUGS = tuple(drug_col(d) for d in DRUG_COLUMNS)
NATIVE_CATEGORICAL = (*BASE_CATEGORICAL, "diag_1", "diag_2", "diag_3", *DRUGS)
LOW_CATEGORICAL = tuple(c for c in (*BASE_CATEGORICAL, *DRUGS) if c not in TE_COLUMNS)
DIAG_BUCKETS = ("diag_1_bucket", "diag_2_bucket", "diag_3_bucket")


def features_base(cohort: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pre-vector base features: 9 numerics (double) + categoricals (string, '?' for null).
    ``keep`` carries extra columns (e.g. a split) through unchanged."""
    x = cohort.withColumn("age_midpoint", lookup("age", AGE_MIDPOINTS).cast("double"))
    x = with_diag_buckets(x)
    return _numbers_and_codes(x, BASE_NUMERIC, (*BASE_CATEGORICAL, *DRUGS, *DIAG_BUCKETS), keep)


def _numbers_and_codes(x: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return x.select("row_id", "y_30d", *keep, *[F.col(c).cast("double").alias(c) for c in numeric],
                    *[F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in categorical])


def features_native_cat(cohort: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pre-vector features for trees on raw codes: base numerics, and every categorical with the
    diagnosis codes themselves instead of their buckets (string, '?' for null)."""
    x = cohort.withColumn("age_midpoint", lookup("age", AGE_MIDPOINTS).cast("double"))
    return _numbers_and_codes(x, BASE_NUMERIC, NATIVE_CATEGORICAL, keep)


def features_slim(cohort: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pre-vector slim features: bucketed ids, drug counts, log1p utilisation, 8 active drugs.
    ``keep`` carries extra columns (e.g. a stratum) through unchanged."""
    x = cohort.withColumn("age_midpoint", lookup("age", AGE_MIDPOINTS).cast("double"))
    x = with_diag_buckets(x)
    x = (x.withColumn("discharge_bucket", lookup("discharge_disposition_id", DISCHARGE_BUCKETS, "Other"))
          .withColumn("adm_source_bucket", lookup("admission_source_id", ADMISSION_SOURCE_BUCKETS, "Other"))
          .withColumn("specialty_bucket", lookup("medical_specialty", SPECIALTY_BUCKETS, "Other")))
    x = row_count_if(x)
    for c in LOG1P_COLS:
        x = x.withColumn(f"{c}_log1p", F.log1p(F.col(c).cast("double")))
    cats = list(SLIM_CATEGORICAL) + list(ACTIVE_DRUGS)
    return x.select("row_id", "y_30d", *keep, *[F.col(c).cast("double").alias(c) for c in SLIM_NUMERIC],
                    *[F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in cats])


def onehot_long(df: DataFrame, key: str, cols: Sequence[str], *, drop_first: bool = True) -> DataFrame:
    """Sparse one-hot ``(key, feature, value=1.0)``; the lexicographically first
    level of each column is dropped (computed by one aggregation)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).cast("string").alias("lvl"))
                                for c in cols]))
    long = df.select(key, pairs.alias("p")).select(key, "p.var", "p.lvl").where(F.col("lvl").isNotNull())
    if drop_first:
        first = long.groupBy("var").agg(F.min("lvl").alias("_first"))
        long = long.join(F.broadcast(first), "var").where(F.col("lvl") != F.col("_first")).drop("_first")
    return long.select(key, F.concat(F.col("var"), F.lit("_"), normalize_col("lvl")).alias("feature"),
                       F.lit(1.0).alias("value"))


def interact_products(df: DataFrame, key: str, a: str, b: str, *, drop_first: bool = True) -> DataFrame:
    """Products of one-hot(a) x one-hot(b), named ``a_lvl__x__b_lvl``.

    Only the row's own level pair can be non-zero, so this is one projection
    per row plus a one-row aggregate (first levels) broadcast back.
    """
    x = df.select(key, F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b")).where(
        F.col("_a").isNotNull() & F.col("_b").isNotNull())
    if drop_first:
        from riskloom.functions.stats import one_row
        firsts = one_row(df.agg(F.min(F.col(a).cast("string")).alias("fa"), F.min(F.col(b).cast("string")).alias("fb")))
        x = x.where((F.col("_a") != firsts["fa"]) & (F.col("_b") != firsts["fb"]))
    name = F.concat(F.lit(a + "_"), normalize_col("_a"), F.lit("__x__" + b + "_"), normalize_col("_b"))
    return x.select(key, name.alias("feature"), F.lit(1.0).alias("value"))


def scale_std(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Divide by the population std (no centring); zero variance -> scale 1.

    The per-column scales are one aggregated row, broadcast back.
    """
    from riskloom.functions.stats import one_row
    sd = one_row(df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(f"sd_{i}") for i, c in enumerate(cols)]))
    return df.select(*keep, *[
        (F.col(c).cast("double") / F.when(sd[f"sd_{i}"] > 0, sd[f"sd_{i}"]).otherwise(1.0)).alias(c)
        for i, c in enumerate(cols)])


def assemble_features(*frames: DataFrame, key: str = "row_id") -> DataFrame:
    """Column-concatenate aligned frames by joining on the durable key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key)
    return out


def features_te(split_cohort: DataFrame, k: int = 5, cols: Sequence[str] = TE_COLUMNS,
                label: str = "y_30d", smoothing: float = 20.0) -> DataFrame:
    """Base numerics + low-cardinality categoricals + target-encoded high-cardinality raw codes.

    Train rows get out-of-fold encodings (folds stratified by label, prior =
    mean over all train); val/test rows use the table learned on all train.
    """
    from riskloom.operators.encode import target_encode_many
    from riskloom.operators.split import kfold_stratified
    x = split_cohort.withColumn("age_midpoint", lookup("age", AGE_MIDPOINTS).cast("double"))
    base = _numbers_and_codes(x, BASE_NUMERIC, LOW_CATEGORICAL, ("split",))
    raw = split_cohort.select("row_id", label, "split", *cols)
    train = kfold_stratified(raw.where(F.col("split") == "train"), "row_id", label, k)
    rest = raw.where(F.col("split") != "train")
    return base.join(target_encode_many(train, rest, cols, label, "fold", s=smoothing), "row_id")
