"""Cohort construction: label, exclusion filter, column drops, first-per-entity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.vocab import DROP_COLUMNS, EXCLUDED_DISPOSITIONS, YOUNG_AGE_BINS


def label_binary(df: DataFrame, col: str = "readmitted", positive: str = "<30",
                 out: str = "y_30d") -> DataFrame:
    """``out = (col == positive)`` as int; a null source value is a negative."""
    return df.withColumn(out, F.coalesce((F.col(col) == F.lit(positive)).cast("int"), F.lit(0)))


def filter_exclusion_set(df: DataFrame, col: str = "discharge_disposition_id",
                         excluded: Iterable = EXCLUDED_DISPOSITIONS) -> DataFrame:
    """Drop rows whose ``col`` is in ``excluded``; null values are kept.

    A literal IN-list is pushed to the parquet scan as a data filter.
    """
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(excluded)))


def drop_if_present(df: DataFrame, cols: Iterable[str] = DROP_COLUMNS,
                    keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns and c not in keep])


def first_per_entity(df: DataFrame, entity: str, order_by: Sequence[str]) -> DataFrame:
    """One row per ``entity``: the row with the smallest ``order_by`` tuple, nulls first, then the smallest rest.

    The smallest tuples are found first, from their columns alone. Being a filter, the ``exists``
    on them is pushed below the projections of a derived ``df`` (a semi join is not), whose
    other columns are then made for rows of a smallest tuple only, mostly one for each
    entity. It joins on entity and tuple, which spreads the rows of an entity that
    holds a third of all. Among equal tuples ``min(struct(order.., rest..))`` decides, combined
    map-side. ``df`` is read twice, so its keys must not be drawn at random.
    """
    rest = [c for c in df.columns if c != entity and c not in order_by]
    if len(order_by) == 1:  # a number is then aggregated by hash; a struct would be sorted
        o = F.col(order_by[0])
        least = [F.when(~F.max(o.isNull()), F.min(o)).alias("_least")]
    else:
        least = [F.min(F.struct(*order_by)).alias("_least")]
    firsts = df.groupBy(F.col(entity).alias("_entity")).agg(*least).select(F.struct("_entity", "_least").alias("_key"))
    own = [F.col(c).outer() for c in order_by]
    same = F.col("_key") == F.struct(F.col(entity).outer(), own[0] if len(own) == 1 else F.struct(*own))  # structs also equal in their nulls
    packed = F.min(F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest])).alias("_r")
    out = df.where(firsts.where(same).exists()).groupBy(entity).agg(packed)
    return out.select(*[F.col("_r." + c).alias(c) if c != entity else F.col(entity)
                        for c in df.columns])


def cohort_mask(df: DataFrame, col: str = "age", in_bins: Iterable[str] = YOUNG_AGE_BINS,
                in_label: str = "young", out_label: str = "old", out: str = "cohort") -> DataFrame:
    """Two strata by bin membership; everything not in ``in_bins`` (incl. null) is ``out_label``."""
    member = F.coalesce(F.col(col).isin(list(in_bins)), F.lit(False))
    return df.withColumn(out, F.when(member, F.lit(in_label)).otherwise(F.lit(out_label)))


def clean_cohort(df: DataFrame, *, entity: str = "patient_nbr", row_id: str = "encounter_id",
                 dedupe: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """label -> exclusion filter -> drop -> first encounter per patient, in that order.

    The encounter id is kept as the durable ``row_id`` (never a position).
    ``columns`` projects the payload *before* the dedupe shuffle: the winning
    row travels as one struct through the aggregation, and Catalyst cannot
    prune fields out of an aggregate, so name what you need.
    """
    out = label_binary(df)
    out = filter_exclusion_set(out)
    out = drop_if_present(out, keep=(row_id,))
    if columns is not None:
        keep = [row_id, entity, "y_30d"] + [c for c in columns if c not in (row_id, entity, "y_30d")]
        out = out.select(*keep)
    out = out.withColumnRenamed(row_id, "row_id")
    if dedupe:
        out = first_per_entity(out, entity, ["row_id"])
    return out


def cast_categorical(df: DataFrame, cols: Sequence[str], sentinel: str = "?") -> DataFrame:
    """Categoricals to string; nulls become ``sentinel``."""
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit(sentinel)).alias(c)
                        if c in cols else F.col(c)) for c in df.columns])


def select_by_prefix(df: DataFrame, *prefixes: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefixes) and c not in keep])


def normalize_name(name: str) -> str:
    """Feature-name tidy: ' '->'_', drop '[' and ')', '/'->'_'."""
    return name.replace(" ", "_").replace("[", "").replace(")", "").replace("/", "_")


def normalize_col(c) -> Column:
    """Same tidy rule on a string column (for level values that become names)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(F.regexp_replace(c, "[\\[)]", ""), " /", "__")


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])
