"""Running sums in an order, where one group may hold any share of all rows.

Rows are dealt by ranges of (group, order), so a large group lies in several
neighbouring partitions. Each partition sums its own rows. What a group had in
the partitions before is added from a table that has two rows a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import stored


def _sum_rows(columns: list[str], group: list[str], values: list[str], out: list[str]):
    at = [columns.index(c) for c in group]
    of = [columns.index(c) for c in values]

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last_key, carry, head, held, fresh = None, np.zeros(len(of), np.int64), True, None, True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = [b.column(i).to_numpy(zero_copy_only=False) for i in at]
            new = np.zeros(n, bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            key = [k[0] for k in keys]
            new[0] = last_key is not None and key != last_key
            begins = np.flatnonzero(new)
            first = np.zeros(n, np.int64)  # row before which a row's group begins in this batch
            first[begins] = begins
            first = np.maximum.accumulate(first)
            sums = []
            for j, i in enumerate(of):
                total = np.concatenate([[0], np.cumsum(b.column(i).to_numpy(zero_copy_only=False))])
                base = total[first]
                base[: begins[0] if len(begins) else n] = -carry[j]
                sums.append(total[1:] - base)
                carry[j] = sums[-1][-1]
            last_key = [k[-1] for k in keys]
            inside = np.ones(n, bool) if head else np.zeros(n, bool)
            if len(begins):
                inside[begins[0]:] = False
                head = False
            if held is not None:
                yield held
            start = np.zeros(n, bool)
            start[0], fresh = fresh, False
            held = pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(s) for s in sums], pa.array(np.full(n, part, np.int32)), pa.array(inside), pa.array(start), pa.array(np.zeros(n, bool))],
                names=[*columns, *out, "__part", "__head", "__first", "__last"])
        if held is not None:
            end = np.zeros(held.num_rows, bool)
            end[-1] = True
            yield held.set_column(held.num_columns - 1, "__last", pa.array(end))
    return run


def running(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], values: dict[str, str], name: str = "running") -> DataFrame:
    """``df`` with the inclusive running sum of each column of ``values`` (to: from) in its group.

    ``df`` should be a stored table, as ranges are found from a sample of it. Group
    columns and values are longs without nulls. Rows that tie in ``order`` are summed in any order. The
    result is stored.
    """
    group, columns, out = list(group), df.columns, list(values)
    schema = T.StructType(list(df.schema.fields))
    for c in out:
        schema = schema.add(c, "long")
    schema = schema.add("__part", "integer").add("__head", "boolean").add("__first", "boolean").add("__last", "boolean")
    by = [*group, *order]
    summed = stored(df.repartitionByRange(*by).sortWithinPartitions(*by)
                    .mapInArrow(_sum_rows(columns, group, list(values.values()), out), schema), name)
    keys = [F.col(c) for c in group]
    marks = (summed.where("__last").select(*keys, "__part", F.lit(False).alias("head"), *out)
             .unionByName(summed.where("__first").select(*keys, "__part", F.lit(True).alias("head"), *[F.lit(0).cast("long").alias(c) for c in out])))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__part").rangeBetween(Window.unboundedPreceding, -1)
    carried = (marks.select(*keys, "__part", "head", *[F.sum(c).over(before).alias(f"__c_{c}") for c in out])
               .where("head").select("__part", *[f"__c_{c}" for c in out]).where(" or ".join(f"__c_{c} <> 0" for c in out)))
    return summed.join(carried, "__part", "left").select(
        *columns, *[(F.col(c) + F.when(F.col("__head"), F.coalesce(F.col(f"__c_{c}"), F.lit(0))).otherwise(0)).alias(c) for c in out])
