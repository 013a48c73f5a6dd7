"""Derived views that give the driver tables the shape of the study's inputs.

The SQL text is shared verbatim by Spark (over temp views of the parquet
tables) and by the DuckDB oracle (as CTEs), so both engines start from
identical rows. Each view is a single projection over one scan — no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.vocab import DRUG_COLUMNS
from riskloom.sources.tables import register_tables


def _diag(j: int) -> str:
    m = f"(o_orderkey + {j}) % 50"
    return (
        f"case when {m} = 0 then '?' when {m} = 1 then concat('V', 10 + o_custkey % 80) "
        f"when {m} = 2 then concat('E', 800 + o_custkey % 199) "
        f"when {m} between 3 and 7 then concat('250.', 10 + o_custkey % 90) "
        f"when {m} = 8 then '5d' else concat('', 1 + (o_orderkey * 7 + {100 * j}) % 999) end as diag_{j}"
    )


def _drug(i: int, name: str) -> str:
    return (f"case (o_orderkey + {i}) % {5 + 3 * i} when 0 then 'Steady' when 1 then 'Up' "
            f"when 2 then 'Down' else 'No' end as {name.replace('-', '_')}")


ENCOUNTERS_SQL = (
    "select o_orderkey as encounter_id, o_custkey as patient_nbr,\n"
    " case o_custkey % 6 when 0 then 'Caucasian' when 1 then 'AfricanAmerican' when 2 then '?' "
    "when 3 then 'Asian' when 4 then 'Hispanic' else 'Other' end as race,\n"
    " case when o_custkey % 500 = 7 then 'Unknown/Invalid' when o_custkey % 2 = 0 then 'Female' "
    "else 'Male' end as gender,\n"
    " concat('[', (o_custkey % 10) * 10, '-', (o_custkey % 10) * 10 + 10, ')') as age,\n"
    " cast(1 + o_orderkey % 8 as int) as admission_type_id,\n"
    " cast(1 + o_orderkey % 30 as int) as discharge_disposition_id,\n"
    " cast(1 + (o_orderkey * 7) % 26 as int) as admission_source_id,\n"
    " cast(1 + o_orderkey % 14 as int) as time_in_hospital,\n"
    " case o_orderkey % 5 when 0 then 'MC' when 1 then '?' when 2 then 'HM' when 3 then 'SP' "
    "else 'BC' end as payer_code,\n"
    " case o_orderkey % 9 when 0 then '?' when 1 then 'InternalMedicine' when 2 then "
    "'Family/GeneralPractice' when 3 then 'Cardiology' when 4 then 'Surgery-General' when 5 then "
    "'Orthopedics' when 6 then 'Nephrology' when 7 then 'Pediatrics-Endocrinology' else 'Podiatry' "
    "end as medical_specialty,\n"
    " cast(1 + (o_orderkey * 31) % 100 as int) as num_lab_procedures,\n"
    " cast(o_orderkey % 7 as int) as num_procedures,\n"
    " cast(1 + (o_orderkey * 13) % 60 as int) as num_medications,\n"
    " cast((o_orderkey * 3) % 5 as int) as number_outpatient,\n"
    " cast((o_orderkey * 11) % 3 as int) as number_emergency,\n"
    " cast((o_orderkey * 17) % 6 as int) as number_inpatient,\n"
    " cast(1 + (o_orderkey * 5) % 9 as int) as number_diagnoses,\n"
    " case o_orderkey % 6 when 0 then '>200' when 1 then '>300' when 2 then 'Norm' else 'None' "
    "end as max_glu_serum,\n"
    " case when o_orderkey % 4 = 0 then cast(null as varchar(8)) when o_orderkey % 4 = 1 then '>7' "
    "when o_orderkey % 4 = 2 then '>8' else 'Norm' end as a1cresult,\n"
    " case when o_orderkey % 3 = 0 then 'Ch' else 'No' end as change,\n"
    " case when o_orderkey % 4 = 0 then 'No' else 'Yes' end as diabetesmed,\n"
    " case when (o_orderkey * 7919 + 104729) % 100 < 4 + 4 * ((o_orderkey * 17) % 6) then '<30' "
    "when o_orderkey % 3 = 0 then '>30' else 'NO' end as readmitted,\n "
    + ",\n ".join(_diag(j) for j in (1, 2, 3)) + ",\n "
    + ",\n ".join(_drug(i, d) for i, d in enumerate(DRUG_COLUMNS))
    + "\nfrom orders"
)

RESPONSES_SQL = """select o.o_orderkey as row_id, f.fmt as prompt_format,
 cast(floor(o.o_orderkey / 1000) as int) as chunk_id,
 case (o.o_orderkey * 3 + f.i) % 20
   when 0 then 'Error in API response: throttled' when 1 then 'Error: 503 retry 1'
   when 2 then 'I''m sorry, but I can''t comply with that.' when 3 then '{"p": 1.3}'
   when 4 then 'The probability is 70% (0.7)' when 5 then '{"p": 1.3} sorry, say 0.2' when 6 then '{"p": "NaN"}'
   else concat('{"p": 0.', lpad(concat('', 5 + 12 * ((o.o_orderkey * 17) % 6) + o.o_orderkey % 11), 2, '0'), '}') end as response
from orders o cross join (select 0 as i, 'structured' as fmt union all select 1, 'natural' union all select 2, 'abbreviated') f"""

RUNS_SQL = """select concat('cand_', p_partkey) as id, p_type as method, p_brand as cohort,
 case p_partkey % 10 when 0 then 'failed' when 1 then 'pending' else 'complete' end as status,
 case when p_partkey % 10 > 1 then 0.6e0 + cast((p_partkey * 37) % 1000 as double) / 1e4 end as metric_value
from part"""

_FORMATS_JOIN = "cross join (select 0 as i, 'structured' as fmt union all select 1, 'natural' union all select 2, 'abbreviated') f"
# Spark explodes a literal array in place instead of joining three rows
_SPARK_FORMATS = "lateral view posexplode(array('structured', 'natural', 'abbreviated')) f as i, fmt"

VIEWS = {
    "encounters": (ENCOUNTERS_SQL, ("orders",)),
    "responses": (RESPONSES_SQL, ("orders",)),
    "runs": (RUNS_SQL, ("part",)),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Materialise-free derived view over the driver parquet tables."""
    sql, deps = VIEWS[name]
    register_tables(spark, sf_dir, *deps)
    return spark.sql(sql.replace(_FORMATS_JOIN, _SPARK_FORMATS))


def cte(*names: str) -> str:
    """``with`` clause carrying the same view text, for the DuckDB oracle."""
    return "with " + ",\n".join(f"{n} as (\n{VIEWS[n][0]}\n)" for n in names) + "\n"
