"""Catalogued queries: scalar functions, lookups, pre-vector features, one-hot."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.functions.codes import icd9_bucket, sql_icd9_bucket
from riskloom.functions.stats import r6 as sr6
from riskloom.functions.vocab import (ACTIVE_DRUGS, ADMISSION_SOURCE_BUCKETS, ADMISSION_SOURCE_LABELS,
                                      ADMISSION_TYPE_LABELS, AGE_MIDPOINTS, DISCHARGE_BUCKETS,
                                      DRUG_COLUMNS, INSTRUCTION, PROMPT_FEATURES, SPECIALTY_BUCKETS)
from riskloom.operators import features as FE
from riskloom.operators import lookup as L
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.registry import query, r6
from riskloom.sources.fixtures import cte, view
from riskloom.sources.tables import read_table

_BASE = cte("encounters") + "," + _COHORT


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else repr(v)


def sql_lookup(col: str, mapping, default=None) -> str:
    whens = " ".join(f"when {_lit(k)} then {_lit(v)}" for k, v in mapping.items())
    return f"(case {col} {whens} else {_lit(default) if default is not None else 'null'} end)"


def _sql_lookup_int_label(col: str, mapping) -> str:
    txt = f"coalesce(trim(cast({col} as varchar)), 'unknown')"
    as_int = f"(case when regexp_matches({txt}, '^[+-]?\\d+$') then try_cast({txt} as int) end)"
    return f"coalesce({sql_lookup(as_int, mapping)}, {txt})"


@query("icd9_bucket", cte("encounters") + f"""
select encounter_id, diag_1, {sql_icd9_bucket('diag_1')} as diag_1_bucket,
  {sql_icd9_bucket('diag_2')} as diag_2_bucket, {sql_icd9_bucket('diag_3')} as diag_3_bucket from encounters""")
def q_icd9_bucket(spark, sf):
    e = view(spark, sf, "encounters")
    return e.select("encounter_id", "diag_1", *[icd9_bucket(f"diag_{j}").alias(f"diag_{j}_bucket") for j in (1, 2, 3)])


@query("log1p_counts", _BASE + "select encounter_id as row_id, " + ", ".join(
    f"{r6(f'ln(1 + cast({c} as double))')} as {c}_log1p" for c in FE.LOG1P_COLS) + " from cohort")
def q_log1p_counts(spark, sf):
    c = cohort_df(spark, sf, list(FE.LOG1P_COLS))
    return c.select("row_id", *[sr6(F.log1p(F.col(x).cast("double"))).alias(f"{x}_log1p") for x in FE.LOG1P_COLS])


_ACTIVE_SQL = " + ".join(f"cast(coalesce({FE.drug_col(d)}, '') <> 'No' as int)" for d in DRUG_COLUMNS)
_CHANGED_SQL = " + ".join(f"cast(coalesce({FE.drug_col(d)}, '') in ('Up', 'Down') as int)" for d in DRUG_COLUMNS)
_SOME_NULL = FE.drug_col(DRUG_COLUMNS[0])  # a drug that the row_count_if query makes null in a seventh of the rows


@query("row_count_if", cte("encounters") + f"""
select encounter_id, {_ACTIVE_SQL} as num_drugs_active, {_CHANGED_SQL} as num_drugs_changed
from (select * replace (case when encounter_id % 7 <> 0 then {_SOME_NULL} end as {_SOME_NULL}) from encounters) x""")
def q_row_count_if(spark, sf):
    e = view(spark, sf, "encounters")
    e = FE.row_count_if(e.withColumn(_SOME_NULL, F.when(F.col("encounter_id") % 7 != 0, F.col(_SOME_NULL))))
    return e.select("encounter_id", F.col("num_drugs_active").cast("int").alias("num_drugs_active"),
                    F.col("num_drugs_changed").cast("int").alias("num_drugs_changed"))


@query("lookup_default", cte("encounters") + f"""
select encounter_id, {sql_lookup('discharge_disposition_id', DISCHARGE_BUCKETS, 'Other')} as discharge_bucket,
  {sql_lookup('admission_source_id', ADMISSION_SOURCE_BUCKETS, 'Other')} as adm_source_bucket,
  {sql_lookup('medical_specialty', SPECIALTY_BUCKETS, 'Other')} as specialty_bucket from encounters""")
def q_lookup_default(spark, sf):
    e = view(spark, sf, "encounters")
    return e.select("encounter_id",
                    L.lookup("discharge_disposition_id", DISCHARGE_BUCKETS, "Other").alias("discharge_bucket"),
                    L.lookup("admission_source_id", ADMISSION_SOURCE_BUCKETS, "Other").alias("adm_source_bucket"),
                    L.lookup("medical_specialty", SPECIALTY_BUCKETS, "Other").alias("specialty_bucket"))


@query("lookup_null", cte("encounters") + f"""
select encounter_id, age, cast({sql_lookup('age', AGE_MIDPOINTS)} as double) as age_midpoint,
  {sql_lookup('admission_source_id', ADMISSION_SOURCE_LABELS)} as admission_source_label from encounters""")
def q_lookup_null(spark, sf):
    e = view(spark, sf, "encounters")
    return e.select("encounter_id", "age", L.lookup("age", AGE_MIDPOINTS).cast("double").alias("age_midpoint"),
                    L.lookup("admission_source_id", ADMISSION_SOURCE_LABELS).alias("admission_source_label"))


@query("lookup_int_label", cte("encounters") + f"""
select encounter_id, {_sql_lookup_int_label('admission_type_id', ADMISSION_TYPE_LABELS)} as admission_type_label,
  {_sql_lookup_int_label('medical_specialty', ADMISSION_TYPE_LABELS)} as specialty_label from encounters""")
def q_lookup_int_label(spark, sf):
    e = view(spark, sf, "encounters")
    return e.select("encounter_id", L.lookup_int_label("admission_type_id", ADMISSION_TYPE_LABELS).alias("admission_type_label"),
                    # text that is not an integer is echoed back
                    L.lookup_int_label("medical_specialty", ADMISSION_TYPE_LABELS).alias("specialty_label"))


def _values(mapping):
    return ", ".join(f"({_lit(k)}, {_lit(v)})" for k, v in mapping.items())


@query("decode_dims", cte("encounters") + f"""
, adm_type as (select * from (values {_values(ADMISSION_TYPE_LABELS)}) v(k, label)),
adm_src as (select * from (values {_values(ADMISSION_SOURCE_LABELS)}) v(k, label)),
disch as (select * from (values {_values(DISCHARGE_BUCKETS)}) v(k, label))
select e.encounter_id, t.label as admission_type, s.label as admission_source, d.label as discharge
from encounters e left join adm_type t on e.admission_type_id = t.k left join adm_src s on e.admission_source_id = s.k
left join disch d on e.discharge_disposition_id = d.k""")
def q_decode_dims(spark, sf):
    e = view(spark, sf, "encounters").select("encounter_id", "admission_type_id", "admission_source_id",
                                             "discharge_disposition_id")
    e = L.decode_with(e, L.dimension(spark, ADMISSION_TYPE_LABELS, "k", "label"), "admission_type_id", "label", "admission_type")
    e = L.decode_with(e, L.dimension(spark, ADMISSION_SOURCE_LABELS, "k", "label"), "admission_source_id", "label", "admission_source")
    e = L.decode_with(e, L.dimension(spark, DISCHARGE_BUCKETS, "k", "label"), "discharge_disposition_id", "label", "discharge")
    return e.select("encounter_id", "admission_type", "admission_source", "discharge")


def _slim_base_sql(src: str = "cohort") -> str:
    diag = ", ".join(f"{sql_icd9_bucket(f'diag_{j}')} as diag_{j}_bucket" for j in (1, 2, 3))
    return (f"select *, cast({sql_lookup('age', AGE_MIDPOINTS)} as double) as age_midpoint, {diag}, "
            f"{sql_lookup('discharge_disposition_id', DISCHARGE_BUCKETS, 'Other')} as discharge_bucket, "
            f"{sql_lookup('admission_source_id', ADMISSION_SOURCE_BUCKETS, 'Other')} as adm_source_bucket, "
            f"{sql_lookup('medical_specialty', SPECIALTY_BUCKETS, 'Other')} as specialty_bucket, "
            f"{_ACTIVE_SQL} as num_drugs_active, {_CHANGED_SQL} as num_drugs_changed, "
            + ", ".join(f"ln(1 + cast({c} as double)) as {c}_log1p" for c in FE.LOG1P_COLS)
            + f" from {src}")


def _features_sql(slim: bool) -> str:
    diag = ", ".join(f"{sql_icd9_bucket(f'diag_{j}')} as diag_{j}_bucket" for j in (1, 2, 3))
    base = (f"select *, cast({sql_lookup('age', AGE_MIDPOINTS)} as double) as age_midpoint, {diag}, "
            f"{sql_lookup('discharge_disposition_id', DISCHARGE_BUCKETS, 'Other')} as discharge_bucket, "
            f"{sql_lookup('admission_source_id', ADMISSION_SOURCE_BUCKETS, 'Other')} as adm_source_bucket, "
            f"{sql_lookup('medical_specialty', SPECIALTY_BUCKETS, 'Other')} as specialty_bucket, "
            f"{_ACTIVE_SQL} as num_drugs_active, {_CHANGED_SQL} as num_drugs_changed, "
            + ", ".join(f"ln(1 + cast({c} as double)) as {c}_log1p" for c in FE.LOG1P_COLS)
            + " from cohort")
    if slim:
        nums, cats = FE.SLIM_NUMERIC, list(FE.SLIM_CATEGORICAL) + list(ACTIVE_DRUGS)
    else:
        nums = FE.BASE_NUMERIC
        cats = list(FE.BASE_CATEGORICAL) + [FE.drug_col(d) for d in DRUG_COLUMNS] + \
            ["diag_1_bucket", "diag_2_bucket", "diag_3_bucket"]
    num_sql = ", ".join(f"{r6(f'cast({c} as double)')} as {c}" for c in nums)
    cat_sql = ", ".join(f"coalesce(cast({c} as varchar), '?') as {c}" for c in cats)
    return _BASE + f", f as ({base})\nselect encounter_id as row_id, y_30d, {num_sql}, {cat_sql} from f"


def _rounded(df, nums):
    return df.select(*[sr6(c).alias(c) if c in nums else F.col(c) for c in df.columns])


@query("features_base", _features_sql(False))
def q_features_base(spark, sf):
    return _rounded(FE.features_base(cohort_df(spark, sf)), FE.BASE_NUMERIC)


@query("features_slim", _features_sql(True))
def q_features_slim(spark, sf):
    return _rounded(FE.features_slim(cohort_df(spark, sf)), FE.SLIM_NUMERIC)


def _norm_sql(x):
    return f"replace(replace(replace(replace({x}, '[', ''), ')', ''), ' ', '_'), '/', '_')"


_OH_COLS = ("race", "gender", "age", "a1cresult")


@query("onehot_drop_first", _BASE + ", long as (" + " union all ".join(
    f"select encounter_id as row_id, '{c}' as var, cast({c} as varchar) as lvl from cohort where {c} is not null"
    for c in _OH_COLS) + """), firsts as (select var, min(lvl) as fl from long group by var)
select row_id, var || '_' || """ + _norm_sql("lvl") + """ as feature, 1.0e0 as value
from long join firsts using (var) where lvl <> fl""")
def q_onehot_drop_first(spark, sf):
    return FE.onehot_long(cohort_df(spark, sf, list(_OH_COLS)), "row_id", list(_OH_COLS))


@query("interact_products", _BASE + f""", d as (select encounter_id as row_id, a1cresult as a, {sql_icd9_bucket('diag_1')} as b from cohort),
firsts as (select min(a) as fa, min(b) as fb from d)
select row_id, 'a1cresult_' || {_norm_sql('a')} || '__x__diag_1_bucket_' || {_norm_sql('b')} as feature, 1.0e0 as value
from d cross join firsts where a is not null and b is not null and a <> fa and b <> fb""")
def q_interact_products(spark, sf):
    c = FE.with_diag_buckets(cohort_df(spark, sf, ["a1cresult", "diag_1", "diag_2", "diag_3"]))
    return FE.interact_products(c, "row_id", "a1cresult", "diag_1_bucket")


# ---- text functions -------------------------------------------------------

def _sql_parse_prob(t: str, strict: bool) -> str:
    tt = f"trim({t})"
    jp = f"(case when json_valid({tt}) and starts_with({tt}, '{{') then nullif(try_cast(json_extract_string({tt}, '$.p') as double), 'NaN'::double) end)"
    fb = (f"try_cast(list_filter(regexp_extract_all({tt}, '{T.FLOAT_RE}'), lambda s: try_cast(s as double) between 0 and 1)[1] as double)")
    e = f"(case when {jp} is not null then least(greatest({jp}, 0.0e0), 1.0e0) else {fb} end)"
    if strict:
        e = f"(case when starts_with({tt}, 'Error') then null else {e} end)"
    return e


def responses_df(spark, sf):
    return view(spark, sf, "responses")


@query("parse_prob", cte("responses") + f"select row_id, prompt_format, {_sql_parse_prob('response', True)} as parsed_p from responses")
def q_parse_prob(spark, sf):
    r = responses_df(spark, sf)
    return r.select("row_id", "prompt_format", T.parse_prob("response", strict=True).alias("parsed_p"))


@query("parse_prob_lenient", cte("responses") + f"select row_id, prompt_format, {_sql_parse_prob('response', False)} as parsed_p from responses")
def q_parse_prob_lenient(spark, sf):
    r = responses_df(spark, sf)
    return r.select("row_id", "prompt_format", T.parse_prob("response", strict=False).alias("parsed_p"))


@query("clip01", f"select event_id, {r6('case when value is not null then least(greatest(value / 50.0e0 - 0.1e0, 0.0e0), 1.0e0) end')} as p from events")
def q_clip01(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", sr6(T.clip01(F.col("value") / 50.0 - 0.1)).alias("p"))


@query("coerce_text", cte("encounters") + "select encounter_id, coalesce(trim(cast(a1cresult as varchar)), 'unknown') as a1c, "
       "coalesce(trim(cast(number_inpatient as varchar)), 'unknown') as n_in from encounters")
def q_coerce_text(spark, sf):
    e = view(spark, sf, "encounters")
    return e.select("encounter_id", T.coerce_text("a1cresult").alias("a1c"), T.coerce_text("number_inpatient").alias("n_in"))


def _co(c):
    return f"coalesce(trim(cast({c} as varchar)), 'unknown')"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NATURAL_SQL = " || ".join([
    _sql_str(INSTRUCTION + "\n\nCLINICAL VIGNETTE:\n"), "'A '", _co("race"), "' '", f"lower({_co('gender')})",
    "' aged '", _co("age"), "' years was admitted under the '",
    _sql_lookup_int_label("admission_type_id", ADMISSION_TYPE_LABELS), "' pathway to the '", _co("medical_specialty"),
    "' service for '", _co("time_in_hospital"), "' day(s). Diabetes lab work: A1c result was '", _co("a1cresult"),
    "'; max serum glucose was '", _co("max_glu_serum"), "'. Medications include insulin ('", _co("insulin"),
    "') and metformin ('", _co("metformin"), "'); the regimen was '", _co("change"),
    "' during the stay (patient is '", _co("diabetesmed"),
    "' on diabetes medications overall). Primary diagnosis ICD-9 code was '", _co("diag_1"),
    "', with secondary '", _co("diag_2"), "' and tertiary '", _co("diag_3"),
    "'. During the encounter the patient had '", _co("num_lab_procedures"), "' lab procedures, '",
    _co("num_medications"), "' medications, and '", _co("number_diagnoses"),
    "' total diagnoses on the problem list. In the year prior they had '", _co("number_outpatient"),
    "' outpatient visit(s), '", _co("number_emergency"), "' ER visit(s), and '", _co("number_inpatient"),
    "' inpatient stay(s).'"])


@query("prompt_natural", _BASE + f"select encounter_id as row_id, {_NATURAL_SQL} as prompt from cohort")
def q_prompt_natural(spark, sf):
    c = cohort_df(spark, sf)
    return c.select("row_id", T.prompt_natural(L.lookup_int_label("admission_type_id", ADMISSION_TYPE_LABELS)).alias("prompt"))


_ABBR_SQL = " || ".join([
    _sql_str(INSTRUCTION + "\n\nCHART_SNAPSHOT:\n"), "'Pt: '", f"upper(substr({_co('gender')}, 1, 1))", "', age '",
    f"replace(replace({_co('age')}, '[', ''), ')', '')", "chr(10)", "'LOS: '", _co("time_in_hospital"), "'d'", "chr(10)",
    "'A1c: '", _co("a1cresult"), "' | MaxGlu: '", _co("max_glu_serum"), "chr(10)",
    "'Dx1: '", _co("diag_1"), "' | Dx2: '", _co("diag_2"), "' | Dx3: '", _co("diag_3"), "chr(10)",
    "'Meds: ins '", _co("insulin"), "', met '", _co("metformin"), "'; Rx change: '", _co("change"), "chr(10)",
    "'Util: '", _co("num_medications"), "' meds, '", _co("number_diagnoses"), "' dx, IP '", _co("number_inpatient"),
    "' | ER '", _co("number_emergency"), "' | OP '", _co("number_outpatient"), "' (prior yr)'", "chr(10)"])


@query("prompt_abbreviated", _BASE + f"select encounter_id as row_id, {_ABBR_SQL} as prompt from cohort")
def q_prompt_abbreviated(spark, sf):
    return cohort_df(spark, sf).select("row_id", T.prompt_abbreviated().alias("prompt"))


def _json_field(k):
    col = k.lower()
    v = _co(col)
    return f"'  \"{k}\": \"' || replace(replace({v}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


_STRUCT_SQL = (_sql_str(INSTRUCTION + "\n\nPATIENT_RECORD:\n{\n") + " || "
               + " || ',' || chr(10) || ".join(_json_field(k) for k in PROMPT_FEATURES) + " || chr(10) || '}'")


@query("prompt_structured", _BASE + f"select encounter_id as row_id, {_STRUCT_SQL} as prompt from cohort")
def q_prompt_structured(spark, sf):
    return cohort_df(spark, sf).select("row_id", T.prompt_structured().alias("prompt"))


_SLUG_SRC = "concat('iter-', p_partkey % 7, '_', lower(replace(p_type, ' ', '-')), case p_partkey % 4 when 0 then '_v2' when 1 then '_rerun' else '' end)"


def _sql_humanize(s, strip_version):
    x = f"regexp_replace({s}, '^iter-\\d+_', '')"
    if strip_version:
        x = f"regexp_replace({x}, '_(v\\d+(_\\w+)?|rerun|retry|fix\\d*)$', '')"
    parts = f"regexp_split_to_array({x}, '[-_]+')"
    cap = f"list_transform({parts}, lambda p: upper(substr(p, 1, 1)) || substr(p, 2))"
    return f"case when {s} is null or {s} = '' then '' else trim(array_to_string({cap}, ' ')) end"


@query("slug_humanize", f"select p_partkey, {_sql_humanize('slug', False)} as title, {_sql_humanize('slug', True)} as short_title "
       f"from (select p_partkey, {_SLUG_SRC} as slug from part) s")
def q_slug_humanize(spark, sf):
    p = read_table(spark, sf, "part")
    s = p.select("p_partkey", F.expr(_SLUG_SRC).alias("slug"))
    return s.select("p_partkey", T.slug_humanize("slug").alias("title"),
                    T.slug_humanize("slug", strip_version=True).alias("short_title"))


_MODEL_NAME_SPARK = "concat(p_brand, ' (', p_type, ') + ', p_size)"


@query("slugify_model", "select p_partkey, replace(replace(replace(replace(name, ' ', '_'), '(', ''), ')', ''), '+', 'plus') as slug "
       "from (select p_partkey, concat(p_brand, ' (', p_type, ') + ', p_size) as name from part) s")
def q_slugify_model(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", T.slugify_model(F.expr(_MODEL_NAME_SPARK)).alias("slug"))
