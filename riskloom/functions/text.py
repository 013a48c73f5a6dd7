"""Text expressions: response parsing, prompt rendering, slugs, formatting.

All are built-in column functions (regex, JSON path, higher-order array
functions), evaluated JVM-side; no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.vocab import ERROR_PREFIXES, INSTRUCTION, PROMPT_FEATURES

# FIXED VALUES: number pattern used by the lenient fallback parser
FLOAT_RE = r"-?\d+\.?\d*(?:[eE][-+]?\d+)?"
#: The plain JSON object that most responses are, which needs no JSON parser.
PLAIN_RE = r'^\{\s*"p"\s*:\s*(-?(?:0|[1-9]\d*)(?:\.\d+)?)\s*\}$'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip01(x) -> Column:
    """Clamp to [0, 1] keeping null as null (greatest/least would skip nulls)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def parse_prob(text, *, strict: bool = True) -> Column:
    """Probability from a model response.

    1. text that is a JSON object with key ``p`` (number or numeric string, not NaN) -> clamped to [0, 1];
    2. else the first number in the text that lies in [0, 1] (not clamped);
    3. else null. ``strict`` makes responses that start with ``Error`` null
       instead of reading numbers out of the error message.
    """
    t = F.trim(_c(text))
    jp = F.get_json_object(t, "$.p").try_cast("double")
    # the whole text must be one JSON value (as an array's only element no text may follow it), and NaN is no probability
    is_obj = t.startswith("{") & F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull()
    jp = F.when(~F.isnan(jp), jp)
    nums = F.regexp_extract_all(t, F.lit(FLOAT_RE), 0)
    in01 = F.filter(nums, lambda s: s.try_cast("double").between(0.0, 1.0))
    fb = F.try_element_at(in01, F.lit(1)).try_cast("double")
    plain = F.regexp_extract(t, PLAIN_RE, 1)
    out = F.when(plain != "", clip01(plain.try_cast("double"))).when(is_obj & jp.isNotNull(), clip01(jp)).otherwise(fb)
    if strict:
        out = F.when(t.startswith("Error"), F.lit(None).cast("double")).otherwise(out)
    return out


def is_failed_call(response, parsed, prefixes: Sequence[str] = ERROR_PREFIXES) -> Column:
    r = _c(response)
    cond = None
    for p in prefixes:
        t = r.startswith(p)
        cond = t if cond is None else cond | t
    return _c(parsed).isNull() & cond


def coerce_text(c) -> Column:
    """null -> 'unknown', else the trimmed text."""
    return F.coalesce(F.trim(_c(c).cast("string")), F.lit("unknown"))


def _render(pieces) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def prompt_natural(adm_label: Column) -> Column:
    """Narrative vignette; ``adm_label`` is the decoded admission type."""
    v = {k: coerce_text(k) for k in PROMPT_FEATURES}
    # FIXED VALUES: narrative template, in reading order
    pieces = [
        INSTRUCTION + "\n\nCLINICAL VIGNETTE:\n",
        "A ", v["race"], " ", F.lower(v["gender"]), " aged ", v["age"], " years was admitted under the ",
        adm_label, " pathway to the ", v["medical_specialty"], " service for ", v["time_in_hospital"],
        " day(s). Diabetes lab work: A1c result was ", v["A1Cresult"], "; max serum glucose was ",
        v["max_glu_serum"], ". Medications include insulin (", v["insulin"], ") and metformin (",
        v["metformin"], "); the regimen was ", v["change"], " during the stay (patient is ",
        v["diabetesMed"], " on diabetes medications overall). Primary diagnosis ICD-9 code was ",
        v["diag_1"], ", with secondary ", v["diag_2"], " and tertiary ", v["diag_3"],
        ". During the encounter the patient had ", v["num_lab_procedures"], " lab procedures, ",
        v["num_medications"], " medications, and ", v["number_diagnoses"],
        " total diagnoses on the problem list. In the year prior they had ", v["number_outpatient"],
        " outpatient visit(s), ", v["number_emergency"], " ER visit(s), and ", v["number_inpatient"],
        " inpatient stay(s).",
    ]
    return _render(pieces)


def prompt_abbreviated() -> Column:
    """Clinical shorthand: gender initial upper-cased, age without brackets."""
    v = {k: coerce_text(k) for k in PROMPT_FEATURES}
    # FIXED VALUES: shorthand template, in reading order
    pieces = [
        INSTRUCTION + "\n\nCHART_SNAPSHOT:\n",
        "Pt: ", F.upper(F.substring(v["gender"], 1, 1)), ", age ",
        F.translate(v["age"], "[)", ""), "\n",
        "LOS: ", v["time_in_hospital"], "d\n",
        "A1c: ", v["A1Cresult"], " | MaxGlu: ", v["max_glu_serum"], "\n",
        "Dx1: ", v["diag_1"], " | Dx2: ", v["diag_2"], " | Dx3: ", v["diag_3"], "\n",
        "Meds: ins ", v["insulin"], ", met ", v["metformin"], "; Rx change: ", v["change"], "\n",
        "Util: ", v["num_medications"], " meds, ", v["number_diagnoses"], " dx, IP ", v["number_inpatient"],
        " | ER ", v["number_emergency"], " | OP ", v["number_outpatient"], " (prior yr)\n",
    ]
    return _render(pieces)


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                    F.lit('"'))


def prompt_structured() -> Column:
    """Instruction + the 24 fields as a 2-space-indented JSON object of strings."""
    body = F.concat_ws(",\n", *[F.concat(F.lit(f'  "{k}": '), _json_str(coerce_text(k)))
                                 for k in PROMPT_FEATURES])
    return F.concat(F.lit(INSTRUCTION + "\n\nPATIENT_RECORD:\n{\n"), body, F.lit("\n}"))


def slug_humanize(slug, *, strip_version: bool = False) -> Column:
    """'iter-3_target-enc_v2' -> 'Target Enc' (capitalise first letter, keep the rest)."""
    s = F.regexp_replace(_c(slug), r"^iter-\d+_", "")
    if strip_version:
        s = F.regexp_replace(s, r"_(v\d+(_\w+)?|rerun|retry|fix\d*)$", "")
    parts = F.split(s, "[-_]+")
    cap = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.when(_c(slug).isNull() | (_c(slug) == ""), F.lit("")).otherwise(F.trim(F.array_join(cap, " ")))


def slugify_model(name) -> Column:
    """spaces -> '_', drop parentheses, '+' -> 'plus'."""
    n = _c(name)
    return F.replace(F.translate(F.replace(n, F.lit(" "), F.lit("_")), "()", ""), F.lit("+"), F.lit("plus"))


def format_ci(m, lo, hi) -> Column:
    """'0.691 (0.672–0.710)'."""
    return F.format_string("%.3f (%.3f–%.3f)", _c(m), _c(lo), _c(hi))


def target_verdict(auc, threshold: float = 0.65) -> Column:
    return F.when(_c(auc) >= threshold, "clears").otherwise("falls short of")
