"""Fixed values that results depend on.

FIXED VALUES — these must equal the study's definitions for results to match.
They are stated as data, in their natural order, and turned into small
dimension DataFrames (broadcast joins) by ``riskloom.operators.lookup``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (cohort definition)
# ---------------------------------------------------------------------------

# discharge dispositions meaning expired or hospice; excluded from the cohort
EXCLUDED_DISPOSITIONS = (11, 13, 14, 19, 20, 21)

# columns dropped when present (id, mostly missing, single valued)
DROP_COLUMNS = ("encounter_id", "weight", "examide", "citoglipton")

# the 21 medication columns, in source order (the fixture view uses "_" for "-")
DRUG_COLUMNS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "insulin", "glyburide-metformin", "glipizide-metformin",
    "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone",
)

# the 8 medications with more than 1 % non-"No" use (slim feature set)
ACTIVE_DRUGS = (
    "metformin", "insulin", "glipizide", "glyburide",
    "pioglitazone", "rosiglitazone", "glimepiride", "repaglinide",
)

# ten-year age bins in natural order, with their midpoints
AGE_MIDPOINTS = {
    "[0-10)": 5, "[10-20)": 15, "[20-30)": 25, "[30-40)": 35, "[40-50)": 45,
    "[50-60)": 55, "[60-70)": 65, "[70-80)": 75, "[80-90)": 85, "[90-100)": 95,
}

# age bins forming the "young" (< 50) stratum of the shift study
YOUNG_AGE_BINS = ("[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)")

# discharge disposition id -> 6 semantic buckets (unmatched -> "Other")
DISCHARGE_BUCKETS = {
    1: "Home", 6: "Home", 8: "Home",
    2: "TransferInpatient", 3: "TransferInpatient", 4: "TransferInpatient",
    5: "TransferInpatient", 9: "TransferInpatient", 15: "TransferInpatient",
    22: "TransferInpatient", 23: "TransferInpatient", 24: "TransferInpatient",
    27: "TransferInpatient", 28: "TransferInpatient", 29: "TransferInpatient",
    30: "TransferInpatient",
    16: "OutpatientReferral", 17: "OutpatientReferral",
    7: "LeftAMA", 25: "Unknown", 26: "Unknown",
    12: "StillInpatient",
    18: "Unknown",
}

# admission source id -> 5 buckets (unmatched -> "Other")
ADMISSION_SOURCE_BUCKETS = {
    1: "Referral", 2: "Referral", 3: "Referral",
    4: "TransferFromHospital", 5: "TransferFromHospital", 6: "TransferFromHospital",
    10: "TransferFromHospital", 18: "TransferFromHospital",
    22: "TransferFromHospital", 25: "TransferFromHospital", 26: "TransferFromHospital",
    7: "EmergencyRoom",
    8: "EmergencyRoom",
    11: "Newborn", 12: "Newborn", 13: "Newborn", 14: "Newborn",
    23: "Newborn", 24: "Newborn",
    9: "Unknown", 15: "Unknown", 17: "Unknown", 20: "Unknown", 21: "Unknown",
    19: "Unknown",
}

# medical specialty -> 10 buckets (unmatched -> "Other")
SPECIALTY_BUCKETS = {
    "InternalMedicine": "Medicine",
    "Family/GeneralPractice": "FamilyPractice",
    "Cardiology": "Cardiology",
    "Surgery-General": "Surgery",
    "Surgery-Cardiovascular/Thoracic": "Surgery",
    "Surgery-Cardiovascular": "Surgery",
    "Surgery-Vascular": "Surgery",
    "Surgery-Neuro": "Surgery",
    "Surgery-Plastic": "Surgery",
    "Surgery-Thoracic": "Surgery",
    "Orthopedics": "Surgery",
    "Orthopedics-Reconstructive": "Surgery",
    "Emergency/Trauma": "Emergency",
    "Nephrology": "Nephrology",
    "Pulmonology": "Pulmonology",
    "Psychiatry": "Psychiatry",
    "Psychiatry-Addictive": "Psychiatry",
    "Psychiatry-Child/Adolescent": "Psychiatry",
    "ObstetricsandGynecology": "OBGYN",
    "Obsterics&Gynecology-GynecologicOnco": "OBGYN",
    "Gynecology": "OBGYN",
    "Obstetrics": "OBGYN",
    "Pediatrics": "Pediatrics",
    "Pediatrics-Endocrinology": "Pediatrics",
    "?": "Missing",
}

# admission type id -> label (prompt decoding; unmatched -> raw text)
ADMISSION_TYPE_LABELS = {
    1: "Emergency", 2: "Urgent", 3: "Elective", 4: "Newborn",
    5: "Not Available", 6: "NULL", 7: "Trauma Center", 8: "Not Mapped",
}

# admission source id -> label (coarse decoding)
ADMISSION_SOURCE_LABELS = {
    1: "Physician Referral", 2: "Clinic Referral", 3: "HMO Referral",
    4: "Transfer from a hospital", 5: "Transfer from SNF", 6: "Transfer from another HCF",
    7: "Emergency Room", 8: "Court/Law Enforcement", 9: "Not Available",
    10: "Transfer from critical access hospital", 11: "Normal Delivery",
    17: "NULL", 20: "Not Mapped", 22: "Transfer hospital inpt", 25: "Transfer ASC",
}

# ---------------------------------------------------------------------------
# FIXED VALUES (scoring prompts)
# ---------------------------------------------------------------------------

PROMPT_FEATURES = (
    "race", "gender", "age", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient",
    "number_diagnoses", "diag_1", "diag_2", "diag_3",
    "max_glu_serum", "A1Cresult", "insulin", "metformin", "change", "diabetesMed",
)

INSTRUCTION = (
    "You are a clinical informatics assistant. Estimate the probability that the "
    "described diabetic patient will be re-admitted to the hospital within 30 days of discharge. "
    'Respond ONLY with a JSON object of the form {"p": <float 0-1>}. Do not include any other text.'
)

PROMPT_FORMATS = ("structured", "natural", "abbreviated")

# response prefixes that mark a failed call
ERROR_PREFIXES = ("Error in API", "Error: ")

# ---------------------------------------------------------------------------
# FIXED VALUES (statistics)
# ---------------------------------------------------------------------------

Z95 = 1.959963984540054          # two-sided 95 % normal quantile
TARGET_SMOOTHING = 20.0          # target-encoding prior weight
TARGET_AUC = 0.65                # report verdict threshold
SPLIT_SEED = 42
