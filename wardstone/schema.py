"""Encounter table layout and the fixed value lists of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: names, codes and labels that results must agree on ----

MEDICATIONS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "insulin", "glyburide_metformin", "glipizide_metformin",
    "glimepiride_pioglitazone", "metformin_rosiglitazone", "metformin_pioglitazone",
]
MEDICATION_STATUSES = ["No", "Steady", "Up", "Down"]
CHANGED_STATUSES = ["Up", "Down"]
ACTIVE_STATUSES = ["Steady", "Up", "Down"]
HEADLINE_MEDICATIONS = ["insulin", "metformin", "glipizide", "glyburide"]
DOSE_CHANGE_MEDICATIONS = ["metformin", "insulin", "glipizide", "glyburide"]

MISSING_TOKEN = "?"
UNKNOWN = "Unknown"
POSITIVE_OUTCOME = "<30"
INVALID_GENDER = "Unknown/Invalid"

DISPOSITION_LABELS = {
    1: "Home",
    2: "Home (other)",
    3: "Skilled Nursing Facility",
    6: "Home Health Agency",
    7: "Left AMA",
    11: "Expired",
    13: "Hospice",
    14: "Hospice (facility)",
    22: "Rehab facility",
    25: "Not mapped",
}
NOT_AT_RISK_LABELS = ["Expired", "Hospice", "Hospice (facility)"]

DISCHARGE_RISK_GROUPS = {
    "High risk (AMA)": [7],
    "Moderate (home)": [1, 2, 8],
    "Lower (SNF/rehab)": [3, 5, 12, 14],
    "Lower (home health)": [6, 10],
}
FORM_DESTINATION_GROUPS = {
    "Home": "Moderate (home)",
    "Skilled Nursing Facility": "Lower (SNF/rehab)",
    "Home Health Agency": "Lower (home health)",
    "Left Against Medical Advice": "High risk (AMA)",
    "Other": "Other",
}

CARE_ACTIONS = {
    "Low": [
        "Standard discharge planning — confirm patient understands medications",
        "Schedule follow-up appointment within 7–14 days",
        "Provide diabetic care education materials",
    ],
    "Moderate": [
        "Arrange structured follow-up call within 48–72 hours of discharge",
        "Ensure patient has a primary care physician appointment within 7 days",
        "Review medication adherence — consider pill organiser or blister packs",
        "Flag for nurse care manager outreach if any concerning signs",
    ],
    "High": [
        "Prioritise for care transitions program enrollment",
        "Schedule follow-up call within 24 hours of discharge",
        "Consider home health agency referral",
        "Medication reconciliation with pharmacist before discharge",
        "Assign care manager for 30-day post-discharge monitoring",
        "Schedule in-person clinic visit within 3 days",
    ],
}
TIER_CUTS = {"Low": 0.15, "Moderate": 0.25}
HIGH_TIER = "High"

# score in thousandths: base, weight per unit of each input, and clamp
SCORECARD_BASE = 100
SCORECARD_WEIGHTS = {
    "number_inpatient": 25,
    "number_emergency": 15,
    "prior_utilization_score": 5,
    "number_diagnoses": 8,
    "time_in_hospital": 3,
    "insulin_changed": 20,
    "a1c_tested": -10,
}
SCORECARD_CLAMP = (20, 950)

# ---- column groups ----

ID_COLUMNS = ["encounter_id", "patient_nbr"]
MEASURES = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
]
CODED_DIMENSIONS = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]
SEGMENT_DIMENSIONS = [
    "age", "gender", "race", "discharge_disposition_id", "number_inpatient",
    "time_in_hospital", "insulin", "A1Cresult", "max_glu_serum", "number_diagnoses",
    "admission_type_id", "admission_source_id",
]

_long, _int, _str = T.LongType(), T.IntegerType(), T.StringType()
ENCOUNTER_SCHEMA = T.StructType(
    [
        T.StructField("encounter_id", _long),
        T.StructField("patient_nbr", _long),
        T.StructField("encounter_ts", T.TimestampNTZType()),
        T.StructField("race", _str),
        T.StructField("gender", _str),
        T.StructField("age", _str),
        T.StructField("weight", _str),
        *[T.StructField(c, _int) for c in CODED_DIMENSIONS],
        T.StructField("time_in_hospital", _int),
        T.StructField("payer_code", _str),
        T.StructField("medical_specialty", _str),
        *[T.StructField(c, _int) for c in MEASURES[1:7]],
        *[T.StructField(c, _str) for c in ("diag_1", "diag_2", "diag_3")],
        T.StructField("number_diagnoses", _int),
        T.StructField("max_glu_serum", _str),
        T.StructField("A1Cresult", _str),
        *[T.StructField(c, _str) for c in MEDICATIONS],
        T.StructField("readmitted", _str),
    ]
)
ENCOUNTER_COLUMNS = ENCOUNTER_SCHEMA.fieldNames()
