"""Feature-engineering queries, on first encounters as in model preparation."""

from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.operators import features as X
from wardstone.operators import scoring as R
from wardstone.plans.oracle import features, over
from wardstone.plans.registry import query
from wardstone.plans.tables import encounters, first_encounters

# Levels as the SQL side lists them; the queries find them in the data.
LEVELS = {
    "race": ["AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other", "Unknown"],
    "gender": ["Female", "Male", "Unknown/Invalid"],
    "age": [f"[{a}-{a + 10})" for a in range(0, 100, 10)],
    "medical_specialty": ["Cardiology", "Emergency/Trauma", "InternalMedicine", "Unknown"],
    "diag1_category": [
        "Circulatory", "Diabetes", "Digestive", "External cause", "Genitourinary", "Injury", "Mental",
        "Musculoskeletal", "Neoplasm", "Other", "Respiratory", "Supplementary", "Unknown",
    ],
    "discharge_risk_group": [
        "High risk (AMA)", "Lower (SNF/rehab)", "Lower (home health)", "Moderate (home)", "Other",
    ],
    "max_glu_serum": [">200", ">300", "None", "Norm"],
    "A1Cresult": [">7", ">8", "None", "Norm"],
    "discharge_disposition_id": ["1", "11", "13", "14", "18", "2", "22", "25", "3", "5", "6", "7"],
    "admission_source_id": ["1", "17", "4", "7"],
    "admission_type_id": ["1", "2", "3", "4", "5"],
}


def _feature_sql(*columns: str) -> str:
    return over(
        f"SELECT encounter_id, {', '.join(columns)} FROM features",
        features("first_encounters"), source="first_encounters",
    )


def _built(spark, sf, *columns):
    return X.build_features(first_encounters(spark, sf)).select("encounter_id", *columns)


def _register_feature_queries() -> None:
    groups = {
        "age_numeric": ["age_numeric"],
        "prior_utilization": ["prior_utilization_score"],
        "comorbidity": ["comorbidity_count"],
        "medication_features": ["medication_changes", "insulin_changed", "num_active_meds"],
        "icd9_category": ["diag_1", "diag1_category"],
        "discharge_risk_group": ["discharge_disposition_id", "discharge_risk_group"],
        "high_lab_burden": ["num_lab_procedures", "high_lab_burden"],
        "admission_flags": ["admitted_from_er", "emergency_admission", "discharge_to_snf"],
        "a1c_flags": ["a1c_abnormal", "a1c_tested"],
    }
    for name, columns in groups.items():
        query(name, _feature_sql(*columns))(lambda spark, sf, columns=columns: _built(spark, sf, *columns))


_register_feature_queries()


@query("icd9_category_floor", _feature_sql("diag_1", "diag1_category_floor"))
def icd9_category_floor(spark, sf):
    category = C.icd9_category(F.col("diag_1"), floor=True).alias("diag1_category_floor")
    return first_encounters(spark, sf).select("encounter_id", "diag_1", category)


def _ordinal_sql(m: str) -> str:
    return f"CASE {m} WHEN 'Steady' THEN 1 WHEN 'Up' THEN 2 WHEN 'Down' THEN 3 ELSE 0 END AS {m}"


@query(
    "med_ordinal",
    over(
        f"SELECT encounter_id, {', '.join(_ordinal_sql(m) for m in S.MEDICATIONS)} FROM first_encounters",
        source="first_encounters",
    ),
)
def med_ordinal(spark, sf):
    codes = [C.medication_ordinal(F.col(m)).alias(m) for m in S.MEDICATIONS]
    return first_encounters(spark, sf).select("encounter_id", *codes)


def _dummies(columns: list[str], sanitize: bool = False) -> list[str]:
    out = []
    for c in columns:
        for level in LEVELS[c][1:]:
            name = f"{c}_{level}"
            name = X.safe_name(name) if sanitize else name
            out.append(f"""CAST(COALESCE(CAST({c} AS VARCHAR), 'Unknown') = '{level}' AS INT) AS "{name}" """)
    return out


@query(
    "onehot_race_gender",
    over(
        f"SELECT encounter_id, {', '.join(_dummies(['race', 'gender']))} FROM first_encounters",
        source="first_encounters",
    ),
)
def onehot_race_gender(spark, sf):
    kept = first_encounters(spark, sf).select("encounter_id", "race", "gender")
    return X.one_hot(kept, X.category_levels(kept, ["race", "gender"]))


def _levels(spark, sf, spec):
    return X.category_levels(X.build_features(first_encounters(spark, sf), spec, lab_p75=0.0), spec.categorical)


@query(
    "category_levels",
    over(
        " UNION ".join(
            f"SELECT '{c}' AS dimension, COALESCE(CAST({c} AS VARCHAR), 'Unknown') AS segment FROM features" for c in LEVELS
        ),
        features("first_encounters"), source="first_encounters",
    ),
)
def category_levels(spark, sf):
    return X.level_rows(X.build_features(first_encounters(spark, sf), lab_p75=0.0), list(LEVELS))


_MEDIANS = ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM features)) AS {c}"
    for c in X.CLINICAL.numeric
)


@query(
    "model_ready",
    over(
        f"SELECT encounter_id, readmitted_30, {_MEDIANS}, {', '.join(_dummies(X.CLINICAL.categorical))} FROM features",
        features("first_encounters"), source="first_encounters",
    ),
)
def model_ready(spark, sf):
    return X.model_ready(first_encounters(spark, sf), X.CLINICAL, _levels(spark, sf, X.CLINICAL), ["encounter_id", "readmitted_30"])


_ORDINAL_NUMERIC = ", ".join(
    f"COALESCE({c}, 0) AS {c}" for c in X.ORDINAL.numeric if c not in S.MEDICATIONS
)


@query(
    "model_ready_ordinal",
    over(
        f"""SELECT encounter_id, readmitted_30, {_ORDINAL_NUMERIC}, {', '.join(_ordinal_sql(m) for m in S.MEDICATIONS)},
        {', '.join(_dummies(X.ORDINAL.categorical, sanitize=True))} FROM features""",
        features("first_encounters"), source="first_encounters",
    ),
)
def model_ready_ordinal(spark, sf):
    return X.model_ready(first_encounters(spark, sf), X.ORDINAL, _levels(spark, sf, X.ORDINAL), ["encounter_id", "readmitted_30"])


_SPARSE = {"num_lab_procedures": "number_inpatient", "num_medications": "num_procedures"}


@query(
    "median_fill",
    over(
        "SELECT encounter_id, "
        + ", ".join(f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM gaps)) AS {c}" for c in _SPARSE)
        + " FROM gaps",
        "gaps AS (SELECT encounter_id, "
        + ", ".join(f"CASE WHEN {by} > 0 THEN CAST({c} AS DOUBLE) END AS {c}" for c, by in _SPARSE.items())
        + " FROM first_encounters)",
        source="first_encounters",
    ),
)
def median_fill(spark, sf):
    """The data set has no numeric gaps, so two measures are blanked by a rule first."""
    gaps = [F.when(F.col(by) > 0, F.col(c)).alias(c) for c, by in _SPARSE.items()]
    return X.fill_medians(first_encounters(spark, sf).select("encounter_id", *gaps), list(_SPARSE))


_ADMISSION = "CASE admission_type_id WHEN 1 THEN 'Emergency' WHEN 2 THEN 'Urgent' ELSE 'Elective' END"
_DESTINATION = """CASE WHEN discharge_disposition_id = 1 THEN 'Home' WHEN discharge_disposition_id = 3 THEN 'Skilled Nursing Facility'
  WHEN discharge_disposition_id = 6 THEN 'Home Health Agency' WHEN discharge_disposition_id = 7 THEN 'Left Against Medical Advice' ELSE 'Other' END"""


def scoring_requests(df):
    """Encounters restated as scoring-form fields."""
    return df.select(
        F.col("encounter_id").alias("request_id"), "age", "gender",
        F.coalesce("race", F.lit("Other")).alias("race"),
        F.expr(_ADMISSION).alias("admission_type"), F.expr(_DESTINATION).alias("discharge_dest"),
        "time_in_hospital",
        F.col("number_inpatient").alias("num_inpatient"), F.col("number_emergency").alias("num_emergency"),
        F.col("number_outpatient").alias("num_outpatient"), F.col("number_diagnoses").alias("num_diagnoses"),
        "num_medications", F.col("num_lab_procedures").alias("num_lab_procs"), "num_procedures",
        F.col("insulin").alias("insulin_status"), F.col("A1Cresult").alias("a1c_result"),
    )


_REQUEST_SQL = f"""SELECT encounter_id AS request_id, CASE WHEN age = '[0-10)' THEN 65 ELSE CAST(SUBSTR(age, 2, POSITION('-' IN age) - 2) AS INT) + 5 END AS age_numeric,
  time_in_hospital, num_lab_procedures, num_procedures, num_medications, number_outpatient, number_emergency, number_inpatient,
  number_diagnoses, number_inpatient*3 + number_emergency*2 + number_outpatient AS prior_utilization_score,
  LEAST(number_diagnoses, 3) AS comorbidity_count, CAST(insulin IN ('Up','Down') AS INT) AS medication_changes,
  CAST(insulin IN ('Up','Down') AS INT) AS insulin_changed, GREATEST(1, num_medications // 3) AS num_active_meds,
  CAST(num_lab_procedures > 54 AS INT) AS high_lab_burden, CAST(admission_type_id = 1 AS INT) AS admitted_from_er,
  CAST(admission_type_id = 1 AS INT) AS emergency_admission, CAST(A1Cresult IN ('>7','>8') AS INT) AS a1c_abnormal,
  CAST(A1Cresult <> 'None' AS INT) AS a1c_tested,
  CASE {_DESTINATION} WHEN 'Home' THEN 'Moderate (home)' WHEN 'Skilled Nursing Facility' THEN 'Lower (SNF/rehab)'
    WHEN 'Home Health Agency' THEN 'Lower (home health)' WHEN 'Left Against Medical Advice' THEN 'High risk (AMA)' ELSE 'Other' END AS discharge_risk_group
  FROM encounters"""


@query("request_features", over(_REQUEST_SQL))
def request_features(spark, sf):
    return R.request_features(scoring_requests(encounters(spark, sf)))


_ALIGNED = ["race_Asian", "number_inpatient", "medical_specialty_Unknown", "age_numeric", "a1c_tested"]


@query(
    "align_features",
    over(
        f"""SELECT request_id, 0 AS "race_Asian", number_inpatient, 0 AS "medical_specialty_Unknown", age_numeric, a1c_tested
        FROM ({_REQUEST_SQL})"""
    ),
)
def align_features(spark, sf):
    return R.align_features(request_features(spark, sf), _ALIGNED, keep=["request_id"])
