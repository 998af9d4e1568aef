"""Risk scores, tiers and what follows from them; the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.functions.rates import count_where, rate_pct

# ---- fixed values: defaults of the scoring form ----
FORM_AGE_DEFAULT = 65
FORM_UNKNOWN_AGES = ["[0-10)"]
FORM_LAB_CUT = 54
EMERGENCY = "Emergency"


def scorecard_inputs(df: DataFrame) -> DataFrame:
    """Encounter columns to the seven inputs of the scorecard."""
    return df.withColumns(
        {
            "prior_utilization_score": C.prior_utilization(
                F.col("number_inpatient"), F.col("number_emergency"), F.col("number_outpatient")
            ),
            "insulin_changed": C.flag(F.col("insulin").isin(S.CHANGED_STATUSES)),
            "a1c_tested": C.flag(F.col("A1Cresult") != "None"),
        }
    )


def scorecard(df: DataFrame) -> DataFrame:
    """Adds ``score_milli``, ``score`` and ``tier`` from the published weights."""
    milli = C.scorecard_clamped()
    score = milli / F.lit(1000.0)
    return df.withColumns({"score_milli": milli, "score": score, "tier": C.risk_tier(score)})


def score_encounters(df: DataFrame) -> DataFrame:
    return scorecard(scorecard_inputs(df))


def request_features(df: DataFrame) -> DataFrame:
    """Scoring-form fields to model features, with the form's simplified rules."""
    changed = C.flag(F.col("insulin_status").isin(S.CHANGED_STATUSES))
    emergency = C.flag(F.col("admission_type") == EMERGENCY)
    group = F.create_map(*[F.lit(v) for kv in S.FORM_DESTINATION_GROUPS.items() for v in kv])
    renamed = {
        "num_lab_procs": "num_lab_procedures",
        "num_outpatient": "number_outpatient",
        "num_emergency": "number_emergency",
        "num_inpatient": "number_inpatient",
        "num_diagnoses": "number_diagnoses",
    }
    features: dict[str, Column] = {
        "age_numeric": F.when(F.col("age").isin(FORM_UNKNOWN_AGES), FORM_AGE_DEFAULT).otherwise(
            C.age_midpoint(F.col("age"), FORM_AGE_DEFAULT)
        ),
        "time_in_hospital": F.col("time_in_hospital"),
        "num_procedures": F.col("num_procedures"),
        "num_medications": F.col("num_medications"),
        **{new: F.col(old) for old, new in renamed.items()},
        "prior_utilization_score": C.prior_utilization(
            F.col("num_inpatient"), F.col("num_emergency"), F.col("num_outpatient")
        ),
        "comorbidity_count": C.clamp(F.col("num_diagnoses"), high=3),
        "medication_changes": changed,
        "insulin_changed": changed,
        "num_active_meds": C.clamp(F.floor(F.col("num_medications") / 3), low=1).cast("int"),
        "high_lab_burden": C.flag(F.col("num_lab_procs") > FORM_LAB_CUT),
        "admitted_from_er": emergency,
        "emergency_admission": emergency,
        "a1c_abnormal": C.flag(F.col("a1c_result").isin(">7", ">8")),
        "a1c_tested": C.flag(F.col("a1c_result") != "None"),
        "discharge_risk_group": F.coalesce(F.try_element_at(group, F.col("discharge_dest")), F.lit("Other")),
    }
    passed = [c for c in ("request_id",) if c in df.columns]
    return df.select(*passed, *[column.alias(name) for name, column in features.items()])


def align_features(df: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly the training columns in training order; absent ones are 0."""
    present = set(df.columns)
    aligned = [F.col(f"`{n}`") if n in present else F.lit(0).alias(n) for n in names]
    return df.select(*(keep or []), *aligned)


def care_actions(scored: DataFrame) -> DataFrame:
    """One row per scored encounter and recommended action of its tier."""
    lists = {t: F.array(*[F.lit(a) for a in actions]) for t, actions in S.CARE_ACTIONS.items()}
    chosen = F.when(F.col("tier") == "Low", lists["Low"])
    for tier in ("Moderate", S.HIGH_TIER):
        chosen = chosen.when(F.col("tier") == tier, lists[tier])
    return scored.select("encounter_id", "tier", F.posexplode(chosen).alias("position", "action")).select(
        "encounter_id", "tier", (F.col("position") + 1).alias("action_no"), "action"
    )


def tier_summary(scored: DataFrame) -> DataFrame:
    label = C.readmitted_30()
    return scored.groupBy("tier").agg(
        F.count("*").alias("encounters"),
        F.sum(label).alias("readmitted_30"),
        rate_pct(F.sum(label), F.count("*")).alias("readmission_rate_pct"),
    )


def key_facts(scored: DataFrame) -> DataFrame:
    facts = {
        "Prior inpatient visits": F.col("number_inpatient").cast("string"),
        "Diagnoses": F.col("number_diagnoses").cast("string"),
        "Length of stay": F.concat(F.col("time_in_hospital").cast("string"), F.lit(" days")),
        "Discharge": C.disposition_label(F.col("discharge_disposition_id")),
        "Insulin": F.col("insulin"),
    }
    names = ["prior_inpatient", "diagnoses", "length_of_stay", "discharge", "insulin_status"]
    columns = [F.concat(F.lit(f"{title}: "), value).alias(n) for n, (title, value) in zip(names, facts.items())]
    return scored.select("encounter_id", *columns)


def kpis(scored: DataFrame) -> DataFrame:
    """Headline cards: encounters, overall rate and patients in the high tier."""
    high = F.col("tier") == S.HIGH_TIER
    per_patient = scored.groupBy("patient_nbr").agg(
        F.count("*").alias("n"),
        F.sum(C.readmitted_30()).alias("pos"),
        count_where(high).alias("high"),
    )
    return per_patient.agg(
        F.sum("n").alias("total_encounters"),
        rate_pct(F.sum("pos"), F.sum("n")).alias("overall_rate_pct"),
        F.sum("high").alias("high_risk_encounters"),
        count_where(F.col("high") > 0).alias("high_risk_patients"),
    )


def predictions(scored: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Export layout: true label, predicted probability, predicted class."""
    return scored.select(
        "encounter_id",
        C.readmitted_30().alias("true_label"),
        F.col(score).alias("predicted_prob"),
        (F.col(score) >= threshold).cast("int").alias("predicted_class"),
    )
