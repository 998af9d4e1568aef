"""Readmission-rate queries."""

from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.operators import profile as P
from wardstone.operators import segments as G
from wardstone.operators.scoring import kpis as kpi_cards
from wardstone.operators.scoring import score_encounters
from wardstone.plans.oracle import POS, count_if, features, over, rate, ratio, scored
from wardstone.plans.registry import query
from wardstone.plans.tables import encounters, first_encounters

_RATE = rate(POS, "COUNT(*)")


def _rate_sql(column: str, *, alias: str | None = None, having: int = 0, where: str = "", source: str = "encounters") -> str:
    having_sql = f" HAVING COUNT(*) > {having}" if having else ""
    return over(
        f"""SELECT {column} AS {alias or column}, COUNT(*) AS total, {POS} AS readmitted_30, {_RATE} AS readmission_rate_pct
        FROM {source} {where} GROUP BY {column}{having_sql}""",
        source=source,
    )


@query("rate_by_age", _rate_sql("age", alias="age_group"))
def rate_by_age(spark, sf):
    return G.segment_rate(encounters(spark, sf), F.col("age").alias("age_group")).orderBy("age_group")


@query("rate_by_gender", _rate_sql("gender", where="WHERE gender <> 'Unknown/Invalid'"))
def rate_by_gender(spark, sf):
    return G.segment_rate(encounters(spark, sf).filter(F.col("gender") != S.INVALID_GENDER), "gender")


@query("rate_by_race", _rate_sql("COALESCE(race, 'Unknown')", alias="race"))
def rate_by_race(spark, sf):
    named = F.coalesce(F.col("race"), F.lit(S.UNKNOWN)).alias("race")
    return G.segment_rate(encounters(spark, sf), named).orderBy(F.desc("readmission_rate_pct"), "race")


@query("rate_by_disposition", _rate_sql("discharge_disposition_id", having=200))
def rate_by_disposition(spark, sf):
    return G.segment_rate(encounters(spark, sf), "discharge_disposition_id", min_count=200).orderBy(
        F.desc("readmission_rate_pct"), "discharge_disposition_id"
    )


@query("rate_by_disposition_500", _rate_sql("discharge_disposition_id", having=500))
def rate_by_disposition_500(spark, sf):
    return G.segment_rate(encounters(spark, sf), "discharge_disposition_id", min_count=500).orderBy(
        F.desc("total"), "discharge_disposition_id"
    )


@query("rate_by_inpatient", _rate_sql("number_inpatient", alias="prior_inpatient_visits"))
def rate_by_inpatient(spark, sf):
    visits = F.col("number_inpatient").alias("prior_inpatient_visits")
    return G.segment_rate(encounters(spark, sf), visits).orderBy("prior_inpatient_visits")


@query("rate_by_inpatient_100", _rate_sql("number_inpatient", alias="prior_inpatient_visits", having=100))
def rate_by_inpatient_100(spark, sf):
    visits = F.col("number_inpatient").alias("prior_inpatient_visits")
    return G.segment_rate(encounters(spark, sf), visits, min_count=100).orderBy("prior_inpatient_visits")


@query(
    "reference_rates",
    over(f"""SELECT {rate("SUM(pos)", "SUM(n)")} AS overall_rate,
    CAST(SUM(CASE WHEN n > 100 THEN (pos*20000+n)//(2*n) END) AS DOUBLE) / CAST(COUNT(CASE WHEN n > 100 THEN 1 END) AS DOUBLE) / 100.0::DOUBLE AS mean_of_group_rates
    FROM (SELECT number_inpatient, COUNT(*) AS n, {POS} AS pos FROM encounters GROUP BY number_inpatient)"""),
)
def reference_rates(spark, sf):
    return G.reference_rates(encounters(spark, sf), "number_inpatient", min_count=100)


_MEANS = {
    "time_in_hospital": "avg_los_days", "num_medications": "avg_medications", "num_lab_procedures": "avg_lab_procedures",
    "number_diagnoses": "avg_diagnoses", "number_inpatient": "avg_prior_inpatient", "number_emergency": "avg_prior_emergency",
}


@query(
    "utilization_means",
    over(
        "SELECT CASE WHEN readmitted = '<30' THEN 'Readmitted <30d' ELSE 'Other' END AS readmission_group, "
        + ", ".join(f"{ratio(f'SUM({c})', f'COUNT({c})')} AS {n}" for c, n in _MEANS.items())
        + " FROM encounters GROUP BY 1"
    ),
)
def utilization_means(spark, sf):
    return G.utilization_means(encounters(spark, sf), _MEANS)


@query("rate_by_los", _rate_sql("time_in_hospital", alias="los_days"))
def rate_by_los(spark, sf):
    return G.segment_rate(encounters(spark, sf), F.col("time_in_hospital").alias("los_days")).orderBy("los_days")


@query("rate_by_insulin", _rate_sql("insulin"))
def rate_by_insulin(spark, sf):
    return G.segment_rate(encounters(spark, sf), "insulin").orderBy(F.desc("readmission_rate_pct"), "insulin")


@query(
    "rate_by_med_change",
    _rate_sql(
        """CASE WHEN metformin IN ('Up','Down') OR insulin IN ('Up','Down') OR glipizide IN ('Up','Down')
        OR glyburide IN ('Up','Down') THEN 'Had medication change' ELSE 'No medication change' END""",
        alias="medication_change",
    ),
)
def rate_by_med_change(spark, sf):
    return G.segment_rate(
        encounters(spark, sf), G.any_dose_change(S.DOSE_CHANGE_MEDICATIONS).alias("medication_change")
    )


@query("rate_by_a1c", _rate_sql("A1Cresult"))
def rate_by_a1c(spark, sf):
    return G.segment_rate(encounters(spark, sf), "A1Cresult").orderBy(F.desc("readmission_rate_pct"), "A1Cresult")


def _eda_sql(column: str, having: int, alias: str | None = None, source: str = "first_encounters") -> str:
    return over(
        f"""SELECT {column} AS {alias or column}, COUNT(*) AS count, CAST({POS} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE AS readmission_rate
        FROM {source} GROUP BY {column} HAVING COUNT(*) > {having}""",
        source="first_encounters",
    )


@query("rate_by_glucose", _eda_sql("max_glu_serum", 100))
def rate_by_glucose(spark, sf):
    return G.mean_rate(first_encounters(spark, sf), "max_glu_serum", min_count=100)


@query("eda_a1c", _eda_sql("A1Cresult", 100))
def eda_a1c(spark, sf):
    return G.mean_rate(first_encounters(spark, sf), "A1Cresult", min_count=100)


@query("eda_age", _eda_sql("age", 0))
def eda_age(spark, sf):
    return G.mean_rate(first_encounters(spark, sf), "age").orderBy("age")


_LABEL = """CASE discharge_disposition_id WHEN 1 THEN 'Home' WHEN 2 THEN 'Home (other)' WHEN 3 THEN 'Skilled Nursing Facility'
  WHEN 6 THEN 'Home Health Agency' WHEN 7 THEN 'Left AMA' WHEN 11 THEN 'Expired' WHEN 13 THEN 'Hospice'
  WHEN 14 THEN 'Hospice (facility)' WHEN 22 THEN 'Rehab facility' WHEN 25 THEN 'Not mapped' ELSE 'Other' END"""


@query(
    "discharge_labels",
    over(f"SELECT encounter_id, discharge_disposition_id, {_LABEL} AS discharge_label FROM encounters"),
)
def discharge_labels(spark, sf):
    return encounters(spark, sf).select(
        "encounter_id", "discharge_disposition_id",
        C.disposition_label(F.col("discharge_disposition_id")).alias("discharge_label"),
    )


@query(
    "rate_by_discharge_label",
    over(
        f"""SELECT discharge_label, count, pos / CAST(count AS DOUBLE) * 100.0::DOUBLE AS readmission_rate,
        pos / CAST(count AS DOUBLE) > overall AS above_overall
        FROM (SELECT {_LABEL} AS discharge_label, COUNT(*) AS count, CAST({POS} AS DOUBLE) AS pos FROM first_encounters GROUP BY 1),
             (SELECT CAST({POS} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS overall FROM first_encounters)
        WHERE discharge_label NOT IN ('Expired', 'Hospice', 'Hospice (facility)') AND count > 200""",
        source="first_encounters",
    ),
)
def rate_by_discharge_label(spark, sf):
    return G.rate_by_label(first_encounters(spark, sf), min_count=200).orderBy("readmission_rate", "discharge_label")


@query("rate_by_diagnoses", _rate_sql("number_diagnoses"))
def rate_by_diagnoses(spark, sf):
    return G.segment_rate(encounters(spark, sf), "number_diagnoses").orderBy("number_diagnoses")


@query("overall_rate", over(f"SELECT {_RATE} AS overall_readmission_rate_pct FROM encounters"))
def overall_rate(spark, sf):
    return G.overall_rate(encounters(spark, sf))


_INSIGHTS = {
    "3+ prior inpatient visits": "number_inpatient >= 3",
    "0 prior inpatient visits": "number_inpatient = 0",
    "Insulin dose changed": "insulin IN ('Up','Down')",
    "Insulin steady / not prescribed": "insulin NOT IN ('Up','Down')",
    "Age 70-80": "age = '[70-80)'",
    "Age 20-30": "age = '[20-30)'",
}


@query(
    "insight_segments",
    over(
        " UNION ALL ".join(
            f"SELECT '{name}' AS segment, {_RATE} AS readmission_rate FROM encounters WHERE {test}"
            for name, test in _INSIGHTS.items()
        )
    ),
)
def insight_segments(spark, sf):
    return G.insight_segments(encounters(spark, sf))


@query(
    "med_status_rates",
    over(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS medication, {m} AS status, COUNT(*) AS count,
            CAST({POS} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE AS readmission_rate,
            CASE {m} WHEN 'No' THEN 1 WHEN 'Steady' THEN 2 WHEN 'Up' THEN 3 ELSE 4 END AS status_order
            FROM first_encounters GROUP BY {m}"""
            for m in S.HEADLINE_MEDICATIONS
        ),
        source="first_encounters",
    ),
)
def med_status_rates(spark, sf):
    return G.medication_status_rates(first_encounters(spark, sf)).orderBy("medication", "status_order")


@query(
    "comorbidity_counts",
    over(
        """SELECT (diag_1 IS NOT NULL)::INT + (diag_2 IS NOT NULL)::INT + (diag_3 IS NOT NULL)::INT AS comorbidity_count,
        COUNT(*) AS count FROM first_encounters GROUP BY 1""",
        source="first_encounters",
    ),
)
def comorbidity_counts(spark, sf):
    count = C.comorbidity_count(F.col("diag_1"), F.col("diag_2"), F.col("diag_3"))
    return P.value_counts(first_encounters(spark, sf), count, "comorbidity_count").orderBy(
        "comorbidity_count"
    )


@query(
    "icd_counts",
    over(
        "SELECT diag1_category, COUNT(*) AS count FROM features GROUP BY diag1_category",
        features("first_encounters"), source="first_encounters",
    ),
)
def icd_counts(spark, sf):
    first = first_encounters(spark, sf)
    return P.value_counts(first, C.icd9_category(F.col("diag_1")), "diag1_category").orderBy(
        F.desc("count"), "diag1_category"
    )


@query(
    "rate_by_risk_group",
    over(
        f"""SELECT discharge_risk_group, COUNT(*) AS count, CAST({POS} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS readmission_rate
        FROM features GROUP BY 1""",
        features("first_encounters"), source="first_encounters",
    ),
)
def rate_by_risk_group(spark, sf):
    group = C.discharge_risk_group(F.col("discharge_disposition_id")).alias("discharge_risk_group")
    return G.mean_rate(first_encounters(spark, sf), group, percent=False)


@query(
    "rate_by_util_bin",
    over(
        f"""SELECT CASE WHEN u <= 1 THEN 'Low (0-1)' WHEN u <= 3 THEN 'Med (2-3)' WHEN u <= 6 THEN 'High (4-6)' ELSE 'Very high (7+)' END AS utilization_band,
        COUNT(*) AS count, CAST({POS} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS readmission_rate
        FROM (SELECT *, number_inpatient*3 + number_emergency*2 + number_outpatient AS u FROM first_encounters)
        WHERE u BETWEEN 0 AND 100 GROUP BY 1""",
        source="first_encounters",
    ),
)
def rate_by_util_bin(spark, sf):
    score = C.prior_utilization(F.col("number_inpatient"), F.col("number_emergency"), F.col("number_outpatient"))
    banded = first_encounters(spark, sf).withColumn("utilization_band", C.utilization_band(score))
    return G.mean_rate(banded.filter(F.col("utilization_band").isNotNull()), "utilization_band", percent=False)


@query(
    "age_map_check",
    over(
        "SELECT DISTINCT age, CAST(SUBSTR(age, 2, POSITION('-' IN age) - 2) AS INT) + 5 AS age_numeric FROM first_encounters",
        source="first_encounters",
    ),
)
def age_map_check(spark, sf):
    first = first_encounters(spark, sf)
    return first.select("age", C.age_midpoint(F.col("age")).alias("age_numeric")).distinct().orderBy("age_numeric")


@query(
    "kpis",
    over(
        f"""SELECT COUNT(*) AS total_encounters, {_RATE} AS overall_rate_pct, {count_if("tier = 'High'")} AS high_risk_encounters,
        CAST(COUNT(DISTINCT CASE WHEN tier = 'High' THEN patient_nbr END) AS BIGINT) AS high_risk_patients FROM scored""",
        scored("encounters"),
    ),
)
def kpis(spark, sf):
    return kpi_cards(score_encounters(encounters(spark, sf)))


def _heat_sql(column: str) -> str:
    parts = {"n_lt30": "<30", "n_gt30": ">30", "n_no": "NO"}
    cells = ", ".join(f"""{count_if(f"readmitted = '{v}'")} AS {n}""" for n, v in parts.items())
    return f"SELECT '{column}' AS test, {column} AS test_result, {cells} FROM encounters GROUP BY {column}"


@query("lab_heatmap", over(_heat_sql("A1Cresult") + " UNION ALL " + _heat_sql("max_glu_serum")))
def lab_heatmap(spark, sf):
    rows = G.long_segments(encounters(spark, sf), ["A1Cresult", "max_glu_serum"], ["readmitted"])
    outcomes = {"<30": "n_lt30", ">30": "n_gt30", "NO": "n_no"}
    return G.outcome_heatmap(rows, {"dimension": "test", "segment": "test_result"}, outcomes)


@query(
    "inpatient_uplift",
    over(
        f"""SELECT prior_inpatient_bucket, total, {rate("pos", "total")} AS readmission_rate_pct,
        {ratio("MAX(CASE WHEN prior_inpatient_bucket = 3 THEN pos END) OVER () * MAX(CASE WHEN prior_inpatient_bucket = 0 THEN total END) OVER ()",
               "MAX(CASE WHEN prior_inpatient_bucket = 3 THEN total END) OVER () * MAX(CASE WHEN prior_inpatient_bucket = 0 THEN pos END) OVER ()")} AS uplift_3plus_vs_0
        FROM (SELECT LEAST(number_inpatient, 3) AS prior_inpatient_bucket, COUNT(*) AS total, {POS} AS pos FROM encounters GROUP BY 1)"""
    ),
)
def inpatient_uplift(spark, sf):
    return G.inpatient_uplift(encounters(spark, sf))


@query(
    "segment_rates_all",
    over(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS dimension, COALESCE(CAST({c} AS VARCHAR), 'Unknown') AS segment, COUNT(*) AS total,
            {POS} AS readmitted_30, {_RATE} AS readmission_rate_pct FROM encounters GROUP BY {c}"""
            for c in S.SEGMENT_DIMENSIONS
        )
    ),
)
def segment_rates_all(spark, sf):
    return G.segment_rates_all(encounters(spark, sf))


_TESTED, _TESTED_POS = count_if("A1Cresult <> 'None'"), count_if("A1Cresult <> 'None' AND readmitted = '<30'")
_UNTESTED, _UNTESTED_POS = count_if("A1Cresult = 'None'"), count_if("A1Cresult = 'None' AND readmitted = '<30'")


@query(
    "a1c_testing",
    over(
        f"""SELECT COUNT(*) AS total, {_TESTED} AS tested, {rate(_TESTED, "COUNT(*)")} AS tested_pct,
        {rate(_TESTED_POS, _TESTED)} AS rate_tested_pct, {rate(_UNTESTED_POS, _UNTESTED)} AS rate_untested_pct FROM encounters"""
    ),
)
def a1c_testing(spark, sf):
    return G.lab_testing(encounters(spark, sf))
