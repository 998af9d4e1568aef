"""Scorecard, tier, action, export and explanation queries."""

from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.operators import explain as A
from wardstone.operators import scoring as R
from wardstone.operators.stats import standardize as standardized
from wardstone.plans.oracle import POS, over, rate, scored
from wardstone.plans.registry import query
from wardstone.session import scratch_path
from wardstone.sources.encounters import write_csv
from wardstone.plans.tables import encounters


def _scored(spark, sf):
    return R.score_encounters(encounters(spark, sf))


def _plain(body: str) -> str:
    return over(body, scored("encounters"))


@query("scorecard", _plain("SELECT encounter_id, score_milli, score FROM scored"))
def scorecard(spark, sf):
    return _scored(spark, sf).select("encounter_id", "score_milli", "score")


@query("risk_tiers", _plain("SELECT encounter_id, score, tier FROM scored"))
def risk_tiers(spark, sf):
    return _scored(spark, sf).select("encounter_id", "score", "tier")


@query(
    "tier_summary",
    _plain(
        f"""SELECT tier, COUNT(*) AS encounters, CAST(SUM(label) AS BIGINT) AS readmitted_30,
        {rate(POS, "COUNT(*)")} AS readmission_rate_pct FROM scored GROUP BY tier"""
    ),
)
def tier_summary(spark, sf):
    return R.tier_summary(_scored(spark, sf))


def _action_rows() -> str:
    rows = [(t, i + 1, a) for t, actions in S.CARE_ACTIONS.items() for i, a in enumerate(actions)]
    return ", ".join(f"('{t}', {i}, '{a}')" for t, i, a in rows)


@query(
    "care_actions",
    _plain(
        f"""SELECT encounter_id, tier, action_no, action FROM scored
        JOIN (VALUES {_action_rows()}) AS actions(tier, action_no, action) USING (tier)"""
    ),
)
def care_actions(spark, sf):
    return R.care_actions(_scored(spark, sf))


@query(
    "key_facts",
    _plain(
        """SELECT encounter_id, 'Prior inpatient visits: ' || number_inpatient AS prior_inpatient, 'Diagnoses: ' || number_diagnoses AS diagnoses,
        'Length of stay: ' || time_in_hospital || ' days' AS length_of_stay,
        'Discharge: ' || CASE discharge_disposition_id WHEN 1 THEN 'Home' WHEN 2 THEN 'Home (other)' WHEN 3 THEN 'Skilled Nursing Facility'
          WHEN 6 THEN 'Home Health Agency' WHEN 7 THEN 'Left AMA' WHEN 11 THEN 'Expired' WHEN 13 THEN 'Hospice'
          WHEN 14 THEN 'Hospice (facility)' WHEN 22 THEN 'Rehab facility' WHEN 25 THEN 'Not mapped' ELSE 'Other' END AS discharge,
        'Insulin: ' || insulin AS insulin_status FROM scored"""
    ),
)
def key_facts(spark, sf):
    return R.key_facts(_scored(spark, sf))


@query(
    "export_predictions",
    _plain(
        """SELECT encounter_id, label AS true_label, score AS predicted_prob, CAST(score >= 0.5 AS INT) AS predicted_class FROM scored"""
    ),
)
def export_predictions(spark, sf):
    """Written as CSV for the dashboard, then read back."""
    path = scratch_path(spark, "predictions")
    exported = R.predictions(_scored(spark, sf))
    write_csv(exported, path)
    return spark.read.schema(exported.schema).option("header", True).csv(path)


@query(
    "standardize",
    over(
        "SELECT encounter_id, "
        + ", ".join(
            f"""(CAST({c} AS DOUBLE) - CAST(s_{c} AS DOUBLE) / CAST(n AS DOUBLE))
            / NULLIF(SQRT(CAST(n * q_{c} - s_{c} * s_{c} AS DOUBLE)) / CAST(n AS DOUBLE), 0) AS {c}"""
            for c in S.MEASURES
        )
        + " FROM encounters, (SELECT COUNT(*) AS n, "
        + ", ".join(f"SUM({c}) AS s_{c}, SUM({c} * {c}) AS q_{c}" for c in S.MEASURES)
        + " FROM encounters)"
    ),
)
def standardize(spark, sf):
    return standardized(encounters(spark, sf), S.MEASURES, ["encounter_id"])


_W = S.SCORECARD_WEIGHTS
_PHI = ", ".join(
    f"CAST(({c} * n - s_{c}) * {w} AS DOUBLE) / CAST(n * 1000 AS DOUBLE) AS phi_{c}" for c, w in _W.items()
)
_WIDE = f"""sums AS (SELECT COUNT(*) AS n, {", ".join(f"SUM({c}) AS s_{c}" for c in _W)} FROM scored),
attributions AS (SELECT encounter_id, {_PHI} FROM scored, sums)"""
_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT encounter_id, '{c}' AS feature, phi_{c} AS attribution FROM attributions" for c in _W
) + ")"
_BASE = f"""base_row AS (SELECT CAST(COUNT(*) * {S.SCORECARD_BASE} + SUM({" + ".join(f"{c} * {w}" for c, w in _W.items())}) AS DOUBLE)
  / CAST(COUNT(*) * 1000 AS DOUBLE) AS base_value FROM scored)"""


def _attr(body: str) -> str:
    return over(body, scored("encounters"), _WIDE, _LONG, _BASE)


def _long(df):
    return A.to_long(A.scorecard_attributions(df), ["encounter_id"], list(_W))


@query("scorecard_attributions", _attr("SELECT * FROM attributions"))
def scorecard_attributions(spark, sf):
    return A.scorecard_attributions(_scored(spark, sf))


@query(
    "export_attributions",
    _attr(
        """SELECT feature, ROUND(AVG(ABS(attribution)), 9) AS mean_abs_shap FROM long GROUP BY feature
        ORDER BY 2 DESC, feature LIMIT 15"""
    ),
)
def export_attributions(spark, sf):
    top = A.mean_abs_attribution(_long(_scored(spark, sf)), top=15)
    return top.withColumn("mean_abs_shap", F.round("mean_abs_shap", 9))


@query(
    "patient_breakdown",
    _attr(
        """SELECT encounter_id, line, feature, ROUND(SUM(attribution), 9) AS attribution, COUNT(*) AS features, base_value
        FROM (SELECT encounter_id, attribution, CAST(LEAST(r, 12) AS INT) AS line, CASE WHEN r >= 12 AND n > 12 THEN 'other features' ELSE feature END AS feature
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY encounter_id ORDER BY ABS(attribution) DESC, feature) AS r,
          COUNT(*) OVER (PARTITION BY encounter_id) AS n FROM long)), base_row
        GROUP BY encounter_id, line, feature, base_value"""
    ),
)
def patient_breakdown(spark, sf):
    scored_rows = _scored(spark, sf)
    base = A.scorecard_base_value(scored_rows).scalar()
    wide = A.scorecard_attributions(scored_rows)
    return A.patient_breakdown(wide, "encounter_id", A.wide_entries(list(_W)), base, max_display=12).withColumn(
        "attribution", F.round("attribution", 9)
    )


@query(
    "dependence_table",
    _attr(
        """SELECT encounter_id, number_inpatient AS value, phi_number_inpatient AS attribution, number_diagnoses AS interaction_value
        FROM scored JOIN attributions USING (encounter_id)"""
    ),
)
def dependence_table(spark, sf):
    kept = ["encounter_id", "number_inpatient", "number_diagnoses"]
    wide = A.scorecard_attributions(_scored(spark, sf), keep=kept)
    return A.dependence_table(wide, "encounter_id", "number_inpatient", "number_diagnoses")
