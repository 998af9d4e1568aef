"""Correlation, quantile, histogram and trend queries."""

from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.operators import stats as T
from wardstone.operators.features import build_features
from wardstone.operators.scoring import score_encounters
from wardstone.plans.oracle import features, over, scored
from wardstone.plans.registry import query
from wardstone.plans.tables import encounters, first_encounters

_NUMERIC = [*S.MEASURES, "readmitted_30"]
_BOX = ["time_in_hospital", "num_medications", "number_diagnoses", "number_inpatient"]
_MED_FEATURES = ["medication_changes", "insulin_changed", "num_active_meds"]


def _labelled(spark, sf):
    return first_encounters(spark, sf).withColumn("readmitted_30", C.readmitted_30())


def _r(a: str, b: str) -> str:
    def spread(c: str) -> str:
        return f"SQRT(CAST(COUNT(*)*SUM({c}*{c}) - SUM({c})*SUM({c}) AS DOUBLE))"

    return f"CAST(COUNT(*)*SUM({a}*{b}) - SUM({a})*SUM({b}) AS DOUBLE) / NULLIF({spread(a)} * {spread(b)}, 0)"


_LABELLED = "labelled AS (SELECT *, CAST(readmitted = '<30' AS INT) AS readmitted_30 FROM first_encounters)"


@query(
    "correlations",
    over(
        " UNION ALL ".join(
            f"SELECT '{_NUMERIC[j]}' AS a, '{_NUMERIC[i]}' AS b, {_r(_NUMERIC[j], _NUMERIC[i])} AS r FROM labelled"
            for j in range(len(_NUMERIC)) for i in range(j)
        ),
        _LABELLED, source="first_encounters",
    ),
)
def correlations(spark, sf):
    return T.correlations(_labelled(spark, sf), _NUMERIC)


@query(
    "target_correlations",
    over(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {_r('readmitted_30', c)} AS r FROM labelled" for c in S.MEASURES
        ),
        _LABELLED, source="first_encounters",
    ),
)
def target_correlations(spark, sf):
    return T.target_correlations(_labelled(spark, sf), S.MEASURES, "readmitted_30")


def _box_sql(c: str) -> str:
    return f"""SELECT readmitted_30, '{c}' AS measure, q1, median, q3, COUNT(*) AS count,
      MIN(CASE WHEN x BETWEEN q1 - (q3-q1)*1.5 AND q3 + (q3-q1)*1.5 THEN x END) AS whisker_low,
      MAX(CASE WHEN x BETWEEN q1 - (q3-q1)*1.5 AND q3 + (q3-q1)*1.5 THEN x END) AS whisker_high,
      CAST(COUNT(*) FILTER (WHERE NOT x BETWEEN q1 - (q3-q1)*1.5 AND q3 + (q3-q1)*1.5) AS BIGINT) AS outliers
    FROM (SELECT readmitted_30, CAST({c} AS DOUBLE) AS x FROM labelled) JOIN
      (SELECT readmitted_30, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
        quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM labelled GROUP BY readmitted_30) USING (readmitted_30)
    GROUP BY readmitted_30, q1, median, q3"""


@query(
    "boxplot_stats",
    over(" UNION ALL ".join(_box_sql(c) for c in _BOX), _LABELLED, source="first_encounters"),
)
def boxplot_stats(spark, sf):
    return T.boxplot_stats(_labelled(spark, sf), "readmitted_30", _BOX)


@query(
    "describe_meds",
    over(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, COUNT(*) AS count, CAST(SUM({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean,
            SQRT(CAST(COUNT(*)*SUM({c}*{c}) - SUM({c})*SUM({c}) AS DOUBLE) / CAST(COUNT(*)*(COUNT(*)-1) AS DOUBLE)) AS std,
            CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
            quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM features"""
            for c in _MED_FEATURES
        ),
        features("first_encounters"), source="first_encounters",
    ),
)
def describe_meds(spark, sf):
    return T.describe(build_features(first_encounters(spark, sf)), _MED_FEATURES)


@query(
    "lab_p75",
    over(
        "SELECT quantile_cont(CAST(num_lab_procedures AS DOUBLE), 0.75) AS lab_p75 FROM first_encounters",
        source="first_encounters",
    ),
)
def lab_p75(spark, sf):
    return T.quantile(first_encounters(spark, sf), "num_lab_procedures", 0.75, "lab_p75")


@query(
    "utilization_trend",
    over(
        """SELECT n, cov / vx AS slope, (CAST(sy AS DOUBLE) - cov / vx * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS intercept,
        cov / vx * (cov / vy) AS r2
        FROM (SELECT COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, CAST(COUNT(*)*SUM(x*x) - SUM(x)*SUM(x) AS DOUBLE) AS vx,
          CAST(COUNT(*)*SUM(y*y) - SUM(y)*SUM(y) AS DOUBLE) AS vy, CAST(COUNT(*)*SUM(x*y) - SUM(x)*SUM(y) AS DOUBLE) AS cov
          FROM (SELECT number_inpatient*3 + number_emergency*2 + number_outpatient AS x, readmitted_30 AS y FROM labelled))""",
        _LABELLED, source="first_encounters",
    ),
)
def utilization_trend(spark, sf):
    score = C.prior_utilization(F.col("number_inpatient"), F.col("number_emergency"), F.col("number_outpatient"))
    points = _labelled(spark, sf).select(score.alias("prior_utilization_score"), "readmitted_30")
    return T.linear_trend(points, "prior_utilization_score", "readmitted_30")


@query(
    "score_histogram",
    over(
        """SELECT label, bin, lo + (hi - lo) / 50 * bin AS bin_start, COALESCE(c, 0) AS count,
        CAST(COALESCE(c, 0) AS DOUBLE) / (CAST(n AS DOUBLE) * ((hi - lo) / 50)) AS density
        FROM (SELECT label, CAST(MIN(score_milli) AS DOUBLE) AS lo, CAST(MAX(score_milli) AS DOUBLE) AS hi, COUNT(*) AS n FROM scored GROUP BY label)
        CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range(50))
        LEFT JOIN (SELECT label, CAST(LEAST(FLOOR(CAST(score_milli - lo AS DOUBLE) * 50 / (hi - lo)), 49) AS INT) AS bin, COUNT(*) AS c
          FROM scored JOIN (SELECT label, MIN(score_milli) AS lo, MAX(score_milli) AS hi FROM scored GROUP BY label) USING (label) GROUP BY 1, 2)
        USING (label, bin)""",
        scored("encounters"),
    ),
)
def score_histogram(spark, sf):
    labelled = score_encounters(encounters(spark, sf)).withColumn("label", C.readmitted_30())
    return T.score_histogram(labelled, "score_milli", "label", bins=50)
