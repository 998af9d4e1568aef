"""Evaluation queries on the exact scorecard, so that SQL can check them."""

from pyspark.sql import functions as F

from wardstone.functions import clinical as C
from wardstone.operators import evaluate as V
from wardstone.operators import splits as L
from wardstone.operators.scoring import score_encounters
from wardstone.plans.oracle import over, scored, seeded_hash
from wardstone.plans.registry import query
from wardstone.plans.tables import encounters, first_encounters

SEED = 42


def _scored(spark, sf):
    return score_encounters(encounters(spark, sf)).withColumn("label", C.readmitted_30())


_COUNTS = "counts AS (SELECT score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored GROUP BY score)"
_RUNNING = """running AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
  SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM counts)"""


def _ranked(body: str) -> str:
    return over(body, scored("encounters"), _COUNTS, _RUNNING)


def _plain(body: str) -> str:
    return over(body, scored("encounters"))


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


@query(
    "roc_auc",
    _ranked(
        f"""SELECT CAST(MAX(P) AS BIGINT) AS positives, CAST(MAX(N) AS BIGINT) AS negatives,
        {_d("SUM(pos * (2 * (N - fp) + neg))")} / {_d("2 * MAX(P) * MAX(N)")} AS auc FROM running"""
    ),
)
def roc_auc(spark, sf):
    return V.roc_auc(_scored(spark, sf), "label", "score")


@query(
    "roc_curve",
    _ranked(
        f"""SELECT score AS threshold, {_d("fp")} / {_d("N")} AS fpr, {_d("tp")} / {_d("P")} AS tpr FROM running
        UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE"""
    ),
)
def roc_curve(spark, sf):
    return V.roc_curve(_scored(spark, sf), "label", "score")


@query(
    "pr_curve",
    _ranked(
        f"""SELECT score AS threshold, {_d("tp")} / {_d("tp + fp")} AS precision, {_d("tp")} / {_d("P")} AS recall FROM running
        UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"""
    ),
)
def pr_curve(spark, sf):
    return V.pr_curve(_scored(spark, sf), "label", "score")


@query(
    "average_precision",
    _ranked(
        f"""SELECT ROUND(SUM({_d("pos")} / {_d("P")} * ({_d("tp")} / {_d("tp + fp")})), 6) AS average_precision,
        {_d("MAX(P)")} / {_d("MAX(P) + MAX(N)")} AS base_precision FROM running"""
    ),
)
def average_precision(spark, sf):
    found = V.average_precision(_scored(spark, sf), "label", "score")
    return found.withColumn("average_precision", F.round("average_precision", 6))


def _cells(test: str) -> str:
    return ", ".join(
        f"CAST(COUNT(*) FILTER (WHERE label = {t} AND {'' if p else 'NOT'} ({test})) AS BIGINT) AS {n}"
        for n, t, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    )


def _or0(top: str, bottom: str) -> str:
    return f"COALESCE({_d(top)} / NULLIF({_d(bottom)}, 0), 0)"


@query(
    "confusion_matrix",
    _plain(
        " UNION ALL ".join(
            f"SELECT {t} AS true_label, {p} AS predicted_class, {n} AS count FROM (SELECT {_cells('score >= 0.25')} FROM scored)"
            for n, t, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        )
    ),
)
def confusion_matrix(spark, sf):
    return V.confusion_matrix(_scored(spark, sf), "label", "score", threshold=0.25)


_NEG = (_or0("tn", "tn + fn"), _or0("tn", "tn + fp"), _or0("tn * 2", "tn * 2 + fp + fn"))
_POS = (_or0("tp", "tp + fp"), _or0("tp", "tp + fn"), _or0("tp * 2", "tp * 2 + fp + fn"))
_ACC = _or0("tn + tp", "tn + fp + fn + tp")


def _report_row(name: str, values, support: str) -> str:
    p, r, f = values
    return f"""SELECT '{name}' AS class, {p} AS precision, {r} AS recall, {f} AS f1, CAST({support} AS BIGINT) AS support FROM cells"""


def _report(test: str) -> str:
    both = list(zip(_NEG, _POS))
    macro = [f"({a} + {b}) / 2.0::DOUBLE" for a, b in both]
    weighted = [f"({a} * {_d('tn + fp')} + {b} * {_d('tp + fn')}) / {_d('tn + fp + fn + tp')}" for a, b in both]
    everyone = "tn + fp + fn + tp"
    rows = [
        _report_row("Not Readmitted", _NEG, "tn + fp"), _report_row("Readmitted <30d", _POS, "tp + fn"),
        _report_row("accuracy", [_ACC] * 3, everyone), _report_row("macro avg", macro, everyone),
        _report_row("weighted avg", weighted, everyone),
    ]
    return over(" UNION ALL ".join(rows), scored("encounters"), f"cells AS (SELECT {_cells(test)} FROM scored)")


@query("classification_report", _report("score >= 0.25"))
def classification_report(spark, sf):
    return V.classification_report(_scored(spark, sf), "label", "score", threshold=0.25)


@query("naive_baseline", _report("FALSE"))
def naive_baseline(spark, sf):
    """Nobody is predicted to return: a constant score of zero."""
    constant = _scored(spark, sf).withColumn("score", F.lit(0.0))
    return V.classification_report(constant, "label", "score", threshold=0.5)


_THRESHOLDS = [0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5]


@query(
    "threshold_sweep",
    _plain(
        " UNION ALL ".join(
            f"""SELECT {t}::DOUBLE AS threshold, n AS flagged, h AS true_positives, {_or0('h', 'n')} AS precision,
            {_or0('h', 'p')} AS recall, {_d('n')} / NULLIF({_d('h')}, 0) AS flagged_per_hit
            FROM (SELECT COUNT(*) FILTER (WHERE score >= {t}) AS n, COUNT(*) FILTER (WHERE score >= {t} AND label = 1) AS h,
            SUM(label) AS p FROM scored)"""
            for t in _THRESHOLDS
        )
    ),
)
def threshold_sweep(spark, sf):
    return V.threshold_sweep(_scored(spark, sf), "label", "score", _THRESHOLDS)


@query(
    "calibration_table",
    _ranked(
        f"""SELECT CAST((P + N - tp - fp) * 10 // (P + N) + 1 AS INT) AS score_group, CAST(SUM(pos + neg) AS BIGINT) AS count,
        CAST(SUM(pos) AS BIGINT) AS positives, MIN(score) AS min_score, MAX(score) AS max_score,
        ROUND(SUM(score * {_d("pos + neg")}) / {_d("SUM(pos + neg)")}, 6) AS mean_score,
        {_d("SUM(pos)")} / {_d("SUM(pos + neg)")} AS observed_rate FROM running GROUP BY 1"""
    ),
)
def calibration_table(spark, sf):
    return V.calibration_table(_scored(spark, sf), "label", "score").withColumn("mean_score", F.round("mean_score", 6))


@query(
    "subgroup_metrics",
    _plain(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS dimension, segment, tn + fp + fn + tp AS support, tp + fn AS positives, {_ACC} AS accuracy,
            {_POS[0]} AS precision, {_POS[1]} AS recall, {_POS[2]} AS f1
            FROM (SELECT COALESCE({c}, 'Unknown') AS segment, {_cells('score >= 0.25')} FROM scored GROUP BY 1)"""
            for c in ("race", "gender")
        )
    ),
)
def subgroup_metrics(spark, sf):
    return V.subgroup_metrics(_scored(spark, sf), "label", "score", ["race", "gender"], threshold=0.25)


def _labelled(spark, sf):
    first = first_encounters(spark, sf)
    return first.select("encounter_id", C.readmitted_30().alias("readmitted_30"))


_HASH = seeded_hash("encounter_id", SEED)
_RANKED = f"""ranked AS (SELECT encounter_id, CAST(readmitted = '<30' AS INT) AS readmitted_30,
  ROW_NUMBER() OVER (PARTITION BY readmitted = '<30' ORDER BY {_HASH}, encounter_id) AS rn,
  COUNT(*) OVER (PARTITION BY readmitted = '<30') AS n FROM first_encounters)"""


@query(
    "stratified_split",
    over(
        "SELECT encounter_id, readmitted_30, rn <= FLOOR(n * 0.2::DOUBLE + 0.5) AS is_test FROM ranked",
        _RANKED, source="first_encounters",
    ),
)
def stratified_split(spark, sf):
    return L.stratified_split(_labelled(spark, sf), "readmitted_30", "encounter_id", 0.2, SEED)


@query(
    "stratified_folds",
    over(
        "SELECT encounter_id, readmitted_30, CAST((rn - 1) % 5 AS INT) AS fold FROM ranked",
        _RANKED, source="first_encounters",
    ),
)
def stratified_folds(spark, sf):
    return L.stratified_folds(_labelled(spark, sf), "readmitted_30", "encounter_id", 5, SEED)


@query(
    "seeded_sample",
    over(
        f"""SELECT encounter_id, CAST(readmitted = '<30' AS INT) AS readmitted_30 FROM first_encounters
        ORDER BY {_HASH}, encounter_id LIMIT 500""",
        source="first_encounters",
    ),
)
def seeded_sample(spark, sf):
    return L.seeded_sample(_labelled(spark, sf), "encounter_id", 500, SEED)


@query(
    "class_weights",
    over(
        """SELECT readmitted_30, COUNT(*) AS rows, CAST((SELECT COUNT(*) FROM first_encounters) AS DOUBLE) / CAST(2 * COUNT(*) AS DOUBLE) AS weight
        FROM (SELECT CAST(readmitted = '<30' AS INT) AS readmitted_30 FROM first_encounters) GROUP BY 1""",
        source="first_encounters",
    ),
)
def class_weights(spark, sf):
    return L.class_weights(_labelled(spark, sf), "readmitted_30")
