"""Classifier evaluation over a (label, score) DataFrame.

Rank-based measures work on counts per distinct score. Their running totals
come in two levels: score ranges of nearly equal size, then positions inside a
range. No step sorts the whole table in one task, for a few hundred distinct
scores as for a billion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.functions.rates import count_where, exact, fraction
from wardstone.operators.ranges import ROWS_PER_RANGE, with_range
from wardstone.operators.segments import long_segments
from wardstone.session import materialize


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        df.select(F.col(score).alias("score"), F.col(label).alias("label"))
        .filter(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy("score")
        .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    )


def _totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def running_counts(df: DataFrame, label: str, score: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per distinct score: ``tp``/``fp`` at or above it, and the class totals ``P``/``N``.

    The counts per score are stored first, so the scored table is read once.
    """
    counts = materialize(score_counts(df, label, score), "score_counts")
    ranged = with_range(counts, "score", rows_per_range)
    down = Window.partitionBy().orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    offsets = _totals(ranged, ["_range"]).select(
        "_range",
        (F.sum("pos").over(down) - F.col("pos")).alias("_tp0"),
        (F.sum("neg").over(down) - F.col("neg")).alias("_fp0"),
        F.sum("pos").over(whole).alias("P"),
        F.sum("neg").over(whole).alias("N"),
    )
    within = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({"_tp": F.sum("pos").over(within), "_fp": F.sum("neg").over(within)})
        .join(offsets, "_range")  # partitioned alike already; Spark broadcasts the offsets when they are few
        .select(
            "score", "pos", "neg",
            (F.col("_tp0") + F.col("_tp")).alias("tp"),
            (F.col("_fp0") + F.col("_fp")).alias("fp"),
            "P", "N",
        )
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    running = running_counts(df, label, score)
    below = exact(F.col("N") - F.col("fp"))
    wins = exact(F.sum(exact(F.col("pos")) * (below * 2 + exact(F.col("neg")))))
    pairs = exact(F.max("P")) * exact(F.max("N")) * 2
    return running.agg(
        F.max("P").alias("positives"),
        F.max("N").alias("negatives"),
        (wins.cast("double") / F.nullif(pairs.cast("double"), F.lit(0.0))).alias("auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score used as threshold, plus the origin (NULL threshold)."""
    points = running_counts(df, label, score).select(
        F.col("score").alias("threshold"),
        fraction(F.col("fp"), F.col("N")).alias("fpr"),
        fraction(F.col("tp"), F.col("P")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall per distinct score, plus the end point (NULL threshold, precision 1, recall 0)."""
    points = running_counts(df, label, score).select(
        F.col("score").alias("threshold"),
        fraction(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        fraction(F.col("tp"), F.col("P")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Step sum of precision over recall gains, and the base precision.

    A recall gain at a score is its own positives over all positives, so no
    look at the previous row is needed.
    """
    gain = fraction(F.col("pos"), F.col("P")) * fraction(F.col("tp"), F.col("tp") + F.col("fp"))
    return running_counts(df, label, score).agg(
        F.sum(gain).alias("average_precision"),
        fraction(F.max("P"), F.max("P") + F.max("N")).alias("base_precision"),
    )


def _cells(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tn": count_where((label == 0) & ~predicted),
        "fp": count_where((label == 0) & predicted),
        "fn": count_where((label == 1) & ~predicted),
        "tp": count_where((label == 1) & predicted),
    }


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Always four cells, empty ones included."""
    cells = _cells(F.col(label), F.col(score) >= threshold)
    layout = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    rows = [
        F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("predicted_class"), F.col(c).alias("count"))
        for c, (t, p) in layout.items()
    ]
    return df.agg(*[v.alias(c) for c, v in cells.items()]).select(F.inline(F.array(*rows)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(fraction(top, bottom), F.lit(0.0))


def _class_report(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Precision, recall and F1, 0 where undefined."""
    return [_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tp * 2, tp * 2 + fp + fn)]


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    cells = _cells(F.col(label), F.col(score) >= threshold)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    negative, positive = _class_report(tn, fn, fp), _class_report(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    correct = _ratio(tn + tp, n0 + n1)
    macro = [(a + b) / 2.0 for a, b in zip(negative, positive)]
    weighted = [
        (a * n0.cast("double") + b * n1.cast("double")) / F.nullif((n0 + n1).cast("double"), F.lit(0.0))
        for a, b in zip(negative, positive)
    ]

    def row(name: str, values: list[Column], support: Column) -> Column:
        names = ("precision", "recall", "f1")
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(n) for n, v in zip(names, values)], support.alias("support")
        )

    rows = [
        row("Not Readmitted", negative, n0),
        row("Readmitted <30d", positive, n1),
        row("accuracy", [correct] * 3, n0 + n1),
        row("macro avg", macro, n0 + n1),
        row("weighted avg", weighted, n0 + n1),
    ]
    return df.agg(*[v.alias(c) for c, v in cells.items()]).select(F.inline(F.array(*rows)))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Flagged rows, precision and recall at each threshold, from one pass."""
    positive = F.col(label) == 1
    counts = [count_where(positive).alias("_p")]
    for i, t in enumerate(thresholds):
        flagged = F.col(score) >= t
        counts += [count_where(flagged).alias(f"n{i}"), count_where(flagged & positive).alias(f"t{i}")]
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.col(f"n{i}").alias("flagged"),
            F.col(f"t{i}").alias("true_positives"),
            _ratio(F.col(f"t{i}"), F.col(f"n{i}")).alias("precision"),
            _ratio(F.col(f"t{i}"), F.col("_p")).alias("recall"),
            fraction(F.col(f"n{i}"), F.col(f"t{i}")).alias("flagged_per_hit"),
        )
        for i, t in enumerate(thresholds)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def calibration_table(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score against observed rate by rank group; equal scores share a group.

    The group is the share of rows with a lower score, so it needs only the
    running counts.
    """
    rows = F.col("pos") + F.col("neg")
    below = F.col("P") + F.col("N") - F.col("tp") - F.col("fp")
    group = (F.call_function("div", below * bins, F.col("P") + F.col("N")) + 1).cast("int")
    grouped = running_counts(df, label, score).groupBy(group.alias("score_group")).agg(
        F.sum(rows).alias("count"),
        F.sum("pos").alias("positives"),
        F.sum(F.col("score") * rows).alias("_s"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )
    return grouped.select(
        "score_group", "count", "positives", "min_score", "max_score",
        (F.col("_s") / F.col("count")).alias("mean_score"),
        fraction(F.col("positives"), F.col("count")).alias("observed_rate"),
    )


def subgroup_metrics(df: DataFrame, label: str, score: str, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """Positive-class report within every value of several columns, from one pass."""
    rows = long_segments(df, columns, [F.col(label).alias("label"), F.col(score).alias("score")])
    cells = _cells(F.col("label"), F.col("score") >= threshold)
    grouped = rows.groupBy("dimension", F.coalesce("segment", F.lit("Unknown")).alias("segment")).agg(
        *[v.alias(c) for c, v in cells.items()]
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall, f1 = _class_report(tp, fp, fn)
    return grouped.select(
        "dimension", "segment",
        (tn + fp + fn + tp).alias("support"), (tp + fn).alias("positives"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )


def _running_by(scored: DataFrame, group: str, label: str, score: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """As ``running_counts``, for every group at once: the rows are scored and read once."""
    rows = scored.select(group, F.col(score).alias("score"), F.col(label).alias("label"))
    counts = (
        rows.filter(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy(group, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    )
    ranged = with_range(materialize(counts, "group_scores"), "score", rows_per_range)
    down = Window.partitionBy(group).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group)
    offsets = _totals(ranged, [group, "_range"]).select(
        group, "_range",
        (F.sum("pos").over(down) - F.col("pos")).alias("_tp0"), (F.sum("neg").over(down) - F.col("neg")).alias("_fp0"),
        F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"),
    )
    within = Window.partitionBy(group, "_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({"_tp": F.sum("pos").over(within), "_fp": F.sum("neg").over(within)})
        .join(offsets, [group, "_range"])
        .withColumns({"tp": F.col("_tp0") + F.col("_tp"), "fp": F.col("_fp0") + F.col("_fp")})
    )


def model_comparison(scored: DataFrame, model: str, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row per model of long (model, label, score) rows: AUC, average precision, and the positive class at the threshold."""
    below = exact(F.col("N") - F.col("fp"))
    gain = fraction(F.col("pos"), F.col("P")) * fraction(F.col("tp"), F.col("tp") + F.col("fp"))
    hit = F.col("score") >= threshold
    grouped = _running_by(scored, model, label, score).groupBy(model).agg(
        exact(F.sum(exact(F.col("pos")) * (below * 2 + exact(F.col("neg"))))).cast("double").alias("wins"),
        (exact(F.max("P")) * exact(F.max("N")) * 2).cast("double").alias("pairs"),
        F.sum(gain).alias("average_precision"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("hits"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("wrong"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("missed"),
    )
    precision, recall, f1 = _class_report(F.col("hits"), F.col("wrong"), F.col("missed"))
    return grouped.select(
        model, (F.col("wins") / F.nullif(F.col("pairs"), F.lit(0.0))).alias("auc"), "average_precision",
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )
