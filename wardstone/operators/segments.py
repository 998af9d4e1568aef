"""Readmission rates by patient segment.

Every operator is one pass: rows are reduced to counts on the map side before
the only shuffle, so a segment that holds most of the table costs no more than
any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.functions.rates import count_where, fraction, integer_div, rate_pct, ratio_2dp

def is_positive() -> Column:
    return F.col("readmitted") == S.POSITIVE_OUTCOME


def segment_rate(
    df: DataFrame,
    dims: str | Column | list[str | Column],
    *,
    min_count: int = 0,
    total: str = "total",
    positives: str | None = "readmitted_30",
    rate: str = "readmission_rate_pct",
) -> DataFrame:
    """Row count, positives and rate per segment; segments of at most ``min_count`` rows are left out."""
    dims = dims if isinstance(dims, list) else [dims]
    grouped = df.groupBy(*dims).agg(F.count("*").alias(total), count_where(is_positive()).alias("_pos"))
    if min_count:
        grouped = grouped.filter(F.col(total) > min_count)
    keep = [c for c in grouped.columns if c not in (total, "_pos")]
    out = [F.col(c) for c in keep] + [F.col(total)]
    if positives:
        out.append(F.col("_pos").alias(positives))
    return grouped.select(*out, rate_pct(F.col("_pos"), F.col(total)).alias(rate))


def overall_rate(df: DataFrame, alias: str = "overall_readmission_rate_pct") -> DataFrame:
    return df.agg(rate_pct(count_where(is_positive()), F.count("*")).alias(alias))


def reference_rates(df: DataFrame, dim: str, min_count: int = 0) -> DataFrame:
    """Rate over all rows, and the plain mean of the group rates, from one grouping."""
    grouped = df.groupBy(dim).agg(F.count("*").alias("n"), count_where(is_positive()).alias("pos"))
    kept = F.col("n") > min_count
    rate_cents = F.when(kept, integer_div(F.col("pos") * 20000 + F.col("n"), F.col("n") * 2))
    return grouped.agg(
        rate_pct(F.sum("pos"), F.sum("n")).alias("overall_rate"),
        (fraction(F.sum(rate_cents), F.count(rate_cents)) / 100.0).alias("mean_of_group_rates"),
    )


def utilization_means(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Two-place means of measures by outcome class; ``columns`` maps measure to output name."""
    group = F.when(is_positive(), "Readmitted <30d").otherwise("Other").alias("readmission_group")
    means = [ratio_2dp(F.sum(F.col(c).cast("long")), F.count(c)).alias(name) for c, name in columns.items()]
    return df.groupBy(group).agg(*means)


def any_dose_change(columns: list[str]) -> Column:
    changed = reduce(lambda a, b: a | b, [F.col(c).isin(S.CHANGED_STATUSES) for c in columns])
    return F.when(changed, "Had medication change").otherwise("No medication change")


def rate_by_label(df: DataFrame, min_count: int = 200) -> DataFrame:
    """Rate by discharge label for patients still at risk, flagged against the rate over all rows."""
    label = C.disposition_label(F.col("discharge_disposition_id")).alias("discharge_label")
    everyone = Window.partitionBy()
    grouped = df.groupBy(label).agg(F.count("*").alias("count"), count_where(is_positive()).alias("_pos"))
    share = fraction(F.col("_pos"), F.col("count"))
    overall = fraction(F.sum("_pos").over(everyone), F.sum("count").over(everyone))
    return (
        grouped.withColumns({"_share": share, "_overall": overall})
        .filter(~F.col("discharge_label").isin(S.NOT_AT_RISK_LABELS) & (F.col("count") > min_count))
        .select(
            "discharge_label",
            "count",
            (F.col("_share") * 100.0).alias("readmission_rate"),
            (F.col("_share") > F.col("_overall")).alias("above_overall"),
        )
    )


def mean_rate(df: DataFrame, dims: str | Column | list, *, min_count: int = 0, percent: bool = True) -> DataFrame:
    """Count and unrounded mean outcome per segment."""
    dims = dims if isinstance(dims, list) else [dims]
    grouped = df.groupBy(*dims).agg(F.count("*").alias("count"), count_where(is_positive()).alias("_pos"))
    share = fraction(F.col("_pos"), F.col("count"))
    rate = (share * 100.0 if percent else share).alias("readmission_rate")
    return grouped.filter(F.col("count") > min_count).withColumn("readmission_rate", rate).drop("_pos")


def long_segments(df: DataFrame, columns: list[str], keep: list[str | Column]) -> DataFrame:
    """One row per (row, dimension) with the dimension's value as text."""
    text = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    kept = [c for c in text.columns if c not in columns]
    return text.unpivot(kept, columns, "dimension", "segment")


def segment_rates_all(df: DataFrame, columns: list[str] | None = None, min_count: int = 0) -> DataFrame:
    """Rates for many dimensions from one scan and one shuffle of partial counts."""
    rows = long_segments(df, columns or S.SEGMENT_DIMENSIONS, ["readmitted"])
    named = rows.withColumn("segment", F.coalesce("segment", F.lit(S.UNKNOWN)))
    return segment_rate(named, ["dimension", "segment"], min_count=min_count)


def medication_status_rates(df: DataFrame, medications: list[str] | None = None) -> DataFrame:
    """Rate by dosage status for several drugs, in the usual order of statuses."""
    rows = long_segments(df, medications or S.HEADLINE_MEDICATIONS, ["readmitted"])
    named = rows.select(F.col("dimension").alias("medication"), F.col("segment").alias("status"), "readmitted")
    order = F.array_position(F.array(*[F.lit(s) for s in S.MEDICATION_STATUSES]), F.col("status"))
    known = named.filter(F.col("status").isin(S.MEDICATION_STATUSES))
    return mean_rate(known, ["medication", "status"]).withColumn("status_order", order.cast("int"))


def insight_segments(df: DataFrame) -> DataFrame:
    """Six overlapping segments from one pass; an empty one stays, with a NULL rate."""
    visits, insulin, age = F.col("number_inpatient"), F.col("insulin"), F.col("age")
    segments = {
        "3+ prior inpatient visits": visits >= 3,
        "0 prior inpatient visits": visits == 0,
        "Insulin dose changed": insulin.isin(S.CHANGED_STATUSES),
        "Insulin steady / not prescribed": ~insulin.isin(S.CHANGED_STATUSES),
        "Age 70-80": age == "[70-80)",
        "Age 20-30": age == "[20-30)",
    }
    counts = []
    for i, inside in enumerate(segments.values()):
        counts += [count_where(inside).alias(f"n{i}"), count_where(inside & is_positive()).alias(f"p{i}")]
    rows = [
        F.struct(F.lit(name).alias("segment"), rate_pct(F.col(f"p{i}"), F.col(f"n{i}")).alias("readmission_rate"))
        for i, name in enumerate(segments)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def inpatient_uplift(df: DataFrame) -> DataFrame:
    """Rates for 0, 1, 2 and 3 or more prior stays, and the ratio of the last to the first."""
    bucket = C.clamp(F.col("number_inpatient"), high=3).alias("prior_inpatient_bucket")
    everyone = Window.partitionBy()
    grouped = df.groupBy(bucket).agg(F.count("*").alias("total"), count_where(is_positive()).alias("_pos"))

    def over_all(column: str, value: int) -> Column:
        return F.max(F.when(F.col("prior_inpatient_bucket") == value, F.col(column))).over(everyone)

    uplift = ratio_2dp(over_all("_pos", 3) * over_all("total", 0), over_all("total", 3) * over_all("_pos", 0))
    return grouped.select(
        "prior_inpatient_bucket",
        "total",
        rate_pct(F.col("_pos"), F.col("total")).alias("readmission_rate_pct"),
        uplift.alias("uplift_3plus_vs_0"),
    )


def lab_testing(df: DataFrame) -> DataFrame:
    """Share of encounters with an HbA1c test, and the rate with and without one."""
    tested = F.col("A1Cresult") != "None"
    return df.agg(
        F.count("*").alias("total"),
        count_where(tested).alias("tested"),
        rate_pct(count_where(tested), F.count("*")).alias("tested_pct"),
        rate_pct(count_where(tested & is_positive()), count_where(tested)).alias("rate_tested_pct"),
        rate_pct(count_where(~tested & is_positive()), count_where(~tested)).alias("rate_untested_pct"),
    )


def outcome_heatmap(rows: DataFrame, keys: dict[str, str], outcomes: dict[str, str]) -> DataFrame:
    """Counts per key and outcome, one column per outcome; outcome values are named up front."""
    pivoted = rows.groupBy(*keys).pivot("readmitted", list(outcomes)).count()
    cells = [F.coalesce(F.col(f"`{value}`"), F.lit(0)).alias(name) for value, name in outcomes.items()]
    return pivoted.select(*[F.col(k).alias(v) for k, v in keys.items()], *cells)
