"""Data-quality profile and patient-level reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions.clinical import null_token
from wardstone.functions.rates import count_where, rate_pct, ratio_2dp
from wardstone.operators.ranges import shuffled
from wardstone.operators.segments import is_positive


def overview(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Row, patient and encounter counts. ``approximate`` trades exact distinct counts for sketches."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    counts = df.agg(
        F.count("*").alias("total_encounters"),
        distinct("patient_nbr").alias("distinct_patients"),
        distinct("encounter_id").alias("distinct_encounters"),
    )
    ratio = ratio_2dp(F.col("total_encounters"), F.col("distinct_patients"))
    return counts.withColumn("avg_encounters_per_patient", ratio)


def _missing(df: DataFrame, column: str):
    """NULL, or still the raw missing token in a text column."""
    is_text = df.schema[column].dataType.typeName() == "string"
    value = F.col(column)
    return count_where((null_token(value) if is_text else value).isNull())


def missing_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Missing values of chosen columns in one row; ``columns`` maps column to output name."""
    return df.agg(*[_missing(df, c).alias(name) for c, name in columns.items()], F.count("*").alias("total_rows"))


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long table of columns with missing values, most first, from one pass over all columns."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("_rows"), *[_missing(df, c).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in columns]
    return (
        counts.select("_rows", F.inline(F.array(*entries)))
        .filter(F.col("missing_count") > 0)
        .select("column_name", "missing_count", rate_pct(F.col("missing_count"), F.col("_rows")).alias("missing_pct"))
        .orderBy(F.desc("missing_pct"), "column_name")
    )


def _with_share(grouped: DataFrame, count: str, share: str) -> DataFrame:
    """Share of each group in the total; the window sees only the few grouped rows."""
    total = F.sum(count).over(Window.partitionBy())
    return grouped.withColumn(share, rate_pct(F.col(count), total))


def target_distribution(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("readmitted").agg(F.count("*").alias("encounter_count"))
    return _with_share(grouped, "encounter_count", "pct_of_total")


def class_balance(df: DataFrame) -> DataFrame:
    label = F.when(is_positive(), "Readmitted <30 days").otherwise("Not readmitted <30 days")
    grouped = df.groupBy(label.alias("readmission_class")).agg(F.count("*").alias("count"))
    return _with_share(grouped, "count", "pct")


def value_counts(df: DataFrame, column, alias: str) -> DataFrame:
    return df.groupBy(column.alias(alias)).agg(F.count("*").alias("count"))


def top_codes(df: DataFrame, column: str = "diag_1", min_count: int = 500, limit: int = 20) -> DataFrame:
    """Most frequent non-missing codes with their rate; ties go to the smaller code."""
    grouped = (
        df.filter(null_token(F.col(column)).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("frequency"), count_where(is_positive()).alias("_pos"))
        .filter(F.col("frequency") > min_count)
    )
    ranked = grouped.orderBy(F.desc("frequency"), column).limit(limit)
    return ranked.select(
        column, "frequency", rate_pct(F.col("_pos"), F.col("frequency")).alias("readmission_rate_pct")
    )


def multi_encounter_patients(df: DataFrame, key: str = "patient_nbr", limit: int = 20) -> DataFrame:
    grouped = df.groupBy(key).agg(F.count("*").alias("encounter_count")).filter(F.col("encounter_count") > 1)
    return grouped.orderBy(F.desc("encounter_count"), key).limit(limit)


def first_encounter(df: DataFrame, key: str = "patient_nbr", order: str = "encounter_id") -> DataFrame:
    """The rows with the smallest ``order`` value of each ``key``.

    The minimum per key is a narrow aggregate that map tasks reduce first. The
    semi-join back is on both columns, so its work spreads over the unique
    ``order`` values and a key with a large part of the table is never gathered
    in one task. Rows without a key form one group, as in SQL.
    """
    firsts = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(order) == F.col("_first"))
    return df.join(shuffled(firsts), same, "left_semi")


def dedup_summary(df: DataFrame, key: str = "patient_nbr", order: str = "encounter_id") -> DataFrame:
    """Row counts before and after the reduction, without building the reduced table."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.count("*").alias("deduplicated_rows"),
        (F.sum("n") - F.count("*")).alias("removed_rows"),
    )


def duplicate_ids(df: DataFrame, column: str = "encounter_id") -> DataFrame:
    """Identifiers that occur more than once; empty on a sound table."""
    return df.groupBy(column).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
