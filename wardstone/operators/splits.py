"""Reproducible splits, folds, samples and class weights.

The order inside a class is a hash of the row id, ranked exactly. A plain
``row_number`` over the class would gather half the table in one task, so the
rank is built from two parts: the number of rows in earlier hash ranges (a
small table of counts) and the position inside the row's own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.functions.clinical import seeded_hash
from wardstone.functions.rates import integer_div

HASH_RANGE = (1 << 31) - 1
ROWS_PER_RANGE = 100_000


def ranges_for(df: DataFrame) -> int:
    """Hash ranges of about ``ROWS_PER_RANGE`` rows."""
    return max(1, -(-df.count() // ROWS_PER_RANGE))


def _with_range(df: DataFrame, id_column: str, seed: int, ranges: int) -> DataFrame:
    order = seeded_hash(F.col(id_column), seed)
    return df.withColumn("_order", order).withColumn(
        "_range", integer_div(F.col("_order") * ranges, F.lit(HASH_RANGE)).cast("int")
    )


def _range_offsets(hashed: DataFrame, label: str) -> DataFrame:
    """Rows of the class in earlier ranges, and in all; at most ``ranges`` rows per class."""
    counts = hashed.groupBy(label, "_range").agg(F.count("*").alias("_n"))
    up_to = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(label)
    return counts.select(
        label, "_range", "_n",
        (F.sum("_n").over(up_to) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_class_rows"),
    )


def class_rank(df: DataFrame, label: str, id_column: str, seed: int = 42, ranges: int | None = None) -> DataFrame:
    """Adds ``class_rank`` (1, 2, …) and ``class_rows``: the exact position in hash order within the label."""
    hashed = _with_range(df, id_column, seed, ranges or ranges_for(df))
    within = Window.partitionBy(label, "_range").orderBy("_order", id_column)
    ranked = hashed.withColumn("_pos", F.row_number().over(within))
    offsets = _range_offsets(hashed, label).drop("_n")
    return (
        ranked.join(offsets, [label, "_range"])  # partitioned alike already
        .withColumn("class_rank", F.col("_before") + F.col("_pos"))
        .withColumnRenamed("_class_rows", "class_rows")
        .drop("_order", "_range", "_pos", "_before")
    )


def test_rows(class_rows: Column, test: float) -> Column:
    """Test share of a class in whole rows, rounded half up."""
    return F.floor(class_rows * F.lit(test) + 0.5).cast("long")


def stratified_split(df: DataFrame, label: str, id_column: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly the given share of every class.

    Whole hash ranges fall on one side or the other; only the range that holds
    the cut needs a rank, so nearly all rows are decided without a shuffle.
    """
    hashed = _with_range(df, id_column, seed, ranges_for(df))
    offsets = _range_offsets(hashed, label)
    wanted = test_rows(F.col("_class_rows"), test)
    cuts = (
        offsets.filter((F.col("_before") < wanted) & (F.col("_before") + F.col("_n") >= wanted))
        .select(label, F.col("_range").alias("_cut"), (wanted - F.col("_before")).alias("_take"))
    )
    within = Window.partitionBy(label).orderBy("_order", id_column)
    last = (
        hashed.join(F.broadcast(cuts), label)  # bounded: one row per class
        .filter(F.col("_range") == F.col("_cut"))
        .select(label, "_order", id_column, "_take", F.row_number().over(within).alias("_pos"))
        .filter(F.col("_pos") == F.col("_take"))
        .select(label, F.col("_order").alias("_last_order"), F.col(id_column).alias("_last_id"))
    )
    before_last = (F.col("_order") < F.col("_last_order")) | (
        (F.col("_order") == F.col("_last_order")) & (F.col(id_column) <= F.col("_last_id"))
    )
    return (
        hashed.join(F.broadcast(last), label, "left")  # bounded: one row per class
        .withColumn("is_test", F.coalesce(before_last, F.lit(False)))
        .select(*df.columns, "is_test")
    )


def stratified_folds(df: DataFrame, label: str, id_column: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold``: 0 … folds-1, dealt out in hash order within every class."""
    ranked = class_rank(df, label, id_column, seed)
    return ranked.withColumn("fold", ((F.col("class_rank") - 1) % folds).cast("int")).select(*df.columns, "fold")


def seeded_sample(df: DataFrame, id_column: str, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` rows without replacement, the same ones on every run: the first in hash order.

    Counts per hash range decide nearly all rows; only the range with the cut is
    ranked, so a large sample is never gathered in one task.
    """
    total = df.count()
    if total <= rows:
        return df
    return stratified_split(df.withColumn("_all", F.lit(1)), "_all", id_column, rows / total, seed).filter("is_test").drop("is_test", "_all")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes · rows of the class)."""
    grouped = df.groupBy(label).agg(F.count("*").alias("rows"))
    whole = Window.partitionBy()
    share = F.sum("rows").over(whole).cast("double") / (F.count("*").over(whole) * F.col("rows")).cast("double")
    return grouped.withColumn("weight", share)


def with_class_weight(df: DataFrame, label: str, alias: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(alias))
    return df.join(F.broadcast(weights), label)  # bounded: one row per class
