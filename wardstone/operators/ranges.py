"""Running totals and exact quantiles over sorted values, without one task that sees them all.

Values are first reduced to counts per distinct value. The distinct values are
cut into ranges of nearly equal size; a total per range and a position inside
the range then place every value. NaN is the largest value.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1_000_000
#: A table up to this many rows is sent to all tasks of a join; a larger one is shuffled.
SMALL_TABLE = 100_000


def beside(small: DataFrame) -> DataFrame:
    """The table, marked for broadcast if it is small. It should be stored or cheap, because it is counted."""
    return F.broadcast(small) if small.count() <= SMALL_TABLE else small


def shuffled(large: DataFrame) -> DataFrame:
    """The table, marked for a join by shuffle and sort, because it grows with the input.

    Spark judges a stored table by its compressed files and by default widths, takes
    one of millions of rows or of long arrays for small and sends it through the driver.
    """
    return large.hint("merge")


def with_range(counts: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``_range``, rising with the column, with about ``rows_per_range`` rows in each; NaN has the last one."""
    ranges = -(-counts.count() // rows_per_range)
    steps = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(counts.approxQuantile(column, steps, 0.1 / ranges))) if steps else []
    inner = [b for b in bounds if abs(b) != float("inf")] or [0.0]
    splits = [float("-inf"), *inner, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol="_range", handleInvalid="keep").transform(counts)


def ranked_quantiles(
    counts: DataFrame, keys: list[str], wanted: dict[str, float], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Quantiles with linear interpolation per key as columns, from stored (keys, value, n) rows."""
    if counts.count() <= rows_per_range:  # one range: nothing comes before it
        placed = _placed_in_one_range(counts, keys)
    else:
        placed = _placed(with_range(counts, "value", rows_per_range), keys)
    found, shares = [], {}
    for i, (name, probability) in enumerate(wanted.items()):
        position = (F.col("_rows") - 1) * F.lit(probability)
        low, high = F.floor(position), F.ceil(position)
        for side, index in (("low", low), ("high", high)):
            here = (F.col("_first") <= index) & (index <= F.col("_last"))
            found.append(F.max(F.when(here, F.col("value"))).alias(f"_{side}{i}"))
        found.append(F.max(position - low).alias(f"_share{i}"))
        low, high = F.col(f"_low{i}").cast("double"), F.col(f"_high{i}").cast("double")
        step = F.col(f"_share{i}") * (high - low)
        shares[name] = low + F.when(F.col(f"_share{i}") == 0, 0.0).otherwise(step)
    return placed.groupBy(*keys).agg(*found).select(*keys, *[c.alias(n) for n, c in shares.items()])


def _placed_in_one_range(counts: DataFrame, keys: list[str]) -> DataFrame:
    """First and last place of each value among its key's rows, and the key's rows."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    rows = F.sum("n").over(Window.partitionBy(*keys))
    return counts.select(*keys, "value", rows.alias("_rows"), (upto - F.col("n")).alias("_first"), (upto - 1).alias("_last"))


def _placed(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """The same by range: rows of earlier ranges from a table of totals, and the place within the range."""
    up = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        ranged.groupBy(*keys, "_range")
        .agg(F.sum("n").alias("_n"))
        .select(
            *keys, "_range",
            (F.sum("_n").over(up) - F.col("_n")).alias("_offset"),
            F.sum("_n").over(Window.partitionBy(*keys)).alias("_rows"),
        )
    )
    within = Window.partitionBy(*keys, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_upto", F.sum("n").over(within))
        .join(offsets, [*keys, "_range"])  # partitioned alike already; Spark broadcasts the offsets when they are few
        .select(
            *keys, "value", "_rows",
            (F.col("_offset") + F.col("_upto") - F.col("n")).alias("_first"),
            (F.col("_offset") + F.col("_upto") - 1).alias("_last"),
        )
    )
