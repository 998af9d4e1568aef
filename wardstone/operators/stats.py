"""Descriptive statistics.

Moments of whole-number columns are exact sums, so results do not depend on the
order in which partitions are combined, and no magnitude overflows: products of
columns of up to 32 bits are whole numbers of 64; wider columns are taken as
distances from their least value and cut into a high and a low part, whose
products are summed apart and put together at the end. Columns with fractions
use doubles. Quantiles are taken over value counts, not rows: the table is first
reduced to (group, measure, value) counts on the map side.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from wardstone.operators.ranges import beside, ranked_quantiles
from wardstone.session import materialize

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


#: Wide whole numbers are cut here into a high and a low part.
_LIMB = "10000000000BD"
_TOTAL = "decimal(38,0)"


def _whole(df: DataFrame, columns: list[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, IntegralType) for c in columns)


def _wide(df: DataFrame, columns: list[str]) -> bool:
    return any(isinstance(df.schema[c].dataType, LongType) for c in columns)


def _difference(a: str, b: str, c: str, d: str) -> str:
    """a·b − c·d as a double: exact where 38 digits hold the products, else of doubles."""
    exact = f"cast(try_subtract(try_multiply({a}, {b}), try_multiply({c}, {d})) as double)"
    doubles = [f"cast({x} as double)" for x in (a, b, c, d)]
    return f"coalesce({exact}, {doubles[0]} * {doubles[1]} - {doubles[2]} * {doubles[3]})"


def _limb_sum(sql: str) -> str:
    """Sum of whole numbers of 64 bits: three parts of 22, 22 and 20 bits as plain longs, which hold 2^41 rows, put together at the end."""
    parts = [f"sum(({sql}) & 4194303)", f"sum(shiftright({sql}, 22) & 4194303)", f"sum(shiftright({sql}, 44))"]
    low, middle, high = (f"cast({part} as {_TOTAL})" for part in parts)
    return f"({low} + {middle} * 4194304BD + {high} * 17592186044416BD)"


class Moments:
    """Sums and sums of products of some columns, by the narrowest arithmetic that is exact for their types.

    ``rows`` has the columns as the sums take them: complete rows only (or, with
    ``complete`` off, all rows and a count n_a of each column), and wide columns
    as distances from their least value (their pivot). ``sums`` are the
    aggregates, s_a of values and p_a_b of products. Spreads and slopes do not
    change with the pivots; ``mean`` adds them again.
    """

    def __init__(self, df: DataFrame, columns: list[str], pairs: list[tuple[str, str]], weight: str | None = None, by: list[str] | None = None, complete: bool = True):
        self.columns, self.pairs, self.weight, self.complete = columns, pairs, weight, complete
        self.kind = "double" if not _whole(df, columns) else "wide" if _wide(df, columns) else "narrow"
        keep = [*(by or []), *([weight] if weight else [])]
        self.pivots = {}
        if self.kind == "wide":
            least = df.agg(*[F.min(c).alias(c) for c in columns]).first()
            self.pivots = {c: least[c] or 0 for c in columns}
        taken = {
            "double": lambda c: F.col(c).cast("double"),
            "narrow": lambda c: F.col(c).cast("bigint"),
            "wide": lambda c: F.col(c).cast("decimal(20,0)") - F.lit(Decimal(self.pivots[c])).cast("decimal(20,0)"),
        }[self.kind]
        rows = df.select(*keep, *[taken(c).alias(c) for c in columns])
        rows = rows.dropna(subset=columns) if complete else rows
        if self.kind == "wide":
            parts = {}
            for c in columns:
                parts |= {f"{c}_h": f"cast(floor({c} / {_LIMB}) as decimal(11,0))", f"{c}_l": f"cast({c} % {_LIMB} as decimal(10,0))"}
            rows = rows.select("*", *[F.expr(sql).alias(name) for name, sql in parts.items()])
        self.rows = rows

    def _sum(self, sql: str) -> str:
        if self.kind == "narrow" and not self.weight:
            return _limb_sum(sql)
        if self.weight:
            sql = f"{sql} * cast({self.weight} as {'double' if self.kind == 'double' else 'decimal(15,0)'})"
        if self.kind == "double":
            return f"sum({sql})"
        return f"sum(cast({sql} as decimal(28,0)))"  # of 28 digits: the sum has 38

    def sums(self) -> list[Column]:
        terms = {"n": f"sum({self.weight})" if self.weight else "count(*)"}
        terms |= {f"s_{c}": self._sum(c) for c in self.columns}
        terms |= {} if self.complete else {f"n_{c}": f"count({c})" for c in self.columns}
        for a, b in self.pairs:
            if self.kind == "wide":
                terms |= {
                    f"p_{a}_{b}_hh": self._sum(f"{a}_h * {b}_h"),
                    f"p_{a}_{b}_hl": self._sum(f"({a}_h * {b}_l + {a}_l * {b}_h)"),
                    f"p_{a}_{b}_ll": self._sum(f"{a}_l * {b}_l"),
                }
            else:
                terms[f"p_{a}_{b}"] = self._sum(f"{a} * {b}")
        return [F.expr(f"{sql} AS {name}") for name, sql in terms.items()]

    def _product(self, a: str, b: str, at: str) -> tuple[str, str]:
        """The sum of a product: as 38 digits (NULL beyond them) and as a double."""
        name = f"{at}p_{a}_{b}"
        if self.kind != "wide":
            return (f"cast({name} as {_TOTAL})", f"cast({name} as double)") if self.kind == "narrow" else (f"cast(NULL as {_TOTAL})", name)
        high = f"try_multiply(cast({name}_hh as {_TOTAL}), cast(100000000000000000000BD as {_TOTAL}))"
        middle = f"try_multiply(cast({name}_hl as {_TOTAL}), cast({_LIMB} as {_TOTAL}))"
        exact = f"try_add(try_add({high}, {middle}), cast({name}_ll as {_TOTAL}))"
        return f"cast({exact} as {_TOTAL})", f"(cast({name}_hh as double) * 1e20 + cast({name}_hl as double) * 1e10 + cast({name}_ll as double))"

    def cross(self, a: str, b: str, at: str = "", n: str = "n") -> str:
        """n·Σab − Σa·Σb as a double, exact where 38 digits hold it."""
        exact, near = self._product(a, b, at)
        rough = f"cast({at}{n} as double) * {near} - cast({at}s_{a} as double) * cast({at}s_{b} as double)"
        if self.kind == "double":
            return f"({rough})"
        many, sa, sb = (f"cast({at}{x} as {_TOTAL})" for x in (n, f"s_{a}", f"s_{b}"))
        return f"coalesce(cast(try_subtract(try_multiply({many}, {exact}), try_multiply({sa}, {sb})) as double), {rough})"

    def mean(self, c: str, at: str = "") -> str:
        """Mean, with the pivot added again as whole numbers where they fit."""
        near = f"cast({at}s_{c} as double) / cast({at}n as double)"
        pivot = self.pivots.get(c, 0)
        if not pivot:
            return f"({near})"
        whole = f"try_add(try_multiply(cast({at}n as {_TOTAL}), cast({pivot}BD as {_TOTAL})), cast({at}s_{c} as {_TOTAL}))"
        return f"coalesce(cast({whole} as double) / cast({at}n as double), {float(pivot)!r}D + {near})"


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations below the diagonal, long form, from one aggregate.

    Rows where any of the columns is NULL are left out of every pair.
    """
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    moments = Moments(df.select(*columns), columns, [*pairs, *[(c, c) for c in columns]])
    totals = moments.rows.agg(*moments.sums())

    def r(a: str, b: str) -> str:
        return f"{moments.cross(a, b)} / nullif(sqrt({moments.cross(a, a)}) * sqrt({moments.cross(b, b)}), 0D)"

    rows = ", ".join(f"struct('{a}' AS a, '{b}' AS b, {r(a, b)} AS r)" for a, b in pairs)
    return totals.select(F.expr(f"inline(array({rows}))"))


def target_correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    pairs = correlations(df, [*columns, target])
    return pairs.filter(F.col("a") == target).select(F.col("b").alias("feature"), "r").orderBy(F.desc("r"), "feature")


def value_frequencies(df: DataFrame, columns: list[str], by: list[str | Column]) -> DataFrame:
    """(group, measure, value) counts, the input of every exact quantile here."""
    kind = "bigint" if _whole(df, columns) else "double"  # whole numbers keep all their digits
    wide = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in columns])
    groups = [c for c in wide.columns if c not in columns]
    rows = wide.unpivot(groups, columns, "measure", "value").filter(F.col("value").isNotNull())
    return rows.groupBy(*groups, "measure", "value").agg(F.count("*").alias("n"))


def _counted(df: DataFrame, columns: list[str], by: list[str | Column]) -> DataFrame:
    """The stored frequencies; moments and quantiles then read them instead of the table."""
    return materialize(value_frequencies(df, columns, by), "value_counts")


def boxplot_stats(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges clipped to the data, and outlier counts.

    Both steps read the (group, measure, value) counts; the second joins one
    row of quartiles per group and measure, so no list of values is gathered.
    """
    frequencies = _counted(df, columns, [by])
    quartiles = materialize(ranked_quantiles(frequencies, [by, "measure"], QUARTILES), "quartiles")
    quartiles = quartiles.withColumnRenamed(by, "_by").withColumnRenamed("measure", "_measure")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    keys = [by, "measure", "q1", "median", "q3"]
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("measure") == F.col("_measure"))
    return (
        frequencies.join(beside(quartiles), same)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("count"),
            F.min(F.when(inside, F.col("value"))).cast("double").alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).cast("double").alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    counts = _counted(df, columns, [])
    points = ranked_quantiles(counts, ["measure"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    if _whole(df, columns) and _wide(df, columns):  # each measure has a pivot of its own
        moments = [_described(counts.filter(F.col("measure") == c)) for c in columns]
    else:
        moments = [_described(counts.withColumn("value", F.col("value").cast("int")) if _whole(df, columns) else counts)]
    return reduce(DataFrame.unionByName, moments).join(points, "measure").select(
        F.col("measure").alias("feature"), "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def _described(counts: DataFrame) -> DataFrame:
    moments = Moments(counts, ["value"], [("value", "value")], weight="n", by=["measure"])
    totals = moments.rows.groupBy("measure").agg(*moments.sums(), F.min("value").alias("low"), F.max("value").alias("high"))
    pivot = moments.pivots.get("value", 0)
    back = lambda c: f"cast({c} + cast({pivot}BD as decimal(20,0)) as double)" if moments.kind == "wide" else f"cast({c} as double)"
    spread = f"{moments.cross('value', 'value')} / nullif(cast(n as double) * cast(n - 1 as double), 0D)"
    return totals.selectExpr(
        "measure", "n AS count", f"{moments.mean('value')} AS mean", f"sqrt({spread}) AS std", f"{back('low')} AS min", f"{back('high')} AS max"
    )


def quantile(df: DataFrame, column: str, probability: float, alias: str) -> DataFrame:
    """Exact quantile with linear interpolation; one row, NULL when there are no values."""
    return quantiles(df, [column], probability).agg(F.max("quantile").alias(alias))


def quantiles(df: DataFrame, columns: list[str], probability: float) -> DataFrame:
    """The same quantile of several columns, long form (measure, quantile)."""
    return ranked_quantiles(_counted(df, columns, []), ["measure"], {"quantile": probability})


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` with its fit."""
    points = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    moments = Moments(points, ["x", "y"], [("x", "x"), ("y", "y"), ("x", "y")])
    spreads = moments.rows.agg(*moments.sums()).selectExpr(
        "*", f"nullif({moments.cross('x', 'x')}, 0D) AS vx", f"nullif({moments.cross('y', 'y')}, 0D) AS vy", f"{moments.cross('x', 'y')} AS cov"
    )
    plain = moments.kind != "wide"
    intercept = "(cast(s_y as double) - cov / vx * cast(s_x as double)) / cast(n as double)"
    return spreads.selectExpr(
        "cast(n as bigint) AS n",
        "cov / vx AS slope",
        f"{intercept if plain else f'{moments.mean("y")} - cov / vx * {moments.mean("x")}'} AS intercept",
        "cov / vx * (cov / vy) AS r2",
    )


def score_histogram(df: DataFrame, score: str, by: str, bins: int = 50) -> DataFrame:
    """Density histogram of a score per class, with equal bins over that class's own range.

    A class holds one row of bounds, which are sent to the rows after a check of
    their number. Empty bins are kept.
    """
    bounds = materialize(
        df.groupBy(by).agg(F.min(score).alias("lo"), F.max(score).alias("hi"), F.count(score).alias("n")), "class_bounds"
    )
    span = (F.col("hi") - F.col("lo")).cast("double")
    position = (F.col(score) - F.col("lo")).cast("double") * bins / F.nullif(span, F.lit(0.0))
    index = F.least(F.coalesce(F.floor(position), F.lit(bins // 2)), F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(F.col(score).isNotNull())
        .select(by, score)
        .join(beside(bounds), by)
        .groupBy(by, index.alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    grid = bounds.select(by, "lo", "hi", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = F.when(span == 0, 1.0).otherwise(span) / bins
    start = F.when(span == 0, F.col("lo") - 0.5).otherwise(F.col("lo").cast("double"))
    filled = F.coalesce("count", F.lit(0))
    return grid.join(counted, [by, "bin"], "left").select(
        by, "bin", (start + width * F.col("bin")).alias("bin_start"), filled.alias("count"),
        (filled.cast("double") / (F.col("n").cast("double") * width)).alias("density"),
    )


def standardize(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(x − mean) / population deviation over a column's values; a constant column gives NULL."""
    moments = Moments(df.select(*columns), columns, [(c, c) for c in columns], complete=False)
    stats = moments.rows.agg(F.struct(*moments.sums()).alias("t")).scalar()

    def z(c: str) -> str:
        n = f"n_{c}"
        deviation = f"sqrt({moments.cross(c, c, '_t.', n)}) / cast(_t.{n} as double)"
        pivot = moments.pivots.get(c, 0)
        from_pivot = f"cast(cast({c} as decimal(20,0)) - cast({pivot}BD as decimal(20,0)) as double)" if moments.kind == "wide" else f"cast({c} as double)"
        return f"({from_pivot} - cast(_t.s_{c} as double) / cast(_t.{n} as double)) / nullif({deviation}, 0D) AS {c}"

    return df.select(*keep, *columns).withColumn("_t", stats).selectExpr(*keep, *[z(c) for c in columns])
