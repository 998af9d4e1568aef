"""Mixing of sources by temperature: shares to an exponent, realised as block permutations within token budgets.

A source with a share s of all tokens gets the weight s**a / sum(s**a). The
exponent a between 0 (all sources alike) and 1 (as they are) is the largest one
whose weights reach a target entropy, or whose budgets keep every source within
a repetition limit, found by bisection. A source's budget is its weight of the
total; the default total is the least that uses every document at least once.

A source's documents are dealt into blocks by a hash. Each pass over the source
is a new random permutation of its blocks and of the documents within them. A
budget is so many whole passes, and the part of one more that fits: documents
in permuted order whose tokens before them are still under the budget.

Defined results: a null source is a source of its own. A null text has no
tokens. A source without tokens gets one pass. Rows with equal hash of id and
text stand together in every pass. Columns of the documents are kept as they
are; the mix_* columns replace any of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.session import materialize

BLOCK_TOKENS = 1 << 20
#: A table of sources up to this many rows is sent to all tasks; a larger one is joined by shuffle.
SMALL_TABLE = 100_000
_BITS = 11
_LEVELS = 3  # block numbers stay below 2 ** 31
_POINTS = 15
_ROUNDS = 13


@dataclass(frozen=True)
class Mixture:
    exponent: float
    sources: DataFrame  # source, tokens, rows, blocks, weight, budget, passes, rest


def words(text: str | Column) -> Column:
    """Number of words of a text; the default token count."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _beside(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.count() <= SMALL_TABLE else small


def exponent_for(sources: DataFrame, target_entropy: float | None, max_repetition: float | None, budget: float | None) -> float:
    """The exponent in [0, 1] for a goal; 1 without one.

    ``target_entropy`` (a share of the entropy of equal weights) asks for the
    largest exponent that reaches it. ``max_repetition`` asks for the smallest,
    that is the strongest mixing, at which no source is repeated more often;
    with both, the limit wins. ``budget`` is in units of all tokens. Every round
    tries ``_POINTS`` exponents inside the interval in one aggregation.
    """
    shares = sources.where("tokens > 0").crossJoin(F.broadcast(sources.agg(F.sum("tokens").alias("_sum"))))  # one row
    shares = materialize(shares.select((F.col("tokens") / F.col("_sum")).alias("s")), "shares")

    def figures(trials: list[float]) -> list[tuple[float, float]]:
        """Relative entropy and largest repetition at each trial exponent."""
        sums = [F.sum(F.pow("s", F.lit(a))).alias(f"z{i}") for i, a in enumerate(trials)]
        logs = [F.sum(F.pow("s", F.lit(a)) * F.ln("s")).alias(f"l{i}") for i, a in enumerate(trials)]
        row = shares.agg(F.count("s").alias("n"), F.min("s").alias("least"), F.max("s").alias("most"), *sums, *logs).first()
        if row["n"] < 2:
            return [(1.0, budget or 1.0)] * len(trials)
        out = []
        for i, a in enumerate(trials):
            z, steep = row[f"z{i}"], row["least"] ** (a - 1)
            entropy = (math.log(z) - a * row[f"l{i}"] / z) / math.log(row["n"])
            out.append((entropy, steep / row["most"] ** (a - 1) if budget is None else steep / z * budget))
        return out

    def bisect(meets, rising: bool) -> float:
        """The edge of a condition that holds from some exponent on (``rising``) or up to it."""
        if meets(figures([0.0 if rising else 1.0])[0]):
            return 0.0 if rising else 1.0
        low, high = 0.0, 1.0
        for _ in range(_ROUNDS):
            trials = [low + (high - low) * k / (_POINTS + 1) for k in range(1, _POINTS + 1)]
            edge = next((i for i, f in enumerate(figures(trials)) if meets(f) == rising), len(trials))
            low, high = (trials[edge - 1] if edge else low), (trials[edge] if edge < len(trials) else high)
        return high if rising else low

    exponent = 1.0 if target_entropy is None and max_repetition is None else 0.0
    if target_entropy is not None:
        exponent = bisect(lambda f: f[0] >= target_entropy - 1e-12, False)
    if max_repetition is not None:
        exponent = max(exponent, bisect(lambda f: f[1] <= max_repetition + 1e-12, True))
    return exponent


def mixture(
    rows: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> Mixture:
    """Weights and budgets of the sources of ``rows`` (source, tokens)."""
    sources = materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    share = None if budget is None or not total else budget / total
    a = exponent_for(sources, target_entropy, max_repetition, share)
    raised = sources.withColumn("raised", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))).otherwise(0.0))
    row = raised.agg(F.sum("raised").alias("z"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("raised"))).alias("least")).first()
    z = row["z"] or 1.0
    amount = float(budget) if budget is not None else (row["least"] or 0.0) * z
    planned = raised.withColumn("weight", F.col("raised") / F.lit(z)).withColumn("budget", F.round(F.col("weight") * F.lit(amount)).cast("long"))
    planned = planned.select(
        "source", "tokens", "rows", F.greatest(F.lit(1), F.ceil(F.greatest("tokens", "rows") / F.lit(block_tokens))).cast("long").alias("blocks"),
        "weight", "budget", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("long").alias("passes"),
    )
    planned = planned.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("passes") * F.col("tokens")).otherwise(0))
    return Mixture(a, materialize(planned, "mixture"))


@lru_cache(maxsize=1)
def _primes() -> list[int]:
    """The first eight primes above 2 ** 31; none divides a number of blocks."""
    found: list[int] = []
    n = (1 << 31) + 1
    while len(found) < 8:
        if all(n % d for d in range(3, 46343, 2)):
            found.append(n)
        n += 2
    return found


def _rank(seed: int, pass_: Column) -> Column:
    """A block's place in the permutation of its source's blocks for a pass: an affine one, drawn by hash."""
    draw = F.xxhash64(F.lit(seed), "_source", pass_)
    factor = F.element_at(F.array(*[F.lit(p) for p in _primes()]), (F.pmod(draw, F.lit(8)) + 1).cast("int"))
    return F.pmod(F.col("_block") * factor + F.shiftrightunsigned(draw, 3) % F.col("_blocks"), F.col("_blocks"))


def _row_order(seed: int, pass_: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "_row", pass_), 1)


def _cuts(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Per source with a part of a pass: where its permuted order stops (block and row).

    The cut is narrowed some bits of the blocks' places at a time, from sums per
    value of those bits; only the last block is ordered row by row.
    """
    at = rows.join(_beside(plan.where("rest > 0").select(F.col("source").alias("_name"), "passes", "rest")), F.col("_source").eqNullSafe(F.col("_name")))
    at = materialize(
        at.select("_source", "rest", F.col("_tokens").alias("tokens"), _rank(seed, F.col("passes")).alias("block"), _row_order(seed, F.col("passes")).alias("row")), "partial"
    )
    found = at.select("_source", "rest").distinct().select(F.col("_source").alias("_cut"), F.col("rest").alias("left"), F.lit(0).cast("long").alias("prefix"))
    order = Window.partitionBy("_cut").orderBy("step")
    for level in range(1, _LEVELS + 1):
        shift = _BITS * (_LEVELS - level)
        found = _beside(materialize(found, "cuts"))
        step = F.shiftright("block", shift)
        inside = at.join(found, F.col("_source").eqNullSafe(F.col("_cut")) & (F.shiftright(step, _BITS) == F.col("prefix")))
        sums = inside.groupBy("_cut", "left", step.alias("step")).agg(F.sum("tokens").alias("size"))
        running = sums.withColumn("before", F.sum("size").over(order) - F.col("size")).where("before < left")
        last = running.groupBy("_cut").agg(F.max_by(F.struct((F.col("left") - F.col("before")).alias("left"), F.col("step").alias("prefix")), "step").alias("c"))
        found = last.select("_cut", "c.left", "c.prefix")
    found = _beside(materialize(found, "cuts"))
    block = at.join(found, F.col("_source").eqNullSafe(F.col("_cut")) & (F.col("block") == F.col("prefix"))).groupBy("_cut", "left", "prefix", "row").agg(F.sum("tokens").alias("size"))
    within = Window.partitionBy("_cut").orderBy("row")
    chosen = block.withColumn("before", F.sum("size").over(within) - F.col("size")).where("before < left")
    return chosen.groupBy("_cut", "prefix").agg(F.max("row").alias("last"))


def mix(
    documents: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: int | None = None,
    tokens: Column | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 42, columns: list[str] | None = None,
) -> DataFrame:
    """The mixed documents: the chosen columns and mix_pass, mix_block, mix_tokens, mix_position.

    ``documents`` must give the same rows each time it is read. Sorting by
    mix_position (0 to about 1) gives the mixture with each source spread evenly.
    """
    columns = columns or [c for c in documents.columns if not c.startswith("mix_")]
    counted = F.coalesce(tokens, F.lit(0)) if tokens is not None else words("text")
    keyed = documents.select(F.struct(*columns).alias("_rest"), F.col("source").alias("_source"), counted.alias("_tokens"), F.xxhash64("doc_id", "text").alias("_row"))
    meta = materialize(keyed.select("_source", "_tokens", "_row"), "token-counts")
    plan = mixture(meta.select(F.col("_source").alias("source"), F.col("_tokens").alias("tokens")), target_entropy, max_repetition, budget, block_tokens).sources
    sizes = _beside(plan.select(F.col("source").alias("_name"), "passes", "rest", F.col("blocks").alias("_blocks"), "budget", F.col("tokens").alias("_all")))
    block = F.pmod(F.col("_row"), F.col("_blocks"))
    blocked = meta.join(_beside(plan.select(F.col("source").alias("_name"), F.col("blocks").alias("_blocks"))), F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_block", block).drop("_name")
    cuts = _beside(materialize(_cuts(blocked, plan, seed), "cuts"))
    rows = keyed.join(sizes, F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_block", block)
    rows = rows.join(cuts, F.col("_source").eqNullSafe(F.col("_cut")) & F.col("last").isNotNull(), "left")
    part = F.col("prefix").isNotNull() & (
        (_rank(seed, F.col("passes")) < F.col("prefix"))
        | (_rank(seed, F.col("passes")) == F.col("prefix")) & (_row_order(seed, F.col("passes")) <= F.col("last"))
    )
    times = F.col("passes") + part.cast("long")
    rows = rows.where(times > 0).withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    place = (_rank(seed, F.col("mix_pass")) + _row_order(seed, F.col("mix_pass")) / F.lit(2.0**63)) / F.col("_blocks")
    spread = F.when((F.col("_all") > 0) & (F.col("budget") > 0), F.col("budget") / F.col("_all")).otherwise(1.0)
    return rows.select(
        *[F.col("_rest").getField(c).alias(c) for c in columns], "mix_pass", F.col("_block").alias("mix_block"),
        F.col("_tokens").alias("mix_tokens"), ((F.col("mix_pass") + place) / spread).alias("mix_position"),
    )
