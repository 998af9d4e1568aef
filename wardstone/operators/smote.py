"""Oversampling of the minority class by interpolation between near neighbours.

Every random choice is integer arithmetic on the row's id, so the result is the
same for any partitioning, survives recomputation of lost partitions, and can be
computed again by any engine with 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.clinical import seeded_hash
from wardstone.operators.neighbors import BlockSizes, k_nearest
from wardstone.operators.ranges import shuffled
from wardstone.operators.splits import stratified_split
from wardstone.session import materialize

COPIES_PER_ROW = 1000
#: A step is a whole number of these parts of the way to the neighbour.
STEPS = 1 << 20
Search = Callable[[DataFrame, int], DataFrame]


def _draw(vid: Column, copy: Column, seed: int) -> Column:
    """Pseudo-random integer in [0, 2^31-1) for a vector's copy."""
    return seeded_hash(seeded_hash(vid, seed) + copy, seed + 1)


def _vectors(minority: DataFrame, id_column: str, needed: int, rows: int, k: int, seed: int) -> DataFrame:
    """Distinct minority vectors with their copies and the synthetic rows they owe.

    Each row owes the same number, and the first few in hash order one more.
    Equal rows are merged here, on the map side first, so a vector shared by
    much of the class is one row from now on.
    """
    each, extra = divmod(needed, rows)
    if extra:
        marked = stratified_split(minority, "_class", id_column, test=extra / rows, seed=seed)
        one_more = F.col("is_test").cast("long")
    else:
        marked, one_more = minority, F.lit(0).cast("long")
    merged = marked.groupBy("x").agg(
        F.min(id_column).alias("vid"), F.count("*").alias("copies"), F.sum(one_more + each).alias("owed")
    )
    return merged.withColumn("wanted", F.greatest(F.lit(k) - (F.col("copies") - 1), F.lit(0)))


def _with_neighbors(vectors: DataFrame, k: int, search: Search) -> DataFrame:
    """Adds ``own``, the copies of itself, and ``near``, the others that a vector may be drawn towards.

    Together they are up to k, own copies first. A close vector counts once for
    each of its copies, as in a search over rows.
    """
    lists = search(vectors.select("vid", "x", "copies", "wanted"), k)
    slots = F.flatten(
        F.transform(
            F.col("neighbors"),
            lambda e: F.array_repeat(e["nvid"], F.least(e["copies"], F.lit(k)).cast("int")),
        )
    )
    chosen = (
        lists.join(shuffled(vectors.select("vid", "wanted")), "vid")
        .select("vid", F.posexplode(F.slice(slots, F.lit(1), F.col("wanted").cast("int"))).alias("slot", "nvid"))
        .join(shuffled(vectors.select(F.col("vid").alias("nvid"), F.col("x").alias("nx"))), "nvid")
    )
    others = chosen.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("slot", "nvid", "nx"))).alias("near"))  # at most k
    return vectors.join(shuffled(others), "vid", "left").select(
        "vid", "x", "owed", F.least(F.col("copies") - 1, F.lit(k)).alias("own"), "near"
    )


def synthesize(vectors: DataFrame, seed: int) -> DataFrame:
    """The owed rows of every vector: parent, copy, neighbour, step and x + step·(neighbour − x).

    A vector that owes very many is first cut into parcels, which are spread
    over the tasks before they unfold. A vector without any neighbour, and one
    that draws a copy of itself, is its own neighbour.
    """
    parcels = vectors.withColumn(
        "parcel", F.explode(F.sequence(F.lit(0), F.floor((F.col("owed") - 1) / COPIES_PER_ROW).cast("int")))
    )
    first = F.col("parcel").cast("long") * COPIES_PER_ROW
    last = F.least(first + COPIES_PER_ROW, F.col("owed")) - 1
    unfolded = (
        parcels.filter(F.col("owed") > 0)
        .repartition("vid", "parcel")
        .withColumn("copy", F.explode(F.sequence(first, last)))
    )
    choices = F.greatest(F.col("own") + F.coalesce(F.size("near"), F.lit(0)), F.lit(1))
    pick = _draw(F.col("vid"), F.col("copy"), seed) % choices - F.col("own")
    drawn = unfolded.select(
        "vid", "copy", "x", F.when(pick >= 0, F.get("near", pick.cast("int"))).alias("to"),
        (_draw(F.col("vid"), F.col("copy"), seed + 2) % STEPS / F.lit(float(STEPS))).alias("step"),
    )
    point = F.when(F.col("to").isNull(), F.col("x")).otherwise(F.zip_with("x", F.col("to.nx"), lambda a, b: a + F.col("step") * (b - a)))
    return drawn.select(
        F.col("vid").alias("parent"), "copy", F.coalesce("to.nvid", "vid").alias("neighbour"), "step", point.alias("x")
    )


def _classes(df: DataFrame, label: str) -> tuple[int, int, int]:
    """The minority label, its rows, and the rows it lacks."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(counts) != 2:
        raise ValueError(f"need exactly two classes, found {sorted(counts)}")
    minority = min(counts, key=lambda c: (counts[c], c))
    return minority, counts[minority], max(counts.values()) - counts[minority]


def smote_rows(
    df: DataFrame,
    features: str,
    label: str,
    id_column: str,
    k: int = 5,
    seed: int = 42,
    sizes: BlockSizes = BlockSizes(),
    search: Search | None = None,
) -> DataFrame:
    """The synthetic minority rows that bring both classes to one size.

    ``parent`` (the least id of the vector that a row grew from), ``copy`` (its
    number among the parent's), ``neighbour``, ``step`` and the new vector as an
    array ``x``. ``search`` finds neighbour lists as ``k_nearest`` does; the
    default is that exact search, ``neighbors.k_nearest_hashed`` an approximate one.
    """
    minority, many, needed = _classes(df, label)
    rows = df.filter(F.col(label) == minority).select(
        id_column, F.lit(1).alias("_class"), vector_to_array(features).alias("x")
    )
    vectors = materialize(_vectors(rows, id_column, needed, many, k, seed), "smote_vectors")
    return synthesize(_with_neighbors(vectors, k, search or (lambda v, n: k_nearest(v, n, sizes))), seed)


def smote_balance(
    df: DataFrame,
    features: str,
    label: str,
    id_column: str,
    k: int = 5,
    seed: int = 42,
    sizes: BlockSizes = BlockSizes(),
    search: Search | None = None,
) -> DataFrame:
    """Both classes at the size of the larger one: all given rows plus synthetic minority rows.

    Returns the vector column, the label and ``synthetic``.
    """
    minority, _, needed = _classes(df, label)
    originals = df.select(features, label, F.lit(False).alias("synthetic"))
    if needed == 0:
        return originals
    grown = smote_rows(df, features, label, id_column, k, seed, sizes, search).select(
        array_to_vector("x").alias(features),
        F.lit(minority).cast(df.schema[label].dataType).alias(label),
        F.lit(True).alias("synthetic"),
    )
    return originals.unionByName(grown)
