"""Exact k nearest neighbours among the rows of one table.

The space is cut into cells around pivots drawn from the data. A row needs to
look only at cells that the ball around it, with a radius already known to hold
k neighbours, can reach; the triangle inequality rules the others out. Dense
cells are cut into blocks, and the rows that visit a block into slices, so a
task handles two small matrices however the data is spread, and passes on only
k rows per visitor.

Distances are computed blockwise in numpy. For whole-number features they are
exact; ties go to the smaller id, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstone.operators.ranges import shuffled
from wardstone.session import materialize

MAX_PIVOTS = 4096
CHUNK = 512
#: Numbers of one distance matrix, 8 MB: against many pivots or a large block, fewer rows at a time.
CHUNK_CELLS = 1 << 20
SLACK = 1e-9


@dataclass(frozen=True)
class BlockSizes:
    """Rows per cell aimed at, and upper sizes of what one task compares.

    ``probe`` rows are compared with each other for a first bound; a ``slice``
    of visiting rows is compared with a ``block`` of a cell. Larger blocks mean
    fewer copies of visitors on the wire.
    """

    cell: int = 2048
    probe: int = 2048
    block: int = 16384
    slice: int = 4096


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    cross = a @ b.T
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * cross, 0.0)


def _chunks(frame: pd.DataFrame, width: int) -> Iterator[pd.DataFrame]:
    """Slices of a frame whose distances to ``width`` points fit into ``CHUNK_CELLS``."""
    size = max(1, min(CHUNK, CHUNK_CELLS // max(width, 1)))
    for start in range(0, len(frame), size):
        yield frame.iloc[start : start + size]


def _nearest_in_block(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """Up to k closest other rows of the block for every query, as long rows."""
    block = block.sort_values("vid")
    ids, copies, points = block["vid"].to_numpy(), block["copies"].to_numpy(), _matrix(block["x"])
    width = min(k, len(ids))
    parts = []
    for chunk in _chunks(queries, len(ids)):
        asking = chunk["vid"].to_numpy()
        distances = _squared(_matrix(chunk["x"]), points)
        distances[asking[:, None] == ids[None, :]] = np.inf
        furthest = np.partition(distances, width - 1, axis=1)[:, width - 1]
        row, col = np.nonzero(distances <= furthest[:, None])
        found = distances[row, col]
        order = np.lexsort((col, found, row))
        row, col, found = row[order], col[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = (rank < width) & np.isfinite(found)
        row, col, found = row[keep], col[keep], found[keep]
        parts.append(pd.DataFrame({"vid": asking[row], "dist2": found, "nvid": ids[col], "copies": copies[col]}))
    return pd.concat(parts, ignore_index=True)


def _radius(found: pd.DataFrame, wanted: pd.Series) -> pd.Series:
    """Distance within which each row has its wanted number of neighbours, copies counted."""
    found = found.sort_values(["vid", "dist2"])
    reached = found.groupby("vid")["copies"].cumsum() >= found["vid"].map(wanted)
    return found[reached].groupby("vid")["dist2"].min()


def _pivots(vectors: DataFrame, rows: int, cell: int) -> np.ndarray:
    """A bounded, reproducible draw of data rows."""
    count = int(min(max(-(-rows // cell), 1), MAX_PIVOTS))
    drawn = vectors.orderBy(F.xxhash64("vid"), "vid").limit(count).select("x").collect()
    return np.array([r["x"] for r in drawn], dtype=np.float64)


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the closest pivot as ``cell`` and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk in _chunks(batch, len(pivots)):
                d2 = _squared(_matrix(chunk["x"]), pivots)
                cell = d2.argmin(1)
                yield chunk.assign(cell=cell.astype("int32"), radius=np.sqrt(d2[np.arange(len(chunk)), cell]))

    return vectors.mapInPandas(
        assign, "vid long, x array<double>, copies long, wanted long, cell int, radius double"
    )


def _with_bounds(data: DataFrame, k: int) -> DataFrame:
    """Distance that holds enough neighbours of a row, from its own probe group alone."""

    def own_group(frame: pd.DataFrame) -> pd.DataFrame:
        radius = _radius(_nearest_in_block(frame, frame, k), frame.set_index("vid")["wanted"])
        return frame[["vid", "x"]].assign(bound=np.sqrt(frame["vid"].map(radius)).fillna(np.inf))

    return (
        data.select("vid", "x", "copies", "wanted", "cell", "probe")
        .groupBy("cell", "probe")
        .applyInPandas(own_group, "vid long, x array<double>, bound double")
    )


def _reachable_cells(
    bounded: DataFrame, pivots: np.ndarray, reach: np.ndarray, filled: np.ndarray, k: int
) -> DataFrame:
    """One (vid, cell) row per vector and cell that can hold something closer than its bound.

    Pivots are rows too: the nearest k + 1 of them include k others, which
    bounds rows whose probe group was too small.
    """

    def reachable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk in _chunks(batch, len(pivots)):
                d2 = _squared(_matrix(chunk["x"]), pivots)
                own = d2.argmin(1)
                nearest = d2[np.arange(len(chunk)), own][:, None]
                gap = np.sqrt(_squared(pivots[own], pivots))
                beyond = np.where(gap > 0, (d2 - nearest) / np.where(gap > 0, 2 * gap, 1.0), 0.0)
                lower = np.maximum(np.sqrt(d2) - reach[None, :], beyond)
                bound = chunk["bound"].to_numpy()
                if len(pivots) > k:
                    bound = np.minimum(bound, np.sqrt(np.partition(d2, k, axis=1)[:, k]))
                limit = bound[:, None] * (1 + SLACK) + SLACK
                row, cell = np.nonzero((lower <= limit) & filled[None, :])
                yield pd.DataFrame({"vid": chunk["vid"].to_numpy()[row], "cell": cell.astype("int32")})

    return bounded.mapInPandas(reachable, "vid long, cell int")


def _part(count: str, salt: int, alias: str) -> Column:
    """Even share of a cell's rows, by hash of the id."""
    return F.pmod(F.xxhash64("vid", F.lit(salt)), F.col(count)).cast("int").alias(alias)


def k_nearest(vectors: DataFrame, k: int, sizes: BlockSizes = BlockSizes()) -> DataFrame:
    """Neighbour lists of distinct vectors.

    ``vectors`` holds ``vid`` (unique), ``x`` (distinct arrays), ``copies`` (rows
    that share the vector) and ``wanted`` (neighbours to find besides the
    vector's own copies). Returns ``vid`` and ``neighbors``: the closest other
    vectors in order, at most k, with their copies.
    """
    spark: SparkSession = vectors.sparkSession
    total = vectors.count()
    pivots = _pivots(vectors, total, sizes.cell)
    placed = materialize(_assign(vectors, pivots), "knn_cells")
    summary = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.max("radius").alias("reach"))
    per_cell = summary.toPandas()  # bounded: one row per pivot
    reach = np.full(len(pivots), -np.inf)
    reach[per_cell["cell"]] = per_cell["reach"]
    rows_in = np.zeros(len(pivots), dtype=np.int64)
    rows_in[per_cell["cell"]] = per_cell["rows"]
    cells = spark.createDataFrame(
        pd.DataFrame(
            {
                "cell": np.arange(len(pivots), dtype="int32"),
                "probes": (-(-rows_in // sizes.probe)).astype("int32"),
                "blocks": (-(-rows_in // sizes.block)).astype("int32"),
            }
        )
    )
    data = placed.join(F.broadcast(cells), "cell").select(  # bounded: one row per pivot
        "vid", "x", "copies", "wanted", "cell", _part("probes", 3, "probe"), _part("blocks", 7, "block")
    )
    asked = data.filter(F.col("wanted") > 0)
    visits = materialize(_reachable_cells(_with_bounds(asked, k), pivots, reach, rows_in > 0, k), "knn_visits")
    slices = (
        visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(sizes.slice)).cast("int").alias("slices"))
    )
    plan = F.broadcast(cells.join(slices, "cell"))  # bounded: one row per pivot
    asking = (
        visits.join(plan, "cell")
        .join(shuffled(placed.select("vid", F.col("x").alias("point"))), "vid")  # the stored visits carry no vectors
        .select("cell", "vid", F.col("point").alias("x"), "blocks", _part("slices", 11, "slice"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", "block", "slice", "vid", "x")
    )
    answering = (
        data.join(plan.drop("blocks"), "cell")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select("cell", "block", "slice", "vid", "x", "copies")
    )
    keys = ["cell", "block", "slice"]

    def compare(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"vid": [], "dist2": [], "nvid": [], "copies": []})
        return _nearest_in_block(queries, block, k)

    found = (
        asking.groupBy(*keys)
        .cogroup(answering.groupBy(*keys))
        .applyInPandas(compare, "vid long, dist2 double, nvid long, copies long")
    )
    ordered = F.sort_array(F.collect_list(F.struct("dist2", "nvid", "copies")))
    return found.groupBy("vid").agg(F.slice(ordered, 1, k).alias("neighbors"))


def k_nearest_hashed(
    vectors: DataFrame, k: int, radius: float, bucket_length: float | None = None, tables: int = 4, seed: int = 42
) -> DataFrame:
    """Neighbour lists as ``k_nearest`` gives them, approximate, from a locality-sensitive hash join.

    Pairs that share a bucket of one of ``tables`` random projections and lie
    within ``radius`` are the candidates; the k closest of them are kept, ties
    going to the smaller id. A neighbour is missed when it shares no bucket, and a
    row with no other within the radius gets no list. More tables and longer
    buckets (default: the radius) raise recall and cost. The join compares all
    pairs of a bucket, so the bucket length has to be chosen for the densest
    part of the data; where that is unknown, the exact search is the safe choice.
    """
    points = materialize(vectors.select("vid", "copies", "wanted", array_to_vector("x").alias("point")), "lsh_points")
    hashing = BucketedRandomProjectionLSH(
        inputCol="point", outputCol="hashes", bucketLength=bucket_length or radius, numHashTables=tables, seed=seed
    ).fit(points)
    close = hashing.approxSimilarityJoin(points.filter("wanted > 0"), points, radius, "distance")
    pairs = close.select(
        F.col("datasetA.vid").alias("vid"), F.col("datasetB.vid").alias("nvid"), F.col("datasetB.copies").alias("copies"),
        (F.col("distance") * F.col("distance")).alias("dist2"),
    ).filter("vid <> nvid")
    place = Window.partitionBy("vid").orderBy("dist2", "nvid")  # Spark keeps the first k of each task before the shuffle
    nearest = pairs.withColumn("_rank", F.row_number().over(place)).filter(F.col("_rank") <= k)
    return nearest.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("dist2", "nvid", "copies"))).alias("neighbors"))
