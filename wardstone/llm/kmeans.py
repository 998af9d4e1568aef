"""Exact k-means over integer vectors, with distance bounds loosened by planar geometry.

Each vector carries an upper bound of the distance to its own centroid and a
lower bound of the distance to every other one. When centroids move, the upper
bound grows by the own centroid's drift. The lower bound need not shrink by the
largest drift: all vectors of a cluster lie in a ball around its old centroid,
and for a centroid that moves from p to q no point x of the ball comes nearer by
more than the largest |x - p| - |x - q| over the ball. The points where that
difference has one value lie on a branch of a hyperbola with foci p and q, which
stays inside the cone of its asymptotes; seen in the plane of p, q and the
ball's centre, the difference is at most drift * cos(a), where a is the smallest
angle to the direction of the move, from the middle of p and q, that the ball
reaches. Centroids that move away from or past a cluster thus loosen its bounds
little or not at all.

A vector whose bounds stay apart keeps its cluster unseen. Of the rest, the
distance to the own centroid is renewed first, and the vectors still in doubt
are compared with all centroids in whole numbers; ties go to the smaller number.
Bounds are doubles and are only trusted beyond a margin far above rounding.

Each round is two passes of map and small aggregation, without a shuffle of
vectors. The state is written to the shared folder once a round. The sums of a
cluster follow the vectors that moved. The driver holds the centroids only.

Defined results: vectors with another length, a null, NaN or infinite component,
or null as a whole are not kept and give no row. Equal vectors and repeated rows
are vectors each. A null id stays null and is a starting centroid only when too
few vectors have one; equal ids start in order of their vectors. With fewer kept
vectors than centroids there are as many centroids as vectors; an empty table
gives no rows. A component beyond 2**27 after scaling is an error, because
squared distances would leave the range of a long. Extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, schema_of
from wardstone.session import materialize

MOST = 1 << 27
#: Up to this component a matrix product in doubles gives exact whole numbers for vectors of some hundred components.
_EXACT_DOUBLE = 1 << 21
_MARGIN = 1e-9
_STATE = "vec_id long, v array<int>, cluster int, before int, upper double, lower double, scanned boolean"
_MOVED = "cluster int, n long, sums array<long>"
_FINAL = "vec_id long, cluster int, distance long"


class Bounds(NamedTuple):
    """What a round adds to upper bounds, takes from lower ones, and half the way to the nearest other centroid."""

    grow: np.ndarray
    relax: np.ndarray
    half: np.ndarray


def planar_relaxation(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: how much nearer centroid j's move can bring any point within ``radius[i]`` of old centroid i."""
    old, new = old.astype(float), new.astype(float)
    move = new - old
    drift = np.sqrt((move**2).sum(axis=1))
    way = old[:, None, :] - (old + new)[None, :, :] / 2
    reach = np.sqrt((way**2).sum(axis=2))
    safe = np.where(reach > 0, reach, 1) * np.where(drift > 0, drift, 1)[None, :]
    angle = np.arccos(np.clip(np.einsum("ijd,jd->ij", way, move) / safe, -1, 1))
    ball = np.where(radius[:, None] >= reach, np.pi, np.arcsin(np.clip(radius[:, None] / np.where(reach > 0, reach, 1), 0, 1)))
    nearest = np.maximum(angle - ball, 0)
    return drift[None, :] * np.maximum(np.cos(np.minimum(nearest, np.pi / 2)), 0)


def bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Bounds:
    k = len(new)
    relax = planar_relaxation(old, new, radius)
    drift = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))
    relax = np.minimum(relax, drift[None, :])
    relax[np.arange(k), np.arange(k)] = 0
    apart = np.sqrt(((new[:, None, :] - new[None, :, :]).astype(float) ** 2).sum(axis=2))
    apart[np.arange(k), np.arange(k)] = np.inf
    return Bounds(drift, relax.max(axis=1, initial=0), apart.min(axis=1, initial=np.inf) / 2)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all centroids, as long."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * most * most * 4 < 1 << 53 and most <= _EXACT_DOUBLE:
        a, c = x.astype(float), centroids.astype(float)
        return ((a**2).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c**2).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, its squared distance, and both bounds, from all distances."""
    d = squared(x, centroids)
    own = d.argmin(axis=1)
    rows = np.arange(len(x))
    best = d[rows, own]
    rest = d.astype(float)
    rest[rows, own] = np.inf
    return own, best, np.sqrt(best), np.sqrt(rest.min(axis=1, initial=np.inf))


def _reassign(x, own, upper, lower, centroids: np.ndarray, change: Bounds):
    """Clusters and bounds after a move of the centroids, and which vectors were compared with all of them."""
    own = own.copy()
    upper = upper + change.grow[own]
    lower = lower - change.relax[own]
    safe = lambda u, l, c: u * (1 + _MARGIN) + _MARGIN < np.maximum(l, change.half[c])
    doubt = np.flatnonzero(~safe(upper, lower, own))
    if len(doubt):
        upper[doubt] = np.sqrt(((x[doubt] - centroids[own[doubt]]) ** 2).sum(axis=1).astype(float))
        doubt = doubt[~safe(upper[doubt], lower[doubt], own[doubt])]
    if len(doubt):
        own[doubt], _, upper[doubt], lower[doubt] = _scan(x[doubt], centroids)
    scanned = np.zeros(len(x), bool)
    scanned[doubt] = True
    return own, upper, lower, scanned


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.int64()))


def _moved(batches: Iterable[pa.RecordBatch], k: int, size: int) -> Iterator[pa.RecordBatch]:
    """Per task: what each cluster's sums and size gain or lose by vectors that changed their cluster."""
    sums, n = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        x, now, before = _matrix(batch.column("v"), size), batch.column("cluster").to_numpy(), batch.column("before").to_numpy()
        for cluster, sign in ((now, 1), (before, -1)):
            for c in np.unique(cluster[cluster >= 0]):
                chosen = cluster == c
                sums[c] += sign * x[chosen].sum(axis=0)
                n[c] += sign * int(chosen.sum())
    used = np.flatnonzero(n.astype(bool) | sums.any(axis=1))
    yield batch_of(_MOVED, used, n[used], _lists(sums[used])) if len(used) else pa.RecordBatch.from_pylist([], schema_of(_MOVED))


def integer_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v, the floor of each component times ``scale``, of the vectors that are kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    whole = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.coalesce((F.size("e") == size) & whole, F.lit(False)))
    too_far = F.raise_error(F.lit(f"a component lies beyond {MOST} after scaling"))
    whole_number = lambda x: F.when(F.abs(x * scale) > MOST, too_far.cast("int")).otherwise(F.floor(x * scale).cast("int"))
    return kept.select("vec_id", F.transform("e", whole_number).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ``seed:vec_id`` has the smallest SHA-256, in that order."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.select(place.alias("place"), "v").orderBy(F.asc_nulls_last("place"), "v").limit(k).collect()
    return np.array([r["v"] for r in chosen], np.int64)


def assignments(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, size: int = 64, scale: int = 64) -> tuple[DataFrame, np.ndarray, list[DataFrame]]:
    """vec_id, cluster and squared distance after the last round; the final centroids; and the stored state of each round."""
    rows = materialize(integer_vectors(vectors, size, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    states: list[DataFrame] = []
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids, states
    k = len(centroids)

    def start(batches: Iterable[pa.RecordBatch], centroids=centroids) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, _, upper, lower = _scan(_matrix(batch.column("v"), size), centroids)
            yield batch_of(_STATE, batch.column("vec_id"), batch.column("v"), own, np.full(len(own), -1), upper, lower, np.ones(len(own), bool))

    state = materialize(rows.mapInArrow(start, _STATE), "round")
    sums, n = [[0] * size for _ in range(k)], [0] * k
    for turn in range(rounds):
        states.append(state)
        changed = state.where("cluster <> before").select("v", "cluster", "before").mapInArrow(lambda batches: _moved(batches, k, size), _MOVED)
        gains = changed.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(F.sum("part").alias("part"), F.sum("n").alias("n"))
        for row in gains.collect():  # k rows for each component
            sums[row["cluster"]][row["at"]] += row["part"]
            n[row["cluster"]] += row["n"] if row["at"] == 0 else 0
        far = {r["cluster"]: r["far"] for r in state.groupBy("cluster").agg(F.max("upper").alias("far")).collect()}
        new = np.array([[s // n[c] for s in sums[c]] if n[c] else centroids[c] for c in range(k)], np.int64)
        radius = np.array([far.get(c, 0.0) for c in range(k)]) * (1 + _MARGIN) + _MARGIN
        change, centroids = bounds(centroids, new, radius), new
        last = turn + 1 == rounds

        def step(batches: Iterable[pa.RecordBatch], centroids=centroids, change=change, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, before = _matrix(batch.column("v"), size), batch.column("cluster").to_numpy()
                upper, lower = batch.column("upper").to_numpy(), batch.column("lower").to_numpy()
                own, upper, lower, scanned = _reassign(x, before, upper, lower, centroids, change)
                if last:
                    yield batch_of(_FINAL, batch.column("vec_id"), own, ((x - centroids[own]) ** 2).sum(axis=1))
                else:
                    yield batch_of(_STATE, batch.column("vec_id"), batch.column("v"), own, before, upper, lower, scanned)

        kept = state.select("vec_id", "v", "cluster", "upper", "lower")
        state = materialize(kept.mapInArrow(step, _FINAL if last else _STATE), "final" if last else "round")
    return state, centroids, states


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, size: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    found, centroids, _ = assignments(vectors, k, rounds, seed, size, scale)
    spark = vectors.sparkSession
    digests = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    totals = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row a cluster
    inertia = totals.agg(F.sum("cluster_inertia").alias("inertia"))
    facts = totals.join(named, "cluster").crossJoin(inertia)
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
