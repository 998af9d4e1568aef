"""Near copies among embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Vectors are compared only within their label. Centroids are fitted on a bounded
sample; every vector belongs to the cell of its nearest centroid. A vector also
visits each later cell that can hold a partner: the angle to that cell's
centroid is at most the cell's radius plus the angle of the threshold (triangle
inequality on the sphere), so no pair is missed. Cells are cut into blocks of
bounded size, and each pair of blocks is one product of two matrices in double
precision. A pair of blocks hands on one count per vector and the links of a
spanning forest, never all pairs.

Equal vectors are merged first and counted with their number.

Defined results: vectors that are null, zero or hold null or non-finite
components, and vectors without a label, link with nothing and stand alone.
Vectors of different lengths are never compared. A null id can be linked but
names no group unless it is alone; its ``kept`` is false. Repeated rows are
vectors of their own. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of
from wardstone.llm.components import connected
from wardstone.session import materialize

#: Vectors that the centroids are fitted on, and centroids, at most.
SAMPLE = 20_000
MOST_CELLS = 256
CELL = 2048
BLOCK = 2048
#: Added to the visiting angle against rounding.
_SLACK = 1e-6


def spherical_kmeans(unit: np.ndarray, cells: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Unit centroids; an empty cell keeps its last one."""
    rng = np.random.default_rng(seed)
    centroids = unit[rng.choice(len(unit), min(cells, len(unit)), replace=False)]
    for _ in range(rounds):
        nearest = (unit @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, unit)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centroids)
    return centroids


def _matrix(column) -> np.ndarray:
    """Equally long vectors as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a link to their class, and the classes of equal vectors with a number, size and least id."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False))
    rows = materialize(rows.withColumn("usable", usable).withColumn("vh", F.xxhash64("label", "v")), "vectors")
    classes = rows.where("usable").groupBy("vh", "label", "v").agg(F.count("*").alias("many"), F.min("vec_id").alias("least"))
    return rows, materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def _cells(classes: DataFrame, cell: int) -> tuple[dict[int, np.ndarray], int]:
    """Centroids by vector length, fitted on a sample chosen by hash."""
    n = classes.count()
    sample = classes.select("v", "vh").orderBy("vh").limit(SAMPLE).select("v").toPandas()["v"]
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    cells = int(np.clip(n // cell, 1, MOST_CELLS))
    return {size: spherical_kmeans(_unit(np.array(list(vs), float)), cells) for size, vs in by_size.items()}, n


def links(classes: DataFrame, threshold: float, cell: int = CELL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(node, n) numbers of linked vectors by class, and (src, dst) links that connect all linked classes."""
    centroids, n = _cells(classes, cell)
    angle = float(np.arccos(np.clip(threshold, -1, 1))) + _SLACK

    def angles(size: int, x: np.ndarray) -> np.ndarray:
        if size not in centroids:  # a length the sample missed: one cell that holds all of them
            return np.zeros((len(x), 1))
        return np.arccos(np.clip(x @ centroids[size].T, -1, 1))

    home_ddl = "node long, many long, label string, size int, cell int, far double, v array<double>"

    def home(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x = _unit(_matrix(part.column("v")))
                a = angles(int(size), x)
                own = a.argmin(axis=1)
                unit = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * int(size), pa.int32()), pa.array(x.ravel()))
                yield batch_of(home_ddl, part.column("node"), part.column("many"), part.column("label"), np.full(len(x), size), own, a[np.arange(len(x)), own], unit)

    homes = materialize(classes.select("node", "many", "label", "v").mapInArrow(home, home_ddl), "homes")
    stats = homes.groupBy("label", "size", "cell").agg(F.count("*").alias("members"), F.max("far").alias("radius"))
    reach = stats.groupBy("size", "cell").agg(F.max("radius").alias("radius")).where(F.col("size").isin(*centroids) if centroids else F.lit(False))
    radius = {(r["size"], r["cell"]): r["radius"] for r in reach.collect()}  # at most MOST_CELLS for each length in the sample
    visit_ddl = "node long, many long, label string, size int, cell int, v array<double>"

    def visit(batches):
        for batch in batches:
            sizes, own = batch.column("size").to_numpy(), batch.column("cell").to_numpy()
            for size in np.unique(sizes):
                if int(size) not in centroids:
                    continue
                chosen = np.flatnonzero(sizes == size)
                a = angles(int(size), _matrix(batch.column("v").take(pa.array(chosen))))
                limit = np.array([radius.get((int(size), c), -1.0) for c in range(a.shape[1])])
                near = (a <= limit + angle) & (limit >= 0) & (np.arange(a.shape[1]) > own[chosen][:, None])
                for c in np.flatnonzero(near.any(axis=0)):
                    part = batch.take(pa.array(chosen[near[:, c]]))
                    yield batch_of(visit_ddl, part.column("node"), part.column("many"), part.column("label"), part.column("size"), np.full(part.num_rows, c), part.column("v"))

    visits = homes.select("node", "many", "label", "size", "cell", "v").mapInArrow(visit, visit_ddl)
    key = ["label", "size", "cell"]
    guests = visits.groupBy(*key).agg(F.count("*").alias("guests"))
    plan = stats.join(guests, key, "left").select(
        *key, F.ceil(F.col("members") / block).cast("long").alias("mb"), F.ceil(F.coalesce("guests", F.lit(0)) / block).cast("long").alias("gb")
    )
    plan = materialize(plan, "blocks")
    deal = F.pmod(F.xxhash64("node"), F.col("mb"))
    members = homes.join(plan, key).withColumn("i", deal)
    with_members = members.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1))).select(
        *key, F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"), F.lit(-1).cast("long").alias("guest"), (F.col("i") > F.col("j")).alias("right"),
        "node", "many", "v",
    )
    with_guests = members.where("gb > 0").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gb") - 1))).select(
        *key, F.col("i").alias("low"), F.col("i").alias("high"), F.col("g").alias("guest"), F.lit(False).alias("right"), "node", "many", "v"
    )
    guest_rows = visits.join(plan, key).withColumn("g", F.pmod(F.xxhash64("node"), F.col("gb"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)))
    guest_rows = guest_rows.select(*key, F.col("i").alias("low"), F.col("i").alias("high"), F.col("g").alias("guest"), F.lit(True).alias("right"), "node", "many", "v")
    pair = [*key, "low", "high", "guest"]
    out = "node long, n long, other long"

    def compare(table: pa.Table) -> pa.Table:
        right = table.column("right").to_numpy(zero_copy_only=False)
        node, many = table.column("node").to_numpy(), table.column("many").to_numpy()
        x = _matrix(table.column("v"))
        left_at, right_at = np.flatnonzero(~right), np.flatnonzero(right)
        if table.column("low")[0] == table.column("high")[0] and table.column("guest")[0].as_py() < 0:
            return _products(x, node, many, left_at, left_at, True)
        return _products(x, node, many, left_at, right_at, False)

    def _products(x, node, many, a, b, same) -> pa.Table:
        total = np.zeros(len(node), np.int64)
        root = np.arange(len(node))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for k in range(0, len(a), 256):
            rows = a[k : k + 256]
            hit = x[rows] @ x[b].T >= threshold
            if same:
                hit[np.arange(len(rows)), np.arange(k, k + len(rows))] = False
            total[rows] += hit @ many[b]
            if not same:
                total[b] += many[rows] @ hit
            for r in np.flatnonzero(hit.any(axis=1)):
                i = find(int(rows[r]))
                for j in np.unique(root[b[hit[r]]]):
                    j = find(int(j))
                    if i != j:
                        i, j = min(i, j), max(i, j)
                        root[j] = i
        used = np.flatnonzero(total)
        other = [int(node[find(int(i))]) for i in used]
        return pa.Table.from_batches([batch_of(out, node[used], total[used], other)])

    tasks = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // (4 * block))
    blocks = with_members.union(with_guests).union(guest_rows).repartition(tasks, *pair)
    found = materialize(blocks.groupBy(*pair).applyInArrow(compare, out), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    return counts, found.where("node <> other").select(F.col("node").alias("src"), F.col("other").alias("dst"))


def near_copies(vectors: DataFrame, threshold: float = 0.93, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows, classes = distinct_vectors(vectors)
    counts, edges = links(classes, threshold, cell, block)
    root = connected(edges)
    named = classes.join(root, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").select(
        "vh", F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id"
    )
    match = (rows["vh"] == facts["vh"]) & (rows["label"] == facts["_label"]) & (rows["v"] == facts["_v"]) & rows["usable"]
    joined = rows.join(facts, match, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
