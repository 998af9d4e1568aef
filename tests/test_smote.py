import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wardstone.operators import neighbors
from wardstone.operators.neighbors import BlockSizes, k_nearest, k_nearest_hashed
from wardstone.operators.smote import STEPS, smote_balance, smote_rows

SMALL = BlockSizes(cell=40, probe=15, block=25, slice=30)


def brute_force(points, copies, k):
    out = {}
    for i, p in enumerate(points):
        d = ((points - p) ** 2).sum(1)
        order = sorted((d[j], j) for j in range(len(points)) if j != i)
        out[i] = [j for _, j in order[:k]]
    return out


@pytest.mark.parametrize("sizes", [BlockSizes(), SMALL])
@pytest.mark.parametrize("shape", ["spread", "lumpy"])
def test_neighbors_equal_brute_force(spark, sizes, shape):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 30, size=(400, 4)).astype(float)
    if shape == "lumpy":  # most rows crowd one corner of the space
        points[:300] = rng.integers(0, 7, size=(300, 4))
    points = np.unique(points, axis=0)
    rows = [(i, [float(v) for v in p], 1, 5) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vid long, x array<double>, copies long, wanted long")
    got = {r["vid"]: [e["nvid"] for e in r["neighbors"]] for r in k_nearest(df, 5, sizes).collect()}
    assert got == brute_force(points, None, 5)


def _sample(spark, minority, majority, make):
    rows = [(i, 1, make(i)) for i in range(minority)] + [(i, 0, make(i)) for i in range(minority, minority + majority)]
    df = spark.createDataFrame(rows, "id long, label int, x array<double>")
    return df.select("id", "label", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("sizes", [BlockSizes(), SMALL])
def test_balances_exactly_and_stays_on_segments(spark, sizes):
    rng = np.random.default_rng(5)
    points = rng.integers(0, 20, size=(600, 3)).astype(float)
    df = _sample(spark, 90, 510, lambda i: points[i].tolist())
    out = smote_balance(df, "features", "label", "id", sizes=sizes)
    counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(1, False): 90, (0, False): 510, (1, True): 420}
    made = np.array([r["x"] for r in out.filter("synthetic").select(vector_to_array("features").alias("x")).collect()])
    minority = points[:90]
    for s in made[:60]:
        # on a segment between a minority point and one of its five nearest
        ok = False
        for i, a in enumerate(minority):
            d = ((minority - a) ** 2).sum(1)
            d[i] = np.inf
            for j in np.argsort(d, kind="stable")[:8]:
                b = minority[j]
                ab, at = b - a, s - a
                n = ab @ ab
                t = (at @ ab) / n if n else 0.0
                if -1e-9 <= t <= 1 + 1e-9 and np.abs(at - t * ab).max() < 1e-9 and d[j] <= np.sort(d)[4] + 1e-9:
                    ok = True
        assert ok


def test_same_rows_for_any_partitioning(spark):
    rng = np.random.default_rng(6)
    points = rng.integers(0, 9, size=(200, 3)).astype(float)
    df = _sample(spark, 40, 160, lambda i: points[i].tolist())

    def run(n, sizes):
        out = smote_balance(df.repartition(n), "features", "label", "id", sizes=sizes).filter("synthetic")
        return sorted(tuple(r["x"]) for r in out.select(vector_to_array("features").alias("x")).collect())

    assert run(1, BlockSizes()) == run(7, SMALL)


def test_copies_of_one_vector(spark):
    """A third of the minority is one vector: its synthetic rows are copies, none are lost."""
    df = _sample(spark, 30, 300, lambda i: [1.0, 1.0] if i < 10 else [float(i), float(i % 7)])
    out = smote_balance(df, "features", "label", "id").filter("synthetic")
    assert out.count() == 270
    same = out.filter(vector_to_array("features") == F.array(F.lit(1.0), F.lit(1.0))).count()
    assert same >= 10 * 9  # ten copies owe nine each, and have more than five copies to choose from


def test_two_minority_rows(spark):
    df = _sample(spark, 2, 20, lambda i: [float(i), 0.0])
    assert smote_balance(df, "features", "label", "id").filter("label = 1").count() == 20


def test_needs_two_classes(spark):
    df = _sample(spark, 5, 0, lambda i: [float(i)])
    with pytest.raises(ValueError):
        smote_balance(df, "features", "label", "id")


def test_rows_name_their_parent_neighbour_and_step(spark):
    rng = np.random.default_rng(8)
    points = rng.integers(0, 12, size=(300, 3)).astype(float)
    points[:6] = 1.0  # six equal minority rows
    df = _sample(spark, 40, 260, lambda i: points[i].tolist())
    made = smote_rows(df, "features", "label", "id", sizes=SMALL).collect()
    assert len(made) == 220 and len({(r["parent"], r["copy"]) for r in made}) == 220
    minority = points[:40]
    least = {tuple(p): i for i, p in reversed(list(enumerate(minority)))}
    for r in made:
        a, b = minority[r["parent"]], minority[r["neighbour"]]
        assert least[tuple(a)] == r["parent"] and least[tuple(b)] == r["neighbour"]
        assert 0 <= r["step"] < 1 and r["step"] * STEPS == int(r["step"] * STEPS)
        assert r["x"] == [p + r["step"] * (q - p) for p, q in zip(a, b)]
        others = np.delete(((minority - a) ** 2).sum(axis=1), r["parent"])
        assert ((a - b) ** 2).sum() <= np.sort(others)[4]
    assert {r["neighbour"] for r in made if r["parent"] == 0} == {0}  # more than five copies to choose from


def test_hashed_search_finds_most_neighbours(spark):
    """Measured recall of the approximate search; the exact one is the standard."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 6)) * 10
    points = centres[rng.integers(0, 30, 600)] + rng.normal(size=(600, 6))
    df = spark.createDataFrame([(i, [float(v) for v in p], 1, 5) for i, p in enumerate(points)], "vid long, x array<double>, copies long, wanted long")
    pick = lambda lists: {r["vid"]: {e["nvid"] for e in r["neighbors"]} for r in lists.collect()}
    exact, hashed = pick(k_nearest(df, 5)), pick(k_nearest_hashed(df, 5, radius=4.0, tables=6))
    recall = sum(len(exact[v] & hashed.get(v, set())) for v in exact) / sum(map(len, exact.values()))
    assert recall >= 0.9
    for vid, found in hashed.items():
        assert len(found) <= 5 and vid not in found


def test_balance_with_the_hashed_search(spark):
    rng = np.random.default_rng(10)
    points = rng.normal(size=(200, 3))
    df = _sample(spark, 40, 160, lambda i: points[i].tolist())
    out = smote_balance(df, "features", "label", "id", search=lambda v, k: k_nearest_hashed(v, k, radius=3.0))
    assert out.filter("label = 1").count() == 160


def test_distance_matrices_are_bounded():
    """Against a large block or many pivots, fewer rows are compared at a time; every row once, in order."""
    frame = pd.DataFrame({"vid": np.arange(3000)})
    for width in (1, 400, 4096, 16_384, 3 * neighbors.CHUNK_CELLS):
        parts = list(neighbors._chunks(frame[:40] if width > neighbors.CHUNK_CELLS else frame, width))
        assert max(len(p) for p in parts) == max(1, min(neighbors.CHUNK, neighbors.CHUNK_CELLS // width))
        assert list(pd.concat(parts)["vid"]) == list(range(sum(len(p) for p in parts)))
