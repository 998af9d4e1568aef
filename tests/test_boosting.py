"""Trees grown from blocks of codes against Spark's own learner."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wardstone.operators import boosting as B
from wardstone.operators import models as M


@pytest.fixture(scope="module")
def noisy(spark):
    """12,000 rows of seven columns: whole numbers, mostly zeros, fractions, one constant and one that says nothing."""
    def draw(k):
        return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000.0

    x = [F.floor(draw(1) * 9), F.when(draw(2) < 0.9, 0.0).otherwise(draw(3)), draw(4) - 0.5, F.lit(0.0), F.floor(draw(5) * 2), draw(6), F.floor(draw(7) * 40)]
    odds = 0.2 + 0.05 * x[0] + 0.2 * x[4] - 0.3 * x[2] * x[5]
    rows = spark.range(12_000).select((draw(8) < odds).cast("int").alias(M.LABEL), array_to_vector(F.array(*[c.cast("double") for c in x])).alias("features"), (draw(9) + 0.5).alias("weight"))
    return rows.cache()


def learner(**more):
    return GBTClassifier(
        labelCol=M.LABEL, featuresCol="features", maxIter=6, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        minInstancesPerNode=40, seed=7, **more,
    )


def shapes(model):
    return [re.sub(r"Predict: .*", "", t.toDebugString.split("\n", 1)[1]) for t in model.trees]


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("per_part, parts", [(20_000, 1), (2_500, 5)])
def test_trees_are_those_of_sparks_learner(noisy, weighted, per_part, parts, monkeypatch):
    monkeypatch.setattr(B, "TREES_PER_LINEAGE", 4)
    settings = learner(weightCol="weight") if weighted else learner()
    rows = M.dealt(noisy if weighted else noisy.drop("weight"), per_part).cache()
    assert rows.rdd.getNumPartitions() == parts
    theirs, ours = settings.fit(rows), B.fit(rows, settings)
    assert shapes(ours) == shapes(theirs) and ours.treeWeights == theirs.treeWeights
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-12)
    margins = [np.array([r["m"] for r in m.transform(rows).select(vector_to_array("rawPrediction")[1].alias("m")).collect()]) for m in (theirs, ours)]
    assert np.abs(margins[0] - margins[1]).max() < 1e-12 < np.abs(margins[0]).max()


def test_cut_points_of_a_sample(spark, noisy):
    """From more rows than are sampled, cut points are the ones that Spark takes, zeros that the sample leaves out included."""
    rows = M.dealt(noisy.drop("weight").unionByName(noisy.drop("weight")).repartition(3), 9_000).cache()
    theirs, ours = (f(rows) for f in (learner().fit, lambda df: B.fit(df, learner())))
    assert shapes(ours) == shapes(theirs)


def test_doubles_in_lanes_are_those_of_one_sequence(spark):
    for n in (1, 2, 3, 1000, 4097):
        drawn = B.doubles(42, n)
        one = B._doubles_of(42)
        assert drawn.tolist() == [next(one) for _ in range(n)]
        assert drawn.tolist() == [r["u"] for r in spark.range(0, n, 1, 1).select(F.rand(42).alias("u")).collect()]


def test_joined_columns_give_their_bins_back():
    draw = np.random.default_rng(3)
    binned = np.stack([draw.integers(0, n, 5000).astype(np.uint8) for n in (2, 3, 32, 32, 2, 32, 1)])
    for most in (8, 64, 4096):
        codes, bins = B.joined(binned, [2, 3, 32, 32, 2, 32, 1], most)
        again = np.concatenate([table[:, code] for code, table in zip(codes, bins)])
        assert np.array_equal(again, binned) and codes.dtype == np.uint16
        assert max(t.shape[1] for t in bins if len(t) > 1) <= most
    assert len(codes) == 2


def test_large_tables_are_grown_from_blocks(noisy, monkeypatch):
    """Spark's learner visits every column of every row at each level; at 60 times sf0.1 that did not end in time."""
    monkeypatch.setattr(M, "ROWS_IN_BLOCKS", 12_000)
    used, fit = [], B.fit
    monkeypatch.setattr(B, "fit", lambda rows, settings: used.append(rows.count()) or fit(rows, settings))
    params = M.BoostingParams(trees=2, depth=2)
    rows = noisy.drop("weight")
    M.fit_boosting(rows, params, balance="none")
    M.fit_boosting(rows.limit(11_999), params, balance="none")
    assert used == [12_000]
