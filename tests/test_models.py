"""Training, explanation, saving and streaming."""

import subprocess
import sys
from itertools import combinations
from math import factorial
from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from wardstone.operators import evaluate as V
from wardstone.operators import models as M
from wardstone.operators import trees as T
from wardstone.operators.features import ORDINAL
from wardstone.plans import modelling as P
from wardstone.plans.tables import first_encounters
from wardstone.session import scratch_path
from wardstone.sources.orders_fixture import encounter_stream, encounters
from wardstone.streaming.scoring import score_stream

SF = "/root/testdata/sf0.001"
PARAMS = M.BoostingParams(trees=8)


@pytest.fixture(scope="module")
def parts(spark):
    train, test = M.split(first_encounters(spark, SF))
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def boosted(parts):
    return M.train_boosting(parts[0], params=PARAMS)


def test_boosting_scores(parts, boosted):
    scored = boosted.transform(parts[1])
    assert scored.count() == parts[1].count()
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    trained = boosted.transform(parts[0])
    assert V.roc_auc(trained, M.LABEL, "score").first()["auc"] > 0.6


def test_saved_model_scores_the_same(spark, parts, boosted):
    path = scratch_path(spark, "model")
    M.save_model(boosted, spark, path)
    loaded = M.load_model(spark, path)
    pick = lambda m: sorted((r[M.ID], r["score"]) for r in m.transform(parts[1]).select(M.ID, "score").collect())
    assert loaded.names == boosted.names and pick(loaded) == pick(boosted)


def test_attributions_add_up_to_the_margin(parts, boosted):
    rows = M.encode(boosted.encoder, parts[1])
    explained = T.tree_attributions(boosted.trees, rows, M.ID)
    total = F.aggregate("phi", F.col("base_value"), lambda a, v: a + v)
    margin = boosted.transform(parts[1]).select(M.ID, vector_to_array("rawPrediction")[1].alias("margin"))
    gaps = explained.join(margin, M.ID).select(F.abs(total - F.col("margin")).alias("gap")).collect()
    assert len(gaps) == parts[1].count() and max(r["gap"] for r in gaps) < 1e-9


def _expected_given(nodes, x, known, node_id=0):
    node = nodes[node_id]
    if node["leftChild"] < 0:
        return node["prediction"]
    split = node["split"]
    left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
    if split["featureIndex"] in known:
        go = left if x[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0] else right
        return _expected_given(nodes, x, known, go["id"])
    return sum(c["rawCount"] / node["rawCount"] * _expected_given(nodes, x, known, c["id"]) for c in (left, right))


def test_attributions_are_shapley_values(spark, boosted):
    """Against the definition: all subsets of the features a tree uses."""
    path = scratch_path(spark, "tree_check")
    boosted.trees.write().save(path)
    rows = spark.read.parquet(f"{path}/data").filter("treeID = 1").select("nodeData").collect()
    nodes = {r["nodeData"]["id"]: r["nodeData"].asDict(recursive=True) for r in rows}
    used = sorted({n["split"]["featureIndex"] for n in nodes.values() if n["leftChild"] >= 0})
    if len(used) > 10:  # keep the subsets few: cut the tree below its third level
        parent = {c: n["id"] for n in nodes.values() for c in (n["leftChild"], n["rightChild"]) if c >= 0}

        def depth(i):
            return 0 if i == 0 else 1 + depth(parent[i])

        for n in nodes.values():
            if n["leftChild"] >= 0 and depth(n["id"]) >= 3:
                n["leftChild"] = n["rightChild"] = -1
        reach, stack = {}, [0]
        while stack:
            n = nodes[stack.pop()]
            reach[n["id"]] = n
            stack += [c for c in (n["leftChild"], n["rightChild"]) if c >= 0]
        nodes = reach
        used = sorted({n["split"]["featureIndex"] for n in nodes.values() if n["leftChild"] >= 0})
    width = len(boosted.names)
    x = np.random.default_rng(1).integers(0, 12, size=(6, width)).astype(float)
    tree = T._read_tree(sorted(nodes.values(), key=lambda n: n["id"]))
    got = T.attribute_rows([tree], [1.0], x)
    m = len(used)
    for row in range(len(x)):
        for f in used:
            others = [u for u in used if u != f]
            want = sum(
                factorial(r) * factorial(m - r - 1) / factorial(m)
                * (_expected_given(nodes, x[row], {*s, f}) - _expected_given(nodes, x[row], set(s)))
                for r in range(m) for s in combinations(others, r)
            )
            assert got[row, f] == pytest.approx(want, abs=1e-10)


def test_rows_of_one_part_are_explained_by_several_tasks(parts, boosted, monkeypatch):
    monkeypatch.setattr(T, "ROWS_PER_TASK", 25)
    rows = boosted.transform(parts[1]).coalesce(1)
    explained = T.tree_attributions(boosted.trees, rows, M.ID)
    assert explained.rdd.getNumPartitions() == -(-rows.count() // 25) > 1
    assert explained.count() == rows.count()


def test_listed_patterns_give_the_same_contributions(spark, parts, boosted, monkeypatch):
    trees, weights = T.read_trees(boosted.trees, spark)
    x = np.array([r["x"] for r in M.encode(boosted.encoder, parts[1]).select(vector_to_array("features").alias("x")).collect()])
    listed = T.attribute_rows(trees, weights, x)
    monkeypatch.setattr(T, "LISTED", 0)
    assert np.array_equal(listed, T.attribute_rows(trees, weights, x))


def test_importance_and_curve(spark, parts, boosted):
    top = M.feature_importance(boosted, spark, top=5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]
    curve = M.boosting_curve(boosted, parts[1], every=4).orderBy("trees").collect()
    assert [r["trees"] for r in curve] == [4, 8]
    whole = V.roc_auc(boosted.transform(parts[1]), M.LABEL, "score").first()["auc"]
    assert curve[-1]["auc"] == pytest.approx(whole, abs=1e-12)


def test_logistic_on_the_ordinal_set_with_weights(parts):
    model = M.train_logistic(parts[0], ORDINAL, max_iter=30, balance="weight")
    assert not [n for n in model.names if "[" in n or ">" in n]
    assert V.roc_auc(model.transform(parts[0]), M.LABEL, "score").first()["auc"] > 0.55


def test_cross_validation(parts):
    train = parts[0]
    encoded = M.encode(M.X.fit_encoder(train), train)
    rows = M.logistic_cv(encoded, folds=3, max_iter=20, balance="weight").collect()
    assert len(rows) == 3 and rows[0]["mean_auc"] == pytest.approx(sum(r["auc"] for r in rows) / 3)


def test_stream_with_a_fitted_model_equals_batch(spark, boosted):
    sink = scratch_path(spark, "sink")
    job = score_stream(
        encounter_stream(spark, SF), sink, scratch_path(spark, "ckpt"), boosted.transform, ["encounter_id", "score"]
    )
    job.awaitTermination()
    pick = lambda df: sorted((r["encounter_id"], r["score"]) for r in df.select("encounter_id", "score").collect())
    assert pick(spark.read.parquet(sink)) == pick(boosted.transform(encounters(spark, SF)))


def test_a_stream_of_one_file_is_scored_by_all_cores(spark):
    sink = scratch_path(spark, "spread_sink")
    score_stream(encounter_stream(spark, SF), sink, scratch_path(spark, "spread_ckpt")).awaitTermination()
    scored = spark.read.parquet(sink)
    assert scored.select(F.input_file_name()).distinct().count() == spark.sparkContext.defaultParallelism
    assert scored.count() == encounters(spark, SF).count()


def test_training_parts_follow_the_rows(spark):
    assert [M.training_parts(n, 100) for n in (0, 1, 100, 101, 12_345)] == [1, 1, 1, 2, 124]
    rows = spark.range(1000).select(F.col("id").cast("int").alias(M.LABEL), F.array(F.col("id").cast("double")).alias("x"))
    rows = rows.select(M.LABEL, array_to_vector("x").alias("features"))
    assert M.dealt(rows, 100).rdd.getNumPartitions() == 10 and M.dealt(rows, 1000).rdd.getNumPartitions() == 1


def test_copies_of_one_row_spread_over_the_parts(spark):
    rows = spark.range(20_000).select(
        F.lit(1).alias(M.LABEL), array_to_vector(F.array(F.when(F.col("id") < 15_000, -1).otherwise(F.col("id")).cast("double"))).alias("features")
    )
    parts = M.dealt(rows, 1000)
    sizes = [r["n"] for r in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 6000
    same = lambda df: sorted((str(r["features"]), r["n"]) for r in df.groupBy("features").agg(F.count("*").alias("n")).collect())
    assert same(parts) == same(rows)


_FIT = """
import sys
from wardstone.operators import models as M
from wardstone.plans import modelling as P
from wardstone.plans.tables import first_encounters
from wardstone.session import build_session

spark = build_session("cores", int(sys.argv[1]))
spark.sparkContext.setLogLevel("OFF")
train, _ = M.split(first_encounters(spark, sys.argv[2]))
encoded = M.encode(M.X.fit_encoder(train), train)
boosted = M.fit_boosting(encoded, M.BoostingParams(trees=3, rows_per_part=100), balance="weight").stages[-1]
logistic = M.fit_logistic(encoded, 20, "weight", rows_per_part=100).stages[-1]
print("MODEL", __import__("hashlib").md5((boosted.toDebugString.split(chr(10), 1)[1] + str(logistic.coefficients)).encode()).hexdigest())
"""


def test_same_model_on_two_and_eight_cores():
    found = set()
    for cores in ("2", "8"):
        done = subprocess.run([sys.executable, "-c", _FIT, cores, SF], capture_output=True, text=True, timeout=600, check=True)
        found |= {line for line in done.stdout.splitlines() if line.startswith("MODEL")}
    assert len(found) == 1


def test_default_parts_grow_as_the_root_of_the_rows():
    """A learner's hundreds of jobs have a task per part, and the driver keeps a record of each."""
    assert [M.training_parts(n) for n in (0, 1, 16_384, 16_385, 147_456)] == [1, 1, 1, 2, 9]
    assert [M.training_parts(n) for n in (808_046, 8_080_460, 48_482_760)] == [22, 67, 164]


def test_a_fit_passes_over_dozens_of_parts(spark, monkeypatch):
    """Each pass over a part has a cost of its own, however few its rows."""
    assert [M.fitting_parts(n) for n in (0, 1, 16_385, 147_456)] == [1, 1, 2, 9]
    assert [M.fitting_parts(n) for n in (808_046, 2_000_000, 8_080_460, 48_482_760)] == [12, 12, 24, 48]
    assert M.fitting_parts(12_345, 100) == 124
    monkeypatch.setattr(M, "ROWS_PER_PART", 10)
    rows = spark.range(30_000).select(F.lit(1).alias(M.LABEL), array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    assert M.dealt(rows).rdd.getNumPartitions() == 12 and M.dealt(rows).count() == 30_000


def test_rows_of_a_fit_stream_from_where_they_are_kept(parts, monkeypatch):
    """A serialized level with memory reads a part's rows back as one array; with parts of 340,000 rows executors ran out of heap."""
    levels, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, level: levels.append(level) or persist(df, level))
    train = M.encode(M.X.fit_encoder(parts[0]), parts[0])
    levels.clear()
    M.logistic_cv(train, folds=2, max_iter=2, balance="weight")
    M.fit_boosting(train, M.BoostingParams(trees=1, depth=1), balance="weight")
    assert len(levels) == 4 and not [v for v in levels if v.useMemory and not v.deserialized]


def test_large_folds_are_fitted_fewer_at_a_time():
    assert [M.folds_at_once(n, 5, 5, "weight") for n in (0, 455_529, 4_555_290, 27_331_740)] == [5, 5, 2, 1]
    assert M.folds_at_once(1_000_000, 5, 5, "smote") == 5 and M.folds_at_once(2_000_000, 5, 5, "smote") == 2
    assert M.folds_at_once(1_000, 5, 2, "weight") == 2


def test_both_models_are_fitted_side_by_side(spark, monkeypatch):
    together = Barrier(2, timeout=60)
    for name in ("_boosted", "_logistic"):
        monkeypatch.setattr(P, name, lambda spark, sf, name=name: (together.wait(), name)[1])
    monkeypatch.setattr(P, "_balanced", lambda spark, sf: spark.range(10))
    assert P._fitted(spark, SF) == ["_boosted", "_logistic"]
    assert [M.fits_at_once(n, 2) for n in (0, 808_046, 4_000_000, 4_000_001, 8_080_460)] == [2, 2, 2, 1, 1]
