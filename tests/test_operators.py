"""Operator behaviour on small and on lopsided inputs."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardstone.operators import evaluate as V
from wardstone.operators import features as X
from wardstone.operators import profile as P
from wardstone.operators import segments as G
from wardstone.operators import splits as L
from wardstone.operators import stats as T
from wardstone.operators.patients import bucketed_by_patient, first_encounter_in_bucket
from wardstone.operators.ranges import ranked_quantiles
from wardstone.operators.smote import smote_rows
from wardstone.plans.catalog import QUERIES
from wardstone.plans.tables import encounters, first_encounters
from wardstone.sources.orders_fixture import derive_encounters, order_items

SF = "/root/testdata/sf0.001"


def test_first_encounter_keeps_smallest_id(spark):
    rows = [(1, 7, "a"), (1, 3, "b"), (1, 9, "c"), (2, 5, "d"), (None, 8, "e"), (None, 2, "f")]
    df = spark.createDataFrame(rows, "patient_nbr long, encounter_id long, v string")
    assert sorted(r["v"] for r in P.first_encounter(df).collect()) == ["b", "d", "f"]


def test_first_encounter_with_one_crowded_patient(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("patient_nbr"),
        (10_000 - F.col("id")).alias("encounter_id"),
    )
    got = P.first_encounter(df)
    assert got.count() == df.select("patient_nbr").distinct().count()
    assert got.filter("patient_nbr = 0").first()["encounter_id"] == 10_000 - 8997


def test_dedup_and_duplicate_checks(spark):
    df = encounters(spark, SF)
    row = P.dedup_summary(df).first()
    assert row["deduplicated_rows"] == P.first_encounter(df).count()
    assert row["total_rows"] - row["removed_rows"] == row["deduplicated_rows"]
    assert P.duplicate_ids(df).count() == 0


def test_shares_add_up(spark):
    assert abs(sum(r["pct_of_total"] for r in P.target_distribution(encounters(spark, SF)).collect()) - 100) < 0.02


def test_empty_segment_keeps_its_row(spark):
    df = encounters(spark, SF).filter(F.col("age") != "[20-30)")
    rates = {r["segment"]: r["readmission_rate"] for r in G.insight_segments(df).collect()}
    assert len(rates) == 6 and rates["Age 20-30"] is None


def test_raw_and_normalised_missing_counts_agree(spark):
    from wardstone.sources.orders_fixture import raw_encounters

    key = lambda df: {r["column_name"]: r["missing_count"] for r in P.missing_profile(df).collect()}
    assert key(raw_encounters(spark, SF)) == key(encounters(spark, SF))


def test_rate_rises_with_utilisation(spark):
    rates = {r["prior_inpatient_visits"]: r["readmission_rate_pct"] for r in QUERIES["rate_by_inpatient"](spark, "/root/testdata/sf0.01").collect()}
    assert rates[0] < rates[1] < rates[2] < rates[3]


@pytest.mark.parametrize("test", [0.2, 0.37])
def test_split_is_exact_and_disjoint(spark, test):
    df = spark.range(5000).select("id", (F.col("id") % 9 == 0).cast("int").alias("label"))
    out = L.stratified_split(df, "label", "id", test).collect()
    assert len(out) == 5000 and len({r["id"] for r in out}) == 5000
    for label in (0, 1):
        rows = [r for r in out if r["label"] == label]
        assert sum(r["is_test"] for r in rows) == math.floor(len(rows) * test + 0.5)


def test_rank_does_not_depend_on_ranges(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    ranks = [
        {r["id"]: r["class_rank"] for r in L.class_rank(df.repartition(p), "label", "id", ranges=n).collect()}
        for p, n in ((1, 1), (5, 64), (3, 4096))
    ]
    assert ranks[0] == ranks[1] == ranks[2]
    assert sorted(v for k, v in ranks[0].items() if k % 7 == 0) == list(range(1, 430))


def test_folds_are_even(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    sizes = L.stratified_folds(df, "label", "id").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["label"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def _scores(spark, n=4000, decimals=None):
    rng = random.Random(1)
    rows = []
    for _ in range(n):
        label = int(rng.random() < 0.2)
        score = min(max(rng.gauss(0.4 + 0.15 * label, 0.15), 0.0), 1.0)
        rows.append((label, round(score, decimals) if decimals else score))
    return rows, spark.createDataFrame(rows, "label int, score double")


def brute_auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("decimals", [None, 2])
def test_auc_against_brute_force_and_spark(spark, decimals):
    rows, df = _scores(spark, decimals=decimals)
    auc = V.roc_auc(df, "label", "score").first()["auc"]
    assert auc == pytest.approx(brute_auc(rows), abs=1e-12)
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert auc == pytest.approx(spark_auc.evaluate(df), abs=1e-9)
    moved = df.withColumn("score", F.exp("score") * 3)
    assert V.roc_auc(moved, "label", "score").first()["auc"] == pytest.approx(auc, abs=1e-12)


def test_running_counts_do_not_depend_on_ranges(spark):
    _, df = _scores(spark)
    one = sorted(tuple(r) for r in V.running_counts(df, "label", "score").collect())
    many = sorted(tuple(r) for r in V.running_counts(df, "label", "score", rows_per_range=100).collect())
    assert one == many


def test_average_precision_is_the_step_sum(spark):
    rows, df = _scores(spark, n=800, decimals=2)
    total, last, positives = 0.0, 0.0, sum(y for y, _ in rows)
    for t in sorted({s for _, s in rows}, reverse=True):
        above = [y for y, s in rows if s >= t]
        recall = sum(above) / positives
        total, last = total + (recall - last) * sum(above) / len(above), recall
    assert V.average_precision(df, "label", "score").first()["average_precision"] == pytest.approx(total, abs=1e-6)


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "label int, score double")
    cells = {(r["true_label"], r["predicted_class"]): r["count"] for r in V.confusion_matrix(df, "label", "score").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    report = {r["class"]: r for r in V.classification_report(df, "label", "score").collect()}
    assert report["Readmitted <30d"]["precision"] == 0.0 and report["accuracy"]["f1"] == 0.5


def test_lab_burden_is_strict(spark):
    df = encounters(spark, SF)
    cut = X.lab_cut(df).first()["lab_p75"]
    at_cut = X.build_features(df).filter(F.col("num_lab_procedures") == cut)
    assert at_cut.filter("high_lab_burden = 1").count() == 0


def test_category_levels_are_all_found(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("c"))
    assert X.category_levels(df, ["c"]) == {"c": sorted(map(str, range(3000)))}


@pytest.mark.parametrize("rows_per_range", [3, 10**6])
def test_nan_is_the_largest_score_in_one_range_and_in_many(spark, rows_per_range):
    rows = [(i % 2, float(i)) for i in range(20)] + [(1, float("nan")), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    found = V.running_counts(df, "label", "score", rows_per_range).collect()
    place = {i: v for i, v in enumerate([float(i) for i in range(20)])} | {20: float("inf")}
    want = {}
    for r in found:
        score = float("inf") if r["score"] != r["score"] else r["score"]
        above = [(y, s) for y, s in rows if (float("inf") if s != s else s) >= score]
        want[score] = (sum(y for y, _ in above), sum(1 - y for y, _ in above))
        assert (r["tp"], r["fp"]) == want[score]
    assert len(found) == len(place)


def test_moments_of_wide_numbers(spark):
    values = [4_000_000_000 + i * 7_919 for i in range(200)]
    df = spark.createDataFrame([(i, v, v * 2 + i % 3) for i, v in enumerate(values)], "id long, a long, b long")
    want = df.agg(F.corr("a", "b"), F.mean("a"), F.stddev("a"), F.regr_slope("b", "a")).first()
    assert T.correlations(df, ["a", "b"]).first()["r"] == pytest.approx(want[0], abs=1e-9)
    described = {r["feature"]: r for r in T.describe(df, ["a", "b"]).collect()}
    assert (described["a"]["mean"], described["a"]["std"]) == pytest.approx((want[1], want[2]), rel=1e-9)
    assert T.linear_trend(df, "a", "b").first()["slope"] == pytest.approx(want[3], rel=1e-6)
    z = [r["a"] for r in T.standardize(df, ["a", "b"], ["id"]).collect()]
    assert sum(z) == pytest.approx(0, abs=1e-6) and sum(v * v for v in z) / len(z) == pytest.approx(1, abs=1e-6)


def test_encoder_ignores_unseen_levels(spark):
    train = first_encounters(spark, SF)
    encoder = X.fit_encoder(train)
    strange = train.limit(5).withColumn("race", F.lit("Martian"))
    race = [i for i, n in enumerate(encoder.names) if n.startswith("race_")]
    for row in encoder.transform(strange).collect():
        assert len(row["features"]) == len(encoder.names)
        assert all(row["features"][i] == 0.0 for i in race)


def test_median_fill(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0)], "id int, a double")
    assert [r["a"] for r in X.fill_medians(df, ["a"]).orderBy("id").collect()] == [1.0, 2.5, 4.0]


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_in_ranges(spark, p):
    rng = random.Random(2)
    values = [rng.choice([1.5, 2.5, rng.random() * 100]) for _ in range(2000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0)], "measure string, value double")
    counts = df.groupBy("measure", "value").agg(F.count("*").alias("n"))
    want = df.groupBy("measure").agg(F.percentile("value", p).alias("quantile"))
    for size in (50, 10**6):
        got = {r["measure"]: r["quantile"] for r in ranked_quantiles(counts, ["measure"], {"quantile": p}, size).collect()}
        assert got == pytest.approx({r["measure"]: r["quantile"] for r in want.collect()})


def test_statistics_of_columns_with_fractions(spark):
    rng = random.Random(4)
    rows = [(i % 2, rng.gauss(0, 1), rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    r = T.correlations(df, ["a", "b"]).first()["r"]
    assert r == pytest.approx(df.select(F.corr("a", "b").alias("r")).first()["r"], abs=1e-12)
    got = {r["feature"]: r for r in T.describe(df, ["a", "b"]).collect()}
    want = df.agg(F.mean("a"), F.stddev("a"), F.percentile("a", 0.25), F.max("a")).first()
    assert [got["a"][k] for k in ("mean", "std", "p25", "max")] == pytest.approx(list(want), abs=1e-12)
    box = {(r["g"], r["measure"]): r for r in T.boxplot_stats(df, "g", ["a", "b"]).collect()}
    assert box[(0, "a")]["median"] == pytest.approx(df.filter("g = 0").select(F.median("a")).first()[0])
    trend = T.linear_trend(df, "a", "b").first()
    want = df.select(F.regr_slope("b", "a"), F.regr_intercept("b", "a"), F.regr_r2("b", "a")).first()
    assert [trend["slope"], trend["intercept"], trend["r2"]] == pytest.approx(list(want), abs=1e-10)
    z = T.standardize(df, ["a"], ["g"]).agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s")).first()
    assert (z["m"], z["s"]) == pytest.approx((0, 1), abs=1e-9)


def test_constant_column_has_no_spread(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "id int, a int")
    assert [r["a"] for r in T.standardize(df, ["a"], ["id"]).collect()] == [None, None]


def test_histogram_of_equal_scores(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (1, 1), (1, 3)], "label int, s int")
    rows = T.score_histogram(df, "s", "label", bins=4).collect()
    zero = {r["bin"]: r["count"] for r in rows if r["label"] == 0}
    assert zero == {0: 0, 1: 0, 2: 2, 3: 0}
    one = {r["bin"]: r["count"] for r in rows if r["label"] == 1}
    assert one == {0: 1, 1: 0, 2: 0, 3: 1}


@pytest.mark.parametrize("name", ["segment_rates_all", "boxplot_stats", "calibration_table", "stratified_folds"])
def test_same_result_for_any_number_of_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(str(tuple(r)) for r in QUERIES[name](spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


# ---- exact sums ----


def _plain_correlation(a, b):
    from fractions import Fraction

    n = len(a)
    cross = lambda x, y: n * sum(p * q for p, q in zip(x, y)) - sum(x) * sum(y)
    return float(Fraction(cross(a, b))) / math.sqrt(cross(a, a)) / math.sqrt(cross(b, b))


WIDE = [4 * 10**18 + i * i % 97 for i in range(200)]
FAR = [(-1) ** i * (9 * 10**18 - i * 10**16) for i in range(200)]


def _wide(spark):
    rows = [(a, b, i, float(i)) for i, (a, b) in enumerate(zip(WIDE, FAR))]
    return spark.createDataFrame(rows, "a long, b long, i int, x double")


@pytest.mark.parametrize("left, right", [("a", "i"), ("b", "i"), ("a", "b")])
def test_correlations_of_wide_numbers(spark, left, right):
    values = {"a": WIDE, "b": FAR, "i": list(range(200))}
    got = T.correlations(_wide(spark), [left, right]).first()["r"]
    assert got == pytest.approx(_plain_correlation(values[left], values[right]), abs=1e-12)


def test_describe_of_wide_numbers(spark):
    import statistics

    got = {r["feature"]: r for r in T.describe(_wide(spark), ["a", "b"]).collect()}
    for name, values in (("a", WIDE), ("b", FAR)):
        r = got[name]
        assert r["count"] == 200 and r["min"] == float(min(values)) and r["max"] == float(max(values))
        assert r["mean"] == pytest.approx(float(sum(values) / 200), rel=1e-12)
        assert r["std"] == pytest.approx(float(statistics.stdev(values)), rel=1e-9)
        assert r["p50"] == pytest.approx(float(statistics.median(values)), rel=1e-15)


def test_trend_of_wide_numbers(spark):
    df = spark.createDataFrame([(4 * 10**18 + i, 4 * 10**18 + 3 * i + 1) for i in range(150)], "x long, y long")
    row = T.linear_trend(df, "x", "y").first()
    assert row["slope"] == 3.0 and row["r2"] == 1.0 and row["n"] == 150


def test_standardize_of_wide_numbers_and_nulls(spark):
    df = spark.createDataFrame([(i, 4 * 10**18 + 2 * i if i % 3 else None) for i in range(30)], "id long, v long")
    got = {r["id"]: r["v"] for r in T.standardize(df, ["v"], ["id"]).collect()}
    values = [2 * i for i in range(30) if i % 3]
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    for i in range(30):
        assert got[i] is None if i % 3 == 0 else got[i] == pytest.approx((2 * i - mean) / deviation, abs=1e-12)


def test_narrow_columns_take_the_narrow_path(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("a"), (F.col("id") * -2_000_000_000 / 9).cast("int").alias("b"))
    plan = T.correlations(df, ["a", "b"])._jdf.queryExecution().toString()
    assert "_hh" not in plan and T.correlations(df, ["a", "b"]).first()["r"] == pytest.approx(-1.0, abs=1e-9)
    assert T.Moments(df, ["a"], [("a", "a")]).kind == "narrow"


# ---- a table bucketed by patient ----


def _patients(spark):
    rows = [(1, 7, "a"), (1, 3, "b"), (1, 9, "c"), (2, 5, "d"), (None, 8, "e"), (None, 2, "f")] + [(3, 100 + i, "g") for i in range(50)]
    return spark.createDataFrame(rows, "patient_nbr long, encounter_id long, v string")


def test_bucketed_table_gives_the_same_rows_without_an_exchange_of_patients(spark):
    df = _patients(spark)
    table = bucketed_by_patient(df, buckets=4)
    for operator, plain in (
        (first_encounter_in_bucket, P.first_encounter), (P.multi_encounter_patients, P.multi_encounter_patients), (P.dedup_summary, P.dedup_summary),
    ):
        got = operator(table)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(patient_nbr" not in plan and "Bucketed: true" in plan
        key = lambda frame: sorted(str(tuple(r)) for r in frame.collect())
        assert key(got) == key(plain(df))


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    from wardstone.operators import patients

    monkeypatch.setattr(patients, "ROWS_PER_BUCKET", 5)
    name = "many_buckets"
    bucketed_by_patient(_patients(spark), name)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    assert int(described["Num Buckets"]) == 12


def _joins(df):
    """Join nodes of the plan as Spark would run it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Join " in line and "AdaptiveSparkPlan" not in line]


def test_tables_that_grow_are_not_sent_through_the_driver(spark):
    """However small Spark takes a stored table for."""
    stays = spark.createDataFrame([(1, 7, "a"), (1, 3, "b"), (2, 5, "d")], "patient_nbr long, encounter_id long, v string")
    joins = _joins(P.first_encounter(stays))
    assert joins and not [j for j in joins if "Broadcast" in j]

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    items = order_items(spark.read.parquet(f"{SF}/lineitem.parquet"))
    by_customer = [j for j in _joins(derive_encounters(orders, spark.read.parquet(f"{SF}/customer.parquet"), items)) if "o_custkey" in j]
    assert by_customer and not [j for j in by_customer if "Broadcast" in j]

    rows = spark.range(60).select("id", (F.col("id") < 12).cast("int").alias("label"), F.array((F.col("id") * 7 % 13).cast("double"), F.col("id").cast("double")).alias("x"))
    grown = smote_rows(rows.select("id", "label", array_to_vector("x").alias("features")), "features", "label", "id")
    by_vector = [j for j in _joins(grown) if "vid#" in j]
    assert len(by_vector) == 4 and not [j for j in by_vector if "Broadcast" in j]
