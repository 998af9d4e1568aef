"""Training, model-based scoring and tree explanation queries, and the scoring stream.

The rows of the training set, the balanced set and the fitted models are made
once per application and table folder, as a training job would leave them for
scoring jobs. A fitted model's numbers have no SQL form; the queries named
*_checks state what must hold for them row by row, and those have oracles.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.operators import evaluate as V
from wardstone.operators import explain as A
from wardstone.operators import models as M
from wardstone.operators import trees as T
from wardstone.operators.features import build_features, fit_encoder
from wardstone.operators.ranges import shuffled
from wardstone.operators.scoring import score_encounters, scorecard_inputs, scorecard as add_scorecard
from wardstone.operators.smote import smote_balance as balance_by_smote
from wardstone.operators.smote import smote_rows as smote_rows_of
from wardstone.operators.splits import stratified_folds, stratified_split
from wardstone.operators.stats import score_histogram
from wardstone.plans.oracle import features, over, scored, seeded_hash
from wardstone.plans.registry import query
from wardstone.plans.tables import encounters, first_encounters, stored
from wardstone.session import scratch_path
from wardstone.sources.encounters import write_csv
from wardstone.sources.orders_fixture import encounter_stream, line_counts, order_table
from wardstone.streaming.scoring import SCORED_COLUMNS, score_stream

PARAMS = M.BoostingParams()
_FITTED: dict[tuple[str, str, str], object] = {}
Fitted = TypeVar("Fitted")


def _once(spark, sf, name: str, fit: Callable[[], Fitted]) -> Fitted:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _train(spark, sf):
    return stored(spark, sf, "train", lambda: M.split(first_encounters(spark, sf))[0])


def _test(spark, sf):
    return stored(spark, sf, "test", lambda: M.split(first_encounters(spark, sf))[1])


def _encoder(spark, sf):
    return _once(spark, sf, "encoder", lambda: fit_encoder(_train(spark, sf)))


def _encoded(spark, sf):
    return stored(spark, sf, "train_encoded", lambda: M.encode(_encoder(spark, sf), _train(spark, sf)))


def _balanced(spark, sf):
    return stored(
        spark, sf, "train_balanced",
        lambda: balance_by_smote(_encoded(spark, sf), "features", M.LABEL, M.ID),
    )


def _boosted(spark, sf) -> M.RiskModel:
    def fit():
        return M.RiskModel(_encoder(spark, sf), M.fit_boosting(_balanced(spark, sf), PARAMS, balance="none"))

    return _once(spark, sf, "boosted", fit)


def _logistic(spark, sf) -> M.RiskModel:
    def fit():
        return M.RiskModel(_encoder(spark, sf), M.fit_logistic(_balanced(spark, sf), balance="none"))

    return _once(spark, sf, "logistic", fit)


def _fitted(spark, sf) -> list[M.RiskModel]:
    """The boosted trees and the logistic regression, fitted side by side unless together they hold too many training rows.

    Both make hundreds of short passes, so one's work fills the cores that the other leaves idle.
    """
    at_once = M.fits_at_once(_balanced(spark, sf).count(), 2)
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda fit: fit(spark, sf)), (_boosted, _logistic)))


def _predictions(df):
    return df.select(M.ID, M.LABEL, "score", (F.col("score") >= 0.5).cast("int").alias("predicted_class"))


@query(
    "smote_balance",
    over(
        """SELECT readmitted_30, FALSE AS synthetic, COUNT(*) AS rows FROM train GROUP BY 1
        UNION ALL SELECT 1, TRUE, CAST(SUM(CASE WHEN readmitted_30 = 0 THEN 1 ELSE -1 END) AS BIGINT) FROM train""",
        f"""train AS (SELECT readmitted_30 FROM (SELECT CAST(readmitted = '<30' AS INT) AS readmitted_30,
          ROW_NUMBER() OVER (PARTITION BY readmitted = '<30' ORDER BY {seeded_hash("encounter_id", 42)}, encounter_id) AS rn,
          COUNT(*) OVER (PARTITION BY readmitted = '<30') AS n FROM first_encounters)
        WHERE rn > FLOOR(n * 0.2::DOUBLE + 0.5))""",
        source="first_encounters",
    ),
)
def smote_balance(spark, sf):
    return _balanced(spark, sf).groupBy(M.LABEL, "synthetic").agg(F.count("*").alias("rows"))


#: Whole numbers of an encounter that the synthetic rows of the checkable query have.
_MEASURES = [
    "age_numeric", "prior_utilization_score", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses", "comorbidity_count", "medication_changes",
    "num_active_meds", "high_lab_burden", "admitted_from_er", "a1c_abnormal",
]


def _draw_sql(copy: str, seed: int) -> str:
    return seeded_hash(f"({seeded_hash('v.vid', seed)} + {copy})", seed + 1)


_GROWN = f"""marked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY readmitted_30 ORDER BY {seeded_hash("encounter_id", 42)}, encounter_id) AS rn,
  COUNT(*) OVER (PARTITION BY readmitted_30) AS n FROM features),
train AS (SELECT *, COUNT(*) OVER (PARTITION BY readmitted_30) AS many, COUNT(*) OVER () AS rows,
  ROW_NUMBER() OVER (PARTITION BY readmitted_30 ORDER BY {seeded_hash("encounter_id", 42)}, encounter_id) AS place
  FROM marked WHERE rn > FLOOR(n * 0.2::DOUBLE + 0.5)),
owing AS (SELECT encounter_id, [{", ".join(f"CAST({c} AS DOUBLE)" for c in _MEASURES)}] AS x,
  (rows - 2 * many) // many + CASE WHEN place <= (rows - 2 * many) % many THEN 1 ELSE 0 END AS owed FROM train WHERE 2 * many < rows),
vectors AS MATERIALIZED (SELECT MIN(encounter_id) AS vid, x, COUNT(*) AS copies, CAST(SUM(owed) AS BIGINT) AS owed FROM owing GROUP BY x),
ranked AS (SELECT a.vid, b.vid AS nvid, b.copies, b.x, GREATEST(6 - a.copies, 0) AS wanted,
  ROW_NUMBER() OVER (PARTITION BY a.vid ORDER BY d2, b.vid) AS r FROM (
    SELECT a.vid, a.copies, b.vid AS nvid, list_dot_product(a.x, a.x) + list_dot_product(b.x, b.x) - 2 * list_dot_product(a.x, b.x) AS d2
    FROM vectors a JOIN vectors b ON a.vid <> b.vid) a JOIN vectors b ON b.vid = a.nvid),
reached AS (SELECT *, CAST(SUM(LEAST(copies, 5)) OVER (PARTITION BY vid ORDER BY r) AS BIGINT) AS upto FROM ranked WHERE r <= 5),
near AS MATERIALIZED (SELECT vid, nvid, x, upto - LEAST(copies, 5) AS low, LEAST(upto, wanted) AS high FROM reached WHERE upto - LEAST(copies, 5) < wanted),
ways AS (SELECT vid, MAX(high) AS ways FROM near GROUP BY vid),
copied AS (SELECT v.vid, v.x, LEAST(v.copies - 1, 5) AS own, COALESCE(ways, 0) AS ways, UNNEST(range(v.owed)) AS copy FROM vectors v LEFT JOIN ways USING (vid)),
drawn AS (SELECT vid, x, copy, {_draw_sql("copy", 42)} % GREATEST(own + ways, 1) - own AS pick,
  CAST({_draw_sql("copy", 44)} % 1048576 AS DOUBLE) / 1048576.0::DOUBLE AS step FROM copied v),
grown AS (SELECT d.vid AS parent, d.copy, COALESCE(n.nvid, d.vid) AS neighbour, d.step, d.x, COALESCE(n.x, d.x) AS nx
  FROM drawn d LEFT JOIN near n ON n.vid = d.vid AND d.pick >= n.low AND d.pick < n.high)"""


@query(
    "smote_rows",
    over(
        "SELECT parent, copy, neighbour, step, "
        + ", ".join(f"x[{i + 1}] + step * (nx[{i + 1}] - x[{i + 1}]) AS {c}" for i, c in enumerate(_MEASURES))
        + " FROM grown",
        features("first_encounters"), _GROWN, source="first_encounters",
    ),
)
def smote_rows(spark, sf):
    """Every synthetic training row over the whole-number measures, with its parent, neighbour and step."""
    rows = build_features(first_encounters(spark, sf))
    marked = stratified_split(rows.select(M.ID, M.LABEL, *_MEASURES), M.LABEL, M.ID, 0.2, 42).filter("not is_test")
    train = marked.select(M.ID, M.LABEL, array_to_vector(F.array(*[F.col(c).cast("double") for c in _MEASURES])).alias("features"))
    grown = smote_rows_of(train, "features", M.LABEL, M.ID)
    return grown.select("parent", "copy", "neighbour", "step", *[F.col("x")[i].alias(c) for i, c in enumerate(_MEASURES)])


@query("lr_scores")
def lr_scores(spark, sf):
    return _predictions(_logistic(spark, sf).transform(_test(spark, sf)))


@query("lr_cv_auc")
def lr_cv_auc(spark, sf):
    return M.logistic_cv(_encoded(spark, sf))


@query("cv_weighted_auc")
def cv_weighted_auc(spark, sf):
    """Five folds with class weights in place of synthetic rows, fitted side by side."""
    return _weighted_folds(spark, sf)


def _weighted_folds(spark, sf):
    return stored(spark, sf, "weighted_folds", lambda: M.logistic_cv(_encoded(spark, sf), balance="weight"))


@query("gbt_scores")
def gbt_scores(spark, sf):
    return _predictions(_boosted(spark, sf).transform(_test(spark, sf)))


@query("feature_importance")
def feature_importance(spark, sf):
    return M.feature_importance(_boosted(spark, sf), spark)


@query("boosting_curve")
def boosting_curve(spark, sf):
    return M.boosting_curve(_boosted(spark, sf), _test(spark, sf))


@query("model_round_trip")
def model_round_trip(spark, sf):
    """The boosted model saved and loaded again, scoring the test rows."""
    path = scratch_path(spark, "model")
    M.save_model(_boosted(spark, sf), spark, path)
    return _predictions(M.load_model(spark, path).transform(_test(spark, sf)))


def _compared(spark, sf):
    """(model, label, score) of the test rows by every model, each scored once."""
    test, (boosted, logistic) = _test(spark, sf), _fitted(spark, sf)
    card = add_scorecard(scorecard_inputs(test)).withColumn(M.LABEL, (F.col("readmitted") == "<30").cast("int"))
    scored = {
        "naive": card.withColumn("score", F.lit(0.0)),
        "scorecard": card,
        "logistic regression": logistic.transform(test),
        "boosted trees": boosted.transform(test),
    }
    parts = [df.select(F.lit(name).alias("model"), M.ID, M.LABEL, F.col("score").cast("double").alias("score")) for name, df in scored.items()]
    return stored(spark, sf, "compared", lambda: reduce(DataFrame.unionByName, parts))


@query("model_comparison")
def model_comparison(spark, sf):
    return V.model_comparison(_compared(spark, sf), "model", M.LABEL, "score")


def _explained(spark, sf):
    def explain():
        model = _boosted(spark, sf)
        return T.tree_attributions(model.trees, model.transform(_test(spark, sf)), M.ID)

    return stored(spark, sf, "explained", explain)


def _long(spark, sf):
    return T.attribution_rows(_explained(spark, sf), _boosted(spark, sf).names, M.ID)


@query("tree_attributions")
def tree_attributions(spark, sf):
    """Base value plus contributions, next to the margin they must add up to."""
    total = F.aggregate("phi", F.col("base_value"), lambda a, v: a + v)
    return _explained(spark, sf).select(M.ID, "base_value", total.alias("explained_margin"), "margin")


@query("attribution_long")
def attribution_long(spark, sf):
    return A.top_feature_rows(_long(spark, sf), top=15)


@query("mean_abs_attribution")
def mean_abs_attribution(spark, sf):
    return A.mean_abs_attribution(_long(spark, sf), top=15)


@query("tree_patient_breakdown")
def tree_patient_breakdown(spark, sf):
    entries = T.attribution_entries(_boosted(spark, sf).names)
    return A.patient_breakdown(_explained(spark, sf), M.ID, entries, F.col("base_value"), max_display=12)


_SPLIT = f"""split AS (SELECT encounter_id, readmitted_30, rn <= FLOOR(n * 0.2::DOUBLE + 0.5) AS is_test FROM (
  SELECT encounter_id, CAST(readmitted = '<30' AS INT) AS readmitted_30,
    ROW_NUMBER() OVER (PARTITION BY readmitted = '<30' ORDER BY {seeded_hash("encounter_id", 42)}, encounter_id) AS rn,
    COUNT(*) OVER (PARTITION BY readmitted = '<30') AS n FROM first_encounters)),
test AS (SELECT encounter_id, readmitted_30 FROM split WHERE is_test)"""


def _checks(body: str) -> str:
    return over(body, _SPLIT, source="first_encounters")


@query(
    "score_checks",
    _checks(
        """SELECT model, encounter_id, readmitted_30, TRUE AS in_range FROM test,
        (VALUES ('naive'), ('scorecard'), ('logistic regression'), ('boosted trees')) v(model)"""
    ),
)
def score_checks(spark, sf):
    """Every model scores every test row once, within 0 and 1."""
    return _compared(spark, sf).select("model", M.ID, M.LABEL, F.col("score").between(0, 1).alias("in_range"))


@query("round_trip_checks", _checks("SELECT encounter_id, readmitted_30, TRUE AS same_score FROM test"))
def round_trip_checks(spark, sf):
    """The loaded model gives each test row the score that the model gave it before it was saved."""
    direct = _compared(spark, sf).where("model = 'boosted trees'").select(M.ID, F.col("score").alias("direct"))
    loaded = model_round_trip(spark, sf).join(shuffled(direct), M.ID, "left")
    return loaded.select(M.ID, M.LABEL, F.col("score").eqNullSafe(F.col("direct")).alias("same_score"))


@query("attribution_checks", _checks("SELECT encounter_id, TRUE AS adds_up FROM test"))
def attribution_checks(spark, sf):
    """Each test row's contributions and the base value add up to its margin."""
    adds_up = F.abs(F.col("explained_margin") - F.col("margin")) < 1e-9 * F.greatest(F.lit(1.0), F.abs("margin"))
    return tree_attributions(spark, sf).select(M.ID, adds_up.alias("adds_up"))


@query(
    "quality_checks",
    _checks(
        """SELECT check_name, TRUE AS holds FROM (VALUES ('importances are shares'), ('folds have an area between 0 and 1'),
        ('naive area is one half'), ('boosted trees rank better than chance'), ('logistic regression ranks better than chance'),
        ('curve ends at the last tree')) v(check_name)"""
    ),
)
def quality_checks(spark, sf):
    """What must hold for the fitted models as a whole."""
    areas, model = model_comparison(spark, sf), _boosted(spark, sf)
    importance = M.feature_importance(model, spark, top=len(model.names)).agg(
        (F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)
    )
    folds = lr_cv_auc(spark, sf).agg((F.count_if(F.col("auc").between(0, 1)) == 5) & (F.count("*") == 5))
    curve = boosting_curve(spark, sf).agg((F.max("trees") == PARAMS.trees) & (F.count("*") == PARAMS.trees // 50))

    def area(name, test):
        return areas.where(F.col("model") == name).select(test(F.col("auc")))

    found = {
        "importances are shares": importance,
        "folds have an area between 0 and 1": folds,
        "naive area is one half": area("naive", lambda a: a == 0.5),
        "boosted trees rank better than chance": area("boosted trees", lambda a: a > 0.5),
        "logistic regression ranks better than chance": area("logistic regression", lambda a: a > 0.5),
        "curve ends at the last tree": curve,
    }
    return reduce(DataFrame.union, [df.toDF("holds").select(F.lit(n).alias("check_name"), "holds") for n, df in found.items()])


@query(
    "model_histogram_checks",
    _checks("SELECT readmitted_30, CAST(COUNT(*) AS BIGINT) AS rows, CAST(50 AS BIGINT) AS bins FROM test GROUP BY readmitted_30"),
)
def model_histogram_checks(spark, sf):
    """The model's score histogram holds each class's test rows in fifty bins."""
    return model_score_histogram(spark, sf).groupBy(M.LABEL).agg(F.sum("count").alias("rows"), F.count("*").alias("bins"))


@query(
    "cv_fold_checks",
    _checks(
        f"""SELECT CAST((rank - 1) % 5 AS INT) AS fold, COUNT(*) AS rows, CAST(SUM(readmitted_30) AS BIGINT) AS positives, TRUE AS ranks_better_than_chance,
        TRUE AS mean_of_folds FROM (SELECT readmitted_30, ROW_NUMBER() OVER (PARTITION BY readmitted_30 ORDER BY {seeded_hash("encounter_id", 42)}, encounter_id) AS rank
        FROM split WHERE NOT is_test) GROUP BY 1"""
    ),
)
def cv_fold_checks(spark, sf):
    """The weighted cross-validation's folds, with the rows that they hold out, and what must hold for their areas."""
    held_out = stratified_folds(_encoded(spark, sf), M.LABEL, M.ID).groupBy("fold").agg(F.count("*").alias("rows"), F.sum(M.LABEL).alias("positives"))
    areas = _weighted_folds(spark, sf)
    mean = areas.agg((F.sum("auc") / 5).alias("mean")).scalar()
    valid = areas.select("fold", F.col("auc").between(0.5, 1).alias("ranks_better_than_chance"), (F.abs(F.col("mean_auc") - mean) < 1e-12).alias("mean_of_folds"))
    return held_out.join(valid, "fold", "left")


_RECOMPUTED = [
    "importances from the stored nodes", "curve ends at the area of the scores", "areas from pairs of ranks", "classes of the comparison counted",
    "thresholds counted", "bins counted", "summary rows are the explained ones",
]


@query(
    "recomputed_checks",
    _checks("SELECT check_name, TRUE AS holds FROM (VALUES " + ", ".join(f"('{n}')" for n in _RECOMPUTED) + ") v(check_name)"),
)
def recomputed_checks(spark, sf):
    """Tables about the fitted models, each worked out again another way from the stored rows and trees."""
    scores, model, every = _boosted_scores(spark, sf), _boosted(spark, sf), 1e-9
    path = scratch_path(spark, "stored_trees")
    model.trees.write().save(path)
    gains = spark.read.parquet(f"{path}/data").select("nodeData.*").where("leftChild >= 0").groupBy(F.col("split.featureIndex").alias("at")).agg(F.sum(F.col("gain") * F.col("rawCount")).alias("g"))
    shares = gains.crossJoin(gains.agg(F.sum("g").alias("all"))).select("at", (F.col("g") / F.col("all")).alias("share"))
    names = spark.createDataFrame(list(enumerate(model.names)), "at int, feature string")
    importance = M.feature_importance(model, spark, top=len(model.names)).join(names, "feature").join(shares, "at", "left")

    # the area as the share of pairs in order, from ranks that ties share
    ranked = _compared(spark, sf).groupBy("model", "score").agg(F.sum(F.col(M.LABEL)).alias("pos"), F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("model").orderBy("score"))
    places = ranked.withColumn("rank", upto - (F.col("n") - 1) / 2)
    area = places.groupBy("model").agg(F.sum("pos").alias("p"), F.sum("n").alias("n"), F.sum(F.col("rank") * F.col("pos")).alias("ranks")).select(
        "model", ((F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * (F.col("n") - F.col("p")))).alias("area"), "p")
    flagged = _compared(spark, sf).where("score >= 0.5").groupBy("model").agg(F.count("*").alias("flagged"), F.sum(M.LABEL).alias("hits"))
    compared = model_comparison(spark, sf).join(area, "model").join(flagged, "model", "left").fillna(0, ["flagged", "hits"])
    curve = boosting_curve(spark, sf).where(F.col("trees") == PARAMS.trees).crossJoin(area.where("model = 'boosted trees'"))

    sweep = model_threshold_sweep(spark, sf)
    counted = scores.join(F.broadcast(sweep.select("threshold").distinct()), F.col("score") >= F.col("threshold")).groupBy("threshold").agg(  # seven rows
        F.count("*").alias("n"), F.sum(M.LABEL).alias("t"))
    sweep = sweep.join(counted, "threshold", "left").fillna(0, ["n", "t"])
    bounds = scores.groupBy(M.LABEL).agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    place = F.least(F.floor((F.col("score") - F.col("lo")) * 50 / (F.col("hi") - F.col("lo"))), F.lit(49)).cast("int")
    bins = scores.join(bounds, M.LABEL).groupBy(M.LABEL, place.alias("bin")).agg(F.count("*").alias("again"))
    histogram = model_score_histogram(spark, sf).join(bins, [M.LABEL, "bin"], "left").fillna(0, ["again"])

    long = _long(spark, sf)
    best = long.groupBy("feature").agg((F.sum(F.abs("attribution")) / F.count("*")).alias("size")).orderBy(F.desc("size"), "feature").limit(15)
    total = lambda rows: rows.agg(F.count("*").alias("n"), F.sum("attribution").alias("s"), F.sum("value").alias("v"))
    summary = total(attribution_long(spark, sf)).crossJoin(total(long.join(best, "feature", "left_semi")).toDF("n2", "s2", "v2"))

    def near(a, b):
        return F.abs(F.col(a) - F.coalesce(F.col(b), F.lit(0.0))) < every

    held = [
        importance.agg(F.every(near("importance", "share")) & (F.count("*") == len(model.names))),
        curve.agg(F.every(near("auc", "area")) & (F.count("*") == 1)),
        compared.agg(F.every(near("auc", "area")) & (F.count("*") == 4)),
        compared.agg(F.every(F.abs(F.coalesce("recall", F.lit(0.0)) * F.col("p") - F.col("hits")) < 1e-6) & F.every(F.abs(F.coalesce("precision", F.lit(0.0)) * F.col("flagged") - F.col("hits")) < 1e-6)),
        sweep.agg(F.every((F.col("flagged") == F.col("n")) & (F.col("true_positives") == F.col("t")))),
        histogram.agg(F.every(F.col("count") == F.col("again"))),
        summary.agg(F.every((F.col("n") == F.col("n2")) & (F.abs(F.col("s") - F.col("s2")) < 1e-6) & (F.abs(F.col("v") - F.col("v2")) < 1e-6))),
    ]
    rows = [df.toDF("holds").select(F.lit(n).alias("check_name"), "holds") for n, df in zip(_RECOMPUTED, held)]
    return reduce(DataFrame.union, rows)


#: What a component of the gradient per training row may differ from zero by; the learner stops far below.
OPTIMAL = 1e-5


@query(
    "lr_optimality",
    _checks(
        """SELECT part, TRUE AS optimal, CAST((SELECT 2 * GREATEST(COUNT(*) FILTER (readmitted_30 = 0), COUNT(*) FILTER (readmitted_30 = 1))
        FROM split WHERE NOT is_test) AS BIGINT) AS rows FROM (VALUES ('intercept'), ('features')) v(part)"""
    ),
)
def lr_optimality(spark, sf):
    """The logistic regression is at the least penalised loss over its training rows: every gradient component is zero."""
    rows = _balanced(spark, sf)
    found = M.logistic_gradient(_logistic(spark, sf), rows)
    part = F.when(F.col("term") == "", "intercept").otherwise("features")
    held = found.groupBy(part.alias("part")).agg((F.max(F.abs("gradient")) < OPTIMAL).alias("optimal"))
    return held.crossJoin(rows.agg(F.count("*").alias("rows")))


@query(
    "model_score_checks",
    _checks("SELECT encounter_id, readmitted_30, TRUE AS logistic_matches, TRUE AS boosted_matches, TRUE AS class_matches FROM test"),
)
def model_score_checks(spark, sf):
    """Each test row's score, computed again from the stored weights and from the stored trees' last margin."""
    test, (boosted, logistic) = _test(spark, sf), _fitted(spark, sf)
    staged = T.staged_margins(boosted.trees, M.encode(boosted.encoder, test), [M.ID, M.LABEL], PARAMS.trees).where(F.col("trees") == PARAMS.trees)
    margins = staged.select(M.ID, M.LABEL, (1.0 / (1.0 + F.exp(-2.0 * F.col("margin")))).alias("from_trees"))
    weights = M.encode(logistic.encoder, test).select(M.ID, M.logistic_probability(logistic.classifier).alias("from_weights"))
    scores = _compared(spark, sf).where("model IN ('boosted trees', 'logistic regression')")
    by_model = scores.groupBy(M.ID).agg(*[F.max(F.when(F.col("model") == m, F.col("score"))).alias(c) for c, m in (("b", "boosted trees"), ("l", "logistic regression"))])
    exported = gbt_scores(spark, sf).select(M.ID, "predicted_class")
    near = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) < 1e-9, F.lit(False))
    joined = reduce(lambda rows, other: rows.join(shuffled(other), M.ID, "left"), [weights, by_model, exported], margins)
    same_class = F.coalesce((F.col("b") >= 0.5).cast("int") == F.col("predicted_class"), F.lit(False))
    return joined.select(M.ID, M.LABEL, near("l", "from_weights").alias("logistic_matches"), near("b", "from_trees").alias("boosted_matches"), same_class.alias("class_matches"))


def _boosted_scores(spark, sf):
    return _compared(spark, sf).where("model = 'boosted trees'")


@query("model_score_histogram")
def model_score_histogram(spark, sf):
    return score_histogram(_boosted_scores(spark, sf), "score", M.LABEL)


@query("model_threshold_sweep")
def model_threshold_sweep(spark, sf):
    return V.threshold_sweep(_boosted_scores(spark, sf), M.LABEL, "score", [0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5])


@query("model_export_predictions")
def model_export_predictions(spark, sf):
    """The model's predictions written as CSV for the dashboard, then read back."""
    path = scratch_path(spark, "model_predictions")
    exported = _predictions(_boosted_scores(spark, sf))
    write_csv(exported, path)
    return spark.read.schema(exported.schema).option("header", True).csv(path)


@query("tree_dependence")
def tree_dependence(spark, sf):
    """Prior inpatient stays against their contribution to the model's margin, with the number of diagnoses beside."""
    names = _boosted(spark, sf).names
    at, other = names.index("number_inpatient"), names.index("number_diagnoses")
    wide = _explained(spark, sf).select(
        M.ID, F.col("x")[at].alias("number_inpatient"), F.col("x")[other].alias("number_diagnoses"), F.col("phi")[at].alias("phi_number_inpatient")
    )
    return A.dependence_table(wide, M.ID, "number_inpatient", "number_diagnoses")


_SCORED = ", ".join(SCORED_COLUMNS)


@query("stream_scores", over(f"SELECT {_SCORED} FROM scored", scored("encounters")))
def stream_scores(spark, sf):
    """Orders arrive as a stream of files, become encounters, and are scored into a parquet sink."""
    sink = scratch_path(spark, "stream_sink")
    items = stored(spark, sf, "line_counts", lambda: line_counts(spark, sf))
    job = score_stream(encounter_stream(spark, sf, items), sink, scratch_path(spark, "stream_checkpoint"))
    job.awaitTermination()
    return spark.read.parquet(sink)


class _NotFailed(RuntimeError):
    pass


def _recovered(spark, sf, score, columns):
    """The sink of a stream that fails on a batch and is started again.

    Half of the order files arrive and are scored. The other half arrives, and a
    row among them makes its batch fail; the job ends. Started again from the
    checkpoint with the fault mended, it finishes the rest.
    """
    arrived, sink, checkpoint = (scratch_path(spark, f"recovery_{n}") for n in ("orders", "sink", "checkpoint"))
    orders = order_table(spark, sf)
    items = stored(spark, sf, "line_counts", lambda: line_counts(spark, sf))

    def arrive(half):
        orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == half).repartition(4).write.mode("append").parquet(arrived)

    def run(scoring):
        stream = encounter_stream(spark, sf, items, files_per_batch=1, arrivals=arrived)
        score_stream(stream, sink, checkpoint, scoring, columns).awaitTermination()

    def faulty(encounters):
        late = F.pmod(F.xxhash64(F.col("encounter_id") - 1), F.lit(2)) == 1
        fault = F.when(late & (F.col("encounter_id") % 5 == 2), F.raise_error(F.lit("a faulty row")).cast("long")).otherwise(F.col("encounter_id"))
        return score(encounters).withColumn("encounter_id", fault)

    arrive(0)
    run(score)
    arrive(1)
    try:
        run(faulty)
    except StreamingQueryException:
        run(score)
    else:
        raise _NotFailed("the faulty row did not stop the stream")
    return spark.read.parquet(sink)


@query("stream_recovery", over(f"SELECT {_SCORED} FROM scored", scored("encounters")))
def stream_recovery(spark, sf):
    """Each row once in the sink, though a batch failed and the job was started again."""
    return _recovered(spark, sf, score_encounters, SCORED_COLUMNS)


@query("stream_model_recovery", over("SELECT encounter_id, TRUE AS same_score FROM encounters"))
def stream_model_recovery(spark, sf):
    """The trained model applied as patients leave, over a failure and a restart; scores equal the batch's."""
    model = _boosted(spark, sf)
    streamed = _recovered(spark, sf, model.transform, [M.ID, "score"])
    batch = model.transform(encounters(spark, sf)).select(M.ID, F.col("score").alias("batch"))
    return streamed.join(shuffled(batch), M.ID, "left").select(M.ID, F.col("score").eqNullSafe(F.col("batch")).alias("same_score"))
