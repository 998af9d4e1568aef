"""Training, cross-validation, scoring, and saving of risk models."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from math import isqrt

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.operators import boosting
from wardstone.operators import features as X
from wardstone.operators.evaluate import model_comparison, roc_auc
from wardstone.operators.smote import smote_balance
from wardstone.operators.splits import stratified_folds, stratified_split, with_class_weight
from wardstone.operators.trees import staged_margins
from wardstone.session import ensure_checkpoint_dir

LABEL = "readmitted_30"
ID = "encounter_id"
#: Training rows that one task holds at least, some 26 MB with 200 features. The parts follow from the number of rows alone.
ROWS_PER_PART = 16_384
#: Up to the square of this many parts of that size; beyond, the parts grow too.
PARTS_AT_ROOT = 3
#: Parts that a fit passes over, at most, up to ``ROWS_IN_DOZEN`` rows; twice as many for every eightfold of that.
DOZEN = 12
ROWS_IN_DOZEN = 2_000_000
#: Rows from which boosted trees are grown from blocks of codes; on fewer, starting Python at every level takes longer than Spark's learner.
ROWS_IN_BLOCKS = 400_000
#: Where a fit keeps rows that it reads a few times. They stream from there: a level with memory gets a whole part of rows back onto the
#: heap at once when it had moved to disk, and the learners hold their own copies in memory beside.
ROWS_KEPT = StorageLevel.DISK_ONLY
#: Training rows that folds or models fitted at the same time hold persisted.
ROWS_SIDE_BY_SIDE = 8_000_000


@dataclass(frozen=True)
class BoostingParams:
    """Tree-boosting settings. Leaf penalties of other libraries have no equal here."""

    trees: int = 300
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 5
    seed: int = 42
    rows_per_part: int | None = None


def score_column(df: DataFrame, alias: str = "score") -> DataFrame:
    """Probability of the positive class as a plain double."""
    return df.withColumn(alias, vector_to_array("probability")[1])


@dataclass(frozen=True)
class RiskModel:
    """A fitted encoder and classifier; scores any encounter table, batch or stream."""

    encoder: X.Encoder
    classifier: PipelineModel

    def transform(self, encounters: DataFrame) -> DataFrame:
        return score_column(self.classifier.transform(self.encoder.transform(encounters)))

    @property
    def names(self) -> list[str]:
        return self.encoder.names

    @property
    def trees(self) -> GBTClassificationModel:
        return self.classifier.stages[-1]


def encode(encoder: X.Encoder, df: DataFrame) -> DataFrame:
    return encoder.transform(df).select(ID, LABEL, "features")


def split(encounters: DataFrame, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stratified training and test rows of an encounter table."""
    labelled = encounters.withColumn(LABEL, (F.col("readmitted") == "<30").cast("int"))
    marked = stratified_split(labelled, LABEL, ID, test, seed)
    return marked.filter(~F.col("is_test")).drop("is_test", LABEL), marked.filter("is_test").drop("is_test", LABEL)


def balanced(train: DataFrame, how: str, seed: int) -> DataFrame:
    """Training rows after treating the class imbalance: ``smote``, ``weight`` or ``none``."""
    if how == "smote":
        return smote_balance(train, "features", LABEL, ID, seed=seed)
    if how == "weight":
        return with_class_weight(train, LABEL)
    return train


def rows_in_part(rows: int) -> int:
    """Rows of a part unless a caller says: ``ROWS_PER_PART``, and from nine parts on growing as the square root of the rows.

    The learners run hundreds of jobs over all parts, and the driver gets a report
    of every task and keeps those of the last thousand stages. With parts of one
    size the tasks would grow with the rows in each of these jobs.
    """
    return max(ROWS_PER_PART, isqrt(rows * ROWS_PER_PART) // PARTS_AT_ROOT)


def training_parts(rows: int, rows_per_part: int | None = None) -> int:
    """Parts that training rows are dealt into, by their number and not by the cluster's size."""
    return max(1, -(-rows // (rows_per_part or rows_in_part(rows))))


def fitting_parts(rows: int, rows_per_part: int | None = None) -> int:
    """Parts that a fit passes over: those of ``training_parts``, but in dozens at most unless a caller says.

    A pass of a learner over a part costs some tens of milliseconds and a report
    to the driver whatever its rows, hundreds of times in a fit. Dozens fill 4, 6 or
    12 cores evenly and double with every eightfold of the rows.
    """
    dozens, held = DOZEN, ROWS_IN_DOZEN
    while held < rows:
        dozens, held = 2 * dozens, 8 * held
    parts = training_parts(rows, rows_per_part)
    return parts if rows_per_part else min(parts, dozens)


#: Copies of one row that stay together.
COPIES_PER_PARCEL = 1024


def dealt(rows: DataFrame, rows_per_part: int | None = None) -> DataFrame:
    """The label, feature and weight columns, dealt and ordered by their content.

    Row sampling in the learner and the order in which it adds numbers up follow
    the parts, so the fitted model depends on the data only. Equal rows are
    counted first and dealt in parcels, so that a row with very many copies
    spreads over the parts.
    """
    parts = fitting_parts(rows.count(), rows_per_part)
    columns = [c for c in ("features", LABEL, "weight") if c in rows.columns]
    counted = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    last = F.floor((F.col("_n") - 1) / COPIES_PER_PARCEL).cast("long")
    parcels = counted.withColumn("_parcel", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    content = [vector_to_array("features"), *[F.col(c) for c in columns[1:]]]
    placed = parcels.withColumn("_place", F.xxhash64(*content, F.col("_parcel"))).repartition(parts, "_place").sortWithinPartitions("_place")
    copies = F.least(F.lit(COPIES_PER_PARCEL).cast("long"), F.col("_n") - F.col("_parcel") * COPIES_PER_PARCEL)
    return placed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*columns)


def _weight(balance: str) -> dict[str, str]:
    return {"weightCol": "weight"} if balance == "weight" else {}


def _all_numeric(rows: DataFrame) -> bool:
    return not set(rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})) - {"numeric"}


def fit_boosting(train: DataFrame, params: BoostingParams = BoostingParams(), balance: str = "smote") -> PipelineModel:
    """Gradient-boosted trees on (label, features) rows; large tables of numeric features as blocks of codes, see ``boosting``."""
    ensure_checkpoint_dir(train.sparkSession)  # long chains of trees are cut by the learner's own checkpoints
    learner = GBTClassifier(
        labelCol=LABEL, featuresCol="features", maxIter=params.trees, maxDepth=params.depth, stepSize=params.step,
        subsamplingRate=params.row_share, featureSubsetStrategy=str(params.column_share),
        minInstancesPerNode=params.min_rows, seed=params.seed, checkpointInterval=10, maxMemoryInMB=512,
        **_weight(balance),
    )
    rows = dealt(balanced(train, balance, params.seed), params.rows_per_part).persist(ROWS_KEPT)
    try:
        large = rows.count() >= ROWS_IN_BLOCKS and _all_numeric(rows)
        return PipelineModel([boosting.fit(rows, learner) if large else learner.fit(rows)])
    finally:
        rows.unpersist()


def fit_logistic(
    train: DataFrame, max_iter: int = 1000, balance: str = "smote", seed: int = 42, rows_per_part: int | None = None
) -> PipelineModel:
    """Logistic regression on standardised features, with a unit ridge penalty on the summed loss."""
    rows = dealt(balanced(train, balance, seed), rows_per_part).persist(ROWS_KEPT)
    try:
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(rows)
        learner = LogisticRegression(
            labelCol=LABEL, featuresCol="scaled", maxIter=max_iter, regParam=1.0 / max(rows.count(), 1),
            standardization=False, **_weight(balance),
        )
        return PipelineModel([scaler, learner.fit(scaler.transform(rows))])
    finally:
        rows.unpersist()


def train_boosting(
    train: DataFrame, spec: X.FeatureSpec = X.CLINICAL, params: BoostingParams = BoostingParams(), balance: str = "smote"
) -> RiskModel:
    encoder = X.fit_encoder(train, spec)
    return RiskModel(encoder, fit_boosting(encode(encoder, train), params, balance))


def train_logistic(
    train: DataFrame, spec: X.FeatureSpec = X.CLINICAL, max_iter: int = 1000, balance: str = "smote"
) -> RiskModel:
    encoder = X.fit_encoder(train, spec)
    return RiskModel(encoder, fit_logistic(encode(encoder, train), max_iter, balance))


def fits_at_once(held: int, fits: int) -> int:
    """Fits to run at a time when each holds so many training rows persisted."""
    return max(1, min(fits, ROWS_SIDE_BY_SIDE // max(held, 1)))


def folds_at_once(rows: int, folds: int, side_by_side: int, balance: str) -> int:
    """Folds to fit at a time, by the training rows that each holds; synthetic rows at most double them."""
    held = rows * (folds - 1) // folds * (2 if balance == "smote" else 1)
    return fits_at_once(held, min(side_by_side, folds))


def logistic_cv(
    train: DataFrame, folds: int = 5, seed: int = 42, max_iter: int = 1000, balance: str = "smote", side_by_side: int = 5
) -> DataFrame:
    """AUC per fold, with resampling or class weights made inside each fold, so that no training row sees its test fold.

    Folds are the ones of ``stratified_folds``. Up to ``side_by_side`` folds are
    fitted at a time, each by jobs of its own, so that the short steps of one fold
    fill the cores that another leaves idle; each holds its training rows
    persisted meanwhile, so large folds are fitted fewer at a time.
    """
    spark = train.sparkSession
    marked = stratified_folds(train, LABEL, ID, folds, seed).persist(ROWS_KEPT)
    at_once = folds_at_once(marked.count(), folds, side_by_side, balance)

    def one(fold: int) -> tuple[int, float]:
        model = fit_logistic(marked.filter(F.col("fold") != fold), max_iter, balance, seed)
        held_out = score_column(model.transform(marked.filter(F.col("fold") == fold)))
        return fold, roc_auc(held_out, LABEL, "score").first()["auc"]

    try:
        with ThreadPoolExecutor(at_once) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(one), range(folds)))
    finally:
        marked.unpersist()
    per_fold = spark.createDataFrame(results, "fold int, auc double")
    return per_fold.select(
        "fold", "auc",
        F.expr("avg(auc) OVER ()").alias("mean_auc"), F.expr("stddev_pop(auc) OVER ()").alias("std_auc"),
    )


def logistic_terms(classifier: PipelineModel) -> tuple[list[float], float]:
    """Weights on the features as they are, and the intercept, of a fitted logistic regression."""
    scaler, fitted = classifier.stages
    scale = [0.0 if s == 0 else 1.0 / s for s in scaler.std.toArray().tolist()]
    weights = [w * s for w, s in zip(fitted.coefficients.toArray().tolist(), scale)]
    return weights, float(fitted.intercept) - sum(w * m for w, m in zip(weights, scaler.mean.toArray().tolist()))


def logistic_probability(classifier: PipelineModel, features: str = "features") -> Column:
    """The positive class's probability from the stored weights, as a plain expression."""
    weights, intercept = logistic_terms(classifier)
    terms = F.zip_with(vector_to_array(features), F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
    margin = F.aggregate(terms, F.lit(intercept), lambda total, t: total + t)
    return 1.0 / (1.0 + F.exp(-margin))


def logistic_gradient(model: RiskModel, rows: DataFrame) -> DataFrame:
    """First-order conditions of a fitted logistic regression on its training rows: (term, gradient).

    The gradient of the summed loss plus the unit ridge penalty, by the scaled
    features and the unpenalised intercept (an empty term), divided by the number
    of rows. It is zero at the optimum. One pass adds up p·x and y·x per feature.
    """
    scaler, fitted = model.classifier.stages
    scored = scaler.transform(rows).select("scaled", F.col(LABEL).cast("double").alias("y"), logistic_probability(model.classifier).alias("p"))
    sums = scored.agg(
        Summarizer.sum(F.col("scaled"), F.col("p")).alias("px"), Summarizer.sum(F.col("scaled"), F.col("y")).alias("yx"),
        F.sum("p").alias("p"), F.sum("y").alias("y"), F.count("*").alias("n"),
    ).first()
    by_feature = (sums["px"].toArray() - sums["yx"].toArray() + fitted.coefficients.toArray()) / sums["n"]
    terms = [*zip(model.names, by_feature.tolist()), ("", (sums["p"] - sums["y"]) / sums["n"])]
    return rows.sparkSession.createDataFrame(terms, "term string, gradient double")


def feature_importance(model: RiskModel, spark: SparkSession, top: int = 15) -> DataFrame:
    """Gain-based importance per feature, largest first."""
    values = model.trees.featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(model.names, values)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def boosting_curve(model: RiskModel, held_out: DataFrame, every: int = 50) -> DataFrame:
    """AUC on held-out rows after every ``every`` trees, and after the last one, from one pass over the rows."""
    staged = staged_margins(model.trees, encode(model.encoder, held_out), [LABEL], every)
    return model_comparison(staged, "trees", LABEL, "margin", threshold=0.0).select("trees", "auc")


def save_model(model: RiskModel, spark: SparkSession, path: str) -> None:
    """Encoder, classifier and slot names under one folder."""
    model.encoder.model.write().overwrite().save(f"{path}/encoder")
    model.classifier.write().overwrite().save(f"{path}/classifier")
    about = json.dumps({"names": model.names, "lab_p75": model.encoder.lab_p75, "spec": model.encoder.spec.name})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> RiskModel:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    spec = {s.name: s for s in (X.CLINICAL, X.ORDINAL)}[about["spec"]]
    encoder = X.Encoder(PipelineModel.load(f"{path}/encoder"), about["names"], about["lab_p75"], replace(spec))
    return RiskModel(encoder, PipelineModel.load(f"{path}/classifier"))
