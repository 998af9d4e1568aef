"""Feature engineering: row-wise features, one-hot levels, fills and the model matrix."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.operators.segments import long_segments
from wardstone.operators.stats import quantile, quantiles

FLAG_FEATURES = [
    "insulin_changed", "high_lab_burden", "admitted_from_er", "emergency_admission",
    "a1c_abnormal", "a1c_tested",
]
COUNT_FEATURES = ["age_numeric", "prior_utilization_score", "comorbidity_count", "medication_changes", "num_active_meds"]


@dataclass(frozen=True)
class FeatureSpec:
    """An allow-list: which columns enter the model matrix, and how gaps are filled."""

    name: str
    numeric: list[str]
    categorical: list[str]
    fill: str  # "median" or "zero"
    ordinal_medications: bool = False
    age_default: int | None = None
    icd_floor: bool = False
    excluded: list[str] = field(default_factory=lambda: [*S.ID_COLUMNS, "weight", "payer_code", "readmitted"])


CLINICAL = FeatureSpec(
    name="clinical",
    numeric=[*S.CODED_DIMENSIONS, *S.MEASURES, *COUNT_FEATURES, *FLAG_FEATURES],
    categorical=[
        "race", "gender", "age", "medical_specialty", "diag1_category", "discharge_risk_group",
        "max_glu_serum", "A1Cresult",
    ],
    fill="median",
)
ORDINAL = FeatureSpec(
    name="ordinal",
    numeric=[
        *S.MEASURES, *S.MEDICATIONS,
        *[c for c in COUNT_FEATURES if c != "comorbidity_count"], *FLAG_FEATURES,
    ],
    categorical=["race", "gender", "age", "medical_specialty", "max_glu_serum", "A1Cresult", *S.CODED_DIMENSIONS],
    fill="zero",
    ordinal_medications=True,
    age_default=65,
)


def lab_cut(df: DataFrame, probability: float = 0.75) -> DataFrame:
    return quantile(df, "num_lab_procedures", probability, "lab_p75")


def build_features(df: DataFrame, spec: FeatureSpec = CLINICAL, lab_p75: float | Column | None = None) -> DataFrame:
    """Adds every engineered column.

    ``lab_p75`` is the lab-burden cut. Left out, it is taken from ``df``; a
    scoring job passes the value learned in training instead.
    """
    if lab_p75 is None:
        cut = lab_cut(df).scalar()
    else:
        cut = lab_p75 if isinstance(lab_p75, Column) else F.lit(float(lab_p75))
    added = {
        "readmitted_30": C.readmitted_30(),
        "age_numeric": C.age_midpoint(F.col("age"), spec.age_default),
        "prior_utilization_score": C.prior_utilization(
            F.col("number_inpatient"), F.col("number_emergency"), F.col("number_outpatient")
        ),
        "comorbidity_count": C.comorbidity_count(F.col("diag_1"), F.col("diag_2"), F.col("diag_3")),
        "medication_changes": C.medications_with_status(S.CHANGED_STATUSES, S.MEDICATIONS),
        "insulin_changed": C.flag(F.col("insulin").isin(S.CHANGED_STATUSES)),
        "num_active_meds": C.medications_with_status(S.ACTIVE_STATUSES, S.MEDICATIONS),
        "diag1_category": C.icd9_category(F.col("diag_1"), spec.icd_floor),
        "discharge_risk_group": C.discharge_risk_group(F.col("discharge_disposition_id")),
        "high_lab_burden": C.flag(F.col("num_lab_procedures") > cut),
        "admitted_from_er": C.flag(F.col("admission_source_id") == 7),
        "emergency_admission": C.flag(F.col("admission_type_id") == 1),
        "discharge_to_snf": C.flag(F.col("discharge_disposition_id") == 3),
        "a1c_abnormal": C.flag(F.col("A1Cresult").isin(">7", ">8")),
        "a1c_tested": C.flag(F.col("A1Cresult") != "None"),
    }
    built = df.withColumns(added)
    if spec.ordinal_medications:
        built = built.withColumns({m: C.medication_ordinal(F.col(m)) for m in S.MEDICATIONS})
    return built


def drop_if_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def safe_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", text)


def as_category(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(S.UNKNOWN))


def category_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels of each categorical column, from one pass.

    The level lists become columns of the model matrix, so they come to the
    driver; their number is that of the matrix's columns.
    """
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in level_rows(df, columns).collect():
        levels[row["dimension"]].append(row["segment"])
    return {c: sorted(v) for c, v in levels.items()}


def level_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, segment) of every level that occurs, missing values as their own level."""
    filled = df.select(*[as_category(F.col(c)).alias(c) for c in columns])
    return long_segments(filled, columns, []).distinct()


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def level_columns(levels: dict[str, list[str]], sanitize: bool = False) -> dict[str, str]:
    """Name and SQL condition of the 0/1 column of every level but the first."""
    out = {}
    for column, values in levels.items():
        for value in values[1:]:
            name = f"{column}_{value}"
            out[safe_name(name) if sanitize else name] = (
                f"coalesce(cast(`{column}` as string), '{S.UNKNOWN}') = {_quoted(value)}"
            )
    return out


def one_hot(df: DataFrame, levels: dict[str, list[str]], sanitize: bool = False) -> DataFrame:
    """0/1 column per level but the first; an unseen level is 0 everywhere."""
    kept = [f"`{c}`" for c in df.columns if c not in levels]
    added = [f"cast({test} as int) AS `{name}`" for name, test in level_columns(levels, sanitize).items()]
    return df.selectExpr(*kept, *added)


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs replaced by the column's exact median over ``df``; only columns that have NULLs are ranked."""
    filled = df.agg(F.count("*").alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in columns]).first()
    gaps = [c for c in columns if filled[c] < filled["_rows"]]
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    values = {c: f"cast(`{c}` as double)" for c in columns}
    if gaps:
        long = quantiles(df, gaps, 0.5)
        medians = long.agg(F.map_from_entries(F.collect_list(F.struct("measure", "quantile"))).alias("m"))
        values |= {c: f"coalesce(cast(`{c}` as double), _medians['{c}'])" for c in gaps}
        df = df.withColumn("_medians", medians.scalar())
    return df.selectExpr(*kept, *[f"{value} AS `{c}`" for c, value in values.items()])


def model_ready(
    df: DataFrame, spec: FeatureSpec, levels: dict[str, list[str]], keep: list[str], lab_p75: float | Column | None = None
) -> DataFrame:
    """Wide matrix: kept ids and label, numeric columns with gaps filled, 0/1 level columns."""
    built = build_features(df, spec, lab_p75).select(*keep, *spec.numeric, *[
        F.col(c) for c in spec.categorical if c not in spec.numeric
    ])
    if spec.fill == "median":
        built = fill_medians(built, spec.numeric)
    else:
        built = built.fillna(0, spec.numeric)
    return one_hot(built, levels, sanitize=spec.name == ORDINAL.name)


@dataclass(frozen=True)
class Encoder:
    """A fitted, savable encoding of encounters into ``features``, and the names of its slots."""

    model: PipelineModel
    names: list[str]
    lab_p75: float
    spec: FeatureSpec

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(build_features(df, self.spec, self.lab_p75))


def fit_encoder(train: DataFrame, spec: FeatureSpec = CLINICAL) -> Encoder:
    """Learns levels, fills and the lab cut from the training rows only.

    The encoding is plain SQL expressions plus a vector assembler, so it saves
    with the model and works unchanged on a stream. A level not seen in
    training gets zeros in all of its column's slots.
    """
    cut = lab_cut(train).first()["lab_p75"]
    cut = 0.0 if cut is None else float(cut)
    built = build_features(train, spec, cut)
    levels = category_levels(built, spec.categorical)
    if spec.fill == "median":
        fills = {r["measure"]: r["quantile"] for r in quantiles(built, spec.numeric, 0.5).collect()}
    else:
        fills = {}
    names: list[str] = []
    parts: list[str] = []
    for column in spec.numeric:
        names.append(column)
        parts.append(f"coalesce(cast(`{column}` as double), {float(fills.get(column, 0.0))!r}D)")
    for name, test in level_columns(levels, sanitize=True).items():
        names.append(name)
        parts.append(f"cast({test} as double)")
    slots = [f"f__{i}" for i in range(len(parts))]
    listed = ", ".join(f"{part} AS {slot}" for part, slot in zip(parts, slots))
    encode = SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")
    assemble = VectorAssembler(inputCols=slots, outputCol="features")
    tidy = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(slots)}) FROM __THIS__")
    return Encoder(PipelineModel([encode, assemble, tidy]), names, cut, spec)
