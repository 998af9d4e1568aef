"""Edge rows of the row-wise expressions."""

import pytest
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.functions.rates import rate_pct, ratio_2dp
from wardstone.operators import scoring as R
from wardstone.sources import encounters as E


def column(spark, values, type_name, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r["out"] for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_icd9_as_written(spark):
    codes = ["250", "250.83", "459.8", "785", "V57", "E885", "abc", None, "?", "428", "786", "574", "820", "715", "599", "174", "295"]
    expected = [
        "Diabetes", "Other", "Other", "Circulatory", "Supplementary", "External cause", "Other", "Unknown", "Unknown",
        "Circulatory", "Respiratory", "Digestive", "Injury", "Musculoskeletal", "Genitourinary", "Neoplasm", "Mental",
    ]
    assert column(spark, codes, "string", C.icd9_category) == expected


def test_icd9_floored(spark):
    got = column(spark, ["250.83", "459.8", "785.4", "abc"], "string", lambda c: C.icd9_category(c, floor=True))
    assert got == ["Diabetes", "Circulatory", "Circulatory", "Other"]


def test_age_midpoints(spark):
    ages = [f"[{a}-{a + 10})" for a in range(0, 100, 10)] + [None, "old"]
    assert column(spark, ages, "string", C.age_midpoint) == [*range(5, 105, 10), None, None]
    assert column(spark, ages, "string", lambda c: C.age_midpoint(c, 65))[-2:] == [65, 65]


def test_utilization_bands(spark):
    got = column(spark, [0, 1, 2, 3, 4, 6, 7, 100, 101, -1, None], "int", C.utilization_band)
    low, med, high, very = (name for _, name in C.UTILIZATION_BANDS)
    assert got == [low, low, med, med, high, high, very, very, None, None, None]


def test_risk_tiers(spark):
    got = column(spark, [0.1499, 0.15, 0.2499, 0.25, None], "double", C.risk_tier)
    assert got == ["Low", "Moderate", "Moderate", "High", None]


def test_discharge_groups_and_labels(spark):
    ids = [7, 1, 8, 3, 14, 6, 10, 11, None]
    groups = ["High risk (AMA)", "Moderate (home)", "Moderate (home)", "Lower (SNF/rehab)", "Lower (SNF/rehab)",
              "Lower (home health)", "Lower (home health)", "Other", "Other"]
    assert column(spark, ids, "int", C.discharge_risk_group) == groups
    assert column(spark, [1, 14, 18, None], "int", C.disposition_label) == ["Home", "Hospice (facility)", "Other", "Other"]


def test_comorbidity(spark):
    df = spark.createDataFrame([("250", None, "?"), ("1", "2", "3"), (None, None, None)], "a string, b string, c string")
    counts = df.select(C.comorbidity_count(F.col("a"), F.col("b"), F.col("c")).alias("n")).collect()
    assert [r["n"] for r in counts] == [1, 3, 0]


def test_rounding_is_half_up_and_safe(spark):
    df = spark.createDataFrame([(1, 8), (201, 20000), (0, 0), (5, 0), (3, 3)], "p long, n long")
    rows = df.select(rate_pct(F.col("p"), F.col("n")).alias("r"), ratio_2dp(F.col("p"), F.col("n")).alias("q")).collect()
    assert [r["r"] for r in rows] == [12.5, 1.01, None, None, 100.0]
    assert [r["q"] for r in rows] == [0.13, 0.01, None, None, 1.0]


def test_medication_counts(spark):
    statuses = {m: "No" for m in S.MEDICATIONS} | {"insulin": "Up", "metformin": "Steady", "glipizide": None}
    df = spark.createDataFrame([tuple(statuses.values())], ", ".join(f"{m} string" for m in statuses))
    row = df.select(
        C.medications_with_status(S.CHANGED_STATUSES, S.MEDICATIONS).alias("changed"),
        C.medications_with_status(S.ACTIVE_STATUSES, S.MEDICATIONS).alias("active"),
        C.medication_ordinal(F.col("insulin")).alias("up"), C.medication_ordinal(F.col("glipizide")).alias("none"),
    ).first()
    assert tuple(row) == (1, 2, 2, 0)


def test_scorecard_clamps(spark):
    columns = ["number_inpatient", "number_emergency", "number_outpatient", "number_diagnoses", "time_in_hospital", "insulin", "A1Cresult"]
    df = spark.createDataFrame([(20, 20, 40, 9, 14, "No", "None"), (0, 0, 0, 0, 0, "Up", ">8")], columns)
    rows = R.score_encounters(df).collect()
    assert [(r["score"], r["tier"]) for r in rows] == [(0.95, "High"), (0.11, "Low")]
    gap = R.score_encounters(df.withColumn("number_inpatient", F.lit(None).cast("int"))).first()
    assert (gap["score"], gap["tier"]) == (None, None)


def test_hyphenated_medications_are_renamed(spark):
    df = spark.createDataFrame([("?", "Up")], ["race", "glyburide-metformin"])
    row = E.normalize(df).first()
    assert row.asDict() == {"race": None, "glyburide_metformin": "Up"}


def test_none_text_survives_the_csv_scan(spark, tmp_path):
    line = {c: "1" for c in S.ENCOUNTER_COLUMNS} | {"encounter_ts": "2020-01-01T00:00:00", "race": "?", "A1Cresult": "None", "diag_1": "250.83"}
    names = [c.replace("glyburide_metformin", "glyburide-metformin") for c in S.ENCOUNTER_COLUMNS]
    (tmp_path / "e.csv").write_text(",".join(names) + "\n" + ",".join(line[c] for c in S.ENCOUNTER_COLUMNS) + "\n")
    row = E.read_encounters_csv(spark, str(tmp_path / "e.csv")).first()
    assert (row["race"], row["A1Cresult"], row["diag_1"], row["encounter_id"]) == (None, "None", "250.83", 1)


def test_csv_columns_bind_by_name(spark, tmp_path):
    """Shuffled, further and missing columns; a value that does not fit is NULL."""
    (tmp_path / "e.csv").write_text(
        "readmitted,change,glyburide-metformin,number_inpatient,race,patient_nbr,encounter_id,age\n"
        "<30,Ch,Up,428,?,11,7,[60-70)\nNO,No,No,many,Asian,12,8,?\n"
    )
    rows = E.read_encounters_csv(spark, str(tmp_path / "e.csv")).orderBy("encounter_id").collect()
    assert rows[0].__fields__ == S.ENCOUNTER_COLUMNS
    picked = [(r["encounter_id"], r["patient_nbr"], r["race"], r["age"], r["number_inpatient"], r["readmitted"]) for r in rows]
    assert picked == [(7, 11, None, "[60-70)", 428, "<30"), (8, 12, "Asian", None, None, "NO")]
    assert [r["glyburide_metformin"] for r in rows] == ["Up", "No"] and rows[0]["encounter_ts"] is None


def test_csv_without_a_key_column_is_refused(spark, tmp_path):
    (tmp_path / "e.csv").write_text("encounter_id,readmitted\n1,NO\n")
    with pytest.raises(ValueError, match="patient_nbr"):
        E.read_encounters_csv(spark, str(tmp_path / "e.csv"))


@pytest.mark.parametrize("name", ["race_Asian", "a b", "[0-10)"])
def test_safe_names(name):
    from wardstone.operators.features import safe_name

    assert all(ch.isalnum() or ch == "_" for ch in safe_name(name))
