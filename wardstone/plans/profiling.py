"""Ingest, data-quality and patient-level queries."""

import uuid

from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.operators import profile as P
from wardstone.operators.patients import first_encounter_in_bucket
from wardstone.operators.scoring import score_encounters
from wardstone.operators.segments import segment_rate
from wardstone.plans.oracle import POS, count_if, over, rate, ratio, scored
from wardstone.plans.registry import query
from wardstone.session import scratch_path
from wardstone.sources import encounters as E
from wardstone.plans.tables import encounters, encounters_by_patient
from wardstone.sources.orders_fixture import raw_encounters

_ALL = ", ".join(S.ENCOUNTER_COLUMNS)
# ---- fixed values: names of the result columns ----
_KEY_COLUMNS = {
    "race": "missing_race", "weight": "missing_weight", "diag_1": "missing_diag1", "diag_2": "missing_diag2",
    "diag_3": "missing_diag3", "payer_code": "missing_payer",
}


@query("ingest_nulls", over(f"SELECT {_ALL} FROM encounters"))
def ingest_nulls(spark, sf):
    return encounters(spark, sf)


# ---- fixed values: the published file's column order and spelling, with two columns that are not used here ----
_FILE_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
    "number_diagnoses", "max_glu_serum", "A1Cresult", *S.MEDICATIONS[:16], "change", "diabetesMed", *S.MEDICATIONS[16:],
    "readmitted",
]


def _published(raw):
    """Raw rows as the published file holds them: no time stamp, hyphenated combination drugs, further columns."""
    extra = raw.withColumns({"change": F.lit("No"), "diabetesMed": F.lit("Yes")})
    return extra.select(*[F.col(c).alias(c.replace("_", "-") if c in S.MEDICATIONS else c) for c in _FILE_COLUMNS])


@query(
    "csv_scan",
    over(
        "SELECT "
        + ", ".join("CAST(NULL AS TIMESTAMP) AS encounter_ts" if c == "encounter_ts" else c for c in S.ENCOUNTER_COLUMNS)
        + " FROM encounters"
    ),
)
def csv_scan(spark, sf):
    """Raw rows written in the published layout, read back by column name."""
    path = scratch_path(spark, "encounters_csv")
    E.write_csv(_published(raw_encounters(spark, sf)), path)
    return E.read_encounters_csv(spark, path)


# column, what stands there instead (in both engines' SQL), and every how many encounters
_SPOILED = {
    "encounter_id": ("concat('E-', encounter_id)", 400), "patient_nbr": ("'unknown'", 350), "time_in_hospital": ("'abc'", 50),
    "number_inpatient": ("'1.5'", 70), "num_medications": ("'99999999999'", 90), "admission_type_id": ("'x1'", 110),
}


def _spoiled_file(spark, sf):
    path = scratch_path(spark, "spoiled_csv")
    spoiled = {c: F.when(F.col("encounter_id") % n == 7, F.expr(bad)).otherwise(F.col(c).cast("string")) for c, (bad, n) in _SPOILED.items()}
    E.write_csv(_published(raw_encounters(spark, sf)).withColumns(spoiled), path)
    return path


@query(
    "csv_rejects",
    over(
        " UNION ALL ".join(
            f"""SELECT CASE WHEN encounter_id % 400 = 7 THEN 'E-' || encounter_id ELSE CAST(encounter_id AS VARCHAR) END AS row_id,
            '{c}' AS column_name, {"'E-' || encounter_id" if c == "encounter_id" else bad} AS raw_value FROM encounters WHERE encounter_id % {n} = 7"""
            for c, (bad, n) in _SPOILED.items()
        )
    ),
)
def csv_rejects(spark, sf):
    """Values of a spoiled file that do not fit their columns, each with its row and raw text."""
    return E.read_encounters_checked(spark, _spoiled_file(spark, sf))[1]


@query(
    "csv_accepted",
    over(
        "SELECT encounter_id, patient_nbr, "
        + ", ".join(f"CASE WHEN encounter_id % {n} <> 7 THEN {c} END AS {c}" for c, (_, n) in _SPOILED.items() if not c.endswith(("id", "nbr")) or c == "admission_type_id")
        + ", readmitted FROM encounters WHERE encounter_id % 400 <> 7 AND encounter_id % 350 <> 7"
    ),
)
def csv_accepted(spark, sf):
    """The table of the same file: rows with sound ids, NULL where another value did not fit."""
    table = E.read_encounters_checked(spark, _spoiled_file(spark, sf))[0]
    return table.select("encounter_id", "patient_nbr", *[c for c in _SPOILED if c not in S.ID_COLUMNS], "readmitted")


@query("csv_sink", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def csv_sink(spark, sf):
    """The first encounters written as CSV and read back."""
    path = scratch_path(spark, "first_encounters_csv")
    E.write_csv(P.first_encounter(encounters(spark, sf)), path)
    return E.read_encounters_csv(spark, path)


@query(
    "sql_view",
    over(f"""SELECT medical_specialty, COUNT(*) AS total, CAST(AVG(time_in_hospital) AS DOUBLE) AS avg_los
    FROM encounters WHERE number_inpatient >= 1 GROUP BY medical_specialty"""),
)
def sql_view(spark, sf):
    E.register_view(encounters(spark, sf), "stays")
    return spark.sql(
        """SELECT medical_specialty, COUNT(*) AS total, AVG(time_in_hospital) AS avg_los
        FROM stays WHERE number_inpatient >= 1 GROUP BY medical_specialty"""
    )


@query("write_first_encounter", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def write_first_encounter(spark, sf):
    """Created once; a second call with other rows leaves the table as it is."""
    path = scratch_path(spark, "first_encounter")
    E.create_if_absent(P.first_encounter(encounters(spark, sf)), path)
    return E.create_if_absent(encounters(spark, sf), path)


@query("create_first_encounter_table", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def create_first_encounter_table(spark, sf):
    """A catalog table created once by name; a second creation with other rows gives the first one's."""
    name = f"first_encounter_{uuid.uuid4().hex}"
    E.create_table_if_absent(P.first_encounter(encounters(spark, sf)), name)
    return E.create_table_if_absent(encounters(spark, sf), name)


@query("write_over_unmarked_table", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def write_over_unmarked_table(spark, sf):
    """A table that another writer left without a success mark is not replaced."""
    path = scratch_path(spark, "unmarked")
    writer = P.first_encounter(encounters(spark, sf)).write
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return E.create_if_absent(encounters(spark, sf), path)


@query("binarise_target", over("SELECT encounter_id, readmitted, CAST(readmitted = '<30' AS INT) AS readmitted_30 FROM encounters"))
def binarise_target(spark, sf):
    label = (F.col("readmitted") == S.POSITIVE_OUTCOME).cast("int")
    return encounters(spark, sf).select("encounter_id", "readmitted", label.alias("readmitted_30"))


@query(
    "filtered_kpis",
    over(
        f"""SELECT tier, COUNT(*) AS total_encounters, {rate(POS, "COUNT(*)")} AS overall_rate_pct FROM scored
        WHERE age IN ('[60-70)', '[70-80)', '[80-90)') AND admission_type_id IN (1, 2) AND tier IN ('Moderate', 'High')
        AND discharge_disposition_id IN (1, 3, 6) AND encounter_ts >= TIMESTAMP '1993-01-01' AND encounter_ts < TIMESTAMP '1998-01-01'
        GROUP BY tier""",
        scored("encounters"),
    ),
)
def filtered_kpis(spark, sf):
    plain = E.filter_encounters(
        encounters(spark, sf),
        ages=["[60-70)", "[70-80)", "[80-90)"],
        admission_types=[1, 2],
        dispositions=[1, 3, 6],
        start="1993-01-01 00:00:00",
        end="1998-01-01 00:00:00",
    )
    chosen = E.filter_encounters(score_encounters(plain), tiers=["Moderate", "High"])
    return segment_rate(chosen, "tier", total="total_encounters", positives=None, rate="overall_rate_pct")


@query(
    "overview",
    over(f"""SELECT COUNT(*) AS total_encounters, COUNT(DISTINCT patient_nbr) AS distinct_patients,
    COUNT(DISTINCT encounter_id) AS distinct_encounters, {ratio("COUNT(*)", "COUNT(DISTINCT patient_nbr)")} AS avg_encounters_per_patient
    FROM encounters"""),
)
def overview(spark, sf):
    return P.overview(encounters(spark, sf))


@query(
    "missing_key_columns",
    over(
        "SELECT "
        + ", ".join(f"""{count_if(f"{c} = '?' OR {c} IS NULL")} AS {n}""" for c, n in _KEY_COLUMNS.items())
        + ", COUNT(*) AS total_rows FROM raw_encounters",
        source="raw_encounters",
    ),
)
def missing_key_columns(spark, sf):
    return P.missing_counts(raw_encounters(spark, sf), _KEY_COLUMNS)


@query(
    "missing_profile",
    over(
        f"""SELECT column_name, missing_count, {rate("missing_count", "n")} AS missing_pct FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {count_if(f'{c} IS NULL')} AS missing_count, COUNT(*) AS n FROM encounters"
            for c in S.ENCOUNTER_COLUMNS
        )
        + ") WHERE missing_count > 0"
    ),
)
def missing_profile(spark, sf):
    return P.missing_profile(encounters(spark, sf), S.ENCOUNTER_COLUMNS)


@query(
    "target_distribution",
    over(f"""SELECT readmitted, COUNT(*) AS encounter_count, {rate("COUNT(*)", "(SELECT COUNT(*) FROM encounters)")} AS pct_of_total
    FROM encounters GROUP BY readmitted"""),
)
def target_distribution(spark, sf):
    return P.target_distribution(encounters(spark, sf)).orderBy(F.desc("encounter_count"), "readmitted")


@query(
    "class_balance",
    over(f"""SELECT CASE WHEN readmitted = '<30' THEN 'Readmitted <30 days' ELSE 'Not readmitted <30 days' END AS readmission_class,
    COUNT(*) AS count, {rate("COUNT(*)", "(SELECT COUNT(*) FROM encounters)")} AS pct FROM encounters GROUP BY 1"""),
)
def class_balance(spark, sf):
    return P.class_balance(encounters(spark, sf))


@query(
    "top_diag1",
    over(f"""SELECT diag_1, COUNT(*) AS frequency, {rate(POS, "COUNT(*)")} AS readmission_rate_pct FROM encounters
    WHERE diag_1 IS NOT NULL GROUP BY diag_1 HAVING COUNT(*) > 500 ORDER BY frequency DESC, diag_1 LIMIT 20"""),
)
def top_diag1(spark, sf):
    return P.top_codes(encounters(spark, sf))


_MULTI = over("""SELECT patient_nbr, COUNT(*) AS encounter_count FROM encounters GROUP BY patient_nbr HAVING COUNT(*) > 1
    ORDER BY encounter_count DESC, patient_nbr LIMIT 20""")
_DEDUP = over(
    """SELECT CAST((SELECT COUNT(*) FROM encounters) AS BIGINT) AS total_rows, COUNT(*) AS deduplicated_rows,
    CAST((SELECT COUNT(*) FROM encounters) - COUNT(*) AS BIGINT) AS removed_rows FROM first_encounters""",
    source="first_encounters",
)


@query("multi_encounter_patients", _MULTI)
def multi_encounter_patients(spark, sf):
    return P.multi_encounter_patients(encounters(spark, sf))


@query("first_encounter", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def first_encounter(spark, sf):
    return P.first_encounter(encounters(spark, sf))


@query("dedup_summary", _DEDUP)
def dedup_summary(spark, sf):
    return P.dedup_summary(encounters(spark, sf))


@query("bucketed_multi_encounter_patients", _MULTI)
def bucketed_multi_encounter_patients(spark, sf):
    """From the table bucketed by patient: no exchange of patients."""
    return P.multi_encounter_patients(encounters_by_patient(spark, sf))


@query("bucketed_first_encounter", over(f"SELECT {_ALL} FROM first_encounters", source="first_encounters"))
def bucketed_first_encounter(spark, sf):
    return first_encounter_in_bucket(encounters_by_patient(spark, sf))


@query("bucketed_dedup_summary", _DEDUP)
def bucketed_dedup_summary(spark, sf):
    return P.dedup_summary(encounters_by_patient(spark, sf))
