"""Encounter table derived from an order star schema.

One order is one encounter. All values come from integer arithmetic on the
order key, so they do not depend on partitioning and can be restated in any
SQL engine. The orders side may be a stream; the other two tables are static.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone import schema as S
from wardstone.operators.ranges import shuffled
from wardstone.sources.encounters import normalize

# ---- fixed values: cut points on a per-mille draw, then the value for the rest ----
_DISPOSITIONS = ([(590, 1), (730, 3), (860, 6), (890, 2), (910, 7), (927, 11), (935, 13),
                  (943, 14), (965, 22), (975, 25), (990, 5)], 18)
_SOURCES = ([(565, 7), (855, 1), (925, 17)], 4)
_SPECIALTIES = ([(490, "?"), (640, "InternalMedicine"), (800, "Emergency/Trauma")], "Cardiology")
_DIAG_1 = ([(70, "250.83"), (90, "250"), (300, "428"), (330, "459.8"), (400, "786"), (480, "486"),
            (560, "574"), (630, "820"), (700, "715"), (760, "599"), (810, "174"), (850, "295"),
            (890, "V57"), (910, "E885"), (990, "276")], "?")
_DIAG_2 = ([(30, "?"), (500, "250")], "401")
_DIAG_3 = ([(60, "?"), (500, "272")], "V45")
_GLUCOSE = ([(947, "None"), (973, "Norm"), (988, ">200")], ">300")
_A1C = ([(833, "None"), (882, "Norm"), (920, ">7")], ">8")
_RACES = {"AUTOMOBILE": "Caucasian", "BUILDING": "AfricanAmerican", "FURNITURE": "Hispanic", "HOUSEHOLD": "Asian"}
_RARE_DRUG = (985, 995, 998)
_COMMON_DRUGS = {
    "metformin": (800, 980, 990),
    "glipizide": (875, 980, 990),
    "glyburide": (895, 980, 990),
    "pioglitazone": (930, 990, 995),
    "rosiglitazone": (940, 990, 995),
    "insulin": (470, 770, 880),
}


def _draw(multiplier: int) -> str:
    """Name of the column that holds a per-mille draw from the order key."""
    return f"draw_{multiplier}"


def _with_draws(base: DataFrame, used: list[str]) -> DataFrame:
    """Adds every draw that the expressions name, once each."""
    drawn = sorted(set(re.findall(r"\bdraw_(\d+)\b", " ".join(used))), key=int)
    return base.selectExpr("*", *[f"(o_orderkey * {m} + 12345) % 1000003 % 1000 AS draw_{m}" for m in drawn])


def _literal(value: int | str) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _choose(draw: str, cuts: list[tuple], rest: int | str) -> str:
    """First value whose bound lies above the draw."""
    arms = " ".join(f"WHEN {draw} < {bound} THEN {_literal(value)}" for bound, value in cuts)
    return f"CASE {arms} ELSE {_literal(rest)} END"


def _medication(name: str) -> str:
    draw = _draw(3571 + 104 * S.MEDICATIONS.index(name))
    cuts = zip(_COMMON_DRUGS.get(name, _RARE_DRUG), S.MEDICATION_STATUSES)
    return _choose(draw, list(cuts), S.MEDICATION_STATUSES[-1])


#: Lines that one task counts.
LINES_PER_PART = 250_000


def order_items(lineitem: DataFrame) -> DataFrame:
    """Per-order line counts. Unused ones are pruned by Catalyst.

    Lines are dealt by order into parts that follow their number, so a task's
    memory does not grow with the table; the counts and the distinct parts of an
    order then need no exchange of their own.
    """
    parts = max(1, -(-lineitem.count() // LINES_PER_PART))
    return lineitem.repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(
        F.count("*").alias("n_items"),
        F.sum("l_quantity").cast("long").alias("qty"),
        F.count_distinct("l_partkey").alias("n_parts"),
    )


def derive_encounters(orders: DataFrame, customer: DataFrame, items: DataFrame) -> DataFrame:
    """Raw encounters from orders, customers and per-order line counts; missing values spelled with the token."""
    customers = customer.select("c_custkey", "c_mktsegment")
    base = (
        orders.join(customers if orders.isStreaming else shuffled(customers), F.col("o_custkey") == F.col("c_custkey"))
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .fillna(0, ["n_items", "qty", "n_parts"])
    )
    prior, outpatient, emergency, outcome = (_draw(m) for m in (7919, 5557, 3301, 104729))
    inpatient = f"CASE WHEN {prior} < 660 THEN 0 WHEN {prior} < 850 THEN 1 WHEN {prior} < 930 THEN 2 ELSE {prior} % 4 + 3 END"
    decade = "(o_custkey * 31 % 97 % 10 * 10)"
    races = " ".join(f"WHEN c_mktsegment = '{segment}' THEN '{race}'" for segment, race in _RACES.items())
    columns = {
        "encounter_id": "o_orderkey + 1",
        "patient_nbr": "o_custkey * 10 + o_orderkey % 10",
        "encounter_ts": "o_orderdate",
        "race": f"CASE WHEN o_custkey % 50 = 0 THEN '?' {races} ELSE 'Other' END",
        "gender": f"CASE WHEN o_custkey % 499 = 7 THEN '{S.INVALID_GENDER}' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
        "age": f"concat('[', {decade}, '-', {decade} + 10, ')')",
        "weight": _choose(_draw(611), [(970, "?")], "[75-100)"),
        "admission_type_id": "substring(o_orderpriority, 1, 1)",
        "discharge_disposition_id": _choose(_draw(2741), *_DISPOSITIONS),
        "admission_source_id": _choose(_draw(4447), *_SOURCES),
        "time_in_hospital": f"{_draw(6133)} % 14 + 1",
        "payer_code": _choose(_draw(887), [(400, "?")], "MC"),
        "medical_specialty": _choose(_draw(1429), *_SPECIALTIES),
        "num_lab_procedures": "qty % 132 + 1",
        "num_procedures": "n_items % 7",
        "num_medications": f"(n_parts * 5 + {_draw(9001)} % 11) % 81 + 1",
        "number_outpatient": f"CASE WHEN {outpatient} < 835 THEN 0 ELSE {outpatient} % 12 END",
        "number_emergency": f"CASE WHEN {emergency} < 890 THEN 0 ELSE {emergency} % 8 END",
        "number_inpatient": "prior_stays",
        "diag_1": _choose(_draw(8081), *_DIAG_1),
        "diag_2": _choose(_draw(8087), *_DIAG_2),
        "diag_3": _choose(_draw(8093), *_DIAG_3),
        "number_diagnoses": "least(n_items + 2, 9)",
        "max_glu_serum": _choose(_draw(1033), *_GLUCOSE),
        "A1Cresult": _choose(_draw(1039), *_A1C),
        **{name: _medication(name) for name in S.MEDICATIONS},
        "readmitted": f"CASE WHEN {outcome} < 85 + 50 * least(prior_stays, 3) THEN '<30' WHEN {outcome} < 450 THEN '>30' ELSE 'NO' END",
    }
    types = {field.name: field.dataType.simpleString() for field in S.ENCOUNTER_SCHEMA}
    drawn = _with_draws(base, [*columns.values(), inpatient]).selectExpr("*", f"{inpatient} AS prior_stays")
    return drawn.selectExpr(*[f"CAST({columns[c]} AS {types[c]}) AS {c}" for c in S.ENCOUNTER_COLUMNS])


# declared, so that building a query reads no file footers
_TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_mktsegment STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def raw_encounters(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, lineitem = (_table(spark, folder, n) for n in ("orders", "customer", "lineitem"))
    return derive_encounters(orders, customer, order_items(lineitem))


def line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Per-order line counts of the whole line table."""
    return order_items(_table(spark, folder, "lineitem"))


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    return normalize(raw_encounters(spark, folder))


def encounter_stream(
    spark: SparkSession, folder: str, items: DataFrame | None = None, files_per_batch: int = 64, arrivals: str | None = None
) -> DataFrame:
    """The same table with new orders arriving as a stream of files.

    ``items`` are stored line counts; without them every batch counts the lines
    again. A backlog is read ``files_per_batch`` files at a time. ``arrivals`` is
    a folder that order files arrive in; by default the table's own file is the stream.
    A file is read by one task or few, so its narrow orders are dealt to all cores
    before they become encounters.
    """
    source = spark.readStream.schema(_TABLE_SCHEMAS["orders"]).option("maxFilesPerTrigger", files_per_batch)
    orders = source.parquet(arrivals) if arrivals else source.option("pathGlobFilter", "orders*.parquet").parquet(folder)
    orders = orders.repartition(spark.sparkContext.defaultParallelism)
    return normalize(derive_encounters(orders, _table(spark, folder, "customer"), items or line_counts(spark, folder)))


def order_table(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as the stream reads them."""
    return _table(spark, folder, "orders")
