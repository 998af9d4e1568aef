"""Common table expressions that restate the data set in plain SQL.

Oracle statements start with these and then spell out one query each. They are
written against the base tables only and share no code with the Spark side.
"""

from __future__ import annotations

import re

from wardstone.schema import ENCOUNTER_COLUMNS, ENCOUNTER_SCHEMA, MEDICATIONS


def _draws(sql: str) -> str:
    """``u(A)`` stands for the per-mille draw with multiplier A."""
    return re.sub(r"\bu\((\d+)\)", r"((o_orderkey * \1 + 12345) % 1000003 % 1000)", sql)


def _medication(index: int, name: str) -> str:
    u = f"u({3571 + 104 * index})"
    cuts = {
        "metformin": (800, 980, 990), "glipizide": (875, 980, 990), "glyburide": (895, 980, 990),
        "pioglitazone": (930, 990, 995), "rosiglitazone": (940, 990, 995), "insulin": (470, 770, 880),
    }.get(name, (985, 995, 998))
    a, b, c = cuts
    return f"CASE WHEN {u} < {a} THEN 'No' WHEN {u} < {b} THEN 'Steady' WHEN {u} < {c} THEN 'Up' ELSE 'Down' END AS {name}"


_MEDICATION_SQL = ",\n  ".join(_medication(i, m) for i, m in enumerate(MEDICATIONS))

ENCOUNTERS = _draws(
    f"""items AS (
  SELECT l_orderkey, COUNT(*) AS n_items, CAST(SUM(l_quantity) AS BIGINT) AS qty, COUNT(DISTINCT l_partkey) AS n_parts
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.*, c.c_mktsegment, COALESCE(i.n_items,0) AS n_items, COALESCE(i.qty,0) AS qty, COALESCE(i.n_parts,0) AS n_parts,
    CASE WHEN u(7919) < 660 THEN 0 WHEN u(7919) < 850 THEN 1 WHEN u(7919) < 930 THEN 2 ELSE 3 + u(7919) % 4 END AS ninp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN items i ON o.o_orderkey = i.l_orderkey),
raw_encounters AS (
SELECT o_orderkey + 1 AS encounter_id, o_custkey * 10 + o_orderkey % 10 AS patient_nbr, o_orderdate AS encounter_ts,
  CASE WHEN o_custkey % 50 = 0 THEN '?' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Caucasian' WHEN c_mktsegment = 'BUILDING' THEN 'AfricanAmerican' WHEN c_mktsegment = 'FURNITURE' THEN 'Hispanic' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Asian' ELSE 'Other' END AS race,
  CASE WHEN o_custkey % 499 = 7 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  '[' || CAST(10 * (o_custkey * 31 % 97 % 10) AS VARCHAR) || '-' || CAST(10 * (o_custkey * 31 % 97 % 10) + 10 AS VARCHAR) || ')' AS age,
  CASE WHEN u(611) < 970 THEN '?' ELSE '[75-100)' END AS weight,
  CAST(SUBSTR(o_orderpriority,1,1) AS INT) AS admission_type_id,
  CASE WHEN u(2741) < 590 THEN 1 WHEN u(2741) < 730 THEN 3 WHEN u(2741) < 860 THEN 6 WHEN u(2741) < 890 THEN 2 WHEN u(2741) < 910 THEN 7 WHEN u(2741) < 927 THEN 11 WHEN u(2741) < 935 THEN 13 WHEN u(2741) < 943 THEN 14 WHEN u(2741) < 965 THEN 22 WHEN u(2741) < 975 THEN 25 WHEN u(2741) < 990 THEN 5 ELSE 18 END AS discharge_disposition_id,
  CASE WHEN u(4447) < 565 THEN 7 WHEN u(4447) < 855 THEN 1 WHEN u(4447) < 925 THEN 17 ELSE 4 END AS admission_source_id,
  CAST(1 + u(6133) % 14 AS INT) AS time_in_hospital,
  CASE WHEN u(887) < 400 THEN '?' ELSE 'MC' END AS payer_code,
  CASE WHEN u(1429) < 490 THEN '?' WHEN u(1429) < 640 THEN 'InternalMedicine' WHEN u(1429) < 800 THEN 'Emergency/Trauma' ELSE 'Cardiology' END AS medical_specialty,
  CAST(1 + qty % 132 AS INT) AS num_lab_procedures, CAST(n_items % 7 AS INT) AS num_procedures,
  CAST(1 + (n_parts * 5 + u(9001) % 11) % 81 AS INT) AS num_medications,
  CAST(CASE WHEN u(5557) < 835 THEN 0 ELSE u(5557) % 12 END AS INT) AS number_outpatient,
  CAST(CASE WHEN u(3301) < 890 THEN 0 ELSE u(3301) % 8 END AS INT) AS number_emergency,
  CAST(ninp AS INT) AS number_inpatient,
  CASE WHEN u(8081) < 70 THEN '250.83' WHEN u(8081) < 90 THEN '250' WHEN u(8081) < 300 THEN '428' WHEN u(8081) < 330 THEN '459.8' WHEN u(8081) < 400 THEN '786' WHEN u(8081) < 480 THEN '486' WHEN u(8081) < 560 THEN '574' WHEN u(8081) < 630 THEN '820' WHEN u(8081) < 700 THEN '715' WHEN u(8081) < 760 THEN '599' WHEN u(8081) < 810 THEN '174' WHEN u(8081) < 850 THEN '295' WHEN u(8081) < 890 THEN 'V57' WHEN u(8081) < 910 THEN 'E885' WHEN u(8081) < 990 THEN '276' ELSE '?' END AS diag_1,
  CASE WHEN u(8087) < 30 THEN '?' WHEN u(8087) < 500 THEN '250' ELSE '401' END AS diag_2,
  CASE WHEN u(8093) < 60 THEN '?' WHEN u(8093) < 500 THEN '272' ELSE 'V45' END AS diag_3,
  CAST(CASE WHEN n_items + 2 > 9 THEN 9 ELSE n_items + 2 END AS INT) AS number_diagnoses,
  CASE WHEN u(1033) < 947 THEN 'None' WHEN u(1033) < 973 THEN 'Norm' WHEN u(1033) < 988 THEN '>200' ELSE '>300' END AS max_glu_serum,
  CASE WHEN u(1039) < 833 THEN 'None' WHEN u(1039) < 882 THEN 'Norm' WHEN u(1039) < 920 THEN '>7' ELSE '>8' END AS A1Cresult,
  {_MEDICATION_SQL},
  CASE WHEN u(104729) < 85 + 50 * LEAST(ninp, 3) THEN '<30' WHEN u(104729) < 450 THEN '>30' ELSE 'NO' END AS readmitted
FROM base)"""
)

_TEXT_COLUMNS = [f.name for f in ENCOUNTER_SCHEMA if f.dataType.simpleString() == "string"]
_NORMAL = ", ".join(f"NULLIF({c}, '?') AS {c}" for c in _TEXT_COLUMNS)
NORMALIZED = f"encounters AS (SELECT * REPLACE ({_NORMAL}) FROM raw_encounters)"
FIRST = """first_encounters AS (
  SELECT * FROM encounters WHERE encounter_id IN (SELECT MIN(encounter_id) FROM encounters GROUP BY patient_nbr))"""


def _count_status(statuses: str) -> str:
    return " + ".join(f"(CASE WHEN {m} IN ({statuses}) THEN 1 ELSE 0 END)" for m in MEDICATIONS)


def icd9(code: str, number: str) -> str:
    return f"""CASE WHEN {code} IS NULL OR {code} = '?' THEN 'Unknown'
    WHEN {code} LIKE 'V%' THEN 'Supplementary' WHEN {code} LIKE 'E%' THEN 'External cause'
    WHEN {number} BETWEEN 390 AND 459 OR {number} = 785 THEN 'Circulatory'
    WHEN {number} BETWEEN 460 AND 519 OR {number} = 786 THEN 'Respiratory'
    WHEN {number} BETWEEN 520 AND 579 OR {number} = 787 THEN 'Digestive'
    WHEN {number} = 250 THEN 'Diabetes' WHEN {number} BETWEEN 800 AND 999 THEN 'Injury'
    WHEN {number} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
    WHEN {number} BETWEEN 580 AND 629 OR {number} = 788 THEN 'Genitourinary'
    WHEN {number} BETWEEN 140 AND 239 THEN 'Neoplasm' WHEN {number} BETWEEN 290 AND 319 THEN 'Mental'
    ELSE 'Other' END"""


def features(source: str) -> str:
    """``features`` CTE over a given encounter relation."""
    return f"""p75 AS (SELECT quantile_cont(num_lab_procedures, 0.75) AS lab_p75 FROM {source}),
features AS (
  SELECT {source}.*, CAST(readmitted = '<30' AS INT) AS readmitted_30,
    CAST(SUBSTR(age, 2, POSITION('-' IN age) - 2) AS INT) + 5 AS age_numeric,
    number_inpatient * 3 + number_emergency * 2 + number_outpatient AS prior_utilization_score,
    CAST(diag_1 IS NOT NULL AS INT) + CAST(diag_2 IS NOT NULL AS INT) + CAST(diag_3 IS NOT NULL AS INT) AS comorbidity_count,
    CAST({_count_status("'Up','Down'")} AS INT) AS medication_changes,
    CAST(insulin IN ('Up','Down') AS INT) AS insulin_changed,
    CAST({_count_status("'Steady','Up','Down'")} AS INT) AS num_active_meds,
    {icd9("diag_1", "TRY_CAST(diag_1 AS DOUBLE)")} AS diag1_category,
    {icd9("diag_1", "FLOOR(TRY_CAST(diag_1 AS DOUBLE))")} AS diag1_category_floor,
    CASE WHEN discharge_disposition_id = 7 THEN 'High risk (AMA)' WHEN discharge_disposition_id IN (1,2,8) THEN 'Moderate (home)'
      WHEN discharge_disposition_id IN (3,5,12,14) THEN 'Lower (SNF/rehab)' WHEN discharge_disposition_id IN (6,10) THEN 'Lower (home health)'
      ELSE 'Other' END AS discharge_risk_group,
    CAST(num_lab_procedures > lab_p75 AS INT) AS high_lab_burden,
    CAST(admission_source_id = 7 AS INT) AS admitted_from_er, CAST(admission_type_id = 1 AS INT) AS emergency_admission,
    CAST(discharge_disposition_id = 3 AS INT) AS discharge_to_snf,
    CAST(A1Cresult IN ('>7','>8') AS INT) AS a1c_abnormal, CAST(A1Cresult <> 'None' AS INT) AS a1c_tested
  FROM {source}, p75)"""


def scored(source: str) -> str:
    """``scored`` CTE: scorecard in whole thousandths, score and tier."""
    return f"""inputs AS (
  SELECT *, CAST(readmitted = '<30' AS INT) AS label,
    number_inpatient * 3 + number_emergency * 2 + number_outpatient AS prior_utilization_score,
    CAST(insulin IN ('Up','Down') AS INT) AS insulin_changed, CAST(A1Cresult <> 'None' AS INT) AS a1c_tested
  FROM {source}),
milli AS (
  SELECT *, CAST(GREATEST(20, LEAST(950, 100 + 25*number_inpatient + 15*number_emergency + 5*prior_utilization_score
    + 8*number_diagnoses + 3*time_in_hospital + 20*insulin_changed - 10*a1c_tested)) AS INT) AS score_milli FROM inputs),
scored AS (
  SELECT *, CAST(score_milli AS DOUBLE) / 1000.0::DOUBLE AS score,
    CASE WHEN score_milli < 150 THEN 'Low' WHEN score_milli < 250 THEN 'Moderate' ELSE 'High' END AS tier FROM milli)"""


def seeded_hash(key: str, seed: int) -> str:
    mixed = f"(({key} % 2147483647 * 48271 + {seed}) % 2147483647)"
    return f"(({mixed} * {mixed} % 2147483647 * 16807 + {mixed}) % 2147483647)"


def rate(num: str, den: str) -> str:
    """Percentage rounded half up to two places by integer arithmetic."""
    return f"CAST((({num})*20000 + ({den})) // NULLIF(2*({den}), 0) AS BIGINT) / 100.0::DOUBLE"


def ratio(num: str, den: str) -> str:
    return f"CAST((({num})*200 + ({den})) // NULLIF(2*({den}), 0) AS BIGINT) / 100.0::DOUBLE"


def count_if(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


POS = count_if("readmitted = '<30'")


def over(body: str, *ctes: str, source: str = "encounters") -> str:
    """A statement over the data set; ``source`` names the deepest relation needed."""
    chain = [ENCOUNTERS]
    if source != "raw_encounters":
        chain.append(NORMALIZED)
    if source == "first_encounters":
        chain.append(FIRST)
    return "WITH " + ",\n".join([*chain, *ctes]) + "\n" + body


assert len(ENCOUNTER_COLUMNS) == 47
