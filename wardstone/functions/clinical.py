"""Row-wise clinical expressions; every one stays inside generated JVM code."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardstone import schema as S

# ---- fixed values: ICD-9 chapters, in the order in which they are tried ----
ICD9_CHAPTERS = [
    ("Circulatory", 390, 459, 785),
    ("Respiratory", 460, 519, 786),
    ("Digestive", 520, 579, 787),
    ("Diabetes", 250, 250, None),
    ("Injury", 800, 999, None),
    ("Musculoskeletal", 710, 739, None),
    ("Genitourinary", 580, 629, 788),
    ("Neoplasm", 140, 239, None),
    ("Mental", 290, 319, None),
]
# ---- fixed values: utilisation bands, right-closed upper bounds ----
UTILIZATION_BANDS = [
    (1, "Low (0-1)"),
    (3, "Med (2-3)"),
    (6, "High (4-6)"),
    (100, "Very high (7+)"),
]
MEDICATION_ORDINALS = {"No": 0, "Steady": 1, "Up": 2, "Down": 3}


def flag(condition: Column) -> Column:
    """0/1 integer; NULL conditions count as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def null_token(column: Column, token: str = S.MISSING_TOKEN) -> Column:
    return F.nullif(column, F.lit(token))


def readmitted_30(column: Column | None = None) -> Column:
    column = F.col("readmitted") if column is None else column
    return flag(column == S.POSITIVE_OUTCOME)


def age_midpoint(age: Column, default: int | None = None) -> Column:
    """Middle of an ``[a-b)`` bucket of ten years."""
    low = F.regexp_extract(age, r"^\[(\d+)-\d+\)$", 1)
    middle = low.try_cast("int") + 5
    return middle if default is None else F.coalesce(middle, F.lit(default))


def prior_utilization(inpatient: Column, emergency: Column, outpatient: Column) -> Column:
    return inpatient * 3 + emergency * 2 + outpatient


def utilization_band(score: Column) -> Column:
    """Banded score; NULL below 0 and above the last bound."""
    banded = reduce(
        lambda chain, band: chain.when(score <= band[0], band[1]),
        UTILIZATION_BANDS,
        F.when(score < 0, F.lit(None).cast("string")),
    )
    return banded


def comorbidity_count(*codes: Column) -> Column:
    return reduce(add, [flag(null_token(code).isNotNull()) for code in codes])


def medications_with_status(statuses: list[str], columns: list[str]) -> Column:
    listed = ", ".join(f"'{status}'" for status in statuses)
    return F.expr(" + ".join(f"CAST(coalesce({c} IN ({listed}), false) AS INT)" for c in columns))


def medication_ordinal(status: Column) -> Column:
    chain = F.when(status == "No", 0)
    for name in S.ACTIVE_STATUSES:
        chain = chain.when(status == name, MEDICATION_ORDINALS[name])
    return chain.otherwise(0)


def icd9_category(code: Column, floor: bool = False) -> Column:
    """ICD-9 code to clinical chapter.

    A decimal such as 250.83 is compared as it stands, so it falls outside a
    single-number chapter and outside the gap after a range's end. With
    ``floor`` the code is truncated to its three-digit category first.
    """
    number = code.try_cast("double")
    if floor:
        number = F.floor(number)
    chain = (
        F.when(null_token(code).isNull(), S.UNKNOWN)
        .when(code.startswith("V"), "Supplementary")
        .when(code.startswith("E"), "External cause")
    )
    for chapter, first, last, extra in ICD9_CHAPTERS:
        inside = number.between(first, last)
        chain = chain.when(inside if extra is None else inside | (number == extra), chapter)
    return chain.otherwise("Other")


def discharge_risk_group(disposition: Column) -> Column:
    groups = iter(S.DISCHARGE_RISK_GROUPS.items())
    name, ids = next(groups)
    chain = F.when(disposition.isin(ids), name)
    for name, ids in groups:
        chain = chain.when(disposition.isin(ids), name)
    return chain.otherwise("Other")


def disposition_label(disposition: Column) -> Column:
    pairs = [F.lit(part) for item in S.DISPOSITION_LABELS.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), disposition), F.lit("Other"))


def risk_tier(score: Column) -> Column:
    return (
        F.when(score < S.TIER_CUTS["Low"], "Low")
        .when(score < S.TIER_CUTS["Moderate"], "Moderate")
        .when(score.isNotNull(), S.HIGH_TIER)
    )


def scorecard_milli() -> Column:
    """Published risk score in whole thousandths, before the clamp."""
    terms = [F.col(name) * weight for name, weight in S.SCORECARD_WEIGHTS.items()]
    return reduce(add, terms, F.lit(S.SCORECARD_BASE))


def scorecard_clamped() -> Column:
    """Score within its bounds; NULL when an input is missing."""
    low, high = S.SCORECARD_CLAMP
    return clamp(scorecard_milli(), low, high)


def clamp(value: Column, low: int | None = None, high: int | None = None) -> Column:
    """``greatest``/``least`` that keep NULL instead of skipping it."""
    bounded = value if high is None else F.least(value, F.lit(high))
    bounded = bounded if low is None else F.greatest(bounded, F.lit(low))
    return F.when(value.isNotNull(), bounded)


def seeded_hash(key: Column, seed: int) -> Column:
    """Pseudo-random integer in [0, 2^31-1) from a row key, by integer arithmetic only.

    The same in any engine with 64-bit integers and independent of partitioning.
    """
    prime = (1 << 31) - 1
    mixed = (key % prime * 48271 + seed) % prime
    return (mixed * mixed % prime * 16807 + mixed) % prime
