"""Reading, normalising and writing encounter tables."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wardstone import schema as S
from wardstone.functions import clinical as C
from wardstone.session import materialize, scratch_path
from wardstone.sources import folders


def read_encounters_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan by column name; the missing token arrives as NULL.

    Columns may stand in any order, be hyphenated, or be absent (then NULL);
    columns that are not declared are left out. All are read as text and then
    cast; a value that does not fit its type is NULL. Files whose headers differ
    from each other are refused. The literal text ``None`` of the lab columns
    stays a value.
    """
    text = (
        spark.read.option("header", True).option("enforceSchema", False).option("nullValue", S.MISSING_TOKEN).csv(path)
    )
    return by_name(normalize(text))


def by_name(df: DataFrame) -> DataFrame:
    """The declared columns and types, bound by name; raises when an id or the outcome is missing."""
    present = {c.lower(): c for c in df.columns}
    required = [*S.ID_COLUMNS, "readmitted"]
    lacking = [c for c in required if c.lower() not in present]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    columns = []
    for field in S.ENCOUNTER_SCHEMA:
        found = present.get(field.name.lower())
        value = F.lit(None) if found is None else F.col(f"`{found}`")
        columns.append((value.cast(field.dataType) if found is None else value.try_cast(field.dataType)).alias(field.name))
    return df.select(*columns)


REJECTS = "rejects"


def read_encounters_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The encounter table of a CSV scan, and what did not fit: (row_id, column_name, raw_value).

    The scan is stored once with both. A row whose encounter or patient id does
    not fit, or is missing, is not part of the table; another value that does not
    fit is NULL there. Each such value is one row of the second table, under the
    text that stands in the row's encounter_id; a missing id is listed with a NULL
    value.
    """
    text = (
        spark.read.option("header", True).option("enforceSchema", False).option("nullValue", S.MISSING_TOKEN).csv(path)
    )
    parsed = materialize(with_rejects(normalize(text)), "checked_scan")
    good_ids = reduce(and_, [F.col(c).isNotNull() for c in S.ID_COLUMNS])
    return parsed.filter(good_ids).select(*S.ENCOUNTER_COLUMNS), parsed.select("row_id", F.inline(REJECTS))


def with_rejects(df: DataFrame) -> DataFrame:
    """``by_name`` with the raw id as ``row_id`` and an array of the (column_name, raw_value) that did not fit."""
    typed = by_name(df)
    present = {c.lower(): F.col(f"`{c}`").cast("string") for c in df.columns}
    bad = []
    for field in S.ENCOUNTER_SCHEMA:
        raw = present.get(field.name.lower())
        if raw is None or isinstance(field.dataType, StringType):
            continue
        lost = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
        lost = lost | raw.isNull() if field.name in S.ID_COLUMNS else lost
        bad.append(F.when(lost, F.struct(F.lit(field.name).alias("column_name"), raw.alias("raw_value"))))
    values = [present[c.lower()].try_cast(S.ENCOUNTER_SCHEMA[c].dataType) if c.lower() in present else F.lit(None).cast(S.ENCOUNTER_SCHEMA[c].dataType) for c in typed.columns]
    named = [v.alias(c) for v, c in zip(values, typed.columns)]
    return df.select(*named, present["encounter_id"].alias("row_id"), F.filter(F.array(*bad), lambda e: e.isNotNull()).alias(REJECTS))


def read_encounters_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalize(spark.read.parquet(path))


def normalize(df: DataFrame) -> DataFrame:
    """Missing token to NULL, hyphens in column names to underscores."""
    renamed = {c: c.replace("-", "_") for c in df.columns if "-" in c}
    df = df.withColumnsRenamed(renamed) if renamed else df
    tokens = {f.name: C.null_token(F.col(f.name)) for f in df.schema if isinstance(f.dataType, StringType)}
    return df.withColumns(tokens)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV in which NULL is spelled with the missing token."""
    df.write.mode(mode).option("header", True).option("nullValue", S.MISSING_TOKEN).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def create_table_if_absent(df: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """The catalog table ``name``, created from ``df`` unless it exists.

    The rows are first written whole to a folder that nothing else uses; then one
    ``CREATE TABLE IF NOT EXISTS`` names that folder. The catalog lets one of
    several racing writers win, and the others get the winner's table. No
    existing table or folder is ever written to. ``location`` is the folder to
    keep the data in, below which a new one is made; by default the shared folder.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        folder = f"{location.rstrip('/')}/{uuid.uuid4().hex}" if location else scratch_path(spark, "table")
        df.write.parquet(folder)
        quoted = ".".join(f"`{part}`" for part in name.split("."))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted} USING parquet LOCATION '{folder}'")
    return spark.table(name)


def create_if_absent(df: DataFrame, path: str) -> DataFrame:
    """The parquet folder ``path``, created from ``df`` unless it holds a table already.

    A folder with any file that a reader would see is a table, whoever wrote it
    and with or without a success mark, and is left as it is. New rows are
    written to a hidden folder beside and published by one rename, so that other
    readers find all rows or none; of several racing writers one wins and the
    others read its table. A folder that holds nothing a reader would see, as a
    writer that died leaves it, is moved aside, not deleted.
    """
    spark = df.sparkSession
    if not folders.holds_data(spark, path):
        staged = folders.beside(path, "stage")
        df.write.parquet(staged)
        folders.publish(spark, staged, path)
    return spark.read.parquet(path)


def register_view(df: DataFrame, name: str = "encounters") -> DataFrame:
    """Expose the table to ad-hoc ``spark.sql`` queries."""
    df.createOrReplaceTempView(name)
    return df


def filter_encounters(
    df: DataFrame,
    *,
    ages: list[str] | None = None,
    admission_types: list[int] | None = None,
    dispositions: list[int] | None = None,
    tiers: list[str] | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """Dashboard filters; all but the tier are plain comparisons that reach the scan."""
    conditions: list[Column] = []
    if ages is not None:
        conditions.append(F.col("age").isin(ages))
    if admission_types is not None:
        conditions.append(F.col("admission_type_id").isin(admission_types))
    if dispositions is not None:
        conditions.append(F.col("discharge_disposition_id").isin(dispositions))
    if tiers is not None:
        conditions.append(F.col("tier").isin(tiers))
    if start is not None:
        conditions.append(F.col("encounter_ts") >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        conditions.append(F.col("encounter_ts") < F.lit(str(end)).cast("timestamp_ntz"))
    for condition in conditions:
        df = df.filter(condition)
    return df
