"""Stored encounter tables that the named queries scan.

The encounter table is derived from the order tables once per application and
written to the shared folder, as is its first-encounter reduction; queries then
scan only the columns and rows they need. Analysis over a table that a load
step has written is also how the data reaches real users of these operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardstone.operators import profile
from wardstone.operators.patients import bucketed_by_patient
from wardstone.session import scratch_path
from wardstone.sources import orders_fixture

_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def stored(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table as written earlier by this application, or write it now."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STORED:
        path, table = scratch_path(spark, name), build()
        table.write.parquet(path)
        _STORED[key] = (path, table.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "encounters", lambda: orders_fixture.encounters(spark, folder))


def first_encounters(spark: SparkSession, folder: str) -> DataFrame:
    return stored(
        spark, folder, "first_encounters", lambda: profile.first_encounter(encounters(spark, folder))
    )


_BUCKETED: dict[tuple[str, str], str] = {}


def encounters_by_patient(spark: SparkSession, folder: str) -> DataFrame:
    """The encounter table, stored bucketed by patient once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUCKETED:
        name = f"encounters_by_patient_{uuid.uuid4().hex}"
        bucketed_by_patient(encounters(spark, folder), name)
        _BUCKETED[key] = name
    return spark.table(_BUCKETED[key])
