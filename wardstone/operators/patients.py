"""Patient-level operators over a table that is stored bucketed by patient.

All rows of a patient lie in one bucket, so grouping by patient, and picking a
row of each patient, need no shuffle. Writing the table is the one shuffle. A
patient with very many stays makes its bucket large; the operators pass through
a bucket's rows without gathering them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.session import scratch_path

ROWS_PER_BUCKET = 1_000_000


def bucketed_by_patient(df: DataFrame, name: str | None = None, key: str = "patient_nbr", buckets: int | None = None, path: str | None = None) -> DataFrame:
    """The rows as a catalog table bucketed and sorted by patient.

    ``buckets`` grow with the rows unless they are given. The data goes to
    ``path``, by default a new place in the shared folder.
    """
    spark = df.sparkSession
    name = name or f"by_patient_{uuid.uuid4().hex}"
    count = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_BUCKET))
    dealt = df.repartition(count, key)  # one file a bucket
    dealt.write.bucketBy(count, key).sortBy(key).option("path", path or scratch_path(spark, "by_patient")).saveAsTable(name)
    return spark.table(name)


def first_encounter_in_bucket(df: DataFrame, key: str = "patient_nbr", order: str = "encounter_id") -> DataFrame:
    """The rows with the smallest ``order`` value of each ``key``, without a join.

    Same rows as ``profile.first_encounter``; meant for a table that is bucketed
    by the key, where the minimum beside each row needs no exchange.
    """
    first = F.min(order).over(Window.partitionBy(key))
    return df.withColumn("_first", first).filter(F.col(order) == F.col("_first")).drop("_first")
