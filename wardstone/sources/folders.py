"""Publishing a written folder under its final name, through Hadoop's own file contexts.

These are the calls by which any store that Spark reads is reached. A session
without them (Spark Connect) uses ``create_table_if_absent`` instead.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def beside(path: str, why: str) -> str:
    """A new hidden folder next to the path; readers of the parent skip it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{why}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    jvm = spark._jvm
    if jvm is None:
        raise RuntimeError("publishing a folder needs a session with a JVM; use create_table_if_absent")
    place = jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    return whole, jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.util().exists(place)


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a reader would see a file in the folder: one not hidden by a leading ``_`` or ``.``, at any depth."""
    place, files = _place(spark, path)
    if not files.util().exists(place):
        return False
    open_ = [place]
    while open_:
        found = files.listStatus(open_.pop())
        while found.hasNext():
            status = found.next()
            name = status.getPath().getName()
            if name.startswith("_") and "=" not in name or name.startswith("."):
                continue
            if status.isFile():
                return True
            open_.append(status.getPath())
    return False


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename without replacing; False when the target is there already."""
    place, files = _place(spark, source)
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    try:
        files.rename(place, _place(spark, target)[0], spark.sparkContext._gateway.new_array(option, 0))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or exists(spark, target):
            return False
        raise


def publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Give the staged folder its final name; False when another table has it, which then stays."""
    while not _rename(spark, staged, path):
        if holds_data(spark, path):
            place, files = _place(spark, staged)
            files.delete(place, True)  # this writer's own rows
            return False
        _rename(spark, path, beside(path, "left"))
    return True
