"""Table access and small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_bucket(column: str, buckets: int) -> Column:
    """CRC32 of the id written as text, modulo the number of buckets; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def release_memory() -> None:
    """Give memory that earlier work left unused back to the system; workers outlive tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The Arrow function, with the worker's unused memory given back at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to bounded slices of Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield function(part)

    return df.mapInArrow(tidied(run), schema)


def slices(batch: pa.RecordBatch, text: str = "text", most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``most_bytes`` of text; a row is never cut."""
    if text not in batch.schema.names:
        yield batch
        return
    column = batch.column(text)
    start, size = 0, 0
    for i, n in enumerate(lengths(column)):
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def lengths(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def schema_of(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL string, as mapInArrow functions return it."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
        "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<float>": pa.list_(pa.float32()),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "short": pa.int16(),
    }
    return pa.schema([(n, kinds[k]) for n, k in (x.strip().split(" ") for x in ddl.split(","))])


def batch_of(ddl: str, *columns) -> pa.RecordBatch:
    schema = schema_of(ddl)
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def parts_for(df_rows: int, rows_per_part: int, least: int = 1) -> int:
    return max(least, -(-df_rows // rows_per_part))
