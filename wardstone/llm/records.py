"""Binary token records: length-delimited frames with masked checksums, and a separate offset index.

One frame: payload length (unsigned 64 bits, little-endian), its masked CRC32,
the payload, its masked CRC32, and one line-break byte. The payload is the
document id (signed 64 bits; the largest value stands for a missing id), one
byte with the width of a token id, 2 or 4, whichever the record's ids need, and
the ids (unsigned, little-endian). Files hold frames in ascending id order and follow
each other by their part number. Spark's own writer stores them, so any store
that Spark writes to will do, and a task that is lost or run twice leaves one
complete file. The index is one row per frame: part, offset, id, tokens. It
is stored beside the folder of the record files, as ``<folder>.index``, and
``read_shuffled`` reads each frame at the offset that it names.

Defined results: a null text is an empty one, its record holds the end id alone.
Rows without an id come last; rows of one id are ordered by a hash of the text.
Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, slices
from wardstone.llm.tokens import encoder

_NO_ID = np.iinfo(np.int64).max
_HEAD_SIZE, _TAIL_SIZE, _START = 12, 4, 9
_INDEX = "part int, offset long, doc_id long, before long, n_tokens long, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    """CRC32, rotated and shifted, so that a checksum over stored checksums stays sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def pack_ids(doc_id: int, ids: np.ndarray) -> bytes:
    """A record's payload."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    return struct.pack("<qB", doc_id, width) + ids.astype(f"<u{width}").tobytes()


def unpack_ids(payload: bytes) -> tuple[int, np.ndarray]:
    """Document id and token ids (32 bits) of a payload."""
    doc_id, width = struct.unpack_from("<qB", payload)
    return doc_id, np.frombuffer(payload, f"<u{width}", offset=_START).astype("<u4")


def frame(payload: bytes) -> bytes:
    """A frame without the line break, which the writer adds."""
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and payload of each frame of a file; raises at the first damaged one."""
    at = 0
    while at < len(content):
        payload = frame_at(content, at)
        yield at, payload
        at += _HEAD_SIZE + len(payload) + _TAIL_SIZE + 1


def frame_at(content: bytes, at: int) -> bytes:
    """Payload of the frame at an offset of a file; raises if it is damaged or none begins there."""
    if at + _HEAD_SIZE > len(content):
        raise ValueError(f"cut record at {at}")
    size, check = struct.unpack_from("<QI", content, at)
    if masked_crc(content[at : at + 8]) != check:
        raise ValueError(f"damaged length at {at}")
    end = at + _HEAD_SIZE + size
    payload = content[at + _HEAD_SIZE : end]
    if end + _TAIL_SIZE + 1 > len(content) or masked_crc(payload) != struct.unpack_from("<I", content, end)[0]:
        raise ValueError(f"damaged record at {at}")
    return payload


def write_records(documents: DataFrame, folder: str, path: str, end_id: int, file_bytes: int = 16 << 20) -> None:
    """Encode all documents and write them as record files, and their index; ``file_bytes`` of text go into one file."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, edge = encoder(path).encode(part.column("text"))
                edge = edge + np.arange(len(edge))
                full = np.insert(ids, edge[1:] - np.arange(1, len(edge)), end_id)
                docs = part.column("doc_id").to_pylist()
                framed = [frame(pack_ids(d, full[a:b])) for d, a, b in zip(docs, edge[:-1].tolist(), edge[1:].tolist())]
                yield batch_of("frame binary", framed)

    ordered = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(files, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    framed = ordered.select("doc_id", "text").mapInArrow(run, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.text(folder)
    read_records(spark, folder).write.parquet(index_path(folder))


def index_path(folder: str) -> str:
    return folder.rstrip("/") + ".index"


def _payloads(batches: Iterator[pa.RecordBatch], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content in zip(batch.column("part").to_pylist(), batch.column("content")):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            ids, before = [], 0
            for offset, payload in frames(content.as_py()):
                doc, found = unpack_ids(payload)
                row = (part, offset, None if doc == _NO_ID else doc, before, len(found), zlib.crc32(found.tobytes()))
                before += len(found)
                for column, value in zip(out, row):
                    column.append(value)
                if keep_ids:
                    ids.append(found.astype(np.int64))
            yield batch_of(_INDEX + ", ids array<long>", *out, ids) if keep_ids else batch_of(_INDEX, *out)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Number and content of each record file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract(F.col("path"), r"part-(\d+)", 1).cast("int").alias("part"), "content")


def read_records(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """Every record of a folder, checksums verified: the index columns and, if wanted, the ids."""
    schema = _INDEX + (", ids array<long>" if keep_ids else "")
    return _files(spark, folder).mapInArrow(lambda b: _payloads(b, keep_ids), schema)


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """The stored offset index of the folder's records: start counts the ids of all records before.

    It is taken as it was stored when the records were written and read back; a
    file that was damaged since is not noticed here. ``read_records`` reads the
    files themselves, and it and ``read_at`` fail on a frame whose checksum differs.
    """
    index = spark.read.schema(_INDEX).parquet(index_path(folder))
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("_size").over(order), F.lit(0)).alias("_begin"))  # one row per file
    return index.join(begins, "part").select("part", "offset", "doc_id", (F.col("_begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


_PICKED = "place long, part int, offset long, doc_id long, ids array<long>"
_PICKED_IDS = 1 << 20  # ids of one batch, a record more at most


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content, wanted in zip(batch.column("part").to_pylist(), batch.column("content"), batch.column("wanted")):
            content, rows, size = content.as_py(), [], 0
            for want in wanted:
                place, offset = want["place"].as_py(), want["offset"].as_py()
                doc, ids = unpack_ids(frame_at(content, offset))
                rows.append((place, part, offset, None if doc == _NO_ID else doc, ids.astype(np.int64)))
                size += len(ids)
                if size >= _PICKED_IDS:
                    yield batch_of(_PICKED, *map(list, zip(*rows)))
                    rows, size = [], 0
            if rows:
                yield batch_of(_PICKED, *map(list, zip(*rows)))


def read_at(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records that rows of the index (part, offset) name, each read at its offset, in the order of the rows' ``place``.

    Rows are grouped by file, so that a file is fetched once; a row given twice is read twice.
    """
    picks = wanted.groupBy("part").agg(F.collect_list(F.struct("place", "offset")).alias("wanted"))
    return _files(spark, folder).join(picks, "part").mapInArrow(_pick, _PICKED).orderBy("place", "part", "offset")


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """Every record once, in an order that the seed sets."""
    index = build_index(spark, folder)
    return read_at(spark, folder, index.select("part", "offset", F.xxhash64("part", "offset", F.lit(seed)).alias("place")))
