"""Packing of token sequences into bins of fixed capacity by first-fit decreasing.

Documents are encoded once and cut every ``capacity`` ids; only a document's
last piece is shorter. All pieces are dealt into random groups of bounded size,
and each group is packed on its own: pieces by falling length, each into the
first bin with room, which a tournament tree over the bins' free room finds in
logarithmic time. Token ids do not move for this, only lengths.

Defined results: a null text is an empty one, which is a piece of the end id
alone. Repeated rows are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardstone.llm.common import batch_of, slices
from wardstone.llm.tokens import encoder, forgetful, public_tokenizer
from wardstone.session import materialize

CAPACITY = 2048
GROUP_PIECES = 8192
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(documents: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's ids with the end id, cut every ``capacity`` ids; ``with_ids`` adds the ids."""
    ddl = _PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most_bytes=8 << 20):
                ids, edge = encoder(path).encode(part.column("text"))
                n = np.diff(edge) + 1
                end = np.cumsum(n)
                full = np.insert(ids, edge[1:], end_id)
                count = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(n[doc] - start, capacity)
                at = (end - n)[doc] + start
                raw = memoryview(full.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                more = [pa.ListArray.from_arrays(pa.array(np.append(at, len(full)), pa.int32()), pa.array(full.astype(np.int32)))] if with_ids else []
                yield batch_of(ddl, part.column("doc_id").take(pa.array(doc)), start, length, crc, n[doc], *more)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(forgetful(path, run), ddl)


class TournamentTree:
    """Free room of bins in a row; each inner node knows the most room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put a piece into the first bin with room and return the bin."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bin_ = node - self.leaves
        room[node] -= size
        node >>= 1
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node >>= 1
        return bin_


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece; equal lengths go in the order given."""
    tree = TournamentTree(len(lengths), capacity)
    bins = np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i] = tree.place(int(lengths[i]))
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, seed: int = 42) -> DataFrame:
    """The pieces (doc_id, start, length and whatever else) with sequence_id and offset.

    Pieces longer than ``capacity`` are refused. ``pieces`` should be stored.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    # equal rows get different places by where they are stored, so that many of them spread over the groups
    dealt = pieces.withColumn("_deal", F.xxhash64(F.lit(seed), *[F.col(c) for c in pieces.columns], F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_group", F.pmod("_deal", F.lit(groups)))
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_deal", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        lengths = table.column("length").to_numpy()
        if len(lengths) and lengths.max() > capacity:
            raise ValueError("a piece is longer than a sequence")
        bins = first_fit_decreasing(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.concatenate([[True], bins[order][1:] != bins[order][:-1]]))
        offset = before - np.repeat(before[first], np.diff(np.append(first, len(order))))
        group = table.column("_group")[0].as_py()
        out = table.drop_columns(["_deal", "_group"]).take(pa.array(order))
        out = out.append_column("sequence_id", pa.array(group * (1 << 32) + bins[order]))
        return out.append_column("offset", pa.array(offset))

    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack_documents(documents: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Encode, cut and pack all documents: one row per piece."""
    stored = materialize(token_pieces(documents, path or public_tokenizer(), end_id, capacity), "token-pieces")
    return pack(stored, capacity)
