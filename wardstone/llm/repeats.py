"""Removal of byte strings that occur earlier, by merged Burrows-Wheeler transforms.

A byte goes when some string of ``length`` bytes over it also starts earlier: in
a document of smaller id, or earlier in its own. The work is cut by content, so
that equal strings always meet in one task:

1. Each window of ``length`` bytes has an anchor, the gram of half that length
   with the smallest hash in it (the leftmost of equals). Windows in a row with
   one anchor are a piece. Equal windows have equal anchors, hence pieces are
   grouped by anchor. Equal pieces are merged first, in the task and then over
   all: each but the first of them is removed whole. An anchor left with one
   piece holds no other repeat.
2. Pieces that differ but share an anchor are fetched as text and dealt to parts
   of whole anchors. Each shard of a part is sorted on its own; the shards are
   merged by interleave refinement of their transforms, and blocks with a common
   prefix of ``length`` bytes are the repeated windows. The earliest window of
   each stays.
3. Spans are collected per document and cut out.

The repeats are judged on the input, not on what is left. Only hashes (40 bits
for anchors and 48 for pieces, together 88) decide that two pieces are equal.

Defined results: a null text is an empty one; texts shorter than ``length`` stay
whole. Rows of one id with different texts are ordered by a hash of the text;
rows equal in id and text count as one occurrence and get equal results. Rows
without an id come last. Extra columns are ignored here, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardstone.llm.bwt import repeated_intervals
from wardstone.llm.common import batch_of, schema_of, slices, tidied
from wardstone.llm.textbytes import ByteView
from wardstone.session import materialize

LENGTH = 100
_NO_ID = np.iinfo(np.int64).max
_TEXT_SLICE = 4 << 20
_PIECES = "bucket int, whole boolean, docs binary, items binary"
_FOUND = "doc_id long, th long, spans binary, asks binary"
_ITEM = np.dtype([("doc", "<u4"), ("start", "<u4"), ("anchor", "u1", 5), ("body", "u1", 6), ("n", "u1")])
_DECISIONS = "bucket int, docs binary, items binary"
_DECIDED = np.dtype([("start", "<u4"), ("n", "u1"), ("ask", "u1"), ("anchor", "u1", 5)])
_RANGE = np.dtype([("start", "<u4"), ("n", "<u4")])
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_MULTIPLIER, n, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every gram of the length, by doubling."""
    block, size = _BYTE[data], 1
    out, done = None, 0
    while True:
        if length & size:
            if out is None:
                out, done = block, size
            else:
                n = len(block) - done
                out = block[:n] * _power(done) + out[size : size + n]
                done += size
        if size * 2 > length:
            return out[: len(data) - length + 1]
        n = len(block) - size
        block = block[:n] * _power(size) + block[size : size + n]
        size *= 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    out = values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size : width - size + len(values) - width + 1])


def pieces(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Document, start, anchor hash (40 bits), content hash (48 bits) and windows of each piece of a batch."""
    gram = length // 2
    width = length - gram + 1
    if len(data) < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty
    half = _rolling(data, gram)
    low = np.uint64((1 << 24) - 1)
    assert len(half) <= int(low) + 1
    keyed = (_mix(half) & ~low) | np.arange(len(half), dtype=np.uint64)
    least = _sliding_min(keyed, width)  # by hash, then by place
    window = half[: len(half) - (length - gram)] * _power(length - gram) + _rolling(data, length - gram)[gram:]
    doc_of_break = bounds[1:-1]
    valid = np.ones(len(least), bool)
    blocked = np.zeros(len(least) + 1, np.int64)
    np.add.at(blocked, np.clip(doc_of_break - length + 1, 0, len(least)), 1)
    np.add.at(blocked, np.clip(doc_of_break, 0, len(least)), -1)
    valid = np.cumsum(blocked[:-1]) == 0
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(fresh)
    stop = np.append(start[1:], len(least))
    use = valid[start]
    start, stop = start[use], stop[use]
    n = stop - start
    body = _mix(window[start] * np.uint64(0xD6E8FEB86659FD93) + _mix(window[stop - 1]) + n.astype(np.uint64))
    doc = np.searchsorted(bounds, start, "right") - 1
    return doc, start - bounds[doc], least[start] >> np.uint64(24), body >> np.uint64(16), n


def _low_bytes(values: np.ndarray, count: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :count]


def _number(low: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, : low.shape[1]] = low
    return wide.view("<u8").ravel()


def _keyed(documents: DataFrame, carried: list[str]) -> DataFrame:
    """Id, text bytes and the text's hash, which parts rows of one id; and the columns that go along."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text")]
    return documents.select(*own, F.col("text").isNull().alias("absent"), F.struct(*(carried or [F.lit(0).alias("_none")])).alias("rest"))


def _pieces_of(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    view = ByteView(texts)
    if len(view.data) <= _TEXT_SLICE // 2:
        yield pieces(view.data, view.bounds, length)
        return
    # one very long text: overlapping stretches, so that each window lies in one of them
    stretch = _TEXT_SLICE // 4
    for k in range(0, len(view.data) - length + 1, stretch):
        part = view.data[k : k + stretch + length - 1]
        doc, start, *rest = pieces(part, np.array([0, len(part)]), length)
        yield doc, start + k, *rest


def _list_pieces(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    for batch in (group for batch in batches for group in slices(batch, most_bytes=_TEXT_SLICE)):
        found, at = [], 0
        for part in slices(batch, most_bytes=_TEXT_SLICE // 8):
            found += [(doc + at, *rest) for doc, *rest in _pieces_of(part.column("text"), length)]
            at += part.num_rows
        if found:
            doc, start, anchor, body, n = (np.concatenate(x) for x in zip(*found))
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("th").to_numpy()
            order = np.lexsort((start, hashes[doc], ids[doc], body, anchor))
            doc, start, anchor, body, n = (x[order] for x in (doc, start, anchor, body, n))
            again = np.zeros(len(doc), bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (body[1:] == body[:-1])
            # rows equal in id and text are one occurrence
            lead = np.flatnonzero(~again)
            head = lead[np.cumsum(~again) - 1] if len(doc) else lead
            again &= ~((ids[doc] == ids[doc[head]]) & (hashes[doc] == hashes[doc[head]]) & (start == start[head]))
            items = np.zeros(len(doc), _ITEM)
            items["doc"], items["start"], items["n"] = doc, start, n
            items["anchor"], items["body"] = _low_bytes(anchor, 5), _low_bytes(body, 6)
            known = np.stack([ids, hashes], axis=1).astype("<i8")
            rows = []
            for whole, mask in ((True, again), (False, ~again)):
                chosen = items[mask]
                where = (_mix(anchor[mask]) % np.uint64(buckets)).astype(np.int64)
                if whole:  # decided here; dealt by document
                    where = chosen["doc"].astype(np.int64) % buckets
                by = np.argsort(where, kind="stable")
                edge = np.searchsorted(where[by], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edge)):
                    own = chosen[by[edge[b] : edge[b + 1]]]
                    used, own_doc = np.unique(own["doc"], return_inverse=True)
                    own["doc"] = own_doc
                    rows.append((int(b), whole, known[used].tobytes(), own.tobytes()))
            yield batch_of(_PIECES, *(list(x) for x in zip(*rows))) if rows else pa.RecordBatch.from_pylist([], schema_of(_PIECES))


def _judge_pieces(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The pieces to remove whole, and those whose text has to be compared, dealt by document."""
    items, known = [], []
    for batch in batches:
        settled = []
        for whole, docs, content in zip(*(batch.column(c).to_pylist() for c in ("whole", "docs", "items"))):
            item = np.frombuffer(content, _ITEM)
            own = np.frombuffer(docs, "<i8").reshape(-1, 2)[item["doc"]]
            if whole:  # decided where it was found
                settled.append((own, _decided(item, np.zeros(len(item), bool))))
            else:
                items.append(item)
                known.append(own)
        if settled:
            yield _dealt_by_document(*(np.concatenate(x) for x in zip(*settled)), buckets)
    if not items:
        return
    item, known = np.concatenate(items), np.concatenate(known)
    items.clear()
    anchor, body = _number(item["anchor"]), _number(item["body"])
    order = np.lexsort((item["start"], known[:, 1], known[:, 0], body, anchor))
    item, known, anchor, body = item[order], known[order], anchor[order], body[order]
    new_anchor = np.ones(len(item), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_body = new_anchor.copy()
    new_body[1:] |= body[1:] != body[:-1]
    group = np.cumsum(new_anchor) - 1
    shared = np.bincount(group, weights=new_body) > 1
    head = np.flatnonzero(new_body)[np.cumsum(new_body) - 1]
    first = (known[:, 0] == known[head, 0]) & (known[:, 1] == known[head, 1]) & (item["start"] == item["start"][head])
    ask = first & shared[group]
    use = ~first | ask
    yield _dealt_by_document(known[use], _decided(item[use], ask[use]), buckets)


def _dealt_by_document(known: np.ndarray, decided: np.ndarray, buckets: int) -> pa.RecordBatch:
    where = (_mix((known[:, 0] ^ known[:, 1]).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(where, kind="stable")
    edge = np.searchsorted(where[by], np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(edge))
    parts = [by[edge[k] : edge[k + 1]] for k in filled]
    return batch_of(_DECISIONS, filled, [known[i].tobytes() for i in parts], [decided[i].tobytes() for i in parts])


def _decided(item: np.ndarray, ask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(item), _DECIDED)
    for name in ("start", "n", "anchor"):
        out[name] = item[name]
    out["ask"] = ask
    return out


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: windows to remove, and pieces to compare."""
    docs, items = [], []
    for batch in batches:
        docs += [np.frombuffer(x, "<i8").reshape(-1, 2) for x in batch.column("docs").to_pylist()]
        items += [np.frombuffer(x, _DECIDED) for x in batch.column("items").to_pylist()]
    if not docs:
        return
    known, item = np.concatenate(docs), np.concatenate(items)
    order = np.lexsort((item["start"], known[:, 1], known[:, 0]))
    known, item = known[order], item[order]
    fresh = np.concatenate([[True], (known[1:] != known[:-1]).any(axis=1)])
    edge = np.append(np.flatnonzero(fresh), len(known))
    ranges = np.zeros(len(item), _RANGE)
    ranges["start"], ranges["n"] = item["start"], item["n"]
    for k in range(0, len(edge) - 1, 20000):
        cut = [(slice(a, b), item["ask"][a:b] == 1) for a, b in zip(edge[k : k + 20000], edge[k + 1 : k + 20001])]
        at = edge[k : k + 20000][: len(cut)]
        asks = [np.unique(item[s][a]).tobytes() if a.any() else b"" for s, a in cut]  # rows equal in id and text ask once
        yield batch_of(_FOUND, known[at, 0], known[at, 1], [ranges[s][~a].tobytes() for s, a in cut], asks)


def _ranges(blobs, extra: int) -> np.ndarray:
    """Ascending disjoint (begin, end) rows of the bytes that the blobs' windows cover."""
    item = np.frombuffer(b"".join(b for b in blobs if b), _RANGE)
    if not len(item):
        return np.zeros((0, 2), np.int64)
    begin = item["start"].astype(np.int64)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate((begin + item["n"] + extra)[order])
    fresh = np.ones(len(begin), bool)
    fresh[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(fresh)
    return np.stack([begin[at], end[np.append(at[1:], len(begin)) - 1]], axis=1)


_TEXTS = "anchor long, doc_id long, th long, start int, piece binary"


def _fetch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The text of every piece asked for, with its anchor."""
    for batch in (part for batch in batches for part in slices(batch)):
        out = ([], [], [], [], [])
        for doc, th, text, asks in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "asks"))):
            item = np.frombuffer(asks, _DECIDED)
            starts, ends = item["start"].tolist(), (item["start"].astype(np.int64) + item["n"] + length - 1).tolist()
            out[0].extend(_number(item["anchor"]).tolist())
            out[1].extend([doc] * len(item))
            out[2].extend([th] * len(item))
            out[3].extend(starts)
            out[4].extend([text[a:b] for a, b in zip(starts, ends)])
        yield batch_of(_TEXTS, *out)


def _compare(batches: Iterator[pa.RecordBatch], length: int, most_bytes: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Windows that stand earlier in another piece of their anchor."""
    table = pa.Table.from_batches(batches, schema_of(_TEXTS)).sort_by("anchor").combine_chunks()
    if not table.num_rows:
        return
    anchor = table.column("anchor").to_numpy()
    size = pc.binary_length(table.column("piece")).to_numpy()
    edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))
    before = np.concatenate([[0], np.cumsum(size)])
    low = 0
    while low < len(edge) - 1:
        high = low + 1
        while high < len(edge) - 1 and before[edge[high + 1]] - before[edge[low]] <= most_bytes:
            high += 1
        part = table.slice(edge[low], edge[high] - edge[low])
        low = high
        owner, offset, block = repeated_intervals(part.column("piece").to_pylist(), length)
        doc, th = part.column("doc_id").to_numpy()[owner], part.column("th").to_numpy()[owner]
        start = part.column("start").to_numpy()[owner].astype(np.int64) + offset
        order = np.lexsort((start, th, doc, block))
        doc, th, start, block = doc[order], th[order], start[order], block[order]
        if not len(doc):
            continue
        lead = np.concatenate([[True], block[1:] != block[:-1]])
        head = np.flatnonzero(lead)[np.cumsum(lead) - 1]
        later = (doc != doc[head]) | (th != th[head]) | (start != start[head])
        doc, th, start = doc[later], th[later], start[later]
        order = np.lexsort((start, th, doc))
        doc, th, start = doc[order], th[order], start[order]
        if not len(doc):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]), [True]]))
        packed = np.zeros(len(doc), _RANGE)
        packed["start"], packed["n"] = start, 1
        yield batch_of(_FOUND, doc[cut[:-1]], th[cut[:-1]], [packed[a:b].tobytes() for a, b in zip(cut, cut[1:])], [b""] * (len(cut) - 1))


_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            out = ([], [], [], [], [])
            for doc, text, blobs in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                spans = _ranges(blobs or [], length - 1).tolist()
                at, kept = 0, []
                for begin, end in spans:
                    kept.append(text[at:begin])
                    at = end
                kept.append(text[at:])
                removed = sum(e - b for b, e in spans)
                for column, value in zip(out, (None if doc == _NO_ID else doc, len(text), removed, len(spans), b"".join(kept))):
                    column.append(value)
            yield batch_of(_CUT, *out)


def remove_repeats(documents: DataFrame, length: int = LENGTH, bucket_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every row."""
    marked = find_repeats(documents, length, bucket_bytes)
    return marked.select("doc_id", "text", "spans").mapInArrow(tidied(lambda batches: _cut(batches, length)), _CUT)


def find_repeats(documents: DataFrame, length: int = LENGTH, bucket_bytes: int = 16 << 20, carried: list[str] | None = None) -> DataFrame:
    """doc_id, text (bytes), spans (packed windows to remove), absent (the text was null) and rest (the carried columns) of every row.

    ``bucket_bytes`` of text fall to one task of the hash stage.
    """
    spark = documents.sparkSession
    carried = carried or []
    rows = _keyed(documents, carried)
    total = documents.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    listed = rows.select("doc_id", "th", "text").mapInArrow(tidied(lambda batches: _list_pieces(batches, buckets, length)), _PIECES)
    judged = listed.repartition(buckets, "bucket").mapInArrow(tidied(lambda batches: _judge_pieces(batches, buckets)), _DECISIONS)
    found = materialize(judged.repartition(buckets, "bucket").mapInArrow(tidied(_by_document), _FOUND), "pieces")
    marked = materialize(rows.join(found, ["doc_id", "th"], "left"), "marked")
    asking = marked.where(F.length("asks") > 0)
    windows = (
        asking.select("doc_id", "th", "text", "asks").mapInArrow(tidied(lambda batches: _fetch(batches, length)), _TEXTS)
        .repartition(buckets, "anchor").mapInArrow(tidied(lambda batches: _compare(batches, length)), _FOUND)
    )
    later = materialize(windows.select("doc_id", "th", "spans"), "windows").groupBy("doc_id", "th").agg(F.collect_list("spans").alias("more"))
    settled = marked.where(F.coalesce(F.length("asks"), F.lit(0)) == 0).withColumn("spans", F.array("spans"))
    open_ = asking.join(later, ["doc_id", "th"], "left").withColumn("spans", F.concat(F.array("spans"), F.coalesce("more", F.array())))
    columns = ["doc_id", "text", "spans", "absent", "rest"]
    return settled.select(*columns).union(open_.select(*columns))


def clean_documents(documents: DataFrame, length: int = LENGTH, bucket_bytes: int = 16 << 20) -> DataFrame:
    """The documents (doc_id, text, lang, source, n_chars and the like) with repeats cut out of the text.

    All columns stay; ``n_chars``, if there, follows the new text. A character
    that loses some of its bytes is dropped whole. Null texts stay null.
    """
    names = documents.columns
    carried = [c for c in names if c != "text"]
    marked = find_repeats(documents, length, bucket_bytes, [c for c in carried if c != "doc_id"])
    schema = StructType().add("doc_id", "long").add("text", "binary").add("rest", marked.schema["rest"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch)):
            texts = []
            for text, blobs, absent in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "absent"))):
                spans = _ranges(blobs or [], length - 1).tolist()
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                texts.append(None if absent else kept.decode("utf-8", "ignore").encode() if spans else text)
            ids = [None if d == _NO_ID else d for d in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), batch.column("rest")], names=["doc_id", "text", "rest"])

    done = marked.mapInArrow(tidied(run), schema)
    done = done.select("doc_id", F.col("text").cast("string").alias("text"), *[F.col("rest").getField(c).alias(c) for c in carried if c != "doc_id"])
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*names)
