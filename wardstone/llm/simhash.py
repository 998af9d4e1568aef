"""Near copies by SimHash and BK-trees.

A document's fingerprint has a bit set when over half of its shingles' hashes
have it. Fingerprints within ``radius`` bits are linked; linked documents form
groups. The fingerprints are cut into blocks of bits. Two that differ in at most
``radius`` bits agree on some pair of blocks, so every pair of block values names
a shard, and each shard gets its own BK-tree: children are keyed by their
distance to the parent, and a search follows only edges within the radius. A
shard hands on one link per fingerprint it joins, not all pairs, which keeps
every connection.

Equal fingerprints are merged first, so a mass of copies is one tree node.

Defined results: a null text is an empty one; a text without a word has
fingerprint zero and links like any other. A null id can join a group, but the
group's id is its smallest id that is not null. Repeated rows are copies of each
other and all returned. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, map_batches
from wardstone.llm.components import connected
from wardstone.session import materialize

BITS = 64
#: Fingerprints in one BK-tree at most; larger shards are compared slice by slice.
MOST_IN_TREE = 20000
_ROWS_PER_TASK = 2_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PRINTS = "fp long"


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) > shingle:
        starts, ends = start[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist()
    else:
        starts, ends = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


class BkTree:
    """BK-tree over distinct integers; a search can take what it finds out of the tree."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{}]
        self.live = [True] * len(values)
        self.below = [1] * len(values)  # live nodes in the subtree
        self.parent = [-1]
        for i in range(1, len(values)):
            self._add(i)

    def _add(self, i: int) -> None:
        values, node, value = self.values, 0, self.values[i]
        while True:
            self.below[node] += 1
            children = self.children[node]
            d = (values[node] ^ value).bit_count()
            if d not in children:
                children[d] = i
                self.children.append({})
                self.parent.append(node)
                return
            node = children[d]

    def take(self, value: int, radius: int) -> list[int]:
        """Indices of live nodes within the radius; they are dead afterwards."""
        found, stack = [], [0]
        while stack:
            node = stack.pop()
            if not self.below[node]:
                continue
            d = (self.values[node] ^ value).bit_count()
            if d <= radius and self.live[node]:
                found.append(node)
            stack += [c for k, c in self.children[node].items() if d - radius <= k <= d + radius]
        for i in found:
            self.live[i] = False
            node = i
            while node >= 0:
                self.below[node] -= 1
                node = self.parent[node]
        return found


def shard_groups(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest of its group) for every value that is linked to another one here."""
    if len(values) == 2:
        a, b = sorted(values)
        return [(b, a)] if (a ^ b).bit_count() <= radius else []
    tree = BkTree(values)
    out = []
    for i in range(len(values)):
        if not tree.live[i]:
            continue
        group, k = tree.take(values[i], radius), 0
        while k < len(group):
            group += tree.take(values[group[k]], radius)
            k += 1
        least = min(values[g] for g in group)
        out += [(values[g], least) for g in group if values[g] != least]
    return out


def block_pairs(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks: at least two stay equal under ``radius`` changed bits."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def fingerprints(documents: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row."""
    ddl = "doc_id long, fp long"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], np.uint64)
        return batch_of(ddl, batch.column("doc_id"), prints.view(np.int64))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, ddl)


def links(distinct: DataFrame, radius: int, tasks: int) -> DataFrame:
    """Links (src, dst) between distinct fingerprints that connect all pairs within the radius."""
    blocks = block_pairs(radius)
    keys = []
    for n, (a, b) in enumerate(combinations(range(len(blocks)), 2)):
        part = [F.shiftrightunsigned("fp", blocks[i][0]).bitwiseAND(F.lit((1 << blocks[i][1]) - 1)) for i in (a, b)]
        keys.append(part[0] * F.lit(1 << blocks[b][1]) + part[1] + F.lit(n << 32))
    shards = distinct.select("fp", F.explode(F.array(*keys)).alias("shard"))
    hot = shards.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > MOST_IN_TREE)
    slices = hot.select("shard", F.ceil(F.col("n") / MOST_IN_TREE).cast("long").alias("slices"))
    # a crowded shard becomes slices, and every two slices a shard of their own
    shards = shards.join(slices, "shard", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("slices"))
    shards = shards.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    shards = shards.select("fp", "shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    shards = shards.select("fp", F.when(F.col("high") == 0, F.col("shard")).otherwise(F.xxhash64("shard", "low", "high")).alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("fp", pa.int64()), ("shard", pa.int64())]))
        fp, shard = table.column("fp").to_numpy(), table.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        fp, shard = fp[order], shard[order]
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, int)
        size = np.diff(np.append(first, len(shard)))
        src, dst = [], []
        for at, n in zip(first[size > 1], size[size > 1]):
            for s, d in shard_groups(fp[at : at + n].view(np.uint64).tolist(), radius):
                src.append(s)
                dst.append(d)
        yield batch_of("src long, dst long", np.array(src, np.uint64).view(np.int64), np.array(dst, np.uint64).view(np.int64))

    return shards.repartition(tasks, "shard").mapInArrow(run, "src long, dst long").distinct()


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """(node, component) of the fingerprints (fp) that lie within the radius of another one."""
    distinct = prints.select("fp").distinct()
    shuffles = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = len(block_pairs(radius))
    tasks = max(shuffles, prints.count() * blocks * (blocks - 1) // 2 // _ROWS_PER_TASK)
    return connected(links(distinct, radius, tasks))


def near_copies(documents: DataFrame, shingle: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = materialize(fingerprints(documents, shingle, seed), "simhash")
    root = _components(prints, radius)
    grouped = (
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
        .join(root, F.col("fp") == F.col("node"), "left")
        .select("fp", F.coalesce("component", "fp").alias("component"), "least")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, shingle: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """One row of each component, columns as they were: the one with the smallest id.

    Rows without an id come last; rows of one id are ordered by a hash of the
    text, then of their other columns. Of rows equal in all of that one stays.
    """
    names = documents.columns
    others = [x for c in names if c not in ("doc_id", "text") for x in (F.col(c).isNull(), F.col(c))]
    key = ["_no_id", "_id", "_th", "_rest"]
    own = [
        F.col("doc_id").isNull().alias("_no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_th"), F.xxhash64(F.col("text").isNull(), *others).alias("_rest"),
    ]
    ddl = "_no_id boolean, _id long, _th long, _rest long, fp long"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], np.uint64)
        return batch_of(ddl, *(batch.column(c) for c in key), prints.view(np.int64))

    prints = materialize(map_batches(documents.select(*own, F.col("text").cast("string").alias("text")), run, ddl), "simhash")
    root = _components(prints, radius)
    counted = prints.groupBy(*key, "fp").agg(F.count("*").alias("_n"))
    least = counted.groupBy("fp").agg(F.min(F.struct(*key, "_n")).alias("least"))
    least = least.join(root, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp")).agg(F.min("least").alias("least"))
    chosen = materialize(least.select("least.*"), "kept")
    keyed = documents.select(*own, *names)
    lone = keyed.join(chosen.where("_n = 1"), key, "left_semi")
    twins = keyed.join(chosen.where("_n > 1"), key, "left_semi").dropDuplicates(key)
    return lone.select(*names).union(twins.select(*names))
