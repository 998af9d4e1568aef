"""Prefix trie of conversations, rolled up by centroid decomposition.

**Trie.** Turns are ranked by one range sort over all conversations, so that a
conversation of any length spreads over tasks; its turns before a range are
added from counts per range. A prefix is known by its depth and by two 64-bit
words, the exclusive or of hashes of (place, role, text) of its turns, taken
block by block of places; together over 128 bits, which no two prefixes are
expected to share. Equal prefixes are one node, named by its smallest member
and its depth.

**Rollup.** What is summed over subtrees comes from a centroid decomposition of
the forest of parent edges. A node weighs its members, so the weight of every
subtree is known at the start: the turns its members have from there on. In
each round and component:

1. The nodes that hold more than half of the component's weight are a path from
   its top down; the lowest is the centroid.
2. The subtrees below the centroid become components of their own, the rest
   stays one without them. No part keeps more than half the weight, so rounds
   grow with the logarithm of the turns, however deep the trie is.
3. The totals below the centroid are added up, the centroid's own value with
   them, and the sum is added to every node of the path, the centroid included.

A node lies below the centroid if the prefix of its smallest member at the
centroid's depth is the centroid: one lookup per component and member.
Components of at most ``local`` nodes are dealt to tasks, which decompose them
further by the same three steps in memory.

**Digests.** Ids of a node's ending members are joined block by block of id
values, and each node's blocks pass one digest in order, so memory is bounded
although the digest itself is one sequence.

Defined results: turns of one number are ordered by role and text, and equal
ones count as often as they stand there. A null role or text is empty; rows
without conv_id belong to no conversation and are left out; an empty table
gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, schema_of
from wardstone.session import materialize

#: Turns of one block of places, ids of one block of a digest, nodes that one task decomposes.
TURN_BLOCK = 1024
ID_BLOCK = 4096
LOCAL = 50_000
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), n_turns, two hashes of (role, text) and the text's code points, of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("_row")
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "_row"]
    placed = rows.repartitionByRange(_parts(turns), *order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    stored = materialize(
        placed.select("conv_id", F.monotonically_increasing_id().alias("seq"), part(1).alias("d1"), part(16).alias("d2"), F.length("text").cast("long").alias("points")), "turns"
    )
    spot = stored.withColumn("part", F.shiftright("seq", _ROW_BITS)).withColumn("row", F.col("seq").bitwiseAND((1 << _ROW_BITS) - 1))
    runs = spot.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))  # one row a conversation and range
    whole = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("conv_id", "part", (before - F.col("first") + 1).alias("base"), F.sum("n").over(whole).alias("n_turns"))
    return spot.join(runs, ["conv_id", "part"]).select("conv_id", (F.col("row") + F.col("base")).alias("pos"), "n_turns", "d1", "d2", "points")


def _head(conv: Column, most: int) -> Column:
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(most))


def rebuilt(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation; and its turns as conv_id, depth, length, d1, d2, points."""
    ranked = materialize(ranked_turns(turns), "ranked")
    own = ranked.where("pos = 1").select("conv_id", "n_turns")
    donors = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("donor"), F.col("n_turns").alias("lent"))
    head = _head(F.col("conv_id"), heads)
    shaped = own.withColumn("h", head).withColumn("donor", F.col("conv_id") - F.col("conv_id") % family).join(donors, "donor", "left")
    lent = F.least("h", F.coalesce("lent", F.lit(0)))
    convs = materialize(shaped.select("conv_id", "donor", "h", lent.alias("lent"), (lent + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length")), "convs")
    kept = ranked.withColumn("h", head).where("pos > h").join(convs.select("conv_id", "lent", "length"), "conv_id")
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("depth"), "length", "d1", "d2", "points")
    openings = ranked.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads)).select(F.col("conv_id").alias("donor"), "pos", "d1", "d2", "points")
    taken = convs.join(openings, "donor").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "length", "d1", "d2", "points")
    return convs.select("conv_id", "length"), kept.union(taken)


def prefixes(steps: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """The turns with the key (a, b) of the prefix that they end and the key (pa, pb) of the one before."""
    hashed = steps.withColumn("x", F.xxhash64("depth", "d1", "d2")).withColumn("y", F.xxhash64("d2", "depth", "d1")).withColumn("block", F.floor((F.col("depth") - 1) / block))
    hashed = hashed.drop("d1", "d2")
    totals = hashed.where(F.col("length") > block).groupBy("conv_id", "block").agg(F.bit_xor("x").alias("tx"), F.bit_xor("y").alias("ty"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    carried = totals.select("conv_id", "block", F.bit_xor("tx").over(earlier).alias("ox"), F.bit_xor("ty").over(earlier).alias("oy"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = hashed.withColumn("rx", F.bit_xor("x").over(inside)).withColumn("ry", F.bit_xor("y").over(inside)).join(carried, ["conv_id", "block"], "left")
    a, b = F.col("rx").bitwiseXOR(F.coalesce("ox", F.lit(0).cast("long"))), F.col("ry").bitwiseXOR(F.coalesce("oy", F.lit(0).cast("long")))
    return run.select("conv_id", "depth", "length", "points", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("pa"), b.bitwiseXOR(F.col("y")).alias("pb"))


def digests(ends: DataFrame, key: list[str]) -> DataFrame:
    """Per key the SHA-256 of its conv_ids, ascending and joined by commas."""
    blocks = ends.withColumn("block", F.floor(F.col("conv_id") / ID_BLOCK)).groupBy(*key, "block").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = blocks.select(*key, "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    schema = ", ".join(f"{k} long" for k in key) + ", ends_sha256 string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for batch in batches:
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"])):
                if node == now:
                    digest.update(b"," + ids.encode())
                else:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
            if done:
                yield batch_of(schema, *(list(x) for x in zip(*done)))
                done = []
        if now is not None:
            yield batch_of(schema, *([x] for x in (*now, digest.hexdigest())))

    return texts.repartition(_parts(ends), *key).sortWithinPartitions(*key, "block").select(*key, "ids").mapInArrow(run, schema)


# ---- rollup ----

_NODE = ["conv_id", "depth", "parent"]
_LOCAL = "conv_id long, depth long, top_conv long, top_depth long, parent long, weight long, leaves long, saved long, sum_leaves long, sum_saved long"
_SUMS = "conv_id long, depth long, sum_leaves long, sum_saved long"


def decompose(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of the rows of ``values`` in a forest, by centroid decomposition.

    A parent stands before its children; -1 marks a top. ``weight`` is each
    node's subtree weight, strictly larger than that of all its children together.
    """
    n = len(parent)
    sums, weight, label = np.zeros_like(values), weight.copy(), np.arange(n)
    depth = np.zeros(n, np.int64)
    for v in range(n):
        if parent[v] >= 0:
            label[v], depth[v] = label[parent[v]], depth[parent[v]] + 1
    active = np.arange(n)
    while len(active):
        most = np.zeros(n, np.int64)
        np.maximum.at(most, label[active], weight[active])
        heavy = active[2 * weight[active] > most[label[active]]]
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, label[heavy], weight[heavy])
        lowest = heavy[weight[heavy] == least[label[heavy]]]
        centroid = np.full(n, -1)
        centroid[label[lowest]] = lowest
        # below the centroid, level by level: a child of the centroid tops a component, deeper nodes follow their parents
        moved = np.full(n, -1)
        below = active[depth[active] > depth[centroid[label[active]]]]
        below = below[np.argsort(depth[below], kind="stable")]
        for level in np.split(below, np.flatnonzero(np.diff(depth[below])) + 1):
            up = parent[level]
            moved[level] = np.where(up == centroid[label[level]], level, np.where(up >= 0, moved[up], -1))
        under = active[moved[active] >= 0]
        total = np.zeros((n, values.shape[1]), values.dtype)
        np.add.at(total, label[under], values[under])
        np.add.at(total, label[lowest], values[lowest])
        sums[heavy] += total[label[heavy]]
        weight[heavy] -= weight[centroid[label[heavy]]]
        label[under] = moved[under]
        gone = np.zeros(n, bool)
        gone[lowest] = True
        active = active[~gone[active]]
    return sums


def _decompose_locally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    column = {c: table.column(c).to_numpy() for c in schema_of(_LOCAL).names}
    order = np.argsort(column["depth"], kind="stable")
    column = {c: x[order] for c, x in column.items()}
    place = {node: i for i, node in enumerate(zip(column["conv_id"].tolist(), column["depth"].tolist()))}
    top = (column["conv_id"] == column["top_conv"]) & (column["depth"] == column["top_depth"])
    parents = zip(column["parent"].tolist(), (column["depth"] - 1).tolist(), top.tolist())
    parent = np.array([-1 if is_top else place[(conv, depth)] for conv, depth, is_top in parents], np.int64)
    sums = decompose(parent, column["weight"], np.stack([column["leaves"], column["saved"]], axis=1))
    yield batch_of(_SUMS, column["conv_id"], column["depth"], column["sum_leaves"] + sums[:, 0], column["sum_saved"] + sums[:, 1])


def subtree_sums(nodes: DataFrame, paths: DataFrame, local: int = LOCAL) -> tuple[DataFrame, int]:
    """conv_id, depth, sum_leaves and sum_saved of every node, and the number of distributed rounds.

    ``nodes``: conv_id, depth, parent, weight (of the subtree), leaves, saved.
    ``paths``: for each node's conv_id and depth d, node: the conv_id that names its prefix of d turns.
    """
    state = nodes.select(*_NODE, "weight", "leaves", "saved", F.lit(0).cast("long").alias("sum_leaves"), F.lit(0).cast("long").alias("sum_saved"))
    first = nodes.where("depth = 0").agg(F.min("conv_id").alias("top_conv")).select("top_conv", F.lit(0).cast("long").alias("top_depth"))
    state = state.crossJoin(F.broadcast(first))  # one row: the root
    done, rounds, top = [], 0, ["top_conv", "top_depth"]
    while True:
        sizes = materialize(state.groupBy(*top).agg(F.count("*").alias("n"), F.max("weight").alias("most")).where(F.col("n") > local), "sizes")
        large = sizes.count()
        marked = state.join(sizes.drop("n"), top, "left")
        small = marked.where(F.col("most").isNull()).select(*[c.strip().split(" ")[0] for c in _LOCAL.split(",")])
        done.append((small, _parts(nodes) if rounds or large else 1))
        if not large:
            break
        rounds += 1
        split = _split(marked.where(F.col("most").isNotNull()), paths, top)
        done.append((split.where("gone").select("conv_id", "depth", "sum_leaves", "sum_saved"), 0))
        state = split.where("not gone").drop("gone")
    out = None
    for frame, tasks in done:
        if tasks:
            frame = frame.repartition(max(1, tasks), *top).mapInArrow(_decompose_locally, _SUMS)
        out = frame if out is None else out.union(frame)
    return out, rounds


def _split(state: DataFrame, paths: DataFrame, top: list[str]) -> DataFrame:
    """One round: components without their centroids, sums of the paths, and the centroids marked as gone."""
    state = state.withColumn("heavy", F.col("weight") * 2 > F.col("most"))
    lowest = state.where("heavy").groupBy(*top).agg(F.min_by(F.struct("conv_id", "depth"), "weight").alias("c"), F.min("weight").alias("c_weight"))
    centroids = materialize(lowest.select(*top, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), "c_weight"), "centroids")
    known = state.join(centroids, top)
    # a component's nodes of one name have one answer: whose prefix at the centroid's depth is the centroid lies below it
    asked = known.where("depth > c_depth").select(*top, "conv_id", "c_conv", "c_depth").distinct()
    at = paths.select("conv_id", F.col("depth").alias("to_depth"), F.col("node").alias("to_node"), "parent_node")
    below = asked.withColumn("to_depth", F.col("c_depth") + 1).join(at, ["conv_id", "to_depth"]).where("parent_node = c_conv")
    moved = below.select(*top, "conv_id", F.col("to_node").alias("new_conv"), F.col("to_depth").alias("new_depth"))
    labelled = known.join(moved, [*top, "conv_id"], "left")
    under = F.col("new_conv").isNotNull() & (F.col("depth") > F.col("c_depth"))
    centre = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    labelled = materialize(labelled.withColumn("under", F.coalesce(under, F.lit(False))).withColumn("gone", centre), "labelled")
    totals = labelled.where("under or gone").groupBy(*top).agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
    full = labelled.join(totals, top)
    add = lambda c, t: F.when(F.col("heavy"), F.col(c) + F.col(t)).otherwise(F.col(c)).alias(c)
    return materialize(
        full.select(
            *_NODE, F.when(F.col("heavy"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"), "leaves", "saved",
            add("sum_leaves", "t_leaves"), add("sum_saved", "t_saved"),
            F.when(F.col("under"), F.col("new_conv")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("under"), F.col("new_depth")).otherwise(F.col("top_depth")).alias("top_depth"), "gone",
        ),
        "split",
    )


# ---- operator ----


def prefix_trie(turns: DataFrame, family: int = 100, heads: int = 6, local: int = LOCAL) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Conversation c opens with the first turns of the conversation that leads its
    family of ``family`` ids, as many as CRC-32 of c modulo ``heads``, in place
    of its own first turns.
    """
    convs, steps = rebuilt(turns, family, heads)
    zero = F.lit(0).cast("long")
    steps = materialize(prefixes(steps), "steps")
    starts = convs.select("conv_id", zero.alias("depth"), "length", zero.alias("points"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"))
    rows = steps.union(starts)
    key = ["depth", "a", "b"]
    grouped = rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("points").alias("points"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    grouped = materialize(grouped, "prefixes")
    above = grouped.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    linked = materialize(grouped.join(above, ["depth", "pa", "pb"], "left"), "linked")
    children = linked.where("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    ended = digests(rows.where("depth = length").select(*key, "conv_id"), key)
    nodes = linked.join(children, ["conv_id", "depth"], "left").join(ended, key, "left")
    nodes = materialize(nodes.withColumn("n_children", F.coalesce("n_children", zero)).drop("pa", "pb"), "nodes")
    # each name's way from the root: the names of its prefixes
    names = linked.select("conv_id").distinct()
    ways = rows.select("conv_id", *key).join(names, "conv_id", "left_semi")
    paths = materialize(ways.join(linked.select(*key, F.col("conv_id").alias("node"), F.col("parent").alias("parent_node")), key).select("conv_id", "depth", "node", "parent_node"), "paths")
    values = nodes.select("conv_id", "depth", "parent", "weight", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    sums, _ = subtree_sums(values, paths, local)
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, ["conv_id", "depth"]).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
