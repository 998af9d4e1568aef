"""K-means with planar bounds, the prefix trie, and token counts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardstone.llm import kmeans, prefixtrie, tokencounts
from wardstone.llm.queries import QUERIES
from wardstone.llm.tokens import public_tokenizer

SF = "/root/testdata/sf0.001"
MODEL = "piece_bpe_32k.model"

# ---- k-means ----


def plain_kmeans(rows, k, rounds, scale=64):
    x = np.array([[int(np.floor(scale * float(c))) for c in v] for _, v in rows], np.int64)
    first = sorted(range(len(rows)), key=lambda i: hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest())[:k]
    centroids = x[first].copy()
    distances = lambda: np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    for _ in range(rounds):
        own = distances().argmin(axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                centroids[c] = x[own == c].sum(axis=0) // int((own == c).sum())
    d = distances()
    return d.argmin(axis=1), d.min(axis=1), centroids


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def clustered(count, size, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size)) * 4
    points = centres[rng.integers(0, 6, count)] + rng.normal(size=(count, size)) * 0.2
    return [(i, [float(c) for c in p.astype(np.float32)]) for i, p in enumerate(points)]


@pytest.mark.parametrize("rows", [clustered(300, 4), clustered(40, 4, 1) * 2])
def test_kmeans_equals_brute_force(spark, rows):
    rows = [(i, v) for i, (_, v) in enumerate(rows)]  # repeated vectors, own ids
    own, distance, centroids = plain_kmeans(rows, 5, 4)
    got = {r["vec_id"]: r for r in kmeans.cluster(vectors(spark, rows), k=5, rounds=4, size=4).collect()}
    assert len(got) == len(rows)
    for i in range(len(rows)):
        r = got[i]
        assert (r["cluster"], r["distance"]) == (own[i], distance[i])
        assert r["cluster_inertia"] == distance[own == own[i]].sum() and r["inertia"] == distance.sum()
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[own[i]])).encode()).hexdigest()


def test_bounds_spare_scans(spark):
    found, _, states = kmeans.assignments(vectors(spark, clustered(400, 4)), k=5, rounds=4, size=4)
    scanned = [s.where("scanned").count() for s in states]
    assert scanned[0] == 400 and scanned[-1] < 100
    assert found.count() == 400


def test_stored_bounds_hold(spark):
    rows = clustered(200, 3)
    _, centroids, states = kmeans.assignments(vectors(spark, rows), k=4, rounds=3, size=3)
    x = {i: np.floor(64 * np.array(v)).astype(np.int64) for i, v in rows}
    own, _, after = plain_kmeans(rows, 4, 2)
    for r in states[2].collect():
        d = np.sqrt(((x[r["vec_id"]] - after) ** 2).sum(axis=1))
        others = np.delete(d, r["cluster"])
        assert r["cluster"] == d.argmin() and r["upper"] >= d.min() - 1e-6 and r["lower"] <= others.min() + 1e-6


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 5), st.floats(0, 30))
def test_planar_relaxation_bounds_every_point_of_the_ball(seed, size, radius):
    rng = np.random.default_rng(seed)
    old, new = rng.integers(-40, 40, (3, size)), rng.integers(-40, 40, (3, size))
    relax = kmeans.planar_relaxation(old, new, np.full(3, radius))
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    assert (relax <= drift[None, :] + 1e-9).all()
    way = rng.normal(size=(200, size))
    ball = way / np.linalg.norm(way, axis=1, keepdims=True) * radius * rng.random((200, 1)) ** 0.2
    for i in range(3):
        nearer = np.linalg.norm(old[i] + ball[:, None] - old[None], axis=2) - np.linalg.norm(old[i] + ball[:, None] - new[None], axis=2)
        assert (nearer <= relax[i][None, :] + 1e-6).all()


def test_planar_relaxation_is_less_than_drift():
    old, new = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [100, 50]])
    assert kmeans.planar_relaxation(old, new, np.array([5.0, 1.0]))[0, 1] < 5


def test_kmeans_odd_rows(spark):
    good = [(i, [0.5 * i, -0.25]) for i in range(4)]
    odd = [(10, None), (11, []), (12, [1.0]), (13, [1.0, None]), (14, [float("nan"), 0.0]), (15, [float("inf"), 0.0]), (None, [0.5, -0.25]), (2, [9.0, 9.0])]
    frame = vectors(spark, good + odd).withColumns({c: F.lit(1) for c in ("cluster", "v", "distance", "before", "label")})
    got = kmeans.cluster(frame, k=16, rounds=2, size=2).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["0", "1", "2", "2", "3", "None"]
    assert all(r["distance"] == 0 for r in got)  # as many centroids as vectors
    assert kmeans.cluster(frame.limit(0), size=2).collect() == []
    with pytest.raises(Exception, match="after scaling"):
        kmeans.cluster(vectors(spark, [(1, [1e30, 0.0])]), size=2).collect()


def test_large_components_stay_exact():
    x = np.array([[2**26, -(2**26)], [3, 5]], np.int64)
    c = np.array([[-(2**26), 2**26], [0, 1]], np.int64)
    assert kmeans.squared(x, c).tolist() == [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for b in c] for a in x]


# ---- prefix trie ----


def plain_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = (not children[node]) + sum(leaves[x] for x in children[node])
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[x] for x in children[node])
        ends = ",".join(map(str, sorted(c for c in members[node] if rebuilt[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node], digest))
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def same_trie(frame, rows):
    return sorted(map(str, (tuple(r) for r in frame.collect()))) == sorted(map(str, plain_trie(rows)))


def random_turns(seed, count=400):
    rng = random.Random(seed)
    ids = [rng.randint(-120, 230) for _ in range(60)] + [5, 100]
    return [(rng.choice(ids), rng.choice([None, 0, 1, 2, 3, 3]), rng.choice(["a", None, ""]), rng.choice(["x", "yy", None, "é", "zzz"])) for _ in range(count)]


@pytest.mark.parametrize("local", [5, 10_000])
def test_trie_equals_brute_force(spark, local):
    rows = random_turns(1) + [(None, 1, "a", "no id")]
    assert same_trie(prefixtrie.prefix_trie(conversations(spark, rows), local=local), rows)


def test_long_and_copied_conversations(spark):
    """One conversation holds most turns, many are copies of one another."""
    rows = [(7, i, "u", f"t{i % 3}") for i in range(120)] + [(8, i, "u", f"t{i % 3}") for i in range(90)] + [(c, i, "u", "same") for c in range(300, 340) for i in range(3)]
    frame = conversations(spark, rows).withColumns({c: F.lit("x") for c in ("depth", "length", "a", "parent", "pos", "weight")})
    assert same_trie(prefixtrie.prefix_trie(frame, local=20), rows)


def test_blocks_of_turns_give_the_same_prefixes(spark):
    rows = [(c, i, "u", f"{i % 5}") for c in (1, 2) for i in range(40)]
    _, steps = prefixtrie.rebuilt(conversations(spark, rows), 100, 6)
    whole, cut = (sorted(map(tuple, prefixtrie.prefixes(steps, block).collect())) for block in (1000, 7))
    assert whole == cut


def test_no_conversations(spark):
    assert prefixtrie.prefix_trie(conversations(spark, [])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_decompose_equals_plain_sums(data):
    n = data.draw(st.integers(1, 40))
    parent = np.array([data.draw(st.integers(-1 if i else -1, i - 1)) for i in range(n)], np.int64)
    own = np.array(data.draw(st.lists(st.integers(1, 9), min_size=n, max_size=n)), np.int64)
    values = np.stack([own * 7 % 5, own], axis=1)
    weight, sums = own.copy(), values.copy()
    for v in range(n - 1, -1, -1):
        if parent[v] >= 0:
            weight[parent[v]] += weight[v]
            sums[parent[v]] += sums[v]
    assert (prefixtrie.decompose(parent, weight, values) == sums).all()


def test_rounds_grow_with_the_logarithm(spark):
    """A path of 200 nodes is halved each round."""
    chain = [(1, d, 1 if d else None, 200 - d, int(d == 199), d) for d in range(200)]
    nodes = spark.createDataFrame(chain, "conv_id long, depth long, parent long, weight long, leaves long, saved long")
    paths = nodes.select("conv_id", "depth", F.lit(1).cast("long").alias("node"), F.col("parent").alias("parent_node"))
    sums, rounds = prefixtrie.subtree_sums(nodes, paths, local=30)
    got = {r["depth"]: (r["sum_leaves"], r["sum_saved"]) for r in sums.collect()}
    assert got == {d: (1, sum(range(d, 200))) for d in range(200)} and 2 <= rounds <= 4


def test_digest_of_many_blocks(spark):
    ids = [5, -9000, 123456, 4096, 4095, 8191, -1]
    frame = spark.createDataFrame([(1, i) for i in ids] + [(2, 3)], "k long, conv_id long")
    got = {r["k"]: r["ends_sha256"] for r in prefixtrie.digests(frame, ["k"]).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), 2: hashlib.sha256(b"3").hexdigest()}


# ---- token counts ----


@pytest.fixture(scope="module")
def counter():
    return tokencounts.PieceCounter(public_tokenizer(MODEL), most_chars=16)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abtheing  \n\t▁é中0=-<s>"), st.characters(codec="utf-8")), max_size=90))
def test_counts_equal_the_library(text):
    own = test_counts_equal_the_library.__dict__.setdefault("own", tokencounts.PieceCounter(public_tokenizer(MODEL), most_chars=16))
    want = len(own.model.encode(text))
    assert own.count([text]).tolist() == [want]
    assert own.count_column(pa.array([None, text, text + " end", text])).tolist() == [0, want, len(own.model.encode(text + " end")), want]


@pytest.mark.parametrize("text", ["a" * 999, "ab" * 400, "=" * 700 + "a", " " * 333, "the" * 300 + " " + "x" * 300, "中" * 200, "<s></s><unk>" * 40])
def test_texts_without_safe_places(counter, text):
    assert counter.count([text])[0] == len(counter.model.encode(text))


def test_count_tokens(spark):
    model = tokencounts.PieceCounter(public_tokenizer(MODEL)).model
    rows = [(1, None), (2, ""), (None, "no id"), (3, "x y " * 5000), (3, "x y " * 5000), (4, "word " * 4095 + "word"), (5, "word " * 4096 + "word")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_bytes", "n_tokens", "over_limit")})
    path = public_tokenizer(MODEL)
    got = sorted((tuple(r) for r in tokencounts.count_tokens(frame, path, slice_bytes=100).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows]
    assert got == sorted(want, key=str)
    assert tokencounts.count_tokens(frame.limit(0), path).collect() == []


def test_count_query(spark):
    model = tokencounts.PieceCounter(public_tokenizer(MODEL)).model
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    assert {i: (r["n_bytes"], r["n_tokens"]) for i, r in got.items()} == {i: (len(t.encode()), len(model.encode(t))) for i, t in texts.items()}


def test_very_long_texts(counter):
    wide = tokencounts.PieceCounter(public_tokenizer(MODEL))
    text = "a long text of plain words, " * 100_000
    assert wide.count([text])[0] == wide.count_column(pa.array([text]))[0] == len(wide.model.encode(text))
