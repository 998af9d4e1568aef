"""Mixing, packing, records, tool calls, embeddings and the pipeline."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_text_operators import cut, groups, plain_fingerprint
from wardstone.llm import embdedup, linecrf, mixing, packing, records, toolcalls
from wardstone.llm.components import connected
from wardstone.llm.queries import QUERIES, REPLY, conversation_calls
from wardstone.llm.tokens import WordEncoder, public_tokenizer
from wardstone.session import materialize, scratch_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizer())


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id", None, "a", 1), (3, "x " * 9000, None, "b", 2),
            (3, "x " * 9000, None, "b", 2), (4, "the ' é<|endoftext|>İ. s's", None, None, 3)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("mix_pass", "_source", "start", "length", "frame", "_group")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_equal_pieces_spread_and_a_packed_frame_can_be_packed_again(spark):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.lit(700).cast("long").alias("length"))
    rows = materialize(rows.repartition(4), "equal-pieces")
    once = packing.pack(rows, 2048, group_pieces=500)
    groups = once.groupBy(F.shiftright("sequence_id", 32)).count().collect()
    assert len(groups) == 8 and max(r["count"] for r in groups) < 800
    assert packing.pack(rows, 2048, group_pieces=500).count() == 4000


# ---- tokens ----


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abzAZ09.,'|#<>ıİéßΣ̸́ \n\t\xa0"), st.characters(codec="utf-8")), max_size=40))
def test_word_encoder_equals_the_tokenizer(text):
    import pyarrow as pa

    own = test_word_encoder_equals_the_tokenizer.__dict__.setdefault("own", WordEncoder(public_tokenizer()))
    ids, edge = own.encode(pa.array([text, None, text + " <|endoftext|>end's"]))
    whole = own.tokenizer
    for i, t in enumerate([text, "", text + " <|endoftext|>end's"]):
        assert ids[edge[i] : edge[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


# ---- packing ----


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_first_fit_decreasing(lengths):
    sizes = np.array(lengths)
    room, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(50)
        room[b] -= lengths[i]
        want[i] = b
    assert packing.first_fit_decreasing(sizes, 50).tolist() == [want[i] for i in range(len(lengths))]


def check_packing(rows, texts, tokenizer):
    """Every id in exactly one piece, sequences gapless and within capacity."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for doc, copies in texts.items():
        for text in set(copies):
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            own = sorted((p for p in pieces[doc] if p["doc_tokens"] == len(ids)), key=lambda p: p["start"])
            starts = sorted({p["start"] for p in own})
            assert sum(p["length"] for p in own) == len(ids) * copies.count(text)
            for p in own:
                assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
            assert starts[0] == 0
    for rows_ in bins.values():
        at = 0
        for p in sorted(rows_, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    return sum(p["length"] for b in bins.values() for p in b) / (2048 * len(bins))


def test_packing(spark, tokenizer, odd, none):
    texts = {r["doc_id"]: [r["text"]] for r in documents(spark).collect()}
    assert check_packing(QUERIES["op4_packing"](spark, SF).collect(), texts, tokenizer) > 0.97
    strange = defaultdict(list)
    for r in odd.collect():
        strange[r["doc_id"]].append(r["text"])
    check_packing(packing.pack_documents(odd).collect(), strange, tokenizer)
    assert packing.pack_documents(none).count() == 0
    with_ids = packing.token_pieces(documents(spark), public_tokenizer(), 1, with_ids=True).where("size(ids) <> length").count()
    assert with_ids == 0


# ---- records ----


def test_records_round_trip(spark, tokenizer, odd, none):
    for df in (documents(spark), odd):
        where = scratch_path(spark, "records")
        records.write_records(df, where, public_tokenizer(), end_id=2, file_bytes=20_000)
        rows = records.build_index(spark, where).orderBy(F.col("doc_id").asc_nulls_last(), "start").collect()
        texts = df.orderBy(F.col("doc_id").asc_nulls_last()).select("doc_id", "text").collect()
        assert [r["doc_id"] for r in rows] == [t["doc_id"] for t in texts]
        at = 0
        for r, t in zip(rows, texts):
            ids = np.array([*tokenizer.encode(t["text"] or "", add_special_tokens=False).ids, 2], "<u4")
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
        ids = records.read_records(spark, where, keep_ids=True).where("size(ids) <> n_tokens").count()
        assert ids == 0
    where = scratch_path(spark, "records")
    records.write_records(none, where, public_tokenizer(), end_id=2)
    assert records.build_index(spark, where).count() == 0


def test_reads_by_offset(spark, tokenizer, odd, none, monkeypatch):
    monkeypatch.setattr(records, "_PICKED_IDS", 500)
    for df in (documents(spark), odd):
        where = scratch_path(spark, "records")
        records.write_records(df, where, public_tokenizer(), end_id=2, file_bytes=20_000)
        stored = spark.read.parquet(records.index_path(where)).select("part", "offset").collect()
        want = Counter((r["doc_id"], tuple([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])) for r in df.select("doc_id", "text").collect())
        orders = []
        for seed in (1, 2):
            rows = records.read_shuffled(spark, where, seed).collect()
            assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
            orders.append([(r["part"], r["offset"]) for r in rows])
            assert sorted(orders[-1]) == sorted(map(tuple, stored)) and orders[-1] != sorted(orders[-1])
        assert orders[0] != orders[1]
        index = records.build_index(spark, where)
        last = index.orderBy(F.desc("part"), F.desc("offset")).limit(1).collect()[0]
        row = spark.createDataFrame([(last["part"], last["offset"], k) for k in (5, 3)], "part int, offset long, place long")
        assert [(r["place"], r["doc_id"], len(r["ids"])) for r in records.read_at(spark, where, row).collect()] == [(k, last["doc_id"], last["n_tokens"]) for k in (3, 5)]
        with pytest.raises(Exception, match="damaged|cut record"):
            records.read_at(spark, where, row.withColumn("offset", F.col("offset") + 1)).collect()
    where = scratch_path(spark, "records")
    records.write_records(none, where, public_tokenizer(), end_id=2)
    assert records.read_shuffled(spark, where).count() == 0


def test_damage_is_found():
    content = b"".join(records.frame(p) + b"\n" for p in (b"", b"abc" * 9, b"\n\n"))
    assert [p for _, p in records.frames(content)] == [b"", b"abc" * 9, b"\n\n"]
    for at in (3, 9, 20, len(content) - 3):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.frames(content[:-2]))


# ---- mixing ----


def mixed_rows(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return mixing.mix(df, **options)


def test_mixing_budgets_and_passes(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice("aaaaaaab") if i % 10 else None) for i in range(2000)]
    out = mixed_rows(spark, rows, max_repetition=3.0, block_tokens=500).collect()
    tokens = {i: len(t.split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    total = defaultdict(int)
    for i, s in source.items():
        total[s] += tokens[i]
    most = max(total.values())
    share = {s: n / sum(total.values()) for s, n in total.items()}
    seen = defaultdict(int)
    per = defaultdict(int)
    for r in out:
        seen[r["doc_id"]] += 1
        per[r["source"]] += r["mix_tokens"]
        assert r["mix_tokens"] == tokens[r["doc_id"]] and 0 <= r["mix_position"] < 1.5
    assert set(seen) == set(source)  # the default budget leaves nothing out
    top = max(share, key=share.get)
    assert per[top] == most
    rare = min(share, key=share.get)
    assert per[rare] == pytest.approx(3 * total[rare], rel=0.02)
    for s in total:  # passes differ by one at most within a source
        counts = {seen[i] for i in source if source[i] == s}
        assert max(counts) - min(counts) <= 1
    again = mixed_rows(spark, rows, max_repetition=3.0, block_tokens=500).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mixing_cut_against_a_full_sort(spark):
    """The part of the last pass is the permuted order's prefix under the budget."""
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 9), "ab"[i % 5 == 0]) for i in range(900)]
    out = mixed_rows(spark, rows, budget=2500, block_tokens=200).collect()
    share = {"a": 0, "b": 0}
    for _, t, s in rows:
        share[s] += len(t.split())
    for s in share:
        budget = round(share[s] / sum(share.values()) * 2500)
        own = sorted((r for r in out if r["source"] == s), key=lambda r: r["mix_position"])
        assert {r["mix_pass"] for r in own} == {0}
        before = sum(r["mix_tokens"] for r in own[:-1])
        assert before < budget <= before + own[-1]["mix_tokens"]


def test_mixing_entropy(spark):
    sizes = {"a": 4000, "b": 900, "c": 100}
    sources = spark.createDataFrame(list(sizes.items()), "source string, tokens long")
    plain = np.array(list(sizes.values())) / 5000
    entropy = lambda a: -(p := plain**a / (plain**a).sum()) @ np.log(p) / np.log(3)
    a = mixing.exponent_for(sources, 0.9, None, None)
    assert 0 < a < 1 and entropy(a) == pytest.approx(0.9, abs=1e-6)
    assert mixing.exponent_for(sources, 0.1, None, None) == 1.0
    assert mixing.exponent_for(sources, None, 1000.0, None) == 0.0
    b = mixing.exponent_for(sources, None, 4.0, None)
    assert (plain[2] / plain[0]) ** (b - 1) == pytest.approx(4.0, rel=1e-6)


def test_mixing_odd_rows(spark, odd, none):
    out = mixing.mix(odd, max_repetition=2.0).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3, 4, None}
    assert mixing.mix(none, max_repetition=2.0).count() == 0


# ---- tool calls ----


def test_calls_of_conversations(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    by = {(r["conv_id"], r["turn"]): r for r in turns.collect()}
    found = QUERIES["op5_tool_calls"](spark, SF).collect()
    users = [k for k, r in by.items() if r["role"] == "user"]
    assert sorted((r["conv_id"], r["turn"]) for r in found) == sorted(users)

    def depth(key):
        before = (key[0], key[1] - 2)
        return 1 + depth(before) if before in by and by[before]["role"] == "user" else 0

    for r in found:
        key = (r["conv_id"], r["turn"])
        answer = by.get((key[0], key[1] + 1))
        linked = answer is not None and answer["role"] == "assistant"
        assert r["status"] == ("linked" if linked else "pending") and r["depth"] == depth(key) and r["problem"] is None
        record = {
            "after": f"{key[0]}:{key[1] - 2}" if key[1] >= 2 else None, "arguments": {"prompt": by[key]["text"], "turn": key[1]},
            "id": f"{key[0]}:{key[1]}", "name": "reply", "result": answer["text"] if linked else None,
        }
        assert r["record"] == json.dumps(record, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def test_calls_with_faults(spark):
    schemas = {"f": [toolcalls.Argument("x", "integer"), toolcalls.Argument("y", "string", False)], "g": [toolcalls.Argument("o", "object")]}
    calls = [
        (1, 0, "a", "f", '{"x": 1, "y": "q"}', None), (1, 1, "b", "f", '{"y": 2, "x": 3}', "a"), (1, 2, "c", "f", '{"y": "z"}', "b"),
        (1, 3, "d", "g", '{"o": {"k": [1, 2], "a": null}}', "c"), (1, 4, "e", "h", "{}", "zzz"), (1, 5, "f", "f", "{broken", "g"),
        (1, 6, "g", "f", None, "f"), (1, 7, "a", "f", '{"x": 9}', None), (1, 8, None, "f", '{"x": 1}', "a"), (1, 9, "s", "f", "[1]", "s"),
        (2, 0, "t", "f", '{"x": "1"}', "f"),
    ]
    results = [("a", 5, "late"), ("a", 3, "first"), ("b", 2, None), ("nobody", 1, "x"), (None, 1, "y")]
    c = spark.createDataFrame(calls, "group long, turn long, id string, name string, arguments string, after string")
    r = spark.createDataFrame(results, "id string, turn long, content string")
    found = {(x["group"], x["turn"]): x for x in toolcalls.link(c, r, schemas).collect()}
    assert len(found) == len(calls)
    status = [found[k]["status"] for k in sorted(found)]
    assert status == ["linked", "linked", "pending", "pending", "pending", "cyclic", "cyclic", "duplicate", "pending", "cyclic", "cyclic"]
    problems = [found[k]["problem"] for k in sorted(found)]
    assert problems == [None, "y is not string", "missing x", None, "unknown tool", "broken json", "no arguments", None, None, "not an object", "x is not integer"]
    assert [found[k]["depth"] for k in sorted(found)][:5] == [0, 1, 2, 3, 0]
    assert found[(1, 4)]["unknown_after"] and not found[(1, 3)]["unknown_after"]
    assert json.loads(found[(1, 0)]["record"])["result"] == "first" and '"arguments":{"x":1,"y":"q"}' in found[(1, 0)]["record"]
    assert json.loads(found[(1, 5)]["record"])["arguments"] == "{broken"
    assert sorted(x["turn"] for x in toolcalls.orphans(c, r).collect()) == [1, 1]
    assert toolcalls.link(c.limit(0), r.limit(0), schemas).count() == 0


def test_depth_of_a_long_chain(spark):
    n = 700
    calls = spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("after"))
    found = {int(r["id"]): r["depth"] for r in toolcalls.depths(calls).collect()}
    assert found == {i: i for i in range(n)}


def test_conversations_with_nulls(spark):
    rows = [(None, 0, "user", "a"), (1, None, "user", None), (1, 0, None, "x"), (1, 1, "assistant", None), (1, 0, "user", "q"), (1, 0, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = toolcalls.link(*conversation_calls(turns), REPLY).collect()
    assert len(found) == 4 and sorted(r["status"] for r in found) == ["duplicate", "linked", "pending", "pending"]


def test_equal_calls_positions_and_argument_names(spark):
    schemas = {"f": [toolcalls.Argument("a.b", "integer"), toolcalls.Argument('q"', "string", False)]}
    wide = "9" * 25
    calls = [(1, t, f"c{t}", "f", f'{{"a.b": {v}}}', a) for t, (v, a) in enumerate(
        [("1", None), ("1.0", "c3"), (wide, "c0"), ("-2", "c2"), ("1.5", None), ('"1"', None), ("1e30", "c9")])]
    calls += [(1, 0, "c0", "f", '{"a.b": 1}', None)] * 3 + [(2, 0, "x", "f", '{"q\\"": "s", "a.b": 3.000}', "y"), (2, 1, "y", "f", "{}", None), (2, 9, "z", "f", "{}", "z")]
    c = spark.createDataFrame(calls, "group long, turn long, id string, name string, arguments string, after string")
    r = spark.createDataFrame([("c0", 1, "one")], "id string, turn long, content string")
    found = toolcalls.link(c, r, schemas).collect()
    assert sorted(x["status"] for x in found if x["id"] == "c0") == ["duplicate"] * 3 + ["linked"]
    problem = {(x["group"], x["turn"]): x["problem"] for x in found}
    assert [problem[(1, t)] for t in range(7)] == [None, None, None, None, "a.b is not integer", "a.b is not integer", None]
    assert problem[(2, 0)] is None and problem[(2, 1)] == "missing a.b"
    for group in (1, 2):
        rows = sorted((x for x in found if x["group"] == group), key=lambda x: x["position"])
        assert [x["position"] for x in rows] == list(range(1, len(rows) + 1))
        keys = [(x["depth"] is None, x["depth"] or 0, x["turn"], x["id"]) for x in rows]
        assert keys == sorted(keys)
    order = [x["id"] for x in sorted(found, key=lambda x: x["position"]) if x["group"] == 1 and x["status"] != "duplicate"]
    assert order.index("c0") < order.index("c2") < order.index("c3") < order.index("c1")


def test_a_group_of_many_equal_calls(spark):
    c = spark.range(5000).select(F.lit(1).cast("long").alias("group"), F.lit(0).cast("long").alias("turn"), F.lit("a").alias("id"),
        F.lit("f").alias("name"), F.lit("{}").alias("arguments"), F.lit(None).cast("string").alias("after"))
    r = spark.createDataFrame([("a", 1, "one")], "id string, turn long, content string")
    found = toolcalls.link(c, r, {"f": []})
    assert {x["status"]: x["count"] for x in found.groupBy("status").count().collect()} == {"linked": 1, "duplicate": 4999}
    assert found.select("position").distinct().count() == 5000


# ---- embeddings ----


def links(rows, threshold):
    """Brute force over rows (vec_id, embedding, label)."""
    usable = [(i, np.array(v, float), y) for i, v, y in rows if y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    count, root = defaultdict(int), {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a, y) in enumerate(usable):
        for j, b, z in usable[:n]:
            if y == z and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                count[i] += 1
                count[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (count[i], find(i), find(i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("cell, block", [(2048, 2048), (20, 16)])
def test_embedding_links(spark, cell, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=8) * rng.choice([0.02, 0.15, 0.5])).tolist(), int(rng.integers(3))) for i in range(400)]
    rows += [(400 + i, rows[i][1], rows[i][2]) for i in range(30)] + [(500 + i, rows[7][1], rows[7][2]) for i in range(80)]
    rows += [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, rows[0][1], None), (904, [1.0, None] * 4, 0), (905, [1.0, 2.0], 0), (906, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    found = embdedup.near_copies(df, 0.93, cell, block).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == links(rows, 0.93)
    assert len(found) == len(rows)


def test_embeddings_of_nothing_and_without_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embdedup.near_copies(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], schema)
    found = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in embdedup.near_copies(rows).collect())
    assert found == [(-1, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True)]


def test_embeddings_table(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op10_embeddings"](spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == links(rows, 0.93)


def test_components_of_random_links(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: find(i) for i in linked}


# ---- pipeline ----


def test_pipeline_stages(spark, tokenizer):
    docs = documents(spark)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = scratch_path(spark, "stage")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            last = docs
    before = documents(spark).count()
    assert sizes[0] < before and sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] > sizes[2]
    texts = defaultdict(list)
    for r in last.collect():
        texts[r["doc_id"]].append(r["text"])
    check_packing(docs.collect(), texts, tokenizer)


def test_pipeline_keeps_good_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    kept = corpus_pipeline.quality(spark, documents(spark), SF)
    good = documents(spark).join(labels, "doc_id")
    assert good.join(kept.select("doc_id"), "doc_id", "left_anti").count() == 0
    groups = corpus_pipeline.near_copies(spark, kept, SF)
    assert groups.join(kept, "doc_id").count() == groups.count()


@pytest.fixture(scope="module")
def rough(spark):
    """Passages shared between documents, whole and near copies, wide characters, a null text and an empty one; ids differ."""
    rng = random.Random(21)
    draw = lambda n, of="abcdefgh ": "".join(rng.choice(of) for _ in range(n))
    shared = [draw(n) for n in (60, 99, 100, 130, 260)] + [draw(90, "aé漢😀 "), draw(140, "é漢 ")]
    rows = []
    for i in range(90):
        text = "".join(rng.choice(shared) + draw(rng.randint(0, 70), "xyz é") for _ in range(rng.randint(1, 4)))
        if i % 9 == 4:
            text = rng.choice(rows)[1] or ""
        if i % 9 == 7:
            text = (rng.choice(rows)[1] or "") + "."
        rows.append((i * 7 % 97, {30: None, 31: ""}.get(i, text), "en", ("big", "big", "mid", "big", "big", "mid", "big", "big", "big", "small")[i % 10], 1))
    return spark.createDataFrame(rows, SCHEMA).repartition(3), [tuple(r) for r in rows]


def kept_text(rows, length=100):
    """Brute force: the text of each id without the bytes that stand earlier, broken characters dropped."""
    seen, out = set(), {}
    for doc, text in sorted((r[0], r[1]) for r in rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(raw[i : i + length])
        out[doc] = None if text is None else bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stage_quality_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scores = linecrf.score(documents(spark), linecrf.train(documents(spark), labels)).collect()
    want = {r["doc_id"] for r in scores if r["score"] >= 0.3}
    rows = documents(spark).select("doc_id", "text", "lang", "source", "n_chars").collect()
    got = corpus_pipeline.quality(spark, documents(spark), SF).collect()
    assert sorted(got, key=lambda r: r["doc_id"]) == sorted((r for r in rows if r["doc_id"] in want), key=lambda r: r["doc_id"])


def test_stage_near_copies_rows(spark, rough):
    df, rows = rough
    least = groups({r[0]: plain_fingerprint(r[1]) for r in rows}, 4)
    got = [tuple(r) for r in corpus_pipeline.near_copies(spark, df, SF).collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted((r for r in rows if least[r[0]] == r[0]), key=lambda r: r[0])
    assert len(got) < len(rows)


def test_stage_near_copies_decides_by_row(spark):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40)) for _ in range(6)]
    one, two, three, four, five, six = texts
    row = lambda i, t, lang="en": (i, t, lang, "s", 1)
    copies = [
        [row(None, one)] * 3,  # without ids: one stays
        [row(7, two), row(None, two), row(None, two + " ")],  # an id goes before none
        [row(9, three)] * 4,  # equal rows
        [row(2, four), row(11, four)], [row(11, five)],  # 11 is a copy in one row only
        [row(12, six, None), row(12, six, "de")],  # equal but for another column
        [row(13, None), row(14, ""), row(None, None)],
    ]
    want = [row(None, one), row(7, two), row(9, three), row(2, four), row(11, five), row(13, None)]
    prints = [{plain_fingerprint(r[1]) for r in rows} for rows in copies]
    assert all((a ^ b).bit_count() <= 4 for p in prints for a in p for b in p)
    df = spark.createDataFrame([r for rows in copies for r in rows], SCHEMA)
    for parts in (1, 5):
        got = [tuple(r) for r in corpus_pipeline.near_copies(spark, df.repartition(parts), SF).collect()]
        assert sorted(map(repr, (r for r in got if r[0] != 12))) == sorted(map(repr, want))
        assert len([r for r in got if r[0] == 12]) == 1


def test_stage_repeated_passages_rows(spark, rough):
    df, rows = rough
    texts = kept_text(rows)
    digests = cut([(r[0], r[1]) for r in rows], 100)
    got = {r["doc_id"]: r for r in corpus_pipeline.repeated_passages(spark, df, SF).collect()}
    assert {i: r["text"] for i, r in got.items()} == texts and len(got) == len(rows)
    assert {i for i, r in got.items() if r["text"] is not None and r["n_chars"] != len(r["text"])} == set()
    assert {(r[0], r[2], r[3]) for r in rows} == {(i, r["lang"], r["source"]) for i, r in got.items()}
    plain = {r[0] for r in rows if (r[1] or "").isascii()}
    assert all(hashlib.sha256((got[i]["text"] or "").encode()).hexdigest() == digests[i][3] for i in plain)
    assert sum(digests[i][1] > 0 for i in digests) > 20


def test_stage_mix_sources_rows(spark, rough):
    df, rows = rough
    passes = mixing.mix(df, max_repetition=2.0, columns=["doc_id"]).groupBy("doc_id").agg(F.count("*"), F.countDistinct("mix_pass")).collect()
    want = {r[0]: r[1] for r in passes}
    assert all(r[1] == r[2] for r in passes)  # once in a pass
    got = Counter(tuple(r) for r in corpus_pipeline.mix_sources(spark, df, SF).collect())
    assert set(got) == set(rows) and {r[0]: n for r, n in got.items()} == want
    times = {s: {n for r, n in got.items() if r[3] == s} for s in ("big", "mid", "small")}
    assert times["small"] == {2} and all(t <= {1, 2} for t in times.values()) and 1 in times["big"]


def test_pipeline_of_odd_tables(spark, odd, none):
    for df in (odd, none):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert (docs.count() > 0) == (df.count() > 0)
