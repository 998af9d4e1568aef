"""Quality, language, SimHash and repeats against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardstone.llm import bwt, hdlang, linecrf, linerules, repeats, simhash
from wardstone.llm.bwt import repeated_intervals
from wardstone.llm.queries import QUERIES
from wardstone.llm.textbytes import ByteView

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "a", "é\x85b\xa0c", "x" * 3000, "For " * 900, "ab\n" * 500, "😀 ß İ"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, null ids, a repeated row, and further columns whose names operators use inside."""
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "no id", "en", "s", 1), (5, ODD[5], None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("score", "th", "fp", "node", "spans", "_group", "frame", "lang_pred", "kept")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- bytes ----


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\té\x1c\x85", max_size=30)), max_size=6))
def test_words_and_lines(texts):
    view = ByteView(pa.array(texts, pa.string()))
    raw = [(t or "").encode() for t in texts]
    start, end, doc = view.words
    words = [(d, bytes(view.data[s:e])) for s, e, d in zip(start, end, doc)]
    assert words == [(i, w.encode()) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    start, end, doc = view.lines
    assert [(d, bytes(view.data[s:e])) for s, e, d in zip(start, end, doc)] == [(i, x) for i, b in enumerate(raw) for x in b.split(b"\n")]


# ---- line rules ----


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_rule_counts(spark, odd):
    for df in (documents(spark), odd):
        texts = defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r["doc_id"]].append(r["text"])
        found = linerules.clean(df).collect()
        assert len(found) == sum(map(len, texts.values()))
        for r in found:
            want = counts(texts[r["doc_id"]][0])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r["kept"] and r["base_failed"])


def test_line_verdicts(spark):
    good = "\n".join(f"Line{i} holds{i} seven{i} quite{i} plain{i} words{i} here{i}." for i in range(12))
    menu = "\n".join(f"Home{i} | About{i} | Contact{i} | Blog{i}" for i in range(30))
    shout = "\n".join(f"BUY THE THING NUMBER {'X' * i} NOW!! GO!! GET!! IT!!" for i in range(20))
    rows = [(1, good), (2, menu), (3, shout), (4, good + "\nHome | About | Contact"), (5, good + "\nPlease accept our cookie policy here.")]
    found = {r["doc_id"]: r for r in linerules.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i]["kept"] for i in range(1, 6)] == [True, False, False, True, True]
    assert found[1]["clean_text"] == good and found[4]["clean_text"] == good and found[5]["clean_text"] == good


SENTENCE = re.compile(r"""[.!?](?=$|[\x20\x09-\x0D"')\]}*_\[”’“»›])|[…‼⁇⁈⁉](?=$|[\x20\x09-\x0D"')\]}*_\[”’“»›])|[。！？．｡।॥؟۔։።፧។။།\u0E00-\u0EFF]""")
NAVIGATION = set("·•∙‣●▪→▸►▶│¦｜／")


def sentence_fails(line):
    return len(WORD.findall(line)) >= 25 and not SENTENCE.search(line)


def navigation_fails(line):
    words = WORD.findall(line)
    closing = sum(w in {"»", "›"} for w in words[1:]) - line.count("«") - line.count("‹")
    return sum(w in set("|>/~") for w in words) + sum(w in NAVIGATION for w in words[1:]) + max(closing, 0) > 0.2 * len(words)


def test_long_lines_need_a_sentence(spark):
    lists = "\n".join(" ".join(f"key{i}x{k}" for k in range(30)) for i in range(4))
    clean = "\n".join(" ".join(f"plain{i}x{k}" for k in range(29)) + end for i, end in enumerate([" end.", " end!”", " end?)", " end.[4]", " so… on", " 完。了", " ไทย"]))
    wrapped = "\n".join(" ".join(f"wrap{i}x{k}" for k in range(18)) for i in range(6))
    dots = "\n".join(" ".join(f"v{i}.{k}" for k in range(30)) for i in range(4))
    rows = [(1, lists), (2, clean), (3, wrapped), (4, dots), (5, clean + "\n" + lists.split("\n")[0])]
    found = {r["doc_id"]: r for r in linerules.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i]["kept"] for i in range(1, 6)] == [False, True, True, False, True]
    assert [found[i]["clean_text"] for i in range(1, 6)] == ["", clean, wrapped, "", clean]


def test_wide_separators_are_navigation(spark):
    good = "\n".join(f"Line{i} holds{i} seven{i} quite{i} plain{i} words{i} here{i}." for i in range(12))
    menus = ["Home » About » Blog", "Home · About · Blog", "Home • About • Blog", "» Shop » Toys", "Home › News › Sport"]
    prose = ["• one item", "« Bonjour » dit", "Il dit « oui » ici", "a·b c•d e", "»Ja« sagt sie"]
    rows = [(i, good + "\n" + line) for i, line in enumerate(menus + prose)]
    found = {r["doc_id"]: r for r in linerules.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i]["clean_text"] == good for i in range(len(rows))] == [True] * len(menus) + [False] * len(prose)
    assert all(r["kept"] for r in found.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n.!?…。»«·•|”ก"), max_size=40), max_size=4))
def test_sentence_and_separator_rules(texts):
    off = linerules.LineRules(long_line=4, separators=9, symbols=9, bangs=9, again=9)
    view = ByteView(pa.array(texts, pa.string()))
    at, code = linerules._wide(view.data)
    starts, ends, _ = view.lines
    lines = [bytes(view.data[s:e]).decode() for s, e in zip(starts, ends)]
    assert linerules._has_sentence(view, at, code).tolist() == [bool(SENTENCE.search(x)) for x in lines]
    fails = linerules.failing_lines(view, linerules.LineRules(symbols=9, bangs=9, again=9)) if lines else []
    seen = [set(t.split("\n")) and [x in t.split("\n")[:k] for k, x in enumerate(t.split("\n"))] for t in texts]
    again = [a for doc in seen for a in doc]
    assert list(fails) == [bool(WORD.search(x)) and (r or sentence_fails(x) or navigation_fails(x)) for x, r in zip(lines, again)]
    long = linerules.failing_lines(view, off) if lines else []
    assert list(long) == [bool(WORD.search(x)) and (r or (len(WORD.findall(x)) >= 4 and not SENTENCE.search(x))) for x, r in zip(lines, again)]


def test_rules_keep_good_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = linerules.clean(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    rows = found.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r["quality"]: r["kept"] for r in rows}
    assert share[1] == 1.0 and share.get(0, 0) < 0.1


# ---- conditional random field ----


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    docs = np.repeat([0, 1, 2], [4, 1, 3])
    x = rng.normal(size=(len(docs), 5))
    model = linecrf.LineCrf(rng.normal(size=5), rng.normal(size=(2, 2)))
    got = model.marginals(x, docs, 3)
    for d in range(3):
        unary = x[docs == d] @ model.weights
        n, total, good = len(unary), 0.0, np.zeros(len(unary))
        for code in range(1 << n):
            y = [(code >> i) & 1 for i in range(n)]
            p = np.exp(sum(u for u, k in zip(unary, y) if k) + sum(model.pairs[a, b] for a, b in zip(y, y[1:])))
            total += p
            good += p * np.array(y)
        assert got[docs == d] == pytest.approx(good / total)


def test_quality_on_held_out_documents(spark):
    found = QUERIES["op8_line_crf"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (None, 1), (6, None), (7, 0), (7, 1)], "doc_id long, label int")
    model = linecrf.train(odd, labels)
    assert model is not None
    assert all(0 <= r["score"] <= 1 for r in linecrf.score(odd, model).collect())
    assert linecrf.score(odd, model).count() == odd.count()
    assert linecrf.score(none, model).count() == 0
    assert linecrf.keep(odd, model, 0.0).count() == odd.count() and linecrf.keep(odd, model, 0.0).columns == odd.columns
    assert linecrf.train(none, labels) is None
    assert {r["score"] for r in linecrf.score(odd, None).collect()} == {0.5}


# ---- language ----


def test_language_on_held_out_documents(spark):
    found = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    rows = found.where("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_document_vector_from_its_definition():
    text, dim = "Aba, c", 64
    symbols = [0, ord("a"), ord("b"), ord("a"), 0, ord("c"), 0]
    letter = lambda c: hdlang.letter_vector(c, dim).astype(int)
    want = sum(
        np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in zip(symbols, symbols[1:], symbols[2:])
    )
    assert hdlang.document_vectors(["", text, "zz"], dim)[1].tolist() == want.tolist()


def test_language_of_odd_rows(spark, odd, none):
    model = hdlang.learn(odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").otherwise("yy")))
    rows = hdlang.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = ODD[r["doc_id"]] if r["doc_id"] is not None else "no id"
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    assert hdlang.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in hdlang.identify(odd, hdlang.learn(none)).collect()} == {"und"}


# ---- SimHash ----


def plain_fingerprint(text):
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius):
    """Smallest id of each id's group, by all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@settings(max_examples=40, deadline=None)
@given(st.text("aB é\n\tz", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**12 - 1), min_size=2, max_size=60), st.integers(0, 3))
def test_bk_tree_groups(values, radius):
    values = sorted(values)
    want = groups({v: v for v in values}, radius)
    got = {v: v for v in values} | dict(simhash.shard_groups(values, radius))
    assert got == want


def test_near_copies(spark, odd):
    for df in (documents(spark), odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        prints = {i: plain_fingerprint(t) for i, t in texts.items()}
        want = groups(prints, 4)
        rows = simhash.near_copies(df).collect()
        assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in rows} == {i: (prints[i], want[i]) for i in texts}
        assert len(rows) == len(texts)


def test_crowded_shards_and_far_chains(spark, monkeypatch):
    """A chain of fingerprints and a crowd around one, with trees of at most a few."""
    monkeypatch.setattr(simhash, "MOST_IN_TREE", 7)
    rng = random.Random(5)
    chain = [((1 << k) - 1) for k in range(0, 60, 3)]
    centre = rng.getrandbits(64)
    crowd = list({centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)})
    lone = [rng.getrandbits(64) for _ in range(40)]
    prints = {i: v for i, v in enumerate({*chain, *crowd, *lone})}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in prints.values()]
    found = simhash.connected(simhash.links(spark.createDataFrame(signed, "fp long"), 4, 8)).collect()
    part = {int(np.int64(r["node"]).astype(np.uint64)): r["component"] for r in found}
    want = groups(prints, 4)
    by_want, by_got = defaultdict(set), defaultdict(set)
    for i, v in prints.items():
        by_want[want[i]].add(v)
        by_got[part.get(v, ("alone", v))].add(v)
    assert sorted(map(sorted, by_want.values())) == sorted(map(sorted, by_got.values()))


def test_near_copies_of_nothing(spark, none, odd):
    assert simhash.near_copies(none).count() == 0
    assert simhash.near_copies(odd).count() == odd.count()


def test_training_sample_is_bounded_in_lines(spark, monkeypatch):
    """Whole documents by hash while their lines fit; long ones and second rows of an id stay out of the sample."""
    rows = [(i, "good words in a sentence.\n" * 4 if i % 2 else "|| ## ||\n" * 4) for i in range(60)] + [(7, "another text of id 7"), (100, "x\n" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100, 0)], "doc_id long, label int")
    seen = {}
    monkeypatch.setattr(linecrf, "fit", lambda x, docs, label: seen.update(lines=len(x), docs=len(label)))
    linecrf.train(df, labels, most_lines=100)
    assert seen["lines"] <= 100 and 15 <= seen["docs"] <= 20
    linecrf.train(df, labels, most_lines=1000)
    assert seen["docs"] == 60  # id 100 has over a tenth of the lines


# ---- repeats ----


def cut(rows, length):
    """Brute force: (bytes, removed, spans, digest of the rest) of each id."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def removed(spark, df, length):
    rows = repeats.remove_repeats(df, length).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows}, len(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=8), st.sampled_from([1, 3, 8]), st.sampled_from([1, 20, 1000]))
def test_merged_transforms(strings, length, shard):
    strings = strings + [bytes([65 + i % 2 for i in range(15)])] * 2
    want = defaultdict(set)
    for i, s in enumerate(strings):
        for j in range(len(s) - length + 1):
            want[s[j : j + length]].add((i, j))
    got = defaultdict(set)
    for i, j, b in zip(*(a.tolist() for a in repeated_intervals(strings, length, shard))):
        got[b].add((i, j))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_the_merge_reads_the_shards_in_order(monkeypatch):
    """The result hangs on each shard's own order: a scrambled one gives other intervals."""
    rng = random.Random(4)
    base = bytes(rng.choice(b"abcdefgh") for _ in range(130))
    strings = [base[i % 7 :] + bytes(rng.choice(b"xyz") for _ in range(9)) for i in range(40)]
    found = lambda: sorted(zip(*(a.tolist() for a in repeated_intervals(strings, 100, 500))))
    right = found()
    scramble = np.random.default_rng(1)
    own = bwt.shard_order
    monkeypatch.setattr(bwt, "shard_order", lambda text, ends: scramble.permutation(own(text, ends)))
    assert right and found() != right


def test_repeats_of_random_documents(spark):
    rng = random.Random(8)
    draw = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared = [draw(rng.randint(20, 300)) for _ in range(20)]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(shared) + draw(rng.randint(0, 60)) for _ in range(rng.randint(0, 5)))
        if i % 11 == 0:
            text = "ab" * rng.randint(0, 300)
        if i % 17 == 0 and rows:
            text = rng.choice(rows)[1]
        rows.append((i * 3, None if i == 77 else text))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for length in (100, 20):
        got, n = removed(spark, df, length)
        assert got == cut(rows, length) and n == len(rows)


def test_repeats_of_documents(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    assert removed(spark, documents(spark), 100)[0] == cut(rows, 100)


def test_repeats_of_odd_rows(spark, odd, none):
    got, n = removed(spark, odd, 100)
    assert n == odd.count()
    assert {k: v for k, v in got.items() if k is not None} == cut([(i, t) for i, t in enumerate(ODD)], 100)
    assert removed(spark, none, 100) == ({}, 0)
    cleaned = repeats.clean_documents(odd.select("doc_id", "text", "lang", "source", "n_chars", "th", "spans"))
    assert cleaned.count() == odd.count() and cleaned.columns[-2:] == ["th", "spans"]
    assert {r["text"] for r in cleaned.where("doc_id = 0").collect()} == {None}


def test_very_long_texts_are_read_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_TEXT_SLICE", 4000)
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij ") for _ in range(9000))
    rows = [(1, long), (2, long[3000:8000] + "tail"), (3, long[100:150])]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "th": [0, 0, 0], "text": pa.array([t.encode() for _, t in rows], pa.binary())})]
    listed = list(repeats._list_pieces(iter(batches), 3, 100))
    assert sum(b.num_rows for b in listed) > 0
    items = [np.frombuffer(x, repeats._ITEM) for b in listed for x in b.column("items").to_pylist()]
    assert sum(int(i["n"].sum()) for i in items) == (9000 - 99) + (5004 - 99)
