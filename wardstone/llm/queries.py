"""The named queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.llm import embdedup, hdlang, kmeans, linecrf, linerules, mixing, oracles, packing, prefixtrie, records, repeats, simhash, tokencounts, toolcalls
from wardstone.llm.common import id_bucket, table
from wardstone.llm.tokens import public_tokenizer
from wardstone.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A source may be repeated this often by the mixing query and the pipeline.
MAX_REPETITION = 2.0
GOOD = 0.3


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


@query("op1_mixing")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), max_repetition=MAX_REPETITION, columns=["doc_id", "source"])
    return mixed.select("doc_id", "source", "mix_pass", "mix_block", "mix_tokens", "mix_position")


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    bucket = id_bucket("doc_id", 4)
    model = hdlang.learn(documents.where(bucket != 2))
    return hdlang.identify(documents, model).select("doc_id", (bucket == 2).alias("held_out"), "lang_pred", "score")


@query("op3_simhash")
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents"), shingle=4, seed=42, radius=4)


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizer(), end_id=1, capacity=2048)


REPLY = {"reply": [toolcalls.Argument("prompt"), toolcalls.Argument("turn", "integer")]}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user turn asks the tool ``reply``; the assistant's next turn is the result, on which the user's next turn waits."""
    at = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    keyed = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), True)
    calls = turns.where("role = 'user'").select(
        F.col("conv_id").alias("group"), "turn", F.when(keyed, at(0)).alias("id"), F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn"))).alias("arguments"), F.when(keyed & (F.col("turn") >= 2), at(2)).alias("after"),
    )
    results = turns.where("role = 'assistant'").select(F.when(keyed, at(1)).alias("id"), "turn", F.col("text").alias("content"))
    return calls, results


@query("op5_tool_calls", oracles.TOOL_CALLS)
def op5_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = conversation_calls(table(spark, folder, "conversations"))
    return toolcalls.link(calls, results, REPLY).withColumnRenamed("group", "conv_id")


@query("op6_records")
def op6_records(spark: SparkSession, folder: str) -> DataFrame:
    where = scratch_path(spark, "records")
    records.write_records(table(spark, folder, "documents"), where, public_tokenizer(), end_id=2)
    return records.build_index(spark, where).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op7_line_rules", oracles.LINE_RULES)
def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return linerules.clean(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_line_crf")
def op8_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = linecrf.train(documents, labels.where(id_bucket("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label")))
    scored = linecrf.score(documents, model)
    return scored.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query("op9_repeats", oracles.REPEATS)
def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_embeddings", oracles.EMBEDDINGS)
def op10_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embdedup.near_copies(table(spark, folder, "embeddings"))


@query("op11_clusters", oracles.CLUSTERS)
def op11_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.cluster(table(spark, folder, "embeddings"), k=16, rounds=3, seed=1, size=64, scale=64)


@query("op12_prefix_trie", oracles.PREFIXES)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"), family=100, heads=6)


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.count_tokens(table(spark, folder, "documents"), public_tokenizer("piece_bpe_32k.model"), limit=4096)
