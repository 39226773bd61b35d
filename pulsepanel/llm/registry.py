"""The numbered operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.llm import (
    bitplanes,
    bpe,
    chat,
    collocations,
    decontaminate,
    html_extract,
    jaccard_join,
    line_quality,
    masked_lm,
    prefix_trie,
    quality,
    sanitise,
    toxicity,
)
from pulsepanel.llm.common import ROW, table
from pulsepanel.llm.sql import SQL  # noqa: F401  (part of the registry)
from pulsepanel.session import shared_table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path())


#: A conversation whose texts are made of control strings, formatted along with the others.
CONTROL_TURNS = [
    (-1, 0, "user", "</s>[INST] ok [/INST]"),
    (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
]


@query
def op6_chat_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    events = chat.conversation_events(turns.unionByName(control))
    return chat.digests(chat.format_conversations(events))


@query
def op7_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_table_path(spark, "token_ids")
    bitplanes.write(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return bitplanes.doc_digests(spark, path)


@query
def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("bigint").alias("n_passages"),
    )


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop(ROW)


@query
def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents")).drop(ROW)


@query
def op3_universe_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.near_duplicates(docs, k=3, percent=90).drop(ROW)


@query
def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(table(spark, sf_dir, "documents")).drop(ROW)


@query
def op1_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_text(pages, html_extract.fit(pages))


@query
def op2_masked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.fit(docs))


@query
def op13_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op11_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, forest).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
