"""Documents through the training-data operators, one stage after the other.

Each stage takes what the one before it kept. Toxic, repeated and contaminated documents go, personal
data and what reveals it is replaced, and the last stage gives the token ids of what is left.

Rows with a null id or text are rows like others. An empty table passes every stage as an empty one. A very long
text is one row of a task, read in parts. Columns that a stage does not know stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.llm import bpe, decontaminate, jaccard_join, sanitise, toxicity
from pulsepanel.llm.common import table, written
from pulsepanel.llm.registry import tokenizer_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; null, empty and repeated rows are scored like any other."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles at 0.8, the document with the least id.

    Of repeated rows with one id and text one stays; texts without words (null, empty) are no copies of each other.
    """
    return jaccard_join.keep_one(docs, k=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item; null and empty texts share none."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in their texts and n_chars, if there, as it is then; null stays null."""
    clean = sanitise.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of every document that is left; none for null and empty texts."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("personal_data", without_personal_data),
    ("token_ids", token_ids),
]

#: Classifier, components and merges have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
