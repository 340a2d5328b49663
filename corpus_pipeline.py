"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing, BPE encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fusework.llm import bpe, language_id, line_dedup, mixing, near_duplicates
from fusework.llm.queries import tokenizer_path
from fusework.llm.textbatch import WORD, stored

#: Below this score no learned language fits: most letters are foreign to all of them.
LEAST_SCORE = 0.25


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in a language of the corpus; those without letters or in a foreign script go."""
    model = language_id.fit_language_model(docs)
    return language_id.keep_identified(docs, model, LEAST_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, up to two edits, in an earlier place; those that lose all their words go.

    ``whole_text`` is the text with all its lines, for the next stage.
    """
    cut = line_dedup.dedup_lines(docs, whole="whole_text")
    return cut.where(F.col("text").rlike(WORD) | ~F.coalesce(F.col("whole_text").rlike(WORD), F.lit(False)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class of the texts, and of the texts as they were before line dedup."""
    return near_duplicates.drop_near_duplicates(docs, whole="whole_text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row and the digests of ids and decoded text."""
    return bpe.encode_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokenize),
]

#: SQL expresses neither the language model nor the tokens; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
