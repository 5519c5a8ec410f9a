"""From raw documents to the pieces of a training mix: five stages, each one operator of tradewind.llm.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each stage's result to the shared folder and
gives what it reads back to the next one. All stages but the last keep the columns of documents, in any number and of any
name; names that an operator adds give way to them. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import language, line_windows, mixing, pieces, prob_minhash
from tradewind.llm.queries import LANGUAGES
from tradewind.llm.staging import written
from tradewind.llm.words import n_words
from tradewind.session import apply_settings

# Five stages share one application, and its executors keep what the largest batch took: texts go to Python workers and come out
# of Parquet files in smaller batches than in a single query.
SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "2500000",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the fused evidence accepts; others and texts without a letter go, null and empty ones with them.

    A null language or source is evidence of nothing. Repeated rows and ids are judged one by one; texts of any length are read whole.
    """
    apply_settings(spark, SETTINGS)
    names = docs.columns
    found = language.identify(docs, LANGUAGES)
    return found.filter(found[found.columns[-1]]).select(*names)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later window occurrences; one that loses all its lines goes.

    A null or empty text has no window and stays; repeated rows, null ids and very long texts are as in ``line_windows.remove_repeated``.
    ``n_chars`` is counted anew.
    """
    apply_settings(spark, SETTINGS)
    names = docs.columns
    cleaned = line_windows.remove_repeated(docs)
    removed = cleaned[cleaned.columns[-1]]
    cleaned = cleaned.filter((removed == 0) | (n_words(cleaned["text"]) > 0))
    if "n_chars" in names:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id (null is the largest).

    Texts without a word, null ones included, are one class; of repeated rows one stays.
    """
    apply_settings(spark, SETTINGS)
    return prob_minhash.keep_one(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, zero to three times.

    A null source is a source of its own, the last in order; a null or empty text has size 0. Equal rows share their copies.
    """
    apply_settings(spark, SETTINGS)
    return mixing.take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, in place of its text: none for a null or empty text, all of a very long one. Rows are coded one by
    one, repeated ones alike."""
    apply_settings(spark, SETTINGS)
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("language", known_language),
    ("lines", repeated_lines),
    ("near duplicates", near_duplicates),
    ("mix", target_mix),
    ("pieces", encoded),
]

# SentencePiece, trained trigrams and sketches have no SQL form; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
