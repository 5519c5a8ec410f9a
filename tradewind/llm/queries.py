"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    hamming_index, html_text, language, line_quality, line_windows, mixing, periodic_runs, pieces, prob_minhash, spelling, token_files, url_filter, warc,
)
from tradewind.llm.staging import new_folder
from tradewind.llm.words import let, words

# Fixed values of the URL contract.
URL_RULES = [url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
             url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/")]

LANGUAGES = ("en", "fr", "de", "es")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``model``: path of a SentencePiece model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model or public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(_table(spark, sf_dir, "documents")).drop("left_text")


def op4_addressable_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``tokenizer``: path of a tokenizers file."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark)
    token_files.write(_table(spark, sf_dir, "documents"), folder, lambda: token_files.word_encoder(path), end_id=2)
    return token_files.read(spark, folder)


def op5_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_windows.remove_repeated(docs)


def op9_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES)


def op10_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language.identify(docs, LANGUAGES).select("doc_id", "lang", "language", "confidence", F.col("accepted").alias("kept"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text of ``docs``, where every tenth document by the checksum of its id has its words from some place on replaced by
    the first of these, over and over. A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tail(ws):
        n = F.size(ws)
        a = F.when(n > 0, g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = lambda a, p: F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(ws, a + i % p))
        return F.array_join(F.concat(F.slice(ws, 1, a), let(p, lambda p: again(a, p))), " ")

    with_tail = let(words(F.col("text")), lambda ws: F.when(F.size(ws) > 0, tail(ws)))
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(with_tail, F.col("text"))).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(repeated_tails(_table(spark, sf_dir, "documents")))
    best = periodic_runs.longest_run(F.col("runs"))
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")


def op12_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    pages = _table(spark, sf_dir, "pages")
    warc.write(pages, folder)
    kind = pages.schema["page_id"].dataType
    return warc.read(spark, folder, payloads=False).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def misspelt(runs: DataFrame) -> DataFrame:
    """word of each run (id, run): every 31st by the checksum of id and run lacks one code point. A null id is written as
    nothing."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(_table(spark, sf_dir, "documents"), least=7)  # a shorter run cannot give a word of 7
    return spelling.variants(misspelt(runs), least_length=7, least_count=2, ratio=10)


QUERIES = {
    "op1_suffix_pieces": op1_suffix_pieces,
    "op2_text_density": op2_text_density,
    "op3_line_frequency": op3_line_frequency,
    "op4_addressable_ids": op4_addressable_ids,
    "op5_prob_minhash": op5_prob_minhash,
    "op6_entropy_mix": op6_entropy_mix,
    "op7_multi_index": op7_multi_index,
    "op8_line_windows": op8_line_windows,
    "op9_url_trees": op9_url_trees,
    "op10_evidence_fusion": op10_evidence_fusion,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_dictionary_warc": op12_dictionary_warc,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {"op8_line_windows": line_windows.SQL, "op12_dictionary_warc": warc.SQL}
