"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.llm import decontaminate, phrases, urls
from riskstream.llm.alignment import alignment_report
from riskstream.llm.chat import formatted, read_back
from riskstream.llm.common import hash_part, read_table
from riskstream.llm.decontaminate import benchmark_hits
from riskstream.llm.language import identify, learn_languages
from riskstream.llm.lm import scored
from riskstream.llm.packing import packed_documents
from riskstream.llm.phrases import collocations
from riskstream.llm.pii import personal_data, span_report
from riskstream.llm.repeats import without_repeats
from riskstream.llm.sampling import compared_with_next
from riskstream.llm.simhash import near_components
from riskstream.llm.urls import ALLOW, BLOCK, Rule, judged
from riskstream.llm.warc import read_archives, write_archives
from riskstream.workspace import shared_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = (Rule(BLOCK, "net"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    read = read_back(formatted(rows.union(own)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    archives = write_archives(read_table(spark, sf_dir, "pages"), folder)
    return read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"), RANKS)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn_languages(docs))
    return found.select(
        "doc_id", F.coalesce(hash_part("doc_id") % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packed_documents(read_table(spark, sf_dir, "documents"), RANKS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = span_report(personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    return report.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document that loses something: what is left, and the spans that go, as start:end:kept_doc_id."""
    found = without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    one = lambda r: F.concat_ws(":", r["start"], r["end"], F.coalesce(r["kept_doc_id"].cast("string"), F.lit("")))
    return found.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("removed_chars"),
        F.array_join(F.transform("removed", one), ",").alias("removed"), F.col("text").alias("kept_text"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("_text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(read_table(spark, sf_dir, "documents"), RANKS, PIECES)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_warc": op2_warc,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_weighted_sampling": op8_weighted_sampling,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op10_decontamination": decontaminate.ORACLE,
    "op11_collocations": phrases.oracle(),
    "op13_url_filter": urls.oracle(URL_RULES),
}
