"""The training-data pipeline: five stages over `documents`, each written as Parquet before the next reads it.

Every stage takes (spark, docs, sf_dir). Texts may be null or empty, rows may repeat, tables may be empty, and extra columns
pass through; all but the last stage return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.llm.common import as_row, from_row, read_table, written
from riskstream.llm.decontaminate import decontaminated
from riskstream.llm.language import UNKNOWN, identify, learn_languages
from riskstream.llm.packing import packed_documents
from riskstream.llm.pii import redacted
from riskstream.llm.simhash import one_of_each

SHINGLE, DIFFERENT_BITS = 4, 4          # as the operator's own query has them


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language can be told: null texts and texts without a letter, also if no language is learned."""
    model = learn_languages(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs.select(as_row(docs, "text"), "text"), model)
    return from_row(found.where(found["lang_pred"] != UNKNOWN), docs, text="text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of documents whose SimHash fingerprints are linked the one with the smallest doc_id."""
    return one_of_each(docs, most=DIFFERENT_BITS, width=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, also one with other numbers, names or units."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts <kind> in place of personal data."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts documents into pieces of tokens and packs them into sequences."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", packing),
]

# The stages learn, hash and tokenise, which SQL can't express; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
