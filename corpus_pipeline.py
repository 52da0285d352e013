"""From raw documents to packed sequences: each stage is written to the shared folder and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontaminate, harmonic, language_codes, secret_scan, signature_tree
from tallyforge.llm.frames import small_batches, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told clearly; the classifier learns from the labelled ones among them."""
    small_batches(spark)
    return language_codes.keep_identified(docs, language_codes.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked texts the document with the smallest id; rows of one id are told apart by their text."""
    small_batches(spark)
    return signature_tree.drop_near_copies(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without a passage of the benchmark."""
    small_batches(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets blotted out."""
    small_batches(spark)
    return secret_scan.redact(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they lie in."""
    small_batches(spark)
    return harmonic.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("secrets", remove_secrets),
    ("packing", pack),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
