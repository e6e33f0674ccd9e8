"""Corpus pipeline: documents to packed training sequences, in stages that each read what the one before wrote.

Every stage works on all rows it is given, and what it decides takes effect: texts in no language that
the corpus knows go, one document of each group of near duplicates stays, passages that repeat are cut out, secrets are
masked, and what is left is packed. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm import language, neardup, packing, secrets, substring
from faresight.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled rows of docs teach.

    The output codes are learned from all labelled rows, and so is how far such a row's text may be from its language's
    codeword. Texts beyond that (letter noise, a language that no row has) and those without a letter go.
    """
    return language.with_language(docs, language.calibrated(docs, language.train(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, similarity 0.8) the row with the smallest doc_id.

    One row of each group stays, of repeated rows too; a row without a doc_id stays where its whole group has none.
    Rows without a word are in no group and all stay.
    """
    return neardup.one_of_each(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of 35 words or more that also stand elsewhere; other texts are unchanged."""
    return substring.without_repeats(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by ``[SECRET]``; other texts are unchanged."""
    return secrets.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in power-of-two sequences, with the token ids of each."""
    import public_tokenizers
    return packing.decompose(docs, public_tokenizers.path(packing.VOCABULARY)).drop("bucket")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language), ("near_duplicates", drop_near_duplicates), ("substring", cut_repeats), ("secrets", mask_secrets), ("packing", pack)]

#: No stage can be said in SQL as a whole; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
