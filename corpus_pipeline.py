"""The training-data pipeline: stages over ``documents``, each written as Parquet and read by the next.

1. ``language_id``: documents that language ID rejects go (no text, no letter, or n-grams that no learned
   language knows); the filters are learned from the labelled rows that are not held out.
2. ``jaccard_join``: of each group of documents linked by word-5-gram Jaccard similarity >= 0.8 one stays.
3. ``decontaminate``: documents that hold a 10-word window of ``benchmark`` go.
4. ``pii``: personal data is replaced by placeholders such as ``[EMAIL]``; no document goes.
5. ``sentencepiece``: ids of every text that is left, with a check that decoding gives the text back.

All stages but the last return the columns of ``documents``. Null texts and texts without a letter go
in stage 1; repeated rows stand once after stage 2; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from centroidal.llm.decontaminate import remove_leaks
from centroidal.llm.frames import dropped, table, written
from centroidal.llm.jaccard import keep_one_of_each
from centroidal.llm.language import fit_languages, keep_known_languages, training_rows
from centroidal.llm.pii import redact_docs
from centroidal.llm.registry import MODEL_PATH
from centroidal.llm.sentencepieces import encode_texts


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_languages(docs, fit_languages(training_rows(docs)))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_docs(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, MODEL_PATH)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("jaccard_join", jaccard_join), ("decontaminate", decontaminate), ("pii", pii),
    ("sentencepiece", sentencepiece),
]

#: No SQL: the learned filters, the tokenizer and the components are beyond it (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(before)  # a stage's table has one reader, the next stage
    return docs
