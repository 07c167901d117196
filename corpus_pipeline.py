"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

Each stage gets what the stage before kept, with the columns of `documents`, and decides on that alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logsonde.llm.common import shared_folder, table
from logsonde.llm.decontamination import remove_items
from logsonde.llm.ngram_join import keep_one
from logsonde.llm.packing import pack
from logsonde.llm.quality import drop_bad, fit_quality
from logsonde.llm.queries import BYTE_RANKS, WORD_TOKENIZER
from logsonde.llm.secrets_scan import redact_secrets
from logsonde.llm.token_ids import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents, takes for junk or toxic go."""
    return drop_bad(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a shingle similarity of 0.8 or more stays, the one with the smallest id."""
    return keep_one(docs, threshold=0.8, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of ten words of a benchmark item, or whole shorter items, are cut out; texts made of them go."""
    return remove_items(docs, table(spark, sf_dir, "benchmark"), window=10)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact_secrets(docs, tokenizer_path(BYTE_RANKS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its ids, and its place in a sequence of 2048 tokens."""
    return pack(docs, tokenizer_path(WORD_TOKENIZER), end_id=0, capacity=2048, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't express the classifier's training; each stage is tested against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage makes of the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(path)
        docs = spark.read.parquet(path)
    return docs
