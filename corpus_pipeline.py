"""From raw documents to token ids: quality, exact and near copies, source mix, tokens.

Every stage works on all its predecessor kept. Filtering stages return rows of ``documents``
with all their columns; the last returns ids.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorfold.llm.common import shared_dir  # noqa: E402
from sensorfold.llm.op3_mix_sources import mixed_documents  # noqa: E402
from sensorfold.llm.op4_bpe import encode_documents  # noqa: E402
from sensorfold.llm.op5_quality import keep_good  # noqa: E402
from sensorfold.llm.op7_ngram_join import keep_one  # noqa: E402
from sensorfold.llm.op10_exact_dedup import dedup  # noqa: E402


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the quality classifier turns down."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return dedup(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity of 0.8 or more."""
    return keep_one(docs, width=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that sources reach their targets."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of ids and decoded text."""
    return encode_documents(docs, more=("ids",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("mix", mixed_sources),
    ("tokens", token_ids),
]

#: The classifier and the tokeniser have no SQL form; tests hold the stages against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
