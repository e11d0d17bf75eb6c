"""A training corpus in five stages: language ID, exact dedup, near-dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cinderframe.llm import exact_dedup, language_id, near_copies, packing, suffix_dedup
from cinderframe.llm.tables import read, release, shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows, with it where none was given; `und` ones go, and those of scores at which verdicts are mostly wrong."""
    return language_id.drop_unknown(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies: five-word shingles, SimHash tries and then sets, Jaccard similarity 0.8 or more."""
    return near_copies.drop_near_copies(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that an earlier one holds."""
    return suffix_dedup.remove_repeats(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("suffix-array dedup", passages),
    ("best-fit packing", packs),
]

#: A trained classifier, link components and best-fit are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read again as the next one's input.

    Rows with null ids, repeated rows and null or empty texts pass through as the stages' operators state; an empty table gives no rows.
    """
    docs, folder = read(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            if k:
                release(spark, f"{folder}/{k - 1}")  # the last table stays, as the result reads it
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
