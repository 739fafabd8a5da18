"""Corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.  ``run`` writes
each stage's result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refinery.llm import best_fit, decontaminate, language, simhash
from refinery.llm.common import new_folder, read, ship
from refinery.llm.queries import WORD_BPE


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier can tell."""
    ship(spark)
    return language.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of benchmark words."""
    ship(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in training sequences."""
    ship(spark)
    return best_fit.best_fit(docs, WORD_BPE, added_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The classifier of the first stage cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
