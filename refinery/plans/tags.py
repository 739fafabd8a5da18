"""Job tags and statement labels (the reference's QUERY_TAG and query text).

Every job a method starts carries the tag ``method=<name>``, and each write is
labelled with the statement it stands for.  Spark's event log holds both beside
what Spark measured, so ``sources.eventlog`` can be filtered by method or by
statement text.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def method_tag(spark: SparkSession, method: str):
    """Tag the run's jobs."""
    tag = f"method={method}"
    spark.addTag(tag)
    try:
        yield tag
    finally:
        spark.removeTag(tag)


@contextmanager
def statement(spark: SparkSession, text: str):
    """Label the statement's jobs."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.job.description", previous)
