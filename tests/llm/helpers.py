"""Small tables for the operator tests."""

from __future__ import annotations

import random

from refinery.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def docs(spark, rows, extra: bool = False):
    """A documents table from (doc_id, text) or (doc_id, text, lang)."""
    ship(spark)
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:  # names that the operators use inside
        from pyspark.sql import functions as F

        for name in ("fp", "row", "length", "rank", "key", "h", "part"):
            df = df.withColumn(name, F.lit(1))
    return df


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(df):
    """Rows as tuples in the order of columns, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
