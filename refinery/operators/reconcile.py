"""Reconciliation of two refresh methods.

The reference compares row counts only; counts hide most method differences
(SURVEY 1.4), so rows are compared too: keyed tables by a full outer join on
the key with NULL-safe equality, keyless ones (Silver keeps duplicates) as
multisets by counting each distinct row on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.scalar import fingerprint

# Column labels of the layer-count report (fixed values, as published).
LAYER_LABEL = "warstwa"
ROWS_LABEL = "wierszy"


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row count per layer, one union branch per layer.

    Each count is a global aggregate (partial count per task, one final row),
    and the one-row results are unioned.
    """
    parts = [df.agg(F.count(F.lit(1)).alias(ROWS_LABEL))
             .select(F.lit(name).alias(LAYER_LABEL), ROWS_LABEL) for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def method_counts(layer: str, **methods: DataFrame) -> DataFrame:
    """Row count of one layer per method."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(m).alias("method"), "row_count")
             for m, df in methods.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keyed_differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str],
                      a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Keys whose rows differ between ``a`` and ``b``.

    Output: the keys, ``status`` (``only_<a>``, ``only_<b>`` or ``differs``)
    and ``differing_columns`` (comma list in ``columns`` order; empty for
    one-sided keys).  NULL keys
    match each other (the NULL product group is a real Gold row).
    """
    la = a.select(*[F.col(c).alias(f"a__{c}") for c in keys + columns], F.lit(True).alias("a__in"))
    lb = b.select(*[F.col(c).alias(f"b__{c}") for c in keys + columns], F.lit(True).alias("b__in"))
    cond: Column | None = None
    for k in keys:
        c = F.col(f"a__{k}").eqNullSafe(F.col(f"b__{k}"))
        cond = c if cond is None else cond & c
    j = la.join(lb, cond, "full_outer")
    diffs = [F.when(~F.col(f"a__{c}").eqNullSafe(F.col(f"b__{c}")), F.lit(c)) for c in columns]
    status = (F.when(F.col("b__in").isNull(), F.lit(f"only_{a_name}"))
              .when(F.col("a__in").isNull(), F.lit(f"only_{b_name}"))
              .otherwise(F.lit("differs")))
    out = j.select(*[F.coalesce(F.col(f"a__{k}"), F.col(f"b__{k}")).alias(k) for k in keys],
                   status.alias("status"),
                   F.when(status == "differs", F.concat_ws(",", *diffs))
                   .otherwise(F.lit("")).alias("differing_columns"))
    return out.filter((F.col("status") != "differs") | (F.col("differing_columns") != ""))


def multiset_differences(a: DataFrame, b: DataFrame, a_name: str = "a",
                         b_name: str = "b") -> DataFrame:
    """Rows held more often by one side than the other (keyless tables).

    Both sides are unioned and counted per 128-bit row hash, NULLs included (partial
    aggregation first, so a row repeated a billion times costs one small record
    per task).  Only rows whose hash differs in its counts are then read in
    full and counted as rows; they come out once, with ``side`` and ``copies``
    = the surplus.  Where the tables mostly agree, no full row is shuffled.
    """
    cols = a.columns
    tagged = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
              .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    h1, h2 = fingerprint(cols)
    tagged = tagged.withColumn("_h1", h1).withColumn("_h2", h2)
    differing = (tagged.groupBy("_h1", "_h2").agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
                 .filter(F.col("_na") != F.col("_nb")).select("_h1", "_h2"))
    counts = (tagged.join(differing, ["_h1", "_h2"], "left_semi").groupBy(*cols)
              .agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb")))
    return (counts.filter(F.col("_na") != F.col("_nb"))
            .select(*cols,
                    F.when(F.col("_na") > F.col("_nb"), F.lit(f"only_{a_name}"))
                     .otherwise(F.lit(f"only_{b_name}")).alias("side"),
                    F.abs(F.col("_na") - F.col("_nb")).cast("bigint").alias("copies")))
