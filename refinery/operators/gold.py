"""Silver -> Gold per product.

Every Gold measure is decomposable (sum, count, count_if, min, max; the
average is sum / count), so Spark aggregates partially on the map side and
shuffles at most one row per product per task: a product holding a third of
all reviews costs no more shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.scalar import round_half_up
from refinery.spec import MethodSpec

KEY = "parent_asin"

GOLD_DATA_COLUMNS = [
    "parent_asin", "avg_rating", "total_reviews", "verified_count", "unverified_count",
    "helpful_votes_sum", "reviews_with_images", "latest_review_ts", "earliest_review_ts",
]


def _avg(c: Column, spec: MethodSpec) -> Column:
    return round_half_up(c, 2) if spec.round_avg else c


def aggregate(silver: DataFrame, spec: MethodSpec) -> DataFrame:
    """One Gold row per ``parent_asin`` (G1, G3; no ``loaded_at``).

    COUNT_IF(b = TRUE / FALSE) leaves NULL in neither count (G6); SUM is NULL
    when every input is NULL (G7).
    """
    if spec.drop_null_parent:
        silver = silver.filter(F.col(KEY).isNotNull())
    return silver.groupBy(KEY).agg(
        _avg(F.avg("rating"), spec).alias("avg_rating"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("verified_purchase") == F.lit(True)).alias("verified_count"),
        F.count_if(F.col("verified_purchase") == F.lit(False)).alias("unverified_count"),
        F.sum("helpful_vote").cast("bigint").alias("helpful_votes_sum"),
        F.count_if(F.col("has_images") == F.lit(True)).alias("reviews_with_images"),
        F.max("review_ts").alias("latest_review_ts"),
        F.min("review_ts").alias("earliest_review_ts"),
    )


def touched_keys(silver_slice: DataFrame) -> DataFrame:
    """``SELECT DISTINCT parent_asin`` of a slice (G9).  NULL is dropped: the
    reference's ``parent_asin IN (...)`` never matches it (V11)."""
    return silver_slice.select(KEY).filter(F.col(KEY).isNotNull()).distinct()


def rows_of_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``WHERE parent_asin IN (keys)`` as a left-semi join.

    The planner broadcasts ``keys`` only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time);
    otherwise both sides shuffle on the key.
    """
    return df.join(keys, KEY, "left_semi")


def replace_keys(gold: DataFrame, keys: DataFrame, recomputed: DataFrame) -> DataFrame:
    """DELETE ... WHERE key IN (keys) + INSERT recomputed.

    ``left_anti`` keeps NULL-key rows, as the reference's DELETE does.
    """
    kept = gold.join(keys, KEY, "left_anti")
    return kept.unionByName(recomputed, allowMissingColumns=True)


# ---- partial aggregates for the batch method ------------------------------

def partials(silver: DataFrame, year_col: str | None = None) -> DataFrame:
    """Per-product partial Gold measures of a Silver slice (NULL key dropped).

    With ``year_col`` the partials are kept per (year, product), which is what
    the batch method stores next to Silver.
    """
    keys = [KEY] + ([year_col] if year_col else [])
    return silver.filter(F.col(KEY).isNotNull()).groupBy(*keys).agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("verified_purchase") == F.lit(True)).alias("verified_count"),
        F.count_if(F.col("verified_purchase") == F.lit(False)).alias("unverified_count"),
        F.sum("helpful_vote").cast("bigint").alias("helpful_votes_sum"),
        F.count_if(F.col("has_images") == F.lit(True)).alias("reviews_with_images"),
        F.max("review_ts").alias("latest_review_ts"),
        F.min("review_ts").alias("earliest_review_ts"),
    )


def combine_partials(parts: DataFrame, spec: MethodSpec) -> DataFrame:
    """Merge partials into Gold rows: equal to ``aggregate`` over the rows the
    partials were built from."""
    return parts.groupBy(KEY).agg(
        _avg(F.sum("rating_sum") / F.sum("rating_n"), spec).alias("avg_rating"),
        F.sum("total_reviews").cast("bigint").alias("total_reviews"),
        F.sum("verified_count").cast("bigint").alias("verified_count"),
        F.sum("unverified_count").cast("bigint").alias("unverified_count"),
        F.sum("helpful_votes_sum").cast("bigint").alias("helpful_votes_sum"),
        F.sum("reviews_with_images").cast("bigint").alias("reviews_with_images"),
        F.max("latest_review_ts").alias("latest_review_ts"),
        F.min("earliest_review_ts").alias("earliest_review_ts"),
    )


def top_products(gold: DataFrame, k: int = 5) -> DataFrame:
    """``ORDER BY total_reviews DESC LIMIT k`` (L4), ``parent_asin`` breaks ties.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top k, so
    only k rows per task reach the final merge.
    """
    return gold.orderBy(F.col("total_reviews").desc(), F.col(KEY).asc_nulls_first()).limit(k)
