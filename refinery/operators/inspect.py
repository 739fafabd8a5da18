"""Bronze checks (B5, G10, G11, A14): field inspection and year histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.scalar import epoch_ms_to_ts
from refinery.functions.variant import array_size, field, whole_number

PREVIEW_COLUMNS = ["rating", "review_title", "review_text", "asin", "parent_asin", "user_id",
                   "ts_unix", "verified_purchase", "helpful_vote", "image_count"]


def field_preview(bronze: DataFrame, k: int | None = 10) -> DataFrame:
    """The ten known fields, typed, plus the image count.

    The reference takes any 10 rows; here the first 10 in a total order over
    all ten columns (newest first), so the result is the same on every run.
    The sort + limit plans as ``TakeOrderedAndProject`` (k rows per task).
    """
    out = bronze.select(
        field("rating", "double").alias("rating"),
        field("title", "string").alias("review_title"),
        field("text", "string").alias("review_text"),
        field("asin", "string").alias("asin"),
        field("parent_asin", "string").alias("parent_asin"),
        field("user_id", "string").alias("user_id"),
        whole_number("timestamp").alias("ts_unix"),
        field("verified_purchase", "boolean").alias("verified_purchase"),
        whole_number("helpful_vote", "int").alias("helpful_vote"),
        array_size("images").alias("image_count"),
    )
    if k is None:
        return out
    order = [F.col("ts_unix").desc_nulls_last()] + \
        [F.col(c).asc_nulls_last() for c in PREVIEW_COLUMNS if c != "ts_unix"]
    return out.orderBy(*order).limit(k)


def year_histogram(bronze: DataFrame) -> DataFrame:
    """Rows per year of the raw timestamp, by year.

    Bronze carries ``review_year`` = year of that same timestamp as its
    partition column; when present it is used, and the count needs no
    variant decoding at all.
    """
    if "review_year" in bronze.columns:
        yr = F.col("review_year")
    else:
        yr = F.year(epoch_ms_to_ts(whole_number("timestamp")))
    return (bronze.groupBy(yr.alias("yr")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("yr").asc_nulls_first()))


def preview(df: DataFrame, k: int = 5) -> DataFrame:
    """``SELECT ... LIMIT k``."""
    return df.limit(k)
