"""Table schemas.

The reference's VARCHAR(n) widths are enforced by the Silver projection
(``functions.scalar.bounded``); Spark stores plain strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE = T.StructType([
    T.StructField("raw_json", T.VariantType(), True),
    T.StructField("load_timestamp", T.TimestampNTZType(), True),
])

SILVER_COLUMNS = [
    "review_id", "asin", "parent_asin", "user_id", "rating", "review_title",
    "review_text", "helpful_vote", "verified_purchase", "review_ts", "has_images",
    "loaded_at",
]

SILVER = T.StructType([
    T.StructField("review_id", T.StringType(), True),
    T.StructField("asin", T.StringType(), True),
    T.StructField("parent_asin", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("review_title", T.StringType(), True),
    T.StructField("review_text", T.StringType(), True),
    T.StructField("helpful_vote", T.IntegerType(), True),
    T.StructField("verified_purchase", T.BooleanType(), True),
    T.StructField("review_ts", T.TimestampNTZType(), True),
    T.StructField("has_images", T.BooleanType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
])

GOLD_COLUMNS = [
    "parent_asin", "avg_rating", "total_reviews", "verified_count", "unverified_count",
    "helpful_votes_sum", "reviews_with_images", "latest_review_ts", "earliest_review_ts",
    "loaded_at",
]

GOLD = T.StructType([
    T.StructField("parent_asin", T.StringType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("total_reviews", T.LongType(), True),
    T.StructField("verified_count", T.LongType(), True),
    T.StructField("unverified_count", T.LongType(), True),
    T.StructField("helpful_votes_sum", T.LongType(), True),
    T.StructField("reviews_with_images", T.LongType(), True),
    T.StructField("latest_review_ts", T.TimestampNTZType(), True),
    T.StructField("earliest_review_ts", T.TimestampNTZType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
])

# Per (review_year, parent_asin) partial aggregates kept by the batch method:
# every Gold measure is decomposable, so touched products are re-aggregated
# from these instead of from all of Silver.
GOLD_PARTS = T.StructType([
    T.StructField("parent_asin", T.StringType(), True),
    T.StructField("rating_sum", T.DoubleType(), True),
    T.StructField("rating_n", T.LongType(), True),
    T.StructField("total_reviews", T.LongType(), True),
    T.StructField("verified_count", T.LongType(), True),
    T.StructField("unverified_count", T.LongType(), True),
    T.StructField("helpful_votes_sum", T.LongType(), True),
    T.StructField("reviews_with_images", T.LongType(), True),
    T.StructField("latest_review_ts", T.TimestampNTZType(), True),
    T.StructField("earliest_review_ts", T.TimestampNTZType(), True),
    T.StructField("review_year", T.IntegerType(), True),
])

RUN_METRICS_COLUMNS = [
    "run_id", "run_timestamp", "method", "batch_id", "bronze_row_count",
    "silver_rows_loaded", "silver_rows_deleted", "gold_rows_loaded", "duration_sec",
    "credits_used",
]

RUN_METRICS = T.StructType([
    T.StructField("run_id", T.StringType(), True),
    T.StructField("run_timestamp", T.TimestampNTZType(), True),
    T.StructField("method", T.StringType(), True),
    T.StructField("batch_id", T.IntegerType(), True),
    T.StructField("bronze_row_count", T.LongType(), True),
    T.StructField("silver_rows_loaded", T.LongType(), True),
    T.StructField("silver_rows_deleted", T.LongType(), True),
    T.StructField("gold_rows_loaded", T.LongType(), True),
    T.StructField("duration_sec", T.DoubleType(), True),
    T.StructField("credits_used", T.DoubleType(), True),
])

# A run as logged: also its state, the number of rows with a value cut to its
# declared width, and when the row was written.
RUN_LOG = T.StructType(RUN_METRICS.fields + [
    T.StructField("state", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("cut_asin", T.LongType(), True),
    T.StructField("cut_parent_asin", T.LongType(), True),
    T.StructField("cut_user_id", T.LongType(), True),
    T.StructField("cut_review_title", T.LongType(), True),
    T.StructField("logged", T.LongType(), True),
])

# Columns shared by every method's run table (U4, cross-method comparison).
SHARED_RUN_COLUMNS = [c for c in RUN_METRICS_COLUMNS if c != "batch_id"]

BATCH_STATE = T.StructType([T.StructField("next_year", T.IntegerType(), False)])


def one_row(spark: SparkSession, schema: T.StructType, values: tuple) -> DataFrame:
    """A one-row frame of ``schema`` built in the JVM, in one partition.

    Cheaper than ``createDataFrame`` from a local list (which spreads one row
    over the default parallelism) for the one-row state and metrics writes.
    Timestamps are cast from ISO text so no local zone applies.
    """
    cols = []
    for f, v in zip(schema.fields, values):
        if v is not None and isinstance(f.dataType, T.TimestampNTZType):
            lit = F.lit(v.isoformat(sep=" "))
        else:
            lit = F.lit(v)
        cols.append(lit.cast(f.dataType).alias(f.name))
    return spark.range(0, 1, 1, 1).select(*cols)

