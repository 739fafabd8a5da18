"""Review records built from the driver tables (FIXTURES.md section 3).

``lineitem`` joined to ``orders`` gives one review per line item.  The mapping
deliberately produces every case the Silver filters care about: missing keys,
JSON nulls, out-of-range ratings, empty text, the instants at the edges of the
time windows, missing counters and image arrays.  Records leave as JSON text,
exactly what a staged JSON-lines file holds.

The join is on ``orders``' key; Spark broadcasts ``orders`` only while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls
back to a shuffled join beyond it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md section 3).
TS_2024_START_MS = 1704067200000   # 2024-01-01 00:00:00
TS_MID_2024_MS = 1718409600000     # 2024-06-15 00:00:00
TS_END_2023_MS = 1704067199123     # 2023-12-31 23:59:59.123
WAVE1_BEFORE = dt.datetime(1999, 1, 1)
WAVE2_PARENT = "Q21"
# The last second of 2023 goes to a quarter of the products only, so that a
# step of that year is selective at every scale.
END_2023_PRODUCTS = 20
# Corrected input: this ship year has lost the reviews of the first products,
# the other one all of its reviews.
CORRECTED_YEAR, CORRECTED_PRODUCTS, VANISHED_YEAR = 1998, 30, 1997


def review_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per review: the join's columns that a record is made of."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").drop("l_orderkey", "o_orderkey")


# Values longer than their column: (remainder of the part key, modulus, length).
WIDE = {"title": (0, 50, 501), "parent_asin": (7, 60, 26), "asin": (3, 90, 26), "user_id": (9, 70, 51)}


def _widened(value: Column, name: str) -> Column:
    rest, modulus, length = WIDE[name]
    return F.when(F.col("l_partkey") % modulus == rest, F.rpad(value, length, "x")).otherwise(value)


def _record(parent_asin: Column, wide: bool) -> Column:
    """The review object; NULL fields are left out by ``to_json``."""
    fit = _widened if wide else lambda value, name: value
    pk = F.col("l_partkey")
    ln = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    ship_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    ts = (F.when(pk % 97 == 0, F.lit(TS_2024_START_MS))
          .when(pk % 97 == 1, F.lit(TS_MID_2024_MS))
          .when(pk % 97 == 2, F.lit(None).cast("bigint"))
          .when((pk % 97 == 3) & (pk % 80 < END_2023_PRODUCTS), F.lit(TS_END_2023_MS))
          .otherwise(ship_ms))
    images = F.when(ln % 5 == 0, F.lit(None)).otherwise(
        F.array_repeat(F.struct(F.lit("MAIN").alias("variant")), ln % 3))
    return F.struct(
        (ln % 7).cast("double").alias("rating"),
        fit(flag, "title").alias("title"),
        F.when(F.col("l_quantity") == 50, F.lit(""))
         .otherwise(F.concat(flag, F.lit("-"), F.col("l_linestatus"))).alias("text"),
        fit(F.when(pk % 101 == 5, F.lit(None)).when(pk % 101 == 6, F.lit(None))
            .otherwise(F.concat(F.lit("A"), (pk % 400).cast("string"))), "asin").alias("asin"),
        fit(parent_asin, "parent_asin").alias("parent_asin"),
        fit(F.concat(F.lit("U"), F.col("o_custkey").cast("string")), "user_id").alias("user_id"),
        ts.alias("timestamp"),
        F.when(ln % 4 == 0, F.lit(None)).otherwise(F.col("l_quantity").cast("int")).alias("helpful_vote"),
        F.when(flag == "N", F.lit(None)).otherwise(flag == "A").alias("verified_purchase"),
        images.alias("images"),
    )


def _parent(pk: Column) -> Column:
    return F.when(pk % 400 == 13, F.lit(None)).otherwise(F.concat(F.lit("P"), (pk % 80).cast("string")))


def review_lines(base: DataFrame, wave: int | None = None,
                 broken: bool = False, corrected: bool = False, wide: bool = False) -> DataFrame:
    """JSON-lines text (column ``value``, beside ``l_linenumber``) of the reviews in ``base`` (``review_base``).

    ``wide`` makes some values longer than their columns (``WIDE``).

    ``corrected`` leaves out some reviews by ship date (see CORRECTED_YEAR);
    the fixed timestamps of 2023 and 2024 stay.

    ``wave`` 1 / 2 select the two upsert waves; ``broken`` cuts every line with
    ``l_partkey % 89 = 0`` in half, which no JSON reader can parse.
    """
    pk = F.col("l_partkey")
    parent = _parent(pk)
    if wave == 1:
        base = base.filter(F.col("l_shipdate") < F.lit(WAVE1_BEFORE.isoformat(sep=" ")))
    elif wave == 2:
        base = base.filter(pk % 10 != 0)
        parent = F.when(pk % 80 == 21, F.lit(WAVE2_PARENT)).otherwise(parent)
    if corrected:
        dated = ~(pk % 97).isin(0, 1, 2) & ~((pk % 97 == 3) & (pk % 80 < END_2023_PRODUCTS))
        year = F.year("l_shipdate")
        base = base.filter(~(dated & ((year == VANISHED_YEAR)
                                      | ((year == CORRECTED_YEAR) & (pk % 80 < CORRECTED_PRODUCTS)))))
    # to_json drops NULL fields ("missing"); a JSON null is spliced in as text.
    text = F.when(pk % 101 == 6, F.concat(F.lit('{"asin":null,'), F.expr("substring(_j, 2)"))) \
        .otherwise(F.col("_j"))
    lines = base.select(F.to_json(_record(parent, wide)).alias("_j"), pk.alias("l_partkey"), "l_linenumber") \
        .select(text.alias("value"), "l_partkey", "l_linenumber")
    if broken:
        v = F.col("value")
        lines = lines.select(
            F.when(F.col("l_partkey") % 89 == 0, F.expr("substring(value, 1, length(value) div 2)"))
             .otherwise(v).alias("value"), "l_partkey", "l_linenumber")
    return lines.select("value", "l_linenumber")
