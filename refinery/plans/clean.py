"""Clean refresh (P1): full Bronze -> full Silver -> full Gold -> metrics.

Two snapshot replaces.  Silver is a narrow projection of Bronze (no shuffle);
Gold is one partial/final aggregation over Silver.  Counts come from
``Observation``s on the writes themselves; Bronze's rows are counted from its
files' footers, as an observation on its scan would keep Spark from reading the
record's fields alone.
"""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from refinery.functions.scalar import ntz
from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.plans.metrics import RUNS, Clock, RunMetrics, elapsed_sec, estimate_credits, failures_logged, log_run
from refinery.plans.store import TableStore
from refinery.plans.tags import method_tag, statement
from refinery.schemas import GOLD, SILVER
from refinery.sources.staged import read_bronze
from refinery.spec import CLEAN

SILVER_T = "silver"
GOLD_T = "gold"


def create_clean_tables(store: TableStore) -> None:
    """CREATE OR REPLACE the clean-refresh tables (A5): empty Silver and Gold,
    a fresh run table."""
    store.truncate(SILVER_T, SILVER)
    store.truncate(GOLD_T, GOLD)
    store.reset_appended(RUNS)


def clean_refresh(spark: SparkSession, bronze_path: str, store: TableStore,
                  clock: Clock | None = None, credits_per_hour: float | None = 1.0,
                  strict: bool = False) -> RunMetrics:
    """One clean refresh; every job it starts is tagged ``method=clean_refresh``.

    ``strict`` fails the run on a value that does not cast (D3)."""
    clock = clock or Clock()
    start = clock.now()
    with method_tag(spark, "clean_refresh"), failures_logged(store, "clean_refresh", clock, start):
        return _clean_refresh(spark, bronze_path, store, clock, start, credits_per_hour, strict)


def _clean_refresh(spark, bronze_path, store, clock, start, credits_per_hour, strict) -> RunMetrics:
    now = ntz(start)

    previous = store.current(SILVER_T)
    replaced = spark.read.schema(SILVER).parquet(previous).count() if previous else 0  # D8

    obs_s, obs_w = Observation("silver"), Observation("widths")
    bronze = read_bronze(spark, bronze_path)
    bronze_rows = bronze.count()
    silver = silver_ops.with_load_clock(silver_ops.extract(bronze, CLEAN, strict, obs_w), now)
    with statement(spark, "TRUNCATE + INSERT INTO silver"):
        store.replace(SILVER_T, silver.observe(obs_s, F.count(F.lit(1)).alias("n")))

    obs_g = Observation("gold")
    gold = gold_ops.aggregate(store.read(SILVER_T, SILVER), CLEAN).withColumn("loaded_at", now)
    with statement(spark, "TRUNCATE + INSERT INTO gold"):
        store.replace(GOLD_T, gold.observe(obs_g, F.count(F.lit(1)).alias("n")))

    duration = elapsed_sec(start, clock.now())
    row = RunMetrics(
        run_id=clock.new_id(), run_timestamp=start, method="clean_refresh", batch_id=None,
        bronze_row_count=bronze_rows, silver_rows_loaded=int(obs_s.get["n"]),
        silver_rows_deleted=int(replaced), gold_rows_loaded=int(obs_g.get["n"]),
        duration_sec=duration, credits_used=estimate_credits(duration, credits_per_hour),
        cut=dict(obs_w.get))
    log_run(store, row)
    return row
