"""Batch method (P2, P3, A11-A13): one calendar year per call.

Layout that makes a yearly step cost one year of data, not the whole history:

* Bronze is partitioned by ``review_year``: the step reads one partition.
* Silver is partitioned by ``review_year``: the step *overwrites* its year
  (dynamic partition overwrite), so a retry after a failure cannot duplicate
  rows (D9) -- the reference appends and would.
* ``gold_parts`` holds per (year, product) partial aggregates, also
  partitioned by year.  Gold rows of the products a year touched are rebuilt
  from these partials: one row per product-year instead of every Silver row of
  the product, and a product with a third of all reviews still weighs one row
  per year.  The result equals the reference's re-aggregation of all Silver
  rows of the touched products (J1-J3, G2).
* Gold is replaced as a new snapshot: untouched rows are carried over by a
  left-anti join on the touched keys.  A year that was loaded before (a re-run
  of corrected input) also touches the products it held then; those keys are
  saved before its partitions change, so a retry still knows them.
* The watermark is a numbered small file (the old one stands until the new one
  is whole).  Each step logs its row, without a Spark job, before the watermark
  moves: a run cut off after k years has k rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.scalar import ntz
from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.plans.metrics import RUNS, Clock, RunMetrics, elapsed_sec, estimate_credits, failures_logged, log_run
from refinery.plans.store import TableStore
from refinery.plans.tags import method_tag, statement
from refinery.schemas import BATCH_STATE, GOLD, GOLD_PARTS, SILVER, one_row
from refinery.sources.staged import YEAR_COL, bronze_years, read_bronze, year_present
from refinery.spec import BATCH, FIRST_BATCH_YEAR, LAST_BATCH_YEAR

SILVER_T = "silver"
PARTS_T = "gold_parts"
GOLD_T = "gold"
STATE_T = "batch_state"
SILVER_PART = T.StructType(SILVER.fields + [T.StructField(YEAR_COL, T.IntegerType(), True)])
PENDING_T = "batch_pending"
PENDING = T.StructType([T.StructField(gold_ops.KEY, T.StringType(), True)])
DONE = "all batches done"


@dataclass
class BatchResult:
    status: str
    year: int | None
    rows: int
    gold_rows_written: int = 0      # D10: rows really written to Gold
    metrics: RunMetrics | None = None


def create_batch_tables(spark: SparkSession, store: TableStore,
                        first_year: int = FIRST_BATCH_YEAR) -> None:
    """CREATE OR REPLACE the batch tables and seed the watermark."""
    for name in (SILVER_T, PARTS_T, RUNS):
        store.reset_appended(name)
    store.truncate(GOLD_T, GOLD)
    store.put_state(f"{store.path(PENDING_T)}/year", "none\n")
    set_next_year(spark, store, first_year)


def reset_batch(spark: SparkSession, store: TableStore, year: int = 2000) -> None:
    """TRUNCATE Silver, Gold and metrics and set the watermark.

    Years before ``year`` are not loaded again afterwards: the reference's
    reset to 2000 drops 1996-1999 for good.
    """
    create_batch_tables(spark, store, first_year=year)


def set_next_year(spark: SparkSession, store: TableStore, year: int) -> None:
    """UPDATE batch_state SET next_year = year (A12): one small file."""
    store.put_state(f"{store.path(STATE_T)}/next_year", f"{int(year)}\n")


def next_year(store: TableStore) -> int:
    found = store.get_state(f"{store.path(STATE_T)}/next_year")
    if found is None:
        raise RuntimeError("batch_state is empty: call create_batch_tables first")
    return int(found)


def read_state(spark: SparkSession, store: TableStore):
    """The one-row ``batch_state`` table."""
    return one_row(spark, BATCH_STATE, (next_year(store),))


def process_next_batch(spark: SparkSession, bronze_path: str, store: TableStore,
                       clock: Clock | None = None, credits_per_hour: float | None = 1.0,
                       last_year: int = LAST_BATCH_YEAR,
                       bronze_rows: int | None = None,
                       gold_rows: int | None = None, strict: bool = False) -> BatchResult:
    """One yearly step (P2); returns the reference's status string.

    ``bronze_rows`` / ``gold_rows`` let a caller that already knows the Bronze
    size and the current Gold size skip recounting them.
    """
    with method_tag(spark, "batch"):
        return _logged_step(spark, bronze_path, store, clock or Clock(), credits_per_hour, last_year,
                            bronze_rows, gold_rows, strict, year_present(spark, bronze_path, next_year(store)))


def _logged_step(spark, bronze_path, store, clock, credits_per_hour, last_year, bronze_rows, gold_rows,
                 strict, present) -> BatchResult:
    """One step, its row in the run log, then the watermark."""
    start = clock.now()
    year = next_year(store)
    with failures_logged(store, "batch", clock, start, year):
        r = _step(spark, bronze_path, store, clock, start, year, credits_per_hour, last_year, bronze_rows,
                  gold_rows, strict, present)
    if r.metrics is not None:
        log_run(store, r.metrics)
        set_next_year(spark, store, r.year + 1)
    return r


def _load_silver(spark, bronze_path, store, year, now, strict) -> tuple[int, dict]:
    """Overwrite the year's Silver partition; its rows, and the values cut by column."""
    obs, obs_w = Observation(f"silver_{year}"), Observation(f"widths_{year}")
    silver_y = (silver_ops.extract(read_bronze(spark, bronze_path, year=year), BATCH.for_year(year), strict, obs_w)
                .withColumn("loaded_at", now).withColumn(YEAR_COL, F.lit(year))
                .observe(obs, F.count(F.lit(1)).alias("n")))
    with statement(spark, f"INSERT INTO silver (year {year})"):
        store.overwrite_partitions(SILVER_T, silver_y, YEAR_COL)
    return int(obs.get["n"]), dict(obs_w.get)


def _step(spark, bronze_path, store, clock, start, year, credits_per_hour, last_year, bronze_rows, gold_rows,
          strict, present) -> BatchResult:
    """Silver and Gold of one year; the caller logs it and advances the watermark."""
    now = ntz(start)
    if year > last_year:
        return BatchResult(DONE, None, 0)

    # 0) A year loaded before: the products it held are touched too.  They are
    #    saved first, as its partitions are about to change.
    pending_file = f"{store.path(PENDING_T)}/year"
    again = store.get_state(pending_file) == str(year)
    if store.has_partition(PARTS_T, YEAR_COL, year):
        old = store.read_partition(PARTS_T, GOLD_PARTS, YEAR_COL, year).select(gold_ops.KEY)
        if again:
            old = old.unionByName(store.read(PENDING_T, PENDING)).distinct()
        with statement(spark, f"save touched products (year {year})"):
            store.replace(PENDING_T, old)
        store.put_state(pending_file, f"{year}\n")
        again = True

    # 1) Silver: this year's rows; the Bronze read is pruned to one partition,
    #    and a year with no Bronze partition has nothing to load.
    rows, cut = _load_silver(spark, bronze_path, store, year, now, strict) if present else (0, {})
    if not rows:  # an overwrite without rows leaves the old ones
        for name in (SILVER_T, PARTS_T):
            store.drop_partition(name, YEAR_COL, year)

    # 2) Gold: replace the products this year touches, or touched when it was
    #    loaded before; a product without partials left goes.
    gold_written = 0
    if rows or again:
        if rows:
            year_rows = store.read_partition(SILVER_T, SILVER_PART, YEAR_COL, year)
            parts_y = gold_ops.partials(year_rows).withColumn(YEAR_COL, F.lit(year))
            with statement(spark, f"INSERT INTO gold partials (year {year})"):
                store.overwrite_partitions(PARTS_T, parts_y, YEAR_COL)
        all_parts = store.read_partitioned(PARTS_T, GOLD_PARTS)
        touched = store.read_partition(PARTS_T, GOLD_PARTS, YEAR_COL, year).select(gold_ops.KEY)
        if again:
            touched = touched.unionByName(store.read(PENDING_T, PENDING)).distinct()
        recomputed = gold_ops.combine_partials(gold_ops.rows_of_keys(all_parts, touched), BATCH) \
            .withColumn("loaded_at", now).withColumn("_new", F.lit(True))
        obs_g = Observation(f"gold_{year}")
        new_gold = gold_ops.replace_keys(store.read(GOLD_T, GOLD), touched, recomputed) \
            .observe(obs_g, F.count(F.lit(1)).alias("n"),
                     F.count_if(F.col("_new").isNotNull()).alias("written")) \
            .select(*GOLD.fieldNames())
        with statement(spark, f"DELETE + INSERT INTO gold (year {year})"):
            store.replace(GOLD_T, new_gold)
        gold_written = int(obs_g.get["written"])
        gold_total = int(obs_g.get["n"])
        if again:
            store.put_state(pending_file, "none\n")
    elif gold_rows is not None:
        gold_total = int(gold_rows)
    else:
        gold_total = store.read(GOLD_T, GOLD).count()

    # 3) metrics: gold_rows_loaded is the Gold total, as in the reference.
    if bronze_rows is None:
        bronze_rows = read_bronze(spark, bronze_path).count()
    duration = elapsed_sec(start, clock.now())
    metrics = RunMetrics(
        run_id=clock.new_id(), run_timestamp=start, method="batch", batch_id=year,
        bronze_row_count=int(bronze_rows), silver_rows_loaded=rows, silver_rows_deleted=0,
        gold_rows_loaded=gold_total, duration_sec=duration,
        credits_used=estimate_credits(duration, credits_per_hour), cut=cut)
    return BatchResult(f"processed batch year={year} rows={rows}", year, rows, gold_written, metrics)


def run_all_batches(spark: SparkSession, bronze_path: str, store: TableStore,
                    calls: int | None = None, clock: Clock | None = None,
                    credits_per_hour: float | None = 1.0, last_year: int = LAST_BATCH_YEAR,
                    strict: bool = False) -> list[BatchResult]:
    """Catch-up loop (P3): steps until all are done, or ``calls`` of them.

    Whether a year has input is known from one listing.  Each step logs its row
    and moves the watermark before the next one begins.
    """
    clock = clock or Clock()
    out: list[BatchResult] = []
    with method_tag(spark, "batch"):
        years = bronze_years(spark, bronze_path)
        bronze_rows = read_bronze(spark, bronze_path).count()
        gold_rows = None
        while calls is None or len(out) < calls:
            year = next_year(store)
            r = _logged_step(spark, bronze_path, store, clock, credits_per_hour, last_year, bronze_rows,
                             gold_rows, strict, years is None or year in years)
            out.append(r)
            if r.status == DONE:
                break
            gold_rows = r.metrics.gold_rows_loaded
    return out


def read_silver(store: TableStore):
    """Batch Silver with its 12 reference columns (``review_year`` dropped)."""
    return store.read_partitioned(SILVER_T, SILVER_PART).drop(YEAR_COL)
