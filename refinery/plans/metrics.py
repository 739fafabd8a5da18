"""Run metrics, KPI reports and cost.

The run log is append-only, one row per run (per yearly batch for the batch
method), runs that failed included.  Rows are built on the driver from figures
the job already holds (``Observation`` counts, the driver clock), so logging
never rescans a layer, and are durable when the run returns: a JSON line
written without a Spark job.  ``read_runs`` gives the run table of the reports:
succeeded runs, the last one of a batch that was run again.  Reports are plain
DataFrame projections over it.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field as dc_field
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.functions.scalar import round_half_up, ntz
from refinery.schemas import RUN_LOG, RUN_METRICS_COLUMNS, SHARED_RUN_COLUMNS

RUNS = "run_metrics"
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"

# Cost assumptions of the reference (fixed values): the batch estimate uses
# 1 credit per hour of run time, the upsert cost report 2 USD per credit.
CREDITS_PER_HOUR = 1.0
USD_PER_CREDIT = 2.0

# Report labels of the latest-upsert KPI (fixed values, as published).
LABEL_BRONZE = "Wiersze Bronze"
LABEL_SILVER = "Zapisy do Silver (Insert/Update)"
LABEL_GOLD = "Zapisy do Gold (Insert/Update)"
LABEL_DURATION = "Czas trwania (s)"
LABEL_WAREHOUSE_TIME = "Czas pracy warehouse (s)"
LABEL_COST = "Szac. koszt (USD)*"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Clock:
    """Time and id source of a run; tests pass fixed ones."""
    now: Callable[[], dt.datetime] = utc_now
    new_id: Callable[[], str] = dc_field(default=lambda: str(uuid.uuid4()))


@dataclass
class RunMetrics:
    run_id: str
    run_timestamp: dt.datetime
    method: str
    batch_id: int | None
    bronze_row_count: int | None
    silver_rows_loaded: int | None
    silver_rows_deleted: int | None
    gold_rows_loaded: int | None
    duration_sec: float
    credits_used: float | None
    cut: dict = dc_field(default_factory=dict)  # rows whose value was cut to its declared width, by column
    state: str = SUCCEEDED
    error: str | None = None

    def as_row(self) -> dict:
        out = {c: getattr(self, c) for c in (*RUN_METRICS_COLUMNS, "state", "error")}
        return out | {f"cut_{c}": n for c, n in self.cut.items()} | {"logged": time.time_ns()}


def elapsed_sec(start: dt.datetime, end: dt.datetime) -> float:
    """Whole milliseconds elapsed, in seconds (X11: DATEDIFF('millisecond') / 1000.0)."""
    return ((end - start) // dt.timedelta(milliseconds=1)) / 1000.0


def estimate_credits(duration_sec: float, credits_per_hour: float | None) -> float | None:
    """Seconds / 3600 x rate, rounded to 6 places (P10); NULL without a rate."""
    if credits_per_hour is None:
        return None
    return round(duration_sec / 3600.0 * credits_per_hour, 6)


def log_run(store, row: RunMetrics) -> None:
    """INSERT INTO run_metrics (P5)."""
    store.log(RUNS, [row.as_row()])


@contextmanager
def failures_logged(store, method: str, clock: Clock, start: dt.datetime, batch_id: int | None = None):
    """Log the run as FAILED if it fails (F12), then let it fail."""
    try:
        yield
    except BaseException as e:
        log_run(store, RunMetrics(
            run_id=clock.new_id(), run_timestamp=start, method=method, batch_id=batch_id, bronze_row_count=None,
            silver_rows_loaded=None, silver_rows_deleted=None, gold_rows_loaded=None,
            duration_sec=elapsed_sec(start, clock.now()), credits_used=None, state=FAILED,
            error=f"{type(e).__name__}: {e}"[:500]))
        raise


def read_run_log(store) -> DataFrame:
    """Every run, failed ones included."""
    return store.read_log(RUNS, RUN_LOG)


def read_runs(store) -> DataFrame:
    """The run table: succeeded runs, for each batch the last one logged."""
    last = Window.partitionBy("method", F.coalesce(F.col("batch_id").cast("string"), F.concat(F.lit("run "), F.col("logged").cast("string")))) \
        .orderBy(F.desc("logged"))
    return (read_run_log(store).filter(F.col("state") == SUCCEEDED).withColumn("_last", F.row_number().over(last))
            .filter(F.col("_last") == 1).select(*RUN_METRICS_COLUMNS))


# ---- reports -----------------------------------------------------------------

def kpi_per_batch(runs: DataFrame) -> DataFrame:
    """KPI 1: per yearly batch, in batch order."""
    return (runs.filter(F.col("method") == "batch")
            .select("batch_id", "silver_rows_loaded", "gold_rows_loaded",
                    round_half_up(F.col("duration_sec"), 2).alias("duration_sec"),
                    "credits_used")
            .orderBy("batch_id"))


def kpi_totals(runs: DataFrame, method: str | None = "batch") -> DataFrame:
    """KPI 2: totals per method (G12); ``method=None`` reports every method."""
    if method is not None:
        runs = runs.filter(F.col("method") == method)
    return runs.groupBy("method").agg(
        F.count(F.lit(1)).alias("num_batches"),
        F.sum("silver_rows_loaded").alias("total_silver_rows"),
        round_half_up(F.sum("duration_sec"), 2).alias("total_duration_sec"),
        round_half_up(F.sum("credits_used"), 6).alias("est_credits"),
    )


def latest_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    """Newest k runs (L3); ``run_id`` breaks ties of equal timestamps."""
    return runs.orderBy(F.col("run_timestamp").desc(), F.col("run_id").desc()).limit(k)


def kpi_latest(runs: DataFrame, method: str | None = "upsert") -> DataFrame:
    """Latest run with the report labels."""
    if method is not None:
        runs = runs.filter(F.col("method") == method)
    return latest_runs(runs, 1).select(
        F.col("bronze_row_count").alias(LABEL_BRONZE),
        F.col("silver_rows_loaded").alias(LABEL_SILVER),
        F.col("gold_rows_loaded").alias(LABEL_GOLD),
        F.col("duration_sec").alias(LABEL_DURATION))


def latest_run_time(runs: DataFrame, method: str = "upsert") -> DataFrame:
    """Run time of the latest run of a method (P10)."""
    return latest_runs(runs.filter(F.col("method") == method), 1).select(
        "run_timestamp", F.col("duration_sec").alias(LABEL_WAREHOUSE_TIME))


def cost_report(runs: DataFrame, usd_per_credit: float = USD_PER_CREDIT, k: int | None = 5) -> DataFrame:
    """Credits and their price per run, newest first."""
    out = runs.select(
        "run_timestamp", "method", "batch_id",
        F.col("duration_sec").alias(LABEL_WAREHOUSE_TIME),
        "credits_used",
        (F.col("credits_used") * F.lit(usd_per_credit)).alias(LABEL_COST),
    ).orderBy(F.col("run_timestamp").desc(), F.col("batch_id").desc_nulls_last())
    return out.limit(k) if k else out


def recent_summary(log: DataFrame, now: dt.datetime, hours: int = 1, state: str = SUCCEEDED) -> DataFrame:
    """Runs of a run log in the last ``hours`` and of that state: earliest start,
    count and rounded credits (F12, G13, G14, X12)."""
    since = ntz(now) - F.expr(f"INTERVAL {int(hours)} HOUR")
    return (log.filter((F.col("run_timestamp") >= since) & (F.col("state") == state))
            .agg(F.min("run_timestamp").alias("first_run_timestamp"),
                 F.count(F.lit(1)).alias("runs"),
                 round_half_up(F.sum("credits_used"), 4).alias("credits_used")))


def cross_method(*run_tables: DataFrame) -> DataFrame:
    """All methods' runs on the nine shared columns, newest first."""
    parts = [t.select(*SHARED_RUN_COLUMNS) for t in run_tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.col("run_timestamp").desc(), F.col("run_id").desc())


def runs_by_state(log: DataFrame) -> DataFrame:
    """Runs per method and state."""
    return log.groupBy("method", "state").agg(F.count(F.lit(1)).alias("runs"))


def run_counts(runs: DataFrame) -> DataFrame:
    """Row figures per method and batch: the clock-free part of the run table."""
    return runs.select("method", "batch_id", "bronze_row_count", "silver_rows_loaded",
                       "silver_rows_deleted", "gold_rows_loaded")
