"""Whole-method runs over the review tables built from a data folder.

The registered queries read the tables these runs leave behind.  A run is
done once per session and input (several reports read the same run); each
lives in its own new folder under the checkpoint workspace.
"""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from refinery.fixtures import bronze_for, input_key
from refinery.plans import batch as batch_plan
from refinery.plans import clean as clean_plan
from refinery.plans import upsert as upsert_plan
from refinery.plans.metrics import Clock
from refinery.plans.store import TableStore
from refinery.session import fresh_workspace
from refinery.sources.eventlog import job_history, read_events, recording

_DONE: dict[tuple, TableStore] = {}

# Start of the runs' clock (fixed value) and its step: every reading is a
# second later than the one before, ids are counted, so run tables are equal
# on every run and can be compared.
CLOCK_START = dt.datetime(2024, 7, 1)


def ticking_clock(label: str) -> Clock:
    """A clock that moves one second a reading, and ids ``<label>-<n>``."""
    seconds, ids = itertools.count(), itertools.count(1)
    return Clock(now=lambda: CLOCK_START + dt.timedelta(seconds=next(seconds)),
                 new_id=lambda: f"{label}-{next(ids):03d}")


EVENTS = "_events"


def memo(spark: SparkSession, sf_dir: str, label: str, run) -> TableStore:
    """Run ``run(store)`` once per session, input and label; return its store.

    Spark's event log of the run is kept in the store's folder.
    """
    key = (spark.sparkContext.applicationId, input_key(spark, sf_dir), label)
    store = _DONE.get(key)
    if store is None:
        store = TableStore(spark, fresh_workspace(spark, label))
        with recording(spark, store.path(EVENTS), compress=False):
            run(store)
        _DONE[key] = store
    return store


def history(store: TableStore) -> DataFrame:
    """The run's statements as Spark measured them."""
    return job_history(read_events(store.spark, store.path(EVENTS)))


def clean_run(spark: SparkSession, sf_dir: str) -> TableStore:
    """P1 over the whole review set."""
    def run(store):
        clean_plan.clean_refresh(spark, bronze_for(spark, sf_dir, "all"), store, clock=ticking_clock("clean"))
    return memo(spark, sf_dir, "clean", run)


def batch_run(spark: SparkSession, sf_dir: str) -> TableStore:
    """P3 from the seeded 1996 watermark."""
    def run(store):
        batch_plan.create_batch_tables(spark, store)
        batch_plan.run_all_batches(spark, bronze_for(spark, sf_dir, "all"), store, clock=ticking_clock("batch"))
    return memo(spark, sf_dir, "batch", run)


def batch_reset_run(spark: SparkSession, sf_dir: str, year: int) -> TableStore:
    """P3 over filled tables: years to ``year + 1`` are loaded, everything is
    reset to ``year`` (A13), then the rest is loaded."""
    def run(store):
        bronze = bronze_for(spark, sf_dir, "all")
        batch_plan.create_batch_tables(spark, store)
        batch_plan.run_all_batches(spark, bronze, store, last_year=year + 1)
        batch_plan.reset_batch(spark, store, year)
        batch_plan.run_all_batches(spark, bronze, store)
    return memo(spark, sf_dir, f"batch-reset-{year}", run)


def batch_corrected_run(spark: SparkSession, sf_dir: str, year: int, gone: int) -> TableStore:
    """P3 over all years, then again for two of them whose input changed:
    ``year`` has lost the reviews of some products, ``gone`` has no input left."""
    def run(store):
        batch_plan.create_batch_tables(spark, store)
        batch_plan.run_all_batches(spark, bronze_for(spark, sf_dir, "all"), store)
        corrected = bronze_for(spark, sf_dir, "corrected")
        for y in (year, gone):
            batch_plan.set_next_year(spark, store, y)
            batch_plan.process_next_batch(spark, corrected, store)
    return memo(spark, sf_dir, f"batch-corrected-{year}-{gone}", run)


def upsert_two_waves(spark: SparkSession, sf_dir: str) -> TableStore:
    """P4 on wave 1, then on wave 2 (FIXTURES.md section 3)."""
    def run(store):
        clock = ticking_clock("upsert")
        for kind in ("wave1", "wave2"):
            upsert_plan.process_upsert(spark, bronze_for(spark, sf_dir, kind), store, clock=clock)
    return memo(spark, sf_dir, "upsert2", run)


def wide_run(spark: SparkSession, sf_dir: str) -> TableStore:
    """P1 over reviews of which some have values longer than their columns."""
    def run(store):
        clean_plan.clean_refresh(spark, bronze_for(spark, sf_dir, "wide"), store, clock=ticking_clock("wide"))
    return memo(spark, sf_dir, "wide", run)


def failed_run(spark: SparkSession, sf_dir: str) -> TableStore:
    """P1 as it should be, then once over input that isn't there."""
    def run(store):
        clock = ticking_clock("clean")
        bronze = bronze_for(spark, sf_dir, "all")
        clean_plan.clean_refresh(spark, bronze, store, clock=clock)
        try:
            clean_plan.clean_refresh(spark, f"{bronze}-lost", store, clock=clock)
        except AnalysisException:
            return
        raise AssertionError("a run without input did not fail")
    return memo(spark, sf_dir, "failed", run)
