"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory (SURVEY 2.12).

Every query starts from the driver tables: reviews are built from
``lineitem`` joined to ``orders``, staged as JSON-lines and loaded into Bronze,
then the methods run over all of it.  Clock and id columns (``loaded_at``,
``run_id``, ``run_timestamp``, durations) are left out wherever a result is
compared with an oracle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.fixtures import bronze_for, load_fixture, table_files
from refinery.functions.variant import field, whole_number
from refinery.operators import gold as gold_ops
from refinery.operators import inspect as inspect_ops
from refinery.operators import reconcile as rec
from refinery.operators import silver as silver_ops
from refinery.operators.gold import GOLD_DATA_COLUMNS
from refinery.operators.merge import action_counts
from refinery.operators.silver import SILVER_DATA_COLUMNS
from refinery.plans import batch as batch_plan
from refinery.plans import metrics as mx
from refinery.plans import runs
from refinery.plans import upsert as upsert_plan
from refinery.plans.store import TableStore
from refinery.schemas import GOLD, SILVER
from refinery.session import ensure_session_settings
from refinery.sources import eventlog, reviews
from refinery.sources.staged import FILE_COL, list_staged, read_bronze, read_staged
from refinery.sources.staged import load_report as file_report
from refinery.spec import BATCH, CLEAN, FIRST_BATCH_YEAR, UPSERT

# The yearly step shown by the single-year queries.
STEP_YEAR = 2023
MEASURES = GOLD_DATA_COLUMNS[1:]


def _bronze(spark: SparkSession, sf_dir: str, kind: str = "all", year: int | None = None) -> DataFrame:
    ensure_session_settings(spark)
    return read_bronze(spark, bronze_for(spark, sf_dir, kind), year=year)


def _gold(store: TableStore) -> DataFrame:
    return store.read("gold", GOLD).select(*GOLD_DATA_COLUMNS)


def _silver(store: TableStore) -> DataFrame:
    return store.read("silver", SILVER).select(*SILVER_DATA_COLUMNS)


# ---- Bronze -----------------------------------------------------------------

def bronze_field_preview(spark, sf_dir):
    return inspect_ops.field_preview(_bronze(spark, sf_dir))


def bronze_year_histogram(spark, sf_dir):
    ensure_session_settings(spark)
    bronze = read_bronze(spark, bronze_for(spark, sf_dir, "all"), keep_year=True)
    return inspect_ops.year_histogram(bronze)


def file_listing(spark, sf_dir):
    """Staged files (A1): their lines sum up to the input, and each has a name,
    a size and a time.  Their number follows the data and the session."""
    stage, _, _ = load_fixture(spark, sf_dir, "all")
    files = list_staged(spark, stage)
    lines = read_staged(spark, stage).agg(F.count(F.lit(1)).alias("lines"))
    listed = files.agg((F.count(F.lit(1)) > 0).alias("files_listed"),
                       F.coalesce(F.bool_and(F.col("size") > 0), F.lit(False)).alias("all_sized"),
                       F.coalesce(F.bool_and(F.col("last_modified").isNotNull()), F.lit(False)).alias("all_dated"))
    return lines.join(listed)  # one row each


def bronze_preview(spark, sf_dir):
    """First rows of Bronze with their load time (A4, A14), in a total order of what is shown."""
    bronze = _bronze(spark, sf_dir).select(
        field("rating", "double").alias("rating"), field("title", "string").alias("review_title"),
        whole_number("timestamp").alias("ts_unix"), "load_timestamp")
    return inspect_ops.preview(bronze.orderBy(F.col("ts_unix").desc_nulls_last(), F.col("rating").asc_nulls_last(),
                                              F.col("review_title").asc_nulls_last()), 5)


def load_stamp(spark, sf_dir):
    """Load times of the layers of a clean refresh (A4, A10): one per table and run."""
    store = runs.clean_run(spark, sf_dir)
    tables = (("bronze", _bronze(spark, sf_dir), "load_timestamp"),
              ("silver", store.read("silver", SILVER), "loaded_at"), ("gold", store.read("gold", GOLD), "loaded_at"))
    parts = [df.groupBy(F.col(c).alias("stamp")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("tbl"), "stamp", "n") for name, df, c in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def malformed_lines(spark, sf_dir):
    stage, _, _ = load_fixture(spark, sf_dir, "broken")
    return read_staged(spark, stage).agg(
        F.count_if(F.col("raw_json").isNull()).alias("rejected_lines"),
        F.count_if(F.col("raw_json").isNotNull()).alias("loaded_rows"))


def load_report(spark, sf_dir):
    """Lines, loaded and rejected ones of the broken set's files, by their folder."""
    report = file_report(spark, bronze_for(spark, sf_dir, "broken"))
    folder = F.regexp_extract(FILE_COL, "l_linenumber=([0-9]+)", 1).cast("int")
    named = (F.col("rejected_lines") > 0).eqNullSafe(F.try_parse_json("first_rejected").isNull()
                                                     & F.col("first_rejected").isNotNull())
    return report.groupBy(folder.alias("part")).agg(
        F.sum("lines").alias("lines"), F.sum("loaded_rows").alias("loaded_rows"),
        F.sum("rejected_lines").alias("rejected_lines"), F.bool_and(named).alias("first_rejected_named"))


# ---- Silver / Gold by method ----------------------------------------------------

def silver_clean(spark, sf_dir):
    return silver_ops.extract(_bronze(spark, sf_dir), CLEAN)


def silver_batch_year(spark, sf_dir):
    return silver_ops.extract(_bronze(spark, sf_dir, year=STEP_YEAR), BATCH.for_year(STEP_YEAR))


def silver_upsert(spark, sf_dir):
    return silver_ops.extract(_bronze(spark, sf_dir), UPSERT)


def gold_clean(spark, sf_dir):
    return gold_ops.aggregate(silver_clean(spark, sf_dir), CLEAN)


def gold_upsert(spark, sf_dir):
    return gold_ops.aggregate(silver_upsert(spark, sf_dir), UPSERT)


def _batch_silver_through(spark, sf_dir, year):
    """Batch Silver after the steps up to ``year`` (seeded at 1996)."""
    spec = replace(BATCH, lower=None, upper=None, years=(FIRST_BATCH_YEAR, year + 1))
    return silver_ops.extract(_bronze(spark, sf_dir), spec)


def gold_touched_products(spark, sf_dir):
    """G2 for the step ``STEP_YEAR``: Gold rows of the products it touched,
    re-aggregated from all Silver rows loaded so far (J1, G9)."""
    silver = _batch_silver_through(spark, sf_dir, STEP_YEAR)
    year_rows = silver.filter(F.year("review_ts") == STEP_YEAR)
    touched = gold_ops.touched_keys(year_rows)
    return gold_ops.aggregate(gold_ops.rows_of_keys(silver, touched), BATCH)


def gold_replace_touched(spark, sf_dir):
    """Gold after step ``STEP_YEAR``: Gold before it with the touched rows
    deleted and recomputed ones inserted (J2, J3)."""
    before = gold_ops.aggregate(_batch_silver_through(spark, sf_dir, STEP_YEAR - 1), BATCH)
    silver = _batch_silver_through(spark, sf_dir, STEP_YEAR)
    touched = gold_ops.touched_keys(silver.filter(F.year("review_ts") == STEP_YEAR))
    recomputed = gold_ops.aggregate(gold_ops.rows_of_keys(silver, touched), BATCH)
    return gold_ops.replace_keys(before, touched, recomputed).select(*GOLD_DATA_COLUMNS)


def gold_top5(spark, sf_dir):
    return gold_ops.top_products(_gold(runs.upsert_two_waves(spark, sf_dir)), 5)


# ---- whole-method runs ----------------------------------------------------------

def batch_all_years_silver(spark, sf_dir):
    return batch_plan.read_silver(runs.batch_run(spark, sf_dir)).select(*SILVER_DATA_COLUMNS)


def batch_all_years_gold(spark, sf_dir):
    return _gold(runs.batch_run(spark, sf_dir))


def batch_reset_2000(spark, sf_dir):
    return _gold(runs.batch_reset_run(spark, sf_dir, 2000))


def batch_rerun_corrected_year_gold(spark, sf_dir):
    """Gold after two loaded years are run again over corrected input."""
    return _gold(runs.batch_corrected_run(spark, sf_dir, reviews.CORRECTED_YEAR, reviews.VANISHED_YEAR))


def clean_refresh_gold(spark, sf_dir):
    return _gold(runs.clean_run(spark, sf_dir))


def upsert_two_waves_silver(spark, sf_dir):
    return _silver(runs.upsert_two_waves(spark, sf_dir))


def upsert_two_waves_gold(spark, sf_dir):
    return _gold(runs.upsert_two_waves(spark, sf_dir))


def upsert_actions(spark, sf_dir):
    """Actions of the wave-2 merge against Silver after wave 1."""
    store = runs.memo(spark, sf_dir, "upsert-wave1", lambda st: upsert_plan.process_upsert(
        spark, bronze_for(spark, sf_dir, "wave1"), st))
    source = upsert_plan.silver_source(_bronze(spark, sf_dir, "wave2"))
    plan = upsert_plan.silver_merge_plan(store.read("silver", SILVER), source, F.localtimestamp())
    return action_counts(plan)


def upsert_idempotent(spark, sf_dir):
    """Wave 2 applied a second time writes no Silver row and no Silver file
    (J8, README claim)."""
    versions = []

    def run(store):
        for kind in ("wave1", "wave2", "wave2"):
            upsert_plan.process_upsert(spark, bronze_for(spark, sf_dir, kind), store)
            versions.append(table_files(spark, store.path("silver")))
        if versions[1] != versions[2]:
            raise AssertionError("an upsert without changes wrote Silver files")
    store = runs.memo(spark, sf_dir, "upsert-again", run)
    last = mx.latest_runs(mx.read_runs(store), 1)
    figures = [last.select(F.lit(c).alias("figure"), F.col(c).alias("value"))
               for c in ("silver_rows_loaded", "gold_rows_loaded")]
    figures.append(_silver(store).agg(F.count(F.lit(1)).alias("value"))
                   .select(F.lit("silver_rows").alias("figure"), "value"))
    return figures[0].unionByName(figures[1]).unionByName(figures[2])


def layer_counts(spark, sf_dir):
    store = runs.upsert_two_waves(spark, sf_dir)
    return rec.layer_counts(silver=_silver(store), gold=_gold(store))


def reconcile_counts(spark, sf_dir):
    b, c = runs.batch_run(spark, sf_dir), runs.clean_run(spark, sf_dir)
    return (rec.method_counts("silver", batch=batch_plan.read_silver(b), clean_refresh=_silver(c))
            .unionByName(rec.method_counts("gold", batch=_gold(b), clean_refresh=_gold(c))))


def reconcile_rows(spark, sf_dir):
    b, c = runs.batch_run(spark, sf_dir), runs.clean_run(spark, sf_dir)
    return rec.keyed_differences(_gold(b), _gold(c), ["parent_asin"], MEASURES,
                                 "batch", "clean_refresh")


def reconcile_silver_rows(spark, sf_dir):
    b, c = runs.batch_run(spark, sf_dir), runs.clean_run(spark, sf_dir)
    return rec.multiset_differences(
        batch_plan.read_silver(b).select(*SILVER_DATA_COLUMNS), _silver(c), "batch", "clean_refresh")


def reconcile_shifted_nulls(spark, sf_dir):
    """P7 over a table and its copy in which a NULL and its neighbour have changed places."""
    a = silver_clean(spark, sf_dir).select("asin", "parent_asin")
    moved = F.col("asin").isNull() | F.col("parent_asin").isNull()
    b = a.select(F.when(moved, F.col("parent_asin")).otherwise(F.col("asin")).alias("asin"),
                 F.when(moved, F.col("asin")).otherwise(F.col("parent_asin")).alias("parent_asin"))
    return rec.multiset_differences(a, b, "table", "copy")


# ---- run metrics and reports -------------------------------------------------------

def _all_runs(spark, sf_dir):
    return (mx.read_runs(runs.clean_run(spark, sf_dir)),
            mx.read_runs(runs.batch_run(spark, sf_dir)),
            mx.read_runs(runs.upsert_two_waves(spark, sf_dir)))


def run_metrics_counts(spark, sf_dir):
    c, b, u = _all_runs(spark, sf_dir)
    return mx.run_counts(c.unionByName(b).unionByName(u))


def run_metrics_union(spark, sf_dir):
    return mx.cross_method(*_all_runs(spark, sf_dir))


def kpi_per_batch(spark, sf_dir):
    return mx.kpi_per_batch(mx.read_runs(runs.batch_run(spark, sf_dir)))


def kpi_totals(spark, sf_dir):
    return mx.kpi_totals(mx.read_runs(runs.batch_run(spark, sf_dir)))


def latest_runs(spark, sf_dir):
    """``ORDER BY run_timestamp DESC LIMIT 10`` over the upsert runs (L3)."""
    return mx.latest_runs(mx.read_runs(runs.upsert_two_waves(spark, sf_dir)), 10)


def kpi_latest(spark, sf_dir):
    return mx.kpi_latest(mx.read_runs(runs.upsert_two_waves(spark, sf_dir)))


def latest_run_time(spark, sf_dir):
    """Run time of the latest upsert (P10)."""
    return mx.latest_run_time(mx.read_runs(runs.upsert_two_waves(spark, sf_dir)))


def cost_report(spark, sf_dir):
    c, b, u = _all_runs(spark, sf_dir)
    return mx.cost_report(c.unionByName(b).unionByName(u), k=None)


def _all_logs(spark, sf_dir):
    stores = (runs.failed_run(spark, sf_dir), runs.batch_run(spark, sf_dir), runs.upsert_two_waves(spark, sf_dir))
    logs = [mx.read_run_log(s) for s in stores]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


def recent_runs_summary(spark, sf_dir):
    """Succeeded runs of the last hour (F12); the log also holds older and failed ones."""
    # An hour and eleven seconds after the runs' clock began: the first of them are too old.
    now = runs.CLOCK_START + dt.timedelta(seconds=3611)
    return mx.recent_summary(_all_logs(spark, sf_dir), now)


def runs_by_state(spark, sf_dir):
    """Runs by method and state."""
    return mx.runs_by_state(_all_logs(spark, sf_dir))


def cut_values(spark, sf_dir):
    """Rows whose value was cut to its column's width, as the run counted them."""
    return mx.read_run_log(runs.wide_run(spark, sf_dir)).select(
        "method", "cut_asin", "cut_parent_asin", "cut_user_id", "cut_review_title")


def job_history(spark, sf_dir):
    """Statements of the batch run by tag (P9, F13, X15, L7), rows as Spark's tasks counted them."""
    found = eventlog.query_history(runs.history(runs.batch_run(spark, sf_dir)), tag="method=batch", pattern="%INTO%")
    return eventlog.statement_report(found)


def merge_history(spark, sf_dir):
    """Latest Silver MERGE found by its text (F11, L5): the rows it changed, as Spark's tasks counted them."""
    found = eventlog.query_history(runs.history(runs.upsert_two_waves(spark, sf_dir)),
                                   tag="method=upsert", pattern="%merge into SILVER (changed%", k=1)
    return eventlog.statement_report(found)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_field_preview": bronze_field_preview,
    "bronze_year_histogram": bronze_year_histogram,
    "file_listing": file_listing,
    "bronze_preview": bronze_preview,
    "load_stamp": load_stamp,
    "malformed_lines": malformed_lines,
    "load_report": load_report,
    "silver_clean": silver_clean,
    "silver_batch_year": silver_batch_year,
    "silver_upsert": silver_upsert,
    "gold_clean": gold_clean,
    "gold_upsert": gold_upsert,
    "gold_touched_products": gold_touched_products,
    "gold_replace_touched": gold_replace_touched,
    "gold_top5": gold_top5,
    "clean_refresh_gold": clean_refresh_gold,
    "batch_all_years_silver": batch_all_years_silver,
    "batch_all_years_gold": batch_all_years_gold,
    "batch_reset_2000": batch_reset_2000,
    "batch_rerun_corrected_year_gold": batch_rerun_corrected_year_gold,
    "upsert_two_waves_silver": upsert_two_waves_silver,
    "upsert_two_waves_gold": upsert_two_waves_gold,
    "upsert_actions": upsert_actions,
    "upsert_idempotent": upsert_idempotent,
    "layer_counts": layer_counts,
    "reconcile_counts": reconcile_counts,
    "reconcile_rows": reconcile_rows,
    "reconcile_silver_rows": reconcile_silver_rows,
    "reconcile_shifted_nulls": reconcile_shifted_nulls,
    "run_metrics_counts": run_metrics_counts,
    "run_metrics_union": run_metrics_union,
    "kpi_per_batch": kpi_per_batch,
    "kpi_totals": kpi_totals,
    "kpi_latest": kpi_latest,
    "latest_runs": latest_runs,
    "latest_run_time": latest_run_time,
    "cost_report": cost_report,
    "recent_runs_summary": recent_runs_summary,
    "runs_by_state": runs_by_state,
    "cut_values": cut_values,
    "job_history": job_history,
    "merge_history": merge_history,
}
