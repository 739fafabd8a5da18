"""Methods read the record's fields alone, and ship no id through a shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.operators import silver as silver_ops
from refinery.plans import clean, upsert
from refinery.plans.store import TableStore
from refinery.session import fresh_workspace
from refinery.sources import eventlog
from refinery.sources.staged import read_bronze
from refinery.spec import UPSERT


def test_methods_never_rebuild_the_whole_record(spark, golden_bronze):
    bronze, load = golden_bronze
    base = fresh_workspace(spark, "t-narrow")
    with eventlog.recording(spark, f"{base}/_events", compress=False):
        row = clean.clean_refresh(spark, bronze, TableStore(spark, f"{base}/clean"))
        runs = [upsert.process_upsert(spark, bronze, TableStore(spark, f"{base}/upsert")) for _ in range(2)]
    assert [row.bronze_row_count, *(r.metrics.bronze_row_count for r in runs)] == [load.loaded_rows] * 3
    plans = [r["json"] for r in eventlog.read_events(spark, f"{base}/_events")
             .filter(F.col("json").contains("physicalPlanDescription")).collect()]
    assert any("raw_json:struct<" in p for p in plans)
    assert not any("raw_json:struct<0:variant>" in p for p in plans)


def test_id_is_made_behind_the_shuffle(spark, golden_bronze):
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0]), UPSERT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("md5(") < plan.index("Exchange hashpartitioning(user_id")
    assert "md5(" not in plan[plan.index("Exchange hashpartitioning(user_id"):]


def test_only_few_changes_are_broadcast_and_never_bronze(spark):
    bronze, changes = spark.range(10), spark.range(1000)

    def plan(n):
        return bronze.join(upsert._few_or_many(changes, n), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan(upsert.BROADCAST_ROWS)
    assert "SortMergeJoin" in plan(upsert.BROADCAST_ROWS + 1) and "Broadcast" not in plan(upsert.BROADCAST_ROWS + 1)
