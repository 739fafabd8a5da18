"""Plan shape: pruning, pushdown, partial aggregation, no Python on the row path."""

from __future__ import annotations

from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.sources.staged import read_bronze
from refinery.spec import BATCH, CLEAN, UPSERT


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _no_python(plan: str) -> None:
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_year_step_reads_one_partition(spark, golden_bronze):
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0], year=2010), BATCH.for_year(2010))
    files = df.inputFiles()
    assert files and all("/review_year=2010/" in f for f in files)
    _no_python(_plan(df))


def test_full_bronze_read_prunes_by_partition_filter(spark, golden_bronze):
    from pyspark.sql import functions as F
    df = read_bronze(spark, golden_bronze[0], keep_year=True).filter(F.col("review_year") == 2010)
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(review_year" in plan


def test_variant_fields_pushed_into_scan(spark, golden_bronze):
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0]), CLEAN).select("parent_asin", "rating")
    plan = _plan(df)
    # only the needed variant fields are read (shredded read schema)
    assert "ReadSchema: struct<raw_json:struct<" in plan
    assert "Exchange" not in plan      # Bronze -> Silver is narrow


def test_gold_aggregates_partially_before_shuffle(spark, golden_bronze):
    silver = silver_ops.extract(read_bronze(spark, golden_bronze[0]), CLEAN)
    plan = _plan(gold_ops.aggregate(silver, CLEAN))
    assert plan.count("HashAggregate") >= 2 and "hashpartitioning(parent_asin" in plan
    _no_python(plan)


def test_latest_per_key_uses_window_group_limit(spark, golden_bronze):
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0]), UPSERT)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "hashpartitioning(user_id" in plan
    _no_python(plan)


def test_decision_shuffles_narrow_rows_and_reads_narrow_silver(spark, golden_bronze):
    """No text, title or id goes through the decision's exchanges, and only keys and
    fingerprints of Silver are read."""
    from refinery.plans import upsert as upsert_plan
    from refinery.plans.store import TableStore
    from refinery.session import fresh_workspace
    from refinery.sources.staged import read_placed

    store = TableStore(spark, fresh_workspace(spark, "t-decide"))
    upsert_plan.process_upsert(spark, golden_bronze[0], store)
    df = upsert_plan.decide_plan(read_placed(spark, golden_bronze[0]), store)
    plan = _plan(df)
    _no_python(plan)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    silver = [line for line in scans if "/silver/" in line]
    assert len(silver) == 1
    assert "review_text" not in silver[0] and "review_title" not in silver[0] and "review_id" not in silver[0]
    for line in plan.splitlines():
        if "HashAggregate(" in line or "SortAggregate(" in line:
            assert "output=" not in line or "review_text" not in line.split("output=")[1]
    # Spark's own count: the text of the reviews does not weigh in the shuffle
    assert {r["_action"] for r in df.collect()} == {"noop"}


def test_later_sessions_keep_the_bucket_count(spark, golden_bronze):
    from refinery.plans import upsert as upsert_plan
    from refinery.plans.store import TableStore
    from refinery.session import fresh_workspace

    store = TableStore(spark, fresh_workspace(spark, "t-sticky"))
    upsert_plan.process_upsert(spark, golden_bronze[0], store, silver_buckets=6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        upsert_plan.process_upsert(spark, golden_bronze[0], store)
        assert upsert_plan.buckets_of(store) == 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_year_window_is_made_from_parts(spark, golden_bronze):
    """The bounds are DATE_FROM_PARTS (X10), folded to literals in the plan."""
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0], year=2010), BATCH.for_year(2010))
    assert "make_date(2010, 1, 1" in df._jdf.queryExecution().analyzed().toString()
    assert "make_date" not in _plan(df) and "2010-01-01 00:00:00" in _plan(df)
