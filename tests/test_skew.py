"""A hot key holding a third of all rows: what crosses the shuffle.

Shuffle record counts come from Spark's event log (``sources.eventlog``).
With partial aggregation and the partial ``WindowGroupLimit``, the hot key
costs at most one shuffled record per map task, not one per row.
"""

from __future__ import annotations

import json

import pytest

from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.plans.tags import statement
from refinery.session import fresh_workspace
from refinery.sources import eventlog
from refinery.sources.staged import load_bronze, read_bronze
from refinery.spec import CLEAN, UPSERT

ROWS, FILES = 3000, 6


@pytest.fixture(scope="module")
def skewed_bronze(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("skew")
    for f in range(FILES):
        with open(d / f"part-{f}.jsonl", "w") as out:
            for i in range(f, ROWS, FILES):
                hot = i % 3 == 0
                rec = {"rating": 1 + i % 5, "text": "t", "title": "x",
                       "asin": "AHOT" if hot else f"A{i}", "user_id": "UHOT" if hot else f"U{i}",
                       "parent_asin": "PHOT" if hot else f"P{i % 20}",
                       "timestamp": 1275350400000 + i * 1000, "verified_purchase": True}
                out.write(json.dumps(rec) + "\n")
    path = f"{fresh_workspace(spark, 'skew')}/bronze"
    load_bronze(spark, str(d), path)
    return path


def _shuffled(spark, label: str) -> int:
    h = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    rows = eventlog.query_history(h, pattern=label).collect()
    assert rows, label
    return sum(r.shuffle_records for r in rows)


def test_hot_product_ships_one_partial_row_per_task(spark, skewed_bronze):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")   # several map tasks
    try:
        bronze = read_bronze(spark, skewed_bronze)
        tasks = bronze.rdd.getNumPartitions()
        gold = gold_ops.aggregate(silver_ops.extract(bronze, CLEAN), CLEAN)
        with statement(spark, "skew-test gold"):
            got = {r.parent_asin: r.total_reviews for r in gold.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["PHOT"] == ROWS // 3
    assert tasks > 1
    # at most one partial row per (task, product): 21 products
    assert _shuffled(spark, "skew-test gold") <= tasks * 21 < ROWS


def test_hot_review_key_ships_one_row_per_task(spark, skewed_bronze):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        bronze = read_bronze(spark, skewed_bronze)
        tasks = bronze.rdd.getNumPartitions()
        latest = silver_ops.extract(bronze, UPSERT)
        with statement(spark, "skew-test dedupe"):
            rows = [r for r in latest.collect() if r.user_id == "UHOT"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 1 and rows[0].review_ts.year == 2010
    cold = ROWS - ROWS // 3
    # every cold key once, the hot key at most once per map task (1000 rows without it)
    shuffled = _shuffled(spark, "skew-test dedupe")
    assert cold < shuffled <= cold + tasks
