"""Staged and Bronze files of a load: bounded in rows, written without a shuffle or a sort."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from refinery.plans.tags import statement
from refinery.session import fresh_workspace
from refinery.sources import eventlog, staged

ROWS, YEAR_MS = 300, 31_557_600_000


@pytest.mark.parametrize("folders", [(), ("part",)])
def test_load_writes_bounded_files_without_a_shuffle(spark, monkeypatch, folders):
    monkeypatch.setattr(staged, "STAGED_ROWS", 40)
    monkeypatch.setattr(staged, "BRONZE_ROWS", 7)
    base = fresh_workspace(spark, "t-load-files")
    rows = [(json.dumps({"rating": 1 + i % 5, "asin": f"A{i}", "timestamp": 1262304000000 + i % 3 * YEAR_MS}), i % 2)
            for i in range(ROWS)] + [('{"cut', 0)]
    lines = spark.createDataFrame(rows, "value string, part int").coalesce(1)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    label = f"load-files-{len(folders)}"
    with statement(spark, label):
        staged.stage_lines(lines, f"{base}/stage", folders=folders, compression="lz4", rebalance=False)
        load = staged.load_bronze(spark, f"{base}/stage", f"{base}/bronze")
    assert (load.loaded_rows, load.rejected_lines) == (ROWS, 1)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before

    per_file = lambda df: [r["count"] for r in df.groupBy(F.col("_metadata.file_path")).count().collect()]
    text = per_file(spark.read.option("recursiveFileLookup", "true").text(f"{base}/stage"))
    assert sum(text) == ROWS + 1 and max(text) <= 40
    stored = per_file(spark.read.schema(staged.BRONZE_STORED).parquet(f"{base}/bronze"))
    assert sum(stored) == ROWS and max(stored) <= 7
    assert staged.bronze_years(spark, f"{base}/bronze") == {2010, 2011, 2012}
    asins = staged.read_bronze(spark, f"{base}/bronze").select(F.expr("variant_get(raw_json, '$.asin', 'string')"))
    assert sorted(r[0] for r in asins.collect()) == sorted(f"A{i}" for i in range(ROWS))

    history = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    runs = eventlog.query_history(history, pattern=label).collect()
    assert runs and sum(r.shuffle_records for r in runs) == 0
