"""KPI reports over the six literal run rows of FIXTURES.md section 6."""

from __future__ import annotations

import datetime as dt

import pytest

from refinery.plans import metrics as mx
from refinery.plans.metrics import RunMetrics
from refinery.schemas import RUN_LOG

T0 = dt.datetime(2025, 3, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        RunMetrics("r-clean", T0, "clean_refresh", None, 1000, 900, 0, 80, 30.0, 0.0083),
        RunMetrics("r-b2000", T0 + dt.timedelta(minutes=1), "batch", 2000, 1000, 100, 0, 10, 3.6, 0.001),
        RunMetrics("r-b2001", T0 + dt.timedelta(minutes=2), "batch", 2001, 1000, 200, 0, 20, 7.2, 0.002),
        RunMetrics("r-b2002", T0 + dt.timedelta(minutes=3), "batch", 2002, 1000, 300, 0, 30, 1.234, 0.000343),
        RunMetrics("r-b2003", T0 + dt.timedelta(minutes=4), "batch", 2003, 1000, 0, 0, 30, 0.5, 0.000139),
        RunMetrics("r-upsert", T0 + dt.timedelta(minutes=5), "upsert", None, 1000, 850, 0, 79, 12.5, None),
    ]
    return spark.createDataFrame([tuple(r.as_row().get(f) for f in RUN_LOG.fieldNames()) for r in rows], RUN_LOG)


def test_per_batch(runs):
    got = [tuple(r) for r in mx.kpi_per_batch(runs).collect()]
    assert got == [(2000, 100, 10, 3.6, 0.001), (2001, 200, 20, 7.2, 0.002),
                   (2002, 300, 30, 1.23, 0.000343), (2003, 0, 30, 0.5, 0.000139)]


def test_totals(runs):
    (r,) = mx.kpi_totals(runs).collect()
    assert (r.method, r.num_batches, r.total_silver_rows) == ("batch", 4, 600)
    assert r.total_duration_sec == 12.53 and r.est_credits == 0.003482


def test_latest_upsert_labels(runs):
    df = mx.kpi_latest(runs)
    assert df.columns == [mx.LABEL_BRONZE, mx.LABEL_SILVER, mx.LABEL_GOLD, mx.LABEL_DURATION]
    assert tuple(df.first()) == (1000, 850, 79, 12.5)


def test_cross_method_newest_first(runs):
    got = [r.run_id for r in mx.cross_method(runs.filter("method = 'clean_refresh'"),
                                             runs.filter("method = 'batch'"),
                                             runs.filter("method = 'upsert'")).collect()]
    assert got == ["r-upsert", "r-b2003", "r-b2002", "r-b2001", "r-b2000", "r-clean"]


def test_cost_and_recent(runs):
    cost = {r["method"] + str(r["batch_id"]): r[mx.LABEL_COST] for r in mx.cost_report(runs, k=None).collect()}
    assert cost["batch2000"] == pytest.approx(0.002) and cost["upsertNone"] is None
    (s,) = mx.recent_summary(runs, T0 + dt.timedelta(minutes=30)).collect()
    assert s.first_run_timestamp == T0 and s.runs == 6 and s.credits_used == 0.0118
    (s2,) = mx.recent_summary(runs, T0 + dt.timedelta(minutes=62)).collect()
    assert s2.runs == 4


def test_credit_estimate():
    assert mx.estimate_credits(3600.0, 1.0) == 1.0
    assert mx.estimate_credits(1.5, 1.0) == 0.000417
    assert mx.estimate_credits(10.0, None) is None


def test_job_history_from_event_log(spark, golden_bronze):
    from refinery.plans import upsert as upsert_plan
    from refinery.plans.store import TableStore
    from refinery.session import fresh_workspace
    from refinery.sources import eventlog

    store = TableStore(spark, fresh_workspace(spark, "t-history"))
    upsert_plan.process_upsert(spark, golden_bronze[0], store)
    hist = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    merges = eventlog.query_history(hist, tag="method=upsert",
                                    pattern="%MERGE INTO silver%").collect()
    assert merges, "the Silver merge job is in the history"
    m = merges[0]
    assert m.query.startswith("MERGE INTO silver") and m.result == "JobSucceeded"
    assert m.rows_read >= 30 and m.total_sec >= 0
    latest = eventlog.query_history(hist, tag="method=upsert", k=1).collect()
    assert len(latest) == 1


def test_history_columns_and_compile_time(spark, golden_bronze):
    from refinery.sources import eventlog
    from refinery.sources.staged import read_bronze
    from refinery.plans.tags import statement
    with statement(spark, "history-columns probe"):
        read_bronze(spark, golden_bronze[0]).count()
    hist = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    assert hist.columns == eventlog.HISTORY_COLUMNS
    (r,) = eventlog.query_history(hist, pattern="history-columns probe").collect()
    assert r.compile_sec is not None and r.compile_sec >= 0


def test_history_counts_files_and_partitions_read(spark, golden_bronze):
    from refinery.sources import eventlog
    from refinery.sources.staged import read_bronze
    from refinery.plans.tags import statement
    with statement(spark, "files-read probe"):
        read_bronze(spark, golden_bronze[0], year=2010).count()
    hist = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    (r,) = eventlog.query_history(hist, pattern="files-read probe").collect()
    assert r.files_read >= 1 and r.partitions_read == 1      # one year partition


@pytest.mark.parametrize("compress", [False, True])
def test_recorded_log_says_what_spark_wrote(spark, compress):
    """A log of the jobs inside, plain or compressed: records, stages and tasks as Spark counted them."""
    from refinery.plans.tags import method_tag, statement
    from refinery.session import fresh_workspace
    from refinery.sources import eventlog

    folder = fresh_workspace(spark, "t-recording")
    with eventlog.recording(spark, folder, compress) as path:
        with method_tag(spark, "probe"), statement(spark, "INSERT INTO t"):
            spark.range(1234).repartition(3).write.parquet(f"{folder}-t")
        with pytest.raises(Exception, match="broken"):
            with method_tag(spark, "probe"), statement(spark, "INSERT INTO u"):
                spark.range(9).selectExpr("raise_error('broken') AS x").write.parquet(f"{folder}-u")
    spark.range(5).count()      # not in the log
    hist = eventlog.job_history(eventlog.read_events(spark, path))
    assert hist.count() == 2
    (r,) = eventlog.query_history(hist, tag="method=probe", pattern="%into T%").collect()
    assert (r.rows_written, r.stages, r.result) == (1234, 2, "JobSucceeded") and r.tasks > 3
    report = {x.query: (x.query_tag, x.state) for x in eventlog.statement_report(hist).collect()}
    assert report == {"INSERT INTO t": ("method=probe", "SUCCEEDED"), "INSERT INTO u": ("method=probe", "FAILED")}
