"""Snapshot store and Bronze load edge cases."""

from __future__ import annotations

import os

from refinery.plans.store import TableStore
from refinery.schemas import BATCH_STATE
from refinery.session import fresh_workspace, local_path
from refinery.sources.staged import load_bronze, read_bronze


def test_uncommitted_snapshot_is_ignored_and_skipped(spark):
    store = TableStore(spark, fresh_workspace(spark, "t-store"))
    store.replace("state", spark.createDataFrame([(1996,)], BATCH_STATE))
    # a crashed writer leaves v=000002 without its commit marker
    crashed = local_path(store.path("state")) + "/v=000002"
    os.makedirs(crashed)
    with open(f"{crashed}/part-00000.parquet", "w") as f:
        f.write("garbage")
    assert store.read("state", BATCH_STATE).first().next_year == 1996
    path = store.replace("state", spark.createDataFrame([(1997,)], BATCH_STATE))
    assert path.endswith("v=000003")
    assert store.read("state", BATCH_STATE).first().next_year == 1997


def test_truncate_starts_new_generation(spark):
    store = TableStore(spark, fresh_workspace(spark, "t-gen"))
    df = spark.createDataFrame([(1,), (2,)], "x int")
    store.append("log", df)
    store.append("log", df)
    assert store.read_appended("log", df.schema).count() == 4
    store.reset_appended("log")
    assert store.read_appended("log", df.schema).count() == 0
    store.append("log", df)
    assert store.read_appended("log", df.schema).count() == 2


def test_missing_snapshot_reads_empty(spark):
    store = TableStore(spark, fresh_workspace(spark, "t-empty"))
    assert store.read("nothing", BATCH_STATE).count() == 0
    store.create_if_absent("state", BATCH_STATE)
    store.create_if_absent("state", BATCH_STATE)          # IF NOT EXISTS: no second version
    assert store.current("state").endswith("v=000001")


def test_non_object_lines_load_whole(spark, tmp_path):
    f = tmp_path / "odd.jsonl"
    f.write_text('[{"a":1},{"a":2}]\n123\n"x"\nnull\n{}\n\n{"a":1\n')
    out = f"{fresh_workspace(spark, 't-odd')}/bronze"
    load = load_bronze(spark, str(f), out)
    assert (load.loaded_rows, load.rejected_lines) == (5, 1)   # array kept as one row
    assert read_bronze(spark, out).count() == 5


def test_year_histogram_partition_column_equals_timestamp_year(spark, golden_bronze):
    from refinery.operators.inspect import year_histogram
    with_col = read_bronze(spark, golden_bronze[0], keep_year=True)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    a = sorted((tuple(r) for r in year_histogram(with_col).collect()), key=key)
    b = sorted((tuple(r) for r in year_histogram(with_col.drop("review_year")).collect()), key=key)
    assert a == b


def test_absent_year_reads_empty(spark, golden_bronze):
    assert read_bronze(spark, golden_bronze[0], year=1980).count() == 0


def test_vacuum_keeps_current_and_previous(spark):
    store = TableStore(spark, fresh_workspace(spark, "t-vacuum"), keep_sec=0)
    for y in range(1996, 2001):
        store.replace("state", spark.createDataFrame([(y,)], BATCH_STATE))
    kept = sorted(os.listdir(local_path(store.path("state"))))
    assert kept == ["v=000004", "v=000005"]
    assert store.read("state", BATCH_STATE).first().next_year == 2000
    # replaced a moment ago: a reader may still be at it
    young = TableStore(spark, fresh_workspace(spark, "t-young"))
    for y in range(4):
        young.replace("state", spark.createDataFrame([(y,)], BATCH_STATE))
    assert len(os.listdir(local_path(young.path("state")))) == 4
    everything = TableStore(spark, fresh_workspace(spark, "t-keepall"), keep=None)
    for y in range(3):
        everything.replace("state", spark.createDataFrame([(y,)], BATCH_STATE))
    assert len(os.listdir(local_path(everything.path("state")))) == 3


def test_one_row_matches_schema(spark):
    import datetime as dt
    from refinery.schemas import RUN_METRICS, one_row
    row = ("id", dt.datetime(2025, 1, 2, 3, 4, 5, 678000), "batch", 2000, 10, 5, 0, 3, 1.5, None)
    df = one_row(spark, RUN_METRICS, row)
    assert df.schema == RUN_METRICS or [f.dataType for f in df.schema] == [f.dataType for f in RUN_METRICS]
    assert tuple(df.first()) == row and df.rdd.getNumPartitions() == 1


def test_empty_stage_loads_and_reads_empty(spark, tmp_path):
    stage = tmp_path / "stage"
    stage.mkdir()
    out = f"{fresh_workspace(spark, 't-empty-stage')}/bronze"
    load = load_bronze(spark, str(stage), out)
    assert (load.loaded_rows, load.rejected_lines) == (0, 0)
    assert read_bronze(spark, out).count() == 0
    assert read_bronze(spark, out, year=2010).count() == 0


def test_list_staged_files_metadata_only(spark, tmp_path):
    from refinery.sources.staged import list_staged, stage_lines
    lines = spark.createDataFrame([(f'{{"i": {i}}}',) for i in range(50)], "value string")
    stage = f"{fresh_workspace(spark, 't-list')}/stage"
    stage_lines(lines, stage, compression="gzip")
    listed = list_staged(spark, stage)
    assert listed.columns == ["name", "size", "last_modified"]
    rows = listed.collect()
    assert len(rows) == 1 and all(r.size > 0 and r.name.endswith(".gz") for r in rows)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]          # file bodies are not read
    assert load_bronze(spark, stage, f"{stage}-bronze").loaded_rows == 50


def test_load_abort_on_error(spark):
    import pytest
    from refinery.session import fresh_workspace as fw
    from tests.conftest import GOLDEN
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        load_bronze(spark, GOLDEN, f"{fw(spark, 't-abort')}/bronze", on_error="abort")


def _state(spark, year):
    return spark.createDataFrame([(year,)], BATCH_STATE)


def test_state_outlives_sessions_without_success_files(spark, golden_bronze):
    """The store's marker does not depend on the committer's."""
    from refinery.plans import upsert as upsert_plan
    from refinery.schemas import GOLD, SILVER
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store = TableStore(spark, fresh_workspace(spark, "t-nosuccess"))
        first = upsert_plan.process_upsert(spark, golden_bronze[0], store)
        again = upsert_plan.process_upsert(spark, golden_bronze[0], store)
        assert not store._exists(f"{store.current('gold')}/_SUCCESS")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert first.silver_actions["insert"] == 16 and again.silver_actions["noop"] == 16
    assert store.read("silver", SILVER).count() == 16 and store.read("gold", GOLD).count() == 7


def test_unmarked_table_raises(spark):
    import pytest
    from refinery.plans.store import MARKER
    store = TableStore(spark, fresh_workspace(spark, "t-unmarked"))
    path = store.replace("state", _state(spark, 2000))
    os.remove(f"{local_path(path)}/{MARKER}")
    for use in (lambda: store.read("state", BATCH_STATE), lambda: store.create_if_absent("state", BATCH_STATE)):
        with pytest.raises(RuntimeError, match="none is committed"):
            use()
    store.replace("state", _state(spark, 2001))       # a retry of the failed write
    assert store.read("state", BATCH_STATE).first().next_year == 2001


def test_old_generations_are_removed(spark):
    now = TableStore(spark, fresh_workspace(spark, "t-gen"), keep_sec=0)
    for y in range(3):
        now.append("runs", _state(spark, y))
        now.reset_appended("runs")
    assert sorted(os.listdir(local_path(now.path("runs")))) == ["g=000004"]
    later = TableStore(spark, fresh_workspace(spark, "t-gen-young"))
    for y in range(3):
        later.append("runs", _state(spark, y))
        later.reset_appended("runs")
    assert len(os.listdir(local_path(later.path("runs")))) == 4
    assert later.read_appended("runs", BATCH_STATE).count() == 0


def test_bronze_files_follow_data_not_tasks(spark):
    """As many files from 40 input files as from one."""
    lines = spark.createDataFrame(
        [(f'{{"timestamp": {(i % 5) * 31_557_600_000 + 946_684_800_000}, "i": {i}}}',) for i in range(400)], "value string")
    counts = []
    for n in (1, 40):
        base = fresh_workspace(spark, f"t-files-{n}")
        lines.repartition(n).write.text(f"{base}/stage")
        load_bronze(spark, f"{base}/stage", f"{base}/bronze")
        counts.append(sum(f.endswith(".parquet") for _, _, names in os.walk(local_path(f"{base}/bronze")) for f in names))
    assert counts[0] == counts[1] <= 5


def test_rejected_lines_are_counted_when_nothing_is_kept(spark, tmp_path):
    f = tmp_path / "bad.jsonl"
    f.write_text('{"a":\n{"b"\n')
    load = load_bronze(spark, str(f), f"{fresh_workspace(spark, 't-allbad')}/bronze")
    assert (load.loaded_rows, load.rejected_lines) == (0, 2)


def test_state_survives_a_crash_at_any_step(spark, monkeypatch):
    import pytest
    store = TableStore(spark, fresh_workspace(spark, "t-state"))
    at = f"{store.path('batch_state')}/next_year"
    store.put_state(at, "1998\n")
    for step in ("write_text", "_delete"):
        with monkeypatch.context() as m:
            def broken(*_):
                raise OSError("lost")
            m.setattr(store, step, broken)
            with pytest.raises(OSError):
                store.put_state(at, "1999\n")
        # before the new value is whole the old one stands, then the new one does
        assert store.get_state(at) == ("1998" if step == "write_text" else "1999")
    store.put_state(at, "2000\n")
    assert store.get_state(at) == "2000"
    assert len([f for f in os.listdir(local_path(store.path("batch_state"))) if not f.startswith(".")]) == 1


def test_log_is_put_together(spark, monkeypatch):
    from pyspark.sql import types as T
    from refinery.plans import store as module
    monkeypatch.setattr(module, "LOG_FILES", 5)
    store = TableStore(spark, fresh_workspace(spark, "t-log"), keep_sec=0)
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType())])
    assert store.read_log("log", schema).count() == 0
    for i in range(23):
        store.log("log", [{"i": i, "s": "é\n"}])
    assert sorted(r.i for r in store.read_log("log", schema).collect()) == list(range(23))
    assert {r.s for r in store.read_log("log", schema).collect()} == {"é\n"}
    (only,) = os.listdir(local_path(store.path("log")))
    assert len([f for f in os.listdir(f"{local_path(store.path('log'))}/{only}") if f.endswith(".json")]) <= 6
    store.reset_appended("log")
    assert store.read_log("log", schema).count() == 0


def test_load_report_by_file(spark, tmp_path):
    from refinery.sources.staged import load_report
    good = '{"timestamp": 1275350400000}'
    for name, lines in (("a", [good, "{bad one", good, "", "{bad two"]), ("b", [good]), ("c", ["nope", "   "])):
        (tmp_path / f"{name}.jsonl").write_text("".join(x + "\n" for x in lines))
    out = f"{fresh_workspace(spark, 't-report')}/bronze"
    load = load_bronze(spark, str(tmp_path), out)
    rows = {r.source_file[-7:]: tuple(r)[1:] for r in load_report(spark, out).collect()}
    assert rows == {"a.jsonl": (4, 2, 2, "{bad one"), "b.jsonl": (1, 1, 0, None), "c.jsonl": (1, 0, 1, "nope")}
    assert (load.loaded_rows, load.rejected_lines) == (3, 3) and read_bronze(spark, out).count() == 3
    # a load without rejects leaves none from an earlier one
    (tmp_path / "a.jsonl").write_text(good + "\n")
    (tmp_path / "c.jsonl").write_text("")
    load_bronze(spark, str(tmp_path), out)
    assert {r.rejected_lines for r in load_report(spark, out).collect()} == {0}
