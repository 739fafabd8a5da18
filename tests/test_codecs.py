"""Tables are packed closely, and a load's tasks read bounded pieces."""

from __future__ import annotations

from refinery.plans.store import TableStore
from refinery.session import fresh_workspace
from refinery.sources import staged


def test_tables_are_written_with_their_codec(spark):
    store = TableStore(spark, fresh_workspace(spark, "t-codec"))
    rows = spark.range(10).selectExpr("id", "id % 2 AS part")
    store.replace("a", rows)
    store.append("b", rows)
    store.overwrite_partitions("c", rows, "part")
    store.replace_generation("d", rows, "part", {})
    store.replace_partitions("d", rows.filter("part = 1"), "part")
    files = [f for t in "abcd" for f in spark.read.parquet(*([store.current(t)] if t == "a" else [store._gen_path(t)])).inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_load_reads_bounded_pieces(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with staged._side_by_side(spark):
        assert staged._bytes(spark, spark.conf.get(key)) == staged.LOAD_MOST
    assert spark.conf.get(key) == before
