"""Benchmark: the three refresh methods end to end, plus the Bronze load.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  Each timed item starts from a fresh workspace
folder, so nothing is reused between items except the staged input files.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from refinery.fixtures import fixture_paths, load_fixture  # noqa: E402
from refinery.operators import gold as gold_ops  # noqa: E402
from refinery.operators import silver as silver_ops  # noqa: E402
from refinery.plans import batch as batch_plan  # noqa: E402
from refinery.plans import clean as clean_plan  # noqa: E402
from refinery.plans import upsert as upsert_plan  # noqa: E402
from refinery.plans.store import TableStore  # noqa: E402
from refinery.session import build_session, fresh_workspace  # noqa: E402
from refinery.sources.staged import load_bronze, read_bronze  # noqa: E402
from refinery.spec import CLEAN, UPSERT  # noqa: E402


def _sf(sf_dir: str):
    text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(text)
    except ValueError:
        return text


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    import tempfile
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          app_name="refinery-bench",
                          event_log_dir=tempfile.mkdtemp(prefix="run-bench-eventlog-"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Staged JSON-lines input (not timed: it stands for the raw dump).
    for kind in ("all", "wave1", "wave2"):
        load_fixture(spark, sf_dir, kind)
    stage, bronze = fixture_paths(spark, sf_dir, "all")
    _, bronze_w1 = fixture_paths(spark, sf_dir, "wave1")
    _, bronze_w2 = fixture_paths(spark, sf_dir, "wave2")

    # Warm-up (not timed): JVM start-up and first code generation would
    # otherwise land on whichever item runs first.
    from pyspark.sql import functions as F
    from refinery.sources.staged import read_staged
    read_staged(spark, stage).select(F.count_if(F.col("raw_json").isNull())).collect()
    spark.range(100000).groupBy((F.col("id") % 7).alias("k")).count().collect()

    # Bronze load of the whole dump (A2-A4): JSON parse to variant + write.
    scratch = fresh_workspace(spark, "bench-bronze")
    load = timed("bronze_load", lambda: load_bronze(spark, stage, f"{scratch}/bronze"))

    # Flagship query: Bronze -> Silver -> Gold, clean form.
    timed("gold_clean", lambda: gold_ops.aggregate(
        silver_ops.extract(read_bronze(spark, bronze), CLEAN), CLEAN).write.format("noop").mode("overwrite").save())
    timed("silver_upsert_dedupe", lambda: silver_ops.extract(
        read_bronze(spark, bronze), UPSERT).write.format("noop").mode("overwrite").save())

    # P1 clean refresh.
    store = TableStore(spark, fresh_workspace(spark, "bench-clean"))
    clean = timed("clean_refresh", lambda: clean_plan.clean_refresh(spark, bronze, store))

    # P3 batch catch-up 1996..2023 (28 yearly steps).
    bstore = TableStore(spark, fresh_workspace(spark, "bench-batch"))
    batch_plan.create_batch_tables(spark, bstore)
    steps = timed("batch_all_years", lambda: batch_plan.run_all_batches(spark, bronze, bstore))

    # P4 upsert: wave 1 into empty tables, then wave 2 (merge path).
    ustore = TableStore(spark, fresh_workspace(spark, "bench-upsert"))
    timed("upsert_wave1", lambda: upsert_plan.process_upsert(spark, bronze_w1, ustore))
    u2 = timed("upsert_wave2", lambda: upsert_plan.process_upsert(spark, bronze_w2, ustore))

    # Shuffle and spill per method, from the event log (the reference watches
    # bytes spilled by its upsert).
    from refinery.sources import eventlog
    hist = eventlog.job_history(eventlog.read_events(spark, eventlog.event_log_dir(spark)))
    io = {}
    for method in ("clean_refresh", "batch", "upsert"):
        r = (hist.filter(eventlog.has_tag(f"method={method}"))
             .agg(F.sum("shuffle_bytes").alias("b"), F.sum("bytes_spilled").alias("spill")).first())
        io[method] = {"shuffle_mb": round(int(r.b or 0) / 1024 / 1024, 2),
                      "spill_bytes": int(r.spill or 0)}

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "bronze_rows_per_sec": round(load.loaded_rows / times["bronze_load"]),
        "io": io,
        "rows": {"bronze": load.loaded_rows, "silver_clean": clean.silver_rows_loaded,
                 "batch_steps": sum(1 for s in steps if s.year is not None),
                 "upsert_wave2_written": u2.metrics.silver_rows_loaded},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
