"""Command line: ``spark-submit -m refinery <command> ...`` or ``python -m refinery``.

Commands mirror what a user of the SQL original runs:

  load     --stage DIR --bronze DIR [--on-error continue|abort]   staged JSON-lines -> Bronze
  clean    --bronze DIR --target DIR                one clean refresh
  batch    --bronze DIR --target DIR [--create] [--reset-year Y] [--calls N]
  upsert   --bronze DIR --target DIR
  report   --target DIR --method M --name {per_batch,totals,latest,last10,cost,layers}
  sql      --target DIR --method M "SELECT ..."     any SQL over silver / gold / run_metrics
"""

from __future__ import annotations

import argparse
import sys

from refinery.plans import batch as batch_plan
from refinery.plans import clean as clean_plan
from refinery.plans import metrics as mx
from refinery.plans import upsert as upsert_plan
from refinery.plans.store import TableStore
from refinery.session import ensure_session_settings


def _spark():
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("refinery").getOrCreate()
    ensure_session_settings(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="refinery")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--stage", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--on-error", choices=["continue", "abort"], default="continue")
    for name in ("clean", "batch", "upsert"):
        p = sub.add_parser(name)
        p.add_argument("--bronze", required=True)
        p.add_argument("--target", required=True)
        if name == "batch":
            p.add_argument("--create", action="store_true", help="create tables, seed 1996")
            p.add_argument("--reset-year", type=int)
            p.add_argument("--calls", type=int, help="steps at most (default: until all are done)")
    p = sub.add_parser("report")
    p.add_argument("--target", required=True)
    p.add_argument("--method", required=True, choices=["clean_refresh", "batch", "upsert"])
    p.add_argument("--name", required=True,
                   choices=["per_batch", "totals", "latest", "last10", "cost", "layers"])
    p = sub.add_parser("sql")
    p.add_argument("--target", required=True)
    p.add_argument("--method", required=True, choices=["clean_refresh", "batch", "upsert"])
    p.add_argument("query")
    a = ap.parse_args(argv)

    spark = _spark()
    if a.cmd == "load":
        from refinery.sources.staged import load_bronze
        r = load_bronze(spark, a.stage, a.bronze, on_error=a.on_error)
        print(f"loaded={r.loaded_rows} rejected={r.rejected_lines}")
        return 0
    store = TableStore(spark, a.target)
    if a.cmd == "clean":
        print(clean_plan.clean_refresh(spark, a.bronze, store))
    elif a.cmd == "batch":
        if a.create:
            batch_plan.create_batch_tables(spark, store)
        if a.reset_year is not None:
            batch_plan.reset_batch(spark, store, a.reset_year)
        for r in batch_plan.run_all_batches(spark, a.bronze, store, calls=a.calls):
            print(r.status)
    elif a.cmd == "upsert":
        print(upsert_plan.process_upsert(spark, a.bronze, store).status)
    elif a.cmd == "report":
        runs = mx.read_runs(store)
        if a.name == "layers":
            from refinery import views
            from refinery.operators.reconcile import layer_counts
            views.register(spark, store, a.method)
            df = layer_counts(silver=spark.table("silver"), gold=spark.table("gold"))
        else:
            df = {"per_batch": lambda: mx.kpi_per_batch(runs),
                  "totals": lambda: mx.kpi_totals(runs, a.method),
                  "latest": lambda: mx.kpi_latest(runs, a.method),
                  "last10": lambda: mx.latest_runs(runs, 10),
                  "cost": lambda: mx.cost_report(runs)}[a.name]()
        df.show(truncate=False)
    elif a.cmd == "sql":
        from refinery import views
        views.register(spark, store, a.method)
        spark.sql(a.query).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
