"""Temp views over a method's tables, for reports written in Spark SQL.

After ``register(spark, store, method)`` the tables of that method are
queryable as ``silver``, ``gold``, ``run_metrics`` (and ``batch_state`` for the
batch method), optionally with a prefix, e.g.::

    SELECT max(gold_rows_loaded) - min(gold_rows_loaded) AS gold_growth FROM run_metrics
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from refinery.plans import batch as batch_plan
from refinery.plans.metrics import RUNS, read_runs
from refinery.plans.store import TableStore
from refinery.schemas import GOLD, SILVER


def register(spark: SparkSession, store: TableStore, method: str, prefix: str = "") -> list[str]:
    tables = {"silver": SILVER, "gold": GOLD}
    partitioned: tuple[str, ...] = ()
    if method == "batch":
        tables["silver"] = batch_plan.SILVER_PART
        partitioned = ("silver",)
    views = store.register_views(tables, prefix, partitioned=partitioned)
    read_runs(store).createOrReplaceTempView(f"{prefix}{RUNS}")
    views.append(f"{prefix}{RUNS}")
    if method == "batch":
        batch_plan.read_state(spark, store).createOrReplaceTempView(f"{prefix}{batch_plan.STATE_T}")
        views.append(f"{prefix}{batch_plan.STATE_T}")
        # the reference's 12 Silver columns; review_year is storage only
        spark.table(f"{prefix}silver").drop("review_year").createOrReplaceTempView(f"{prefix}silver")
    return views
