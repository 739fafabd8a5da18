"""Run by test_task_retry.py in its own process (master local[4,3]).

Every map task fails on its first attempt; the retried job must produce the
same Silver, Gold and snapshot contents as an undisturbed run.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from refinery.operators import gold as gold_ops  # noqa: E402
from refinery.operators import silver as silver_ops  # noqa: E402
from refinery.plans.store import TableStore  # noqa: E402
from refinery.schemas import SILVER  # noqa: E402
from refinery.session import build_session, fresh_workspace  # noqa: E402
from refinery.sources.staged import load_bronze, read_bronze  # noqa: E402
from refinery.spec import CLEAN, UPSERT  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    # test-only fault injection: the first attempt of every task dies
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def _canon(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def main() -> None:
    spark = build_session(master="local[4,3]", shuffle_partitions=4, app_name="retry")
    root = fresh_workspace(spark, "retry")
    bronze = f"{root}/bronze"
    load_bronze(spark, os.path.join(ROOT, "tests", "data", "golden.jsonl"), bronze)

    def results(disturb: bool):
        b = read_bronze(spark, bronze).repartition(3, F.xxhash64(F.to_json("raw_json")))
        if disturb:
            b = b.filter(fail_first_attempt(F.lit(1)))
        ups = silver_ops.extract(b, UPSERT)
        clean = silver_ops.extract(b, CLEAN)
        store = TableStore(spark, f"{root}/store-{int(disturb)}")
        store.replace("silver", ups.withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")))
        written = _canon(store.read("silver", SILVER).drop("loaded_at").collect())
        gold = _canon(gold_ops.aggregate(clean, CLEAN).collect())
        return written, gold

    assert results(True) == results(False), "retried tasks changed the result"
    print("RETRY-OK")
    spark.stop()


if __name__ == "__main__":
    main()
