"""Print the physical plan tree of each main operator (for PLANS.md).

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from refinery.fixtures import bronze_for, fixture_paths  # noqa: E402
from refinery.operators import gold as gold_ops  # noqa: E402
from refinery.operators import reconcile as rec  # noqa: E402
from refinery.operators import silver as silver_ops  # noqa: E402
from refinery.plans import batch as batch_plan  # noqa: E402
from refinery.plans import upsert as upsert_plan  # noqa: E402
from refinery.plans.store import TableStore  # noqa: E402
from refinery.schemas import GOLD, GOLD_PARTS, SILVER  # noqa: E402
from refinery.session import build_session, fresh_workspace  # noqa: E402
from refinery.sources.staged import read_bronze, read_placed, read_staged, with_year  # noqa: E402
from refinery.spec import BATCH, CLEAN, UPSERT  # noqa: E402


def tree(title: str, df) -> None:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    lines = text.split("\n\n\n")[0] if "\n\n\n" in text else text
    print(f"### {title}\n```\n{lines.strip()}\n```\n")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    bronze = bronze_for(spark, sf, "all")
    stage, _ = fixture_paths(spark, sf, "all")
    tree("Bronze load: JSON lines -> variant, year column", with_year(read_staged(spark, stage)
         .filter(F.col("raw_json").isNotNull())))
    b = read_bronze(spark, bronze)
    tree("Silver, clean form", silver_ops.extract(b, CLEAN))
    tree("Gold, clean form", gold_ops.aggregate(silver_ops.extract(b, CLEAN), CLEAN))
    tree("Upsert source: newest row per (user_id, asin)", silver_ops.extract(b, UPSERT))

    store = TableStore(spark, fresh_workspace(spark, "explain"))
    upsert_plan.process_upsert(spark, bronze_for(spark, sf, "wave1"), store)
    tree("Silver MERGE, decision: narrow rows against keys and fingerprints of Silver",
         upsert_plan.decide_plan(read_placed(spark, bronze_for(spark, sf, "wave2")), store))
    tree("Gold MERGE", upsert_plan.gold_merge_plan(store.read("gold", GOLD),
                                                   store.read("silver", SILVER), F.localtimestamp()))

    bstore = TableStore(spark, fresh_workspace(spark, "explain-batch"))
    batch_plan.create_batch_tables(spark, bstore)
    batch_plan.set_next_year(spark, bstore, 1997)
    batch_plan.run_all_batches(spark, bronze, bstore, calls=2)
    y = 1998
    tree(f"Batch step {y}: Silver rows of the year (one Bronze folder)",
         silver_ops.extract(read_bronze(spark, bronze, year=y), BATCH.for_year(y)))
    parts = bstore.read_partitioned(batch_plan.PARTS_T, GOLD_PARTS)
    touched = bstore.read_partition(batch_plan.PARTS_T, GOLD_PARTS, "review_year", 1997).select("parent_asin")
    recomputed = gold_ops.combine_partials(gold_ops.rows_of_keys(parts, touched), BATCH)
    tree("Batch step: replace touched Gold rows from partials",
         gold_ops.replace_keys(bstore.read("gold", GOLD), touched, recomputed))
    clean_silver = silver_ops.extract(b, CLEAN)
    batch_silver = silver_ops.extract(b, BATCH)
    tree("Reconcile Silver as multisets (one shuffle)",
         rec.multiset_differences(batch_silver, clean_silver, "batch", "clean_refresh"))
    spark.stop()


if __name__ == "__main__":
    main()
