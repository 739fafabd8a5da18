"""refinery: incremental medallion refresh (Bronze -> Silver -> Gold) on Spark.

Three interchangeable refresh methods are offered -- full replace, yearly
watermark batches and change-detecting upsert -- each writing run metrics
and reconcilable results.  Everything is DataFrame / Spark SQL; no Python
code runs on the row path.
"""

from refinery.spec import BATCH, CLEAN, UPSERT, MethodSpec

__all__ = ["MethodSpec", "CLEAN", "BATCH", "UPSERT"]
