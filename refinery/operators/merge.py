"""MERGE as a DataFrame plan.

``merge_plan`` full-outer-joins the target table to a source that is unique
on the merge key and labels every output row with an action:

* ``insert`` -- key only in the source;
* ``update`` -- key in both and (when a change test is given) some compared
  column differs under NULL-safe equality (IS DISTINCT FROM);
* ``noop``   -- key in both, nothing differs: the target row is kept as is;
* ``keep``   -- key only in the target: MERGE has no not-matched-by-source
  branch, so the row stays (V13).

The result holds the whole new table; writing it as a new snapshot is the
commit.  Both sides are shuffled on the key once (the source is usually
already partitioned on it by its de-duplication window, and the planner
reuses that), and a key is unique on each side, so no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"
WRITTEN = ("insert", "update")


def merge_plan(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str],
               update: list[str], compare: list[str] | None, now: Column,
               clock_col: str | None = "loaded_at") -> DataFrame:
    """New table rows (``columns`` order) plus the ``_action`` label.

    ``update`` are the columns a matched row takes from the source; key
    columns are never updated (J5).  ``compare=None`` updates every matched
    row (J6).  ``clock_col`` is stamped with ``now`` on written rows.
    """
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in columns], F.lit(True).alias("t__in"))
    src_cols = [c for c in columns if c != clock_col]
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in src_cols], F.lit(True).alias("s__in"))
    cond = None
    for k in keys:
        c = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")

    if compare:
        changed = None
        for c in compare:
            d = ~F.col(f"t__{c}").eqNullSafe(F.col(f"s__{c}"))
            changed = d if changed is None else changed | d
    else:
        changed = F.lit(True)
    action = (F.when(F.col("t__in").isNull(), F.lit("insert"))
              .when(F.col("s__in").isNull(), F.lit("keep"))
              .when(changed, F.lit("update"))
              .otherwise(F.lit("noop")))
    j = j.withColumn(ACTION, action)
    written = F.col(ACTION).isin(*WRITTEN)
    out = []
    for c in columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t__{c}"), F.col(f"s__{c}")).alias(c))
        elif c == clock_col:
            out.append(F.when(written, now).otherwise(F.col(f"t__{c}")).alias(c))
        elif c in update:
            is_src = (F.col(ACTION) == "insert") | (F.col(ACTION) == "update")
            out.append(F.when(is_src, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        else:
            # insert-only column: source value for new rows, else target's
            out.append(F.when(F.col(ACTION) == "insert", F.col(f"s__{c}"))
                       .otherwise(F.col(f"t__{c}")).alias(c))
    return j.select(*out, ACTION)


def action_counts(plan: DataFrame) -> DataFrame:
    """Rows per action (J8 as counts)."""
    return plan.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumnRenamed(ACTION, "action")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (D14 check for a merge source/target)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
