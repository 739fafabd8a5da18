"""Upsert method (P4): newest row per (user_id, asin) merged into Silver,
all products re-aggregated and merged into Gold.

Silver lies in folders by ``pmod(hash(user_id, asin), n)`` and holds a
fingerprint of the compared columns beside each row.  A run costs what it
changes:

* Decide.  Bronze scan -> keys, time, figures, fingerprint and place of each
  row -> partial aggregate -> shuffle of these narrow rows on (user_id, asin)
  -> newest per key, joined to the keys and fingerprints of Silver (no other
  column of it is read).  Rows to insert or update are written down as places.
* Fetch.  Only those rows' payload is read from Bronze, by their places.
* Rewrite.  Only the buckets that hold a changed row are read, freed of the
  updated keys, and replaced with the fetched rows; other files stay.

A first load has nothing to compare and writes the de-duplicated source.
* Gold: partial aggregate of the new Silver -> shuffle on ``parent_asin`` ->
  final aggregate -> full outer join with the (small) Gold table.

Counts per action come from ``Observation``s on the writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.scalar import fingerprint, ntz
from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.operators.merge import ACTION, duplicate_keys, merge_plan
from refinery.plans.metrics import Clock, RunMetrics, elapsed_sec, estimate_credits, failures_logged, log_run
from refinery.plans.store import TableStore
from refinery.plans.tags import method_tag, statement
from refinery.schemas import GOLD, GOLD_COLUMNS, SILVER, SILVER_COLUMNS
from refinery.sources.staged import PLACE, files_of_keys, read_placed
from refinery.spec import UPSERT

SILVER_T = "silver"
GOLD_T = "gold"
KEYS = ["user_id", "asin"]
# Change test of the Silver merge (F8) and its update list (J5): review_id is
# updated, the key columns never are.
COMPARE = ["rating", "review_ts", "review_title", "review_text", "helpful_vote",
           "verified_purchase", "parent_asin", "has_images"]
UPDATE = ["review_id", "parent_asin", "rating", "review_title", "review_text",
          "helpful_vote", "verified_purchase", "review_ts", "has_images"]
# Silver bytes that a bucket is meant to hold, how far it may outgrow that, and
# the most buckets there are (beyond, they hold more bytes, in more files).
BUCKET_BYTES = 256 << 20
REBUCKET_FACTOR = 4
MAX_BUCKETS = 32_768
BUCKET = "bucket"
MARK = ["_fp1", "_fp2"]
# Silver as stored: beside its columns, the fingerprint of COMPARE.
SILVER_STORED = T.StructType(SILVER.fields + [T.StructField(c, T.LongType(), True) for c in MARK])
SILVER_BUCKETED = T.StructType(SILVER_STORED.fields + [T.StructField(BUCKET, T.IntegerType(), True)])
CHANGES_T = "silver_changes"
CHANGES = T.StructType(
    [T.StructField(k, T.StringType(), True) for k in KEYS]
    + [T.StructField(c, T.LongType(), True) for c in (*PLACE, "t_fp1", "t_fp2")]
    + [T.StructField("t_in", T.BooleanType(), True), T.StructField(ACTION, T.StringType(), True)])
TIED = "tied"
# Changed rows, keys and places alone, that are sent whole to every task; more of them are shuffled.
BROADCAST_ROWS = 100_000
# Most tied keys whose files are looked up before their rows are read whole, and most files that are picked so:
# beyond, nearly every file holds one, and all of Bronze is read.
TIED_KEYS, TIED_FILES = 1_000, 1_000
GOLD_UPDATE = [c for c in GOLD_COLUMNS if c not in ("parent_asin", "loaded_at")]


@dataclass
class UpsertResult:
    status: str
    metrics: RunMetrics
    silver_actions: dict
    gold_actions: dict


def create_upsert_tables(store: TableStore) -> None:
    """CREATE TABLE IF NOT EXISTS (A6): state outlives a run.

    Silver comes into being with its first rows.  A Silver kept as snapshots
    (an earlier layout) is taken over.
    """
    store.create_if_absent(GOLD_T, GOLD)
    if not store.has_generation(SILVER_T) and store.current(SILVER_T) is not None:
        old = store.read(SILVER_T, SILVER)
        _store_anew(store, old, bucket_number(store, store.size(store.current(SILVER_T))))


def silver_source(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Extract + filter + newest per key."""
    return silver_ops.extract(bronze, UPSERT, strict)


def silver_merge_plan(target: DataFrame, source: DataFrame, now) -> DataFrame:
    return merge_plan(target, source, KEYS, SILVER_COLUMNS, UPDATE, COMPARE, now)


def gold_merge_plan(target: DataFrame, silver: DataFrame, now) -> DataFrame:
    """Unconditional merge on parent_asin (J6): every source row is written."""
    source = gold_ops.aggregate(silver, UPSERT)
    return merge_plan(target, source, [gold_ops.KEY], GOLD_COLUMNS, GOLD_UPDATE, None, now)


def _counts(obs: Observation) -> dict:
    return {k: int(v or 0) for k, v in obs.get.items()}


def _observe_actions(plan: DataFrame, obs: Observation) -> DataFrame:
    return plan.observe(obs, *[F.count_if(F.col(ACTION) == a).alias(a)
                               for a in ("insert", "update", "noop", "keep")])


def process_upsert(spark: SparkSession, bronze_path: str, store: TableStore,
                   clock: Clock | None = None, credits_per_hour: float | None = None,
                   silver_buckets: int | None = None, strict: bool = False,
                   prune_orphans: bool = False, verify_keys: bool = False) -> UpsertResult:
    """One upsert run (P4).  Credits default to NULL, as the reference logs.

    Silver is kept in ``silver_buckets`` folders; by default their number
    follows the data when the table is first written and when it has outgrown
    them (``rebucket``).  A run that changes no row writes no Silver file.

    ``prune_orphans`` removes Gold rows whose product has no Silver rows left
    (off by default: the reference keeps them stale, V13 / D12).
    ``verify_keys`` first checks that Silver's merge keys are unique and raises
    otherwise (D14); the source's are unique by its aggregation.
    """
    clock = clock or Clock()
    run_id = clock.new_id()
    start = clock.now()
    with method_tag(spark, "upsert"), failures_logged(store, "upsert", Clock(clock.now, lambda: run_id), start):
        return _process_upsert(spark, bronze_path, store, clock, run_id, start, credits_per_hour, silver_buckets,
                               strict, prune_orphans, verify_keys)


def bucket_number(store: TableStore, size: int) -> int:
    """Buckets for so many bytes: a multiple of the shuffle partitions where that fits,
    so that a task of a shuffle on the keys holds whole buckets."""
    parts = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, -(-(-(-size // BUCKET_BYTES)) // parts)) * parts
    return n if n <= MAX_BUCKETS else max(MAX_BUCKETS // parts * parts, min(parts, MAX_BUCKETS))


def buckets_of(store: TableStore) -> int | None:
    """The present Silver's bucket count, None if there is none."""
    found = store.note(SILVER_T, "buckets")
    return int(found) if found else None


def _bucket(n: int):
    return F.pmod(F.hash(*KEYS), F.lit(n)).alias(BUCKET)


def _store_anew(store: TableStore, rows: DataFrame, n: int) -> None:
    """All of Silver into ``n`` buckets; ``rows`` that are dealt by the keys are not dealt again."""
    mark = [c.alias(m) for c, m in zip(fingerprint(COMPARE), MARK)]
    store.replace_generation(SILVER_T, rows.select(*SILVER_COLUMNS, *mark, _bucket(n)), BUCKET, {"buckets": f"{n}\n"})


def rebucket(store: TableStore, silver_buckets: int | None = None) -> int:
    """Silver's bucket count, after dealing it into more buckets if it has outgrown them."""
    n = buckets_of(store)
    held = store.generation_size(SILVER_T)
    wanted = silver_buckets or (bucket_number(store, held) if held > REBUCKET_FACTOR * n * BUCKET_BYTES else n)
    if wanted != n:
        _store_anew(store, store.read(SILVER_T, SILVER).repartition(*KEYS), wanted)
    return wanted


def _check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"merge {what} has duplicate keys {keys}: {tuple(dup[0])[:len(keys)]}")


def _merge_silver(spark, bronze_path, store, now, silver_buckets, strict) -> tuple[int, dict, dict]:
    """Merge Bronze into Silver; Bronze rows, rows per action, cut values by column."""
    obs_w = Observation("widths")
    bronze = read_placed(spark, bronze_path)
    bronze_rows = bronze.count()  # from the files' footers; an observation here would keep the fields from being read alone
    counts = dict.fromkeys(("insert", "update", "noop", "keep"), 0)
    if not store.partition_values(SILVER_T, BUCKET):
        obs = Observation("silver_load")
        rows = (silver_ops.extract(bronze, UPSERT, strict, obs_w).withColumn("loaded_at", now)
                .observe(obs, F.count(F.lit(1)).alias("insert")))
        with statement(spark, "MERGE INTO silver (first load)"):
            _store_anew(store, rows, silver_buckets or bucket_number(store, store.size(bronze_path)))
        return bronze_rows, counts | _counts(obs), _counts(obs_w)

    n = rebucket(store, silver_buckets)
    held = store.read(SILVER_T, SILVER).count()
    found = _decide(spark, bronze_path, bronze, store, strict, obs_w)
    counts.update(insert=found["insert"], update=found["update"], noop=found["noop"],
                  keep=held - found["update"] - found["noop"])
    if found["insert"] + found["update"]:
        with statement(spark, "MERGE INTO silver (buckets)"):
            _rewrite(bronze, store, now, n, strict, found["insert"] + found["update"])
    return bronze_rows, counts, _counts(obs_w)


def _marked(bronze: DataFrame, strict: bool, cut: Observation | None = None) -> DataFrame:
    """Typed rows with their place and fingerprint."""
    return _with_mark(silver_ops.typed(bronze, UPSERT, strict, PLACE, cut))


def _with_mark(rows: DataFrame) -> DataFrame:
    return rows.withColumns(dict(zip(MARK, fingerprint(COMPARE))))


def _few_or_many(changes: DataFrame, n: int) -> DataFrame:
    """``changes`` (``n`` rows) for a join to Bronze rows.  Bronze is never the side sent to
    every task: its packed files look far smaller than its rows are."""
    return F.broadcast(changes) if n <= BROADCAST_ROWS else changes.hint("merge")


def _labelled(newest: DataFrame) -> DataFrame:
    """``CHANGES`` rows from newest source rows joined to Silver's fingerprints."""
    same = (F.col("_fp1") == F.col("t_fp1")) & (F.col("_fp2") == F.col("t_fp2"))
    action = (F.when(F.col("tied"), F.lit(TIED)).when(F.col("t_in").isNull(), F.lit("insert"))
              .when(same, F.lit("noop")).otherwise(F.lit("update")))
    return newest.withColumn(ACTION, action).select(*CHANGES.fieldNames())


def decide_plan(bronze: DataFrame, store: TableStore, strict: bool = False, cut: Observation | None = None) -> DataFrame:
    """The action for each newest source row, with its place: narrow columns only."""
    target = store.read_appended(SILVER_T, SILVER_STORED).select(
        *KEYS, *[F.col(c).alias(f"t{c}") for c in MARK], F.lit(True).alias("t_in"))
    return _labelled(silver_ops.newest_places(_marked(bronze, strict, cut), KEYS, list(PLACE), MARK).join(target, KEYS, "left"))


def _rows_of_tied(spark, bronze_path, bronze, ties, n) -> DataFrame:
    """Bronze, or of ``n`` few tied keys the files that hold them."""
    files = files_of_keys(spark, bronze_path, ties.select(*KEYS), TIED_FILES) if n <= TIED_KEYS else None
    return bronze if files is None else read_placed(spark, bronze_path, files)


def _decide(spark, bronze_path, bronze, store, strict, cut) -> dict:
    """Write down the rows to insert or update (``CHANGES_T``); rows per action."""
    names = ("insert", "update", "noop", TIED)
    obs = Observation("silver_decide")
    plan = decide_plan(bronze, store, strict, cut)
    plan = plan.observe(obs, *[F.count_if(F.col(ACTION) == a).alias(a) for a in names])
    with statement(spark, "MERGE INTO silver (changed rows)"):
        store.replace(CHANGES_T, plan.filter(F.col(ACTION) != "noop"))
    counts = dict.fromkeys(names, 0) | _counts(obs)
    if counts[TIED]:
        # Rows alike in time and figures: their text columns decide.
        changes = store.read(CHANGES_T, CHANGES)
        ties = changes.filter(F.col(ACTION) == TIED).select(*KEYS, "t_fp1", "t_fp2", "t_in")
        with statement(spark, "MERGE INTO silver (files of tied rows)"):
            tied_rows = _rows_of_tied(spark, bronze_path, bronze, ties, counts[TIED])
        picked = silver_ops.latest_per_key(
            _marked(tied_rows, strict).join(_few_or_many(ties, counts[TIED]), KEYS)).withColumn("tied", F.lit(False))
        obs_t = Observation("silver_ties")
        picked = _labelled(picked).observe(obs_t, *[F.count_if(F.col(ACTION) == a).alias(a) for a in names[:3]])
        with statement(spark, "MERGE INTO silver (changed rows)"):
            store.replace(CHANGES_T, changes.filter(F.col(ACTION) != TIED)
                          .unionByName(picked.filter(F.col(ACTION) != "noop")))
        for action, rows in _counts(obs_t).items():
            counts[action] += rows
    return counts


def _rewrite(bronze, store, now, n, strict, changed) -> None:
    """Replace the buckets that hold one of the ``changed`` rows."""
    changes = store.read(CHANGES_T, CHANGES)
    # At most as many numbers as there are buckets.
    touched = [r[0] for r in changes.select(_bucket(n)).distinct().collect()]
    columns = [*SILVER_STORED.fieldNames(), BUCKET]
    # Id and fingerprint are made last: they would weigh more in the shuffles than what they are made of.
    rows = silver_ops.typed(bronze, UPSERT, strict, PLACE).join(
        _few_or_many(changes.select(*KEYS, *PLACE), changed), [*KEYS, *PLACE])
    fetched = silver_ops.keys_that_fit(rows.drop(*PLACE)).withColumn(BUCKET, _bucket(n)).repartition(BUCKET)
    fetched = (_with_mark(silver_ops.with_review_id(fetched, UPSERT)).withColumn("loaded_at", now).select(*columns))
    kept = store.read_appended(SILVER_T, SILVER_BUCKETED).filter(F.col(BUCKET).isin(touched))
    updated = changes.filter(F.col(ACTION) == "update").select(*KEYS)
    store.replace_partitions(SILVER_T, kept.join(updated, KEYS, "left_anti").select(*columns).unionByName(fetched), BUCKET)


def _process_upsert(spark, bronze_path, store, clock, run_id, start, credits_per_hour, silver_buckets,
                    strict, prune_orphans, verify_keys) -> UpsertResult:
    now = ntz(start)
    store.finish_replace(SILVER_T)
    create_upsert_tables(store)
    if verify_keys:
        _check_unique(store.read(SILVER_T, SILVER), KEYS, "target")
    bronze_rows, s_act, cut = _merge_silver(spark, bronze_path, store, now, silver_buckets, strict)

    obs_g = Observation("gold_merge")
    gplan = gold_merge_plan(store.read(GOLD_T, GOLD), store.read(SILVER_T, SILVER), now)
    gplan = _observe_actions(gplan, obs_g)
    if prune_orphans:
        gplan = gplan.filter(F.col(ACTION) != "keep")
    with statement(spark, "MERGE INTO gold"):
        store.replace(GOLD_T, gplan.drop(ACTION))
    g_act = _counts(obs_g)

    silver_loaded = s_act["insert"] + s_act["update"]
    gold_loaded = g_act["insert"] + g_act["update"]
    duration = elapsed_sec(start, clock.now())
    metrics = RunMetrics(
        run_id=run_id, run_timestamp=start, method="upsert", batch_id=None,
        bronze_row_count=bronze_rows, silver_rows_loaded=silver_loaded,
        silver_rows_deleted=0, gold_rows_loaded=gold_loaded, duration_sec=duration,
        credits_used=estimate_credits(duration, credits_per_hour), cut=cut)
    log_run(store, metrics)
    status = (f"upsert OK | run_id={run_id} | bronze={metrics.bronze_row_count}"
              f" | silver_loaded={silver_loaded} | gold_loaded={gold_loaded}"
              f" | duration_sec={duration}")
    return UpsertResult(status, metrics, s_act, g_act)
