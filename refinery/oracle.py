"""DuckDB SQL equal to each registered query, written straight over the
driver tables (no JSON, no variant): the independent check of the Spark
results.  The review mapping is the one of FIXTURES.md section 3.
"""

from __future__ import annotations


def _rec(name: str, wave: int | None = None) -> str:
    where = ""
    parent = "CASE WHEN l.l_partkey % 400 = 13 THEN NULL ELSE 'P' || CAST(l.l_partkey % 80 AS VARCHAR) END"
    if wave == 1:
        where = "WHERE l.l_shipdate < TIMESTAMP '1999-01-01 00:00:00'"
    elif wave == 2:
        where = "WHERE l.l_partkey % 10 <> 0"
        parent = f"CASE WHEN l.l_partkey % 80 = 21 THEN 'Q21' ELSE {parent} END"
    return f"""{name} AS (
  SELECT
    CAST(l.l_linenumber % 7 AS DOUBLE) AS rating,
    l.l_returnflag AS title,
    CASE WHEN l.l_quantity = 50 THEN '' ELSE l.l_returnflag || '-' || l.l_linestatus END AS text,
    CASE WHEN l.l_partkey % 101 IN (5, 6) THEN NULL ELSE 'A' || CAST(l.l_partkey % 400 AS VARCHAR) END AS asin,
    (l.l_partkey % 101 = 6) AS asin_json_null,
    {parent} AS parent_asin,
    'U' || CAST(o.o_custkey AS VARCHAR) AS user_id,
    CASE l.l_partkey % 97 WHEN 0 THEN 1704067200000 WHEN 1 THEN 1718409600000
         WHEN 2 THEN NULL
         WHEN 3 THEN CASE WHEN l.l_partkey % 80 < 20 THEN 1704067199123 ELSE epoch_ms(l.l_shipdate) END
         ELSE epoch_ms(l.l_shipdate) END AS ts_ms,
    CASE WHEN l.l_linenumber % 4 = 0 THEN NULL ELSE CAST(trunc(l.l_quantity) AS INTEGER) END AS helpful_vote,
    CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_returnflag = 'A' END AS verified_purchase,
    CASE WHEN l.l_linenumber % 5 = 0 THEN NULL ELSE l.l_linenumber % 3 END AS image_count,
    l.l_partkey AS pk
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  {where}
)"""


# Corrected input of the re-run: by timestamp, as the fixed ones lie in 2023 and 2024.
REC_CORRECTED = """rec_c AS (
  SELECT * FROM rec
  WHERE ts_ms IS NULL OR NOT (year(epoch_ms(ts_ms)) = 1997
        OR (year(epoch_ms(ts_ms)) = 1998 AND pk % 80 < 30))
)"""


def _silver_clean_form(name: str, rec: str, lo: str, hi: str, hi_inclusive: bool) -> str:
    """Clean/batch Silver (V1-V8 in clean form) over [lo, hi] or [lo, hi)."""
    op = "<=" if hi_inclusive else "<"
    return f"""{name} AS (
  SELECT
    md5(user_id || asin || CAST(ts_ms AS VARCHAR)) AS review_id,
    substring(asin, 1, 25) AS asin,
    substring(parent_asin, 1, 25) AS parent_asin,
    substring(user_id, 1, 50) AS user_id,
    rating,
    substring(title, 1, 500) AS review_title,
    text AS review_text,
    COALESCE(helpful_vote, 0) AS helpful_vote,
    verified_purchase,
    epoch_ms(ts_ms) AS review_ts,
    image_count > 0 AS has_images
  FROM {rec}
  WHERE (asin IS NOT NULL OR asin_json_null) AND user_id IS NOT NULL
    AND rating IS NOT NULL AND ts_ms IS NOT NULL
    AND rating BETWEEN 1.0 AND 5.0
    AND length(text) > 0
    AND epoch_ms(ts_ms) >= TIMESTAMP '{lo}' AND epoch_ms(ts_ms) {op} TIMESTAMP '{hi}'
)"""


def _silver_upsert(name: str, rec: str) -> str:
    return f"""{name} AS (
  SELECT review_id, asin, parent_asin, user_id, rating, review_title, review_text,
         helpful_vote, verified_purchase, review_ts, has_images
  FROM (
    SELECT
      md5(user_id || '|' || asin || '|' || CAST(ts_ms AS VARCHAR)) AS review_id,
      asin, parent_asin, user_id, rating,
      title AS review_title, text AS review_text, helpful_vote, verified_purchase,
      epoch_ms(ts_ms) AS review_ts,
      CASE WHEN image_count > 0 THEN TRUE ELSE FALSE END AS has_images
    FROM {rec}
    WHERE rating BETWEEN 1.0 AND 5.0 AND text <> ''
      AND user_id IS NOT NULL AND asin IS NOT NULL
      AND epoch_ms(ts_ms) >= TIMESTAMP '1996-01-01 00:00:00'
      AND epoch_ms(ts_ms) < TIMESTAMP '2025-01-01 00:00:00'
  ) x
  QUALIFY row_number() OVER (
    PARTITION BY user_id, asin
    ORDER BY review_ts DESC NULLS LAST, rating DESC NULLS LAST, helpful_vote DESC NULLS LAST,
             verified_purchase DESC NULLS LAST, review_title DESC NULLS LAST,
             review_text DESC NULLS LAST, parent_asin DESC NULLS LAST, has_images DESC NULLS LAST) = 1
)"""


def _gold(silver: str, rounded: bool, drop_null: bool, where: str = "") -> str:
    avg = "CAST(round(CAST(avg(rating) AS DECIMAL(18,6)), 2) AS DOUBLE)" if rounded else "avg(rating)"
    conds = [c for c in (("parent_asin IS NOT NULL" if drop_null else ""), where) if c]
    w = ("WHERE " + " AND ".join(conds)) if conds else ""
    return f"""SELECT parent_asin,
    {avg} AS avg_rating,
    CAST(count(*) AS BIGINT) AS total_reviews,
    CAST(count_if(verified_purchase = TRUE) AS BIGINT) AS verified_count,
    CAST(count_if(verified_purchase = FALSE) AS BIGINT) AS unverified_count,
    CAST(sum(helpful_vote) AS BIGINT) AS helpful_votes_sum,
    CAST(count_if(has_images = TRUE) AS BIGINT) AS reviews_with_images,
    max(review_ts) AS latest_review_ts,
    min(review_ts) AS earliest_review_ts
  FROM {silver} {w}
  GROUP BY parent_asin"""


SILVER_COLS = ("review_id, asin, parent_asin, user_id, rating, review_title, review_text, "
               "helpful_vote, verified_purchase, review_ts, has_images")
GOLD_COLS = ("parent_asin, avg_rating, total_reviews, verified_count, unverified_count, "
             "helpful_votes_sum, reviews_with_images, latest_review_ts, earliest_review_ts")
T1996 = "1996-01-01 00:00:00"
T2024 = "2024-01-01 00:00:00"
STEP_YEAR = 2023


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


REC = _rec("rec")
S_CLEAN = _silver_clean_form("s_clean", "rec", T1996, T2024, True)
S_BATCH = _silver_clean_form("s_batch", "rec", T1996, T2024, False)
S_UPSERT = _silver_upsert("s_upsert", "rec")
TWO_WAVES = [_rec("rec1", 1), _rec("rec2", 2), _silver_upsert("w1", "rec1"),
             _silver_upsert("w2", "rec2"),
             f"""s2 AS (
  SELECT {SILVER_COLS} FROM w2
  UNION ALL
  SELECT {SILVER_COLS} FROM w1
  WHERE NOT EXISTS (SELECT 1 FROM w2 WHERE w2.user_id = w1.user_id AND w2.asin = w1.asin)
)""",
             f"g1 AS ({_gold('w1', False, True)})",
             f"g2 AS ({_gold('s2', False, True)})",
             f"""gold2 AS (
  SELECT {GOLD_COLS} FROM g2
  UNION ALL
  SELECT {GOLD_COLS} FROM g1 WHERE parent_asin NOT IN (SELECT parent_asin FROM g2)
)"""]


def _batch_gold_years(lo: int, hi_excl: int) -> str:
    return (_with(REC, _silver_clean_form("s", "rec", f"{lo}-01-01 00:00:00",
                                          f"{hi_excl}-01-01 00:00:00", False))
            + _gold("s", True, True))


_YEAR_ROWS = _silver_clean_form("s_upto", "rec", T1996, f"{STEP_YEAR + 1}-01-01 00:00:00", False)

RUNS_WITH = _with(REC, S_CLEAN, S_BATCH, *TWO_WAVES,
                  f"g_clean AS ({_gold('s_clean', True, False)})",
                  "years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1996, 2024))")
RUN_COUNTS = """
SELECT 'clean_refresh' AS method, CAST(NULL AS INTEGER) AS batch_id,
       (SELECT CAST(count(*) AS BIGINT) FROM rec) AS bronze_row_count,
       (SELECT CAST(count(*) AS BIGINT) FROM s_clean) AS silver_rows_loaded,
       CAST(0 AS BIGINT) AS silver_rows_deleted,
       (SELECT CAST(count(*) AS BIGINT) FROM g_clean) AS gold_rows_loaded
UNION ALL
SELECT 'batch', y, (SELECT CAST(count(*) AS BIGINT) FROM rec),
       (SELECT CAST(count(*) AS BIGINT) FROM s_batch WHERE year(review_ts) = y),
       CAST(0 AS BIGINT),
       (SELECT CAST(count(DISTINCT parent_asin) AS BIGINT) FROM s_batch
         WHERE year(review_ts) <= y AND parent_asin IS NOT NULL)
FROM years
UNION ALL
SELECT 'upsert', NULL, (SELECT CAST(count(*) AS BIGINT) FROM rec1),
       (SELECT CAST(count(*) AS BIGINT) FROM w1), CAST(0 AS BIGINT),
       (SELECT CAST(count(*) AS BIGINT) FROM g1)
UNION ALL
SELECT 'upsert', NULL, (SELECT CAST(count(*) AS BIGINT) FROM rec2),
       (SELECT CAST(count(*) AS BIGINT) FROM w2 WHERE NOT EXISTS (
          SELECT 1 FROM w1 WHERE w1.user_id = w2.user_id AND w1.asin = w2.asin
            AND w1.rating IS NOT DISTINCT FROM w2.rating AND w1.review_ts IS NOT DISTINCT FROM w2.review_ts
            AND w1.review_title IS NOT DISTINCT FROM w2.review_title
            AND w1.review_text IS NOT DISTINCT FROM w2.review_text
            AND w1.helpful_vote IS NOT DISTINCT FROM w2.helpful_vote
            AND w1.verified_purchase IS NOT DISTINCT FROM w2.verified_purchase
            AND w1.parent_asin IS NOT DISTINCT FROM w2.parent_asin
            AND w1.has_images IS NOT DISTINCT FROM w2.has_images)),
       CAST(0 AS BIGINT),
       (SELECT CAST(count(*) AS BIGINT) FROM g2)"""

# The runs' clock (fixed values): each method's clock starts at this time and
# moves a second a reading; a run reads it at its start and its end, so the
# n-th run of a method starts 2 (n - 1) seconds after it and takes one.
CLOCK_START = "2024-07-01 00:00:00"
# Which run of its method a row is: batch years from 1996, upsert waves by their Bronze size.
RUN_TABLE = RUNS_WITH + f""", counts AS ({RUN_COUNTS}),
numbered AS (
  SELECT *, CASE method WHEN 'batch' THEN batch_id - 1996
                 WHEN 'upsert' THEN CASE WHEN bronze_row_count = (SELECT count(*) FROM rec1) THEN 0 ELSE 1 END
                 ELSE 0 END AS n
  FROM counts),
runs AS (
  SELECT CASE method WHEN 'clean_refresh' THEN 'clean' ELSE method END || '-' || lpad(CAST(n + 1 AS VARCHAR), 3, '0') AS run_id,
         TIMESTAMP '{CLOCK_START}' + to_seconds(2 * n) AS run_timestamp, method, batch_id, bronze_row_count,
         silver_rows_loaded, silver_rows_deleted, gold_rows_loaded, CAST(1 AS DOUBLE) AS duration_sec,
         CASE WHEN method = 'upsert' THEN NULL ELSE CAST(round(1 / 3600.0, 6) AS DOUBLE) END AS credits_used
  FROM numbered)
"""
SHARED = ("run_id, run_timestamp, method, bronze_row_count, silver_rows_loaded, silver_rows_deleted, "
          "gold_rows_loaded, duration_sec, credits_used")
# Writes of the batch run and the records each wrote: years with a Bronze
# partition load Silver, those with Silver rows also partials and the whole Gold.
BATCH_WRITES = """, loaded AS (
  SELECT y, (SELECT count(*) FROM s_batch WHERE year(review_ts) = y) AS silver_rows,
         (SELECT count(DISTINCT parent_asin) FROM s_batch WHERE year(review_ts) = y) AS products,
         (SELECT count(DISTINCT parent_asin) FROM s_batch WHERE year(review_ts) <= y) AS gold_rows
  FROM years WHERE y IN (SELECT year(epoch_ms(ts_ms)) FROM rec)),
statements AS (
  SELECT 'INSERT INTO silver (year ' || y || ')' AS query, silver_rows AS rows_written FROM loaded
  UNION ALL SELECT 'INSERT INTO gold partials (year ' || y || ')', products FROM loaded WHERE silver_rows > 0
  UNION ALL SELECT 'DELETE + INSERT INTO gold (year ' || y || ')', gold_rows FROM loaded WHERE silver_rows > 0)
"""

ORACLE: dict[str, str] = {
    "bronze_field_preview": _with(REC) + """
SELECT rating, title AS review_title, text AS review_text, asin, parent_asin, user_id,
       ts_ms AS ts_unix, verified_purchase, helpful_vote, CAST(image_count AS INTEGER) AS image_count
FROM rec
ORDER BY ts_unix DESC NULLS LAST, rating ASC NULLS LAST, review_title ASC NULLS LAST,
         review_text ASC NULLS LAST, asin ASC NULLS LAST, parent_asin ASC NULLS LAST,
         user_id ASC NULLS LAST, verified_purchase ASC NULLS LAST, helpful_vote ASC NULLS LAST,
         image_count ASC NULLS LAST
LIMIT 10""",
    "bronze_year_histogram": _with(REC) + """
SELECT CAST(year(epoch_ms(ts_ms)) AS INTEGER) AS yr, CAST(count(*) AS BIGINT) AS n
FROM rec GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    "malformed_lines": """
SELECT CAST(count_if(l.l_partkey % 89 = 0) AS BIGINT) AS rejected_lines,
       CAST(count_if(l.l_partkey % 89 <> 0) AS BIGINT) AS loaded_rows
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "load_report": """
SELECT CAST(l.l_linenumber AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS lines,
       CAST(count_if(l.l_partkey % 89 <> 0) AS BIGINT) AS loaded_rows,
       CAST(count_if(l.l_partkey % 89 = 0) AS BIGINT) AS rejected_lines, TRUE AS first_rejected_named
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""",
    "silver_clean": _with(REC, S_CLEAN) + f"SELECT {SILVER_COLS} FROM s_clean",
    "silver_batch_year": _with(REC, _silver_clean_form(
        "s", "rec", f"{STEP_YEAR}-01-01 00:00:00", f"{STEP_YEAR + 1}-01-01 00:00:00", False))
        + f"SELECT {SILVER_COLS} FROM s",
    "silver_upsert": _with(REC, S_UPSERT) + f"SELECT {SILVER_COLS} FROM s_upsert",
    "gold_clean": _with(REC, S_CLEAN) + _gold("s_clean", True, False),
    "gold_upsert": _with(REC, S_UPSERT) + _gold("s_upsert", False, True),
    "gold_touched_products": _with(REC, _YEAR_ROWS) + _gold(
        "s_upto", True, True,
        f"parent_asin IN (SELECT parent_asin FROM s_upto WHERE year(review_ts) = {STEP_YEAR})"),
    "gold_replace_touched": _batch_gold_years(1996, STEP_YEAR + 1),
    "gold_top5": _with(REC, *TWO_WAVES) + f"""
SELECT {GOLD_COLS} FROM gold2 ORDER BY total_reviews DESC, parent_asin ASC NULLS FIRST LIMIT 5""",
    "clean_refresh_gold": _with(REC, S_CLEAN) + _gold("s_clean", True, False),
    "batch_all_years_silver": _with(REC, S_BATCH) + f"SELECT {SILVER_COLS} FROM s_batch",
    "batch_all_years_gold": _batch_gold_years(1996, 2024),
    "batch_reset_2000": _batch_gold_years(2000, 2024),
    "batch_rerun_corrected_year_gold": _with(
        REC, REC_CORRECTED, _silver_clean_form("s", "rec_c", T1996, T2024, False)) + _gold("s", True, True),
    "upsert_two_waves_silver": _with(REC, *TWO_WAVES) + f"SELECT {SILVER_COLS} FROM s2",
    "upsert_two_waves_gold": _with(REC, *TWO_WAVES) + f"SELECT {GOLD_COLS} FROM gold2",
    "upsert_actions": _with(REC, *TWO_WAVES) + """
SELECT action, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CASE
    WHEN t.user_id IS NULL THEN 'insert'
    WHEN s.user_id IS NULL THEN 'keep'
    WHEN t.rating IS DISTINCT FROM s.rating OR t.review_ts IS DISTINCT FROM s.review_ts
      OR t.review_title IS DISTINCT FROM s.review_title OR t.review_text IS DISTINCT FROM s.review_text
      OR t.helpful_vote IS DISTINCT FROM s.helpful_vote
      OR t.verified_purchase IS DISTINCT FROM s.verified_purchase
      OR t.parent_asin IS DISTINCT FROM s.parent_asin OR t.has_images IS DISTINCT FROM s.has_images
    THEN 'update' ELSE 'noop' END AS action
  FROM w1 t FULL OUTER JOIN w2 s ON t.user_id = s.user_id AND t.asin = s.asin
) a GROUP BY action""",
    "upsert_idempotent": _with(REC, *TWO_WAVES) + """
SELECT 'silver_rows_loaded' AS figure, CAST(0 AS BIGINT) AS value
UNION ALL SELECT 'gold_rows_loaded', CAST(count(*) AS BIGINT) FROM g2
UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM s2""",
    "layer_counts": _with(REC, *TWO_WAVES) + """
SELECT 'silver' AS warstwa, CAST(count(*) AS BIGINT) AS wierszy FROM s2
UNION ALL SELECT 'gold', CAST(count(*) AS BIGINT) FROM gold2""",
    "reconcile_counts": _with(REC, S_CLEAN, S_BATCH,
                              f"g_clean AS ({_gold('s_clean', True, False)})",
                              f"g_batch AS ({_gold('s_batch', True, True)})") + """
SELECT 'silver' AS layer, 'batch' AS method, CAST(count(*) AS BIGINT) AS row_count FROM s_batch
UNION ALL SELECT 'silver', 'clean_refresh', CAST(count(*) AS BIGINT) FROM s_clean
UNION ALL SELECT 'gold', 'batch', CAST(count(*) AS BIGINT) FROM g_batch
UNION ALL SELECT 'gold', 'clean_refresh', CAST(count(*) AS BIGINT) FROM g_clean""",
    "reconcile_rows": _with(REC, S_CLEAN, S_BATCH,
                            f"a AS ({_gold('s_batch', True, True)})",
                            f"b AS ({_gold('s_clean', True, False)})") + """
SELECT * FROM (
  SELECT COALESCE(a.parent_asin, b.parent_asin) AS parent_asin,
    CASE WHEN b.total_reviews IS NULL THEN 'only_batch'
         WHEN a.total_reviews IS NULL THEN 'only_clean_refresh'
         ELSE 'differs' END AS status,
    CASE WHEN a.total_reviews IS NULL OR b.total_reviews IS NULL THEN '' ELSE concat_ws(',',
      CASE WHEN a.avg_rating IS DISTINCT FROM b.avg_rating THEN 'avg_rating' END,
      CASE WHEN a.total_reviews IS DISTINCT FROM b.total_reviews THEN 'total_reviews' END,
      CASE WHEN a.verified_count IS DISTINCT FROM b.verified_count THEN 'verified_count' END,
      CASE WHEN a.unverified_count IS DISTINCT FROM b.unverified_count THEN 'unverified_count' END,
      CASE WHEN a.helpful_votes_sum IS DISTINCT FROM b.helpful_votes_sum THEN 'helpful_votes_sum' END,
      CASE WHEN a.reviews_with_images IS DISTINCT FROM b.reviews_with_images THEN 'reviews_with_images' END,
      CASE WHEN a.latest_review_ts IS DISTINCT FROM b.latest_review_ts THEN 'latest_review_ts' END,
      CASE WHEN a.earliest_review_ts IS DISTINCT FROM b.earliest_review_ts THEN 'earliest_review_ts' END
    ) END AS differing_columns
  FROM a FULL OUTER JOIN b ON a.parent_asin IS NOT DISTINCT FROM b.parent_asin
) d WHERE status <> 'differs' OR differing_columns <> ''""",
    "reconcile_silver_rows": _with(REC, S_CLEAN, S_BATCH) + f"""
SELECT {SILVER_COLS},
       CASE WHEN na > nb THEN 'only_batch' ELSE 'only_clean_refresh' END AS side,
       CAST(abs(na - nb) AS BIGINT) AS copies
FROM (
  SELECT {SILVER_COLS}, sum(a) AS na, sum(b) AS nb FROM (
    SELECT {SILVER_COLS}, 1 AS a, 0 AS b FROM s_batch
    UNION ALL
    SELECT {SILVER_COLS}, 0 AS a, 1 AS b FROM s_clean
  ) u GROUP BY ALL
) c WHERE na <> nb""",
    "reconcile_shifted_nulls": _with(REC, S_CLEAN) + """
SELECT asin, parent_asin, CASE WHEN na > nb THEN 'only_table' ELSE 'only_copy' END AS side,
       CAST(abs(na - nb) AS BIGINT) AS copies
FROM (
  SELECT asin, parent_asin, sum(a) AS na, sum(b) AS nb FROM (
    SELECT asin, parent_asin, 1 AS a, 0 AS b FROM s_clean
    UNION ALL
    SELECT CASE WHEN asin IS NULL OR parent_asin IS NULL THEN parent_asin ELSE asin END,
           CASE WHEN asin IS NULL OR parent_asin IS NULL THEN asin ELSE parent_asin END, 0, 1 FROM s_clean
  ) u GROUP BY ALL
) c WHERE na <> nb""",
    "runs_by_state": """
SELECT 'clean_refresh' AS method, 'SUCCEEDED' AS state, CAST(1 AS BIGINT) AS runs
UNION ALL SELECT 'clean_refresh', 'FAILED', 1 UNION ALL SELECT 'batch', 'SUCCEEDED', 28
UNION ALL SELECT 'upsert', 'SUCCEEDED', 2""",
    "cut_values": _with(REC, S_CLEAN) + f"""
SELECT 'clean_refresh' AS method, CAST(count_if(asin IS NOT NULL AND pk % 90 = 3) AS BIGINT) AS cut_asin,
       CAST(count_if(parent_asin IS NOT NULL AND pk % 60 = 7) AS BIGINT) AS cut_parent_asin,
       CAST(count_if(pk % 70 = 9) AS BIGINT) AS cut_user_id, CAST(count_if(pk % 50 = 0) AS BIGINT) AS cut_review_title
FROM rec
WHERE (asin IS NOT NULL OR asin_json_null) AND rating BETWEEN 1.0 AND 5.0 AND length(text) > 0
  AND epoch_ms(ts_ms) >= TIMESTAMP '{T1996}' AND epoch_ms(ts_ms) <= TIMESTAMP '{T2024}'""",
    "run_metrics_counts": RUNS_WITH + RUN_COUNTS,
    "run_metrics_union": RUN_TABLE + f"SELECT {SHARED} FROM runs ORDER BY run_timestamp DESC, run_id DESC",
    "kpi_per_batch": RUN_TABLE + """
SELECT batch_id, silver_rows_loaded, gold_rows_loaded, duration_sec, credits_used
FROM runs WHERE method = 'batch' ORDER BY batch_id""",
    "kpi_totals": RUN_TABLE + """
SELECT method, CAST(count(*) AS BIGINT) AS num_batches, CAST(sum(silver_rows_loaded) AS BIGINT) AS total_silver_rows,
       sum(duration_sec) AS total_duration_sec, CAST(round(sum(credits_used), 6) AS DOUBLE) AS est_credits
FROM runs WHERE method = 'batch' GROUP BY method""",
    "kpi_latest": RUN_TABLE + """
SELECT bronze_row_count AS "Wiersze Bronze", silver_rows_loaded AS "Zapisy do Silver (Insert/Update)",
       gold_rows_loaded AS "Zapisy do Gold (Insert/Update)", duration_sec AS "Czas trwania (s)"
FROM runs WHERE run_id = 'upsert-002'""",
    "latest_run_time": RUN_TABLE + """
SELECT run_timestamp, duration_sec AS "Czas pracy warehouse (s)" FROM runs WHERE run_id = 'upsert-002'""",
    "latest_runs": RUN_TABLE + """
SELECT run_id, run_timestamp, method, batch_id, bronze_row_count, silver_rows_loaded, silver_rows_deleted,
       gold_rows_loaded, duration_sec, credits_used FROM runs WHERE method = 'upsert' ORDER BY run_timestamp DESC""",
    "cost_report": RUN_TABLE + """
SELECT run_timestamp, method, batch_id, duration_sec AS "Czas pracy warehouse (s)", credits_used,
       credits_used * 2 AS "Szac. koszt (USD)*" FROM runs""",
    "recent_runs_summary": RUN_TABLE + f"""
SELECT min(run_timestamp) AS first_run_timestamp, CAST(count(*) AS BIGINT) AS runs,
       CAST(round(sum(credits_used), 4) AS DOUBLE) AS credits_used
FROM runs WHERE run_timestamp >= TIMESTAMP '{CLOCK_START}' + INTERVAL 3611 SECOND - INTERVAL 1 HOUR""",
    "job_history": RUNS_WITH + BATCH_WRITES + """
SELECT query, 'method=batch' AS query_tag, 'SUCCEEDED' AS state, CAST(rows_written AS BIGINT) AS rows_written
FROM statements""",
    "merge_history": RUN_TABLE + """
SELECT 'MERGE INTO silver (changed rows)' AS query, 'method=upsert' AS query_tag, 'SUCCEEDED' AS state,
       silver_rows_loaded AS rows_written FROM runs WHERE run_id = 'upsert-002'""",
    "file_listing": """
SELECT CAST(count(*) AS BIGINT) AS lines, TRUE AS files_listed, TRUE AS all_sized, TRUE AS all_dated
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "bronze_preview": _with(REC) + """
SELECT rating, title AS review_title, ts_ms AS ts_unix, TIMESTAMP '2024-06-30 00:00:00' AS load_timestamp
FROM rec ORDER BY ts_unix DESC NULLS LAST, rating NULLS LAST, review_title NULLS LAST LIMIT 5""",
    "load_stamp": RUNS_WITH + f"""
SELECT 'bronze' AS tbl, TIMESTAMP '2024-06-30 00:00:00' AS stamp, CAST(count(*) AS BIGINT) AS n FROM rec
UNION ALL SELECT 'silver', TIMESTAMP '{CLOCK_START}', CAST(count(*) AS BIGINT) FROM s_clean
UNION ALL SELECT 'gold', TIMESTAMP '{CLOCK_START}', CAST(count(*) AS BIGINT) FROM g_clean""",
}
