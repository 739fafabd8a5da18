"""The ``opN_<name>`` queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    best_fit,
    chat_parse,
    collocations,
    decontaminate,
    edit_counts,
    language,
    neighbours,
    page_text,
    resample,
    simhash,
    token_files,
    topk_search,
    url_filter,
)
from .common import read, ship

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: The rules of op9, host/path and verdict.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.edit_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE, added_tokens=True)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), every=50, top=5)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(read(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_parse.format_chats(read(spark, sf_dir, "conversations"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(read(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, added_tokens=True)


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit(read(spark, sf_dir, "documents"), WORD_BPE, end_id=0, added_tokens=True)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(read(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read(spark, sf_dir, "embeddings"), every=50, top=5)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q) for q in (
        op1_decontamination, op2_edit_counts, op3_neighbours, op4_language, op5_chat_format,
        op6_simhash, op7_token_files, op8_best_fit, op9_url_filter, op10_page_text,
        op11_collocations, op12_topk_search, op13_resample)}

_FOLDED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) x WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS span
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM items) i),
places AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM items) l WHERE len(w) >= n) d),
hits AS (SELECT p.doc_id, p.s, p.n, v.item_id FROM places p JOIN windows v ON p.n = v.n AND p.span = v.span),
hit_words AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS word_no FROM (SELECT DISTINCT doc_id, s, n FROM hits) h) x GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) y GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
phrases AS (
  SELECT lang, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS phrase, list_slice(w, s, s + k - 1) AS ws
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM runs, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k) p),
f AS (SELECT lang, phrase, k, ws, count(*) AS f FROM phrases GROUP BY lang, phrase, k, ws),
cand AS (SELECT lang, phrase, k, ws, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, k, a, c, array_to_string(list_slice(ws, 1, c), ' ') AS p1, array_to_string(list_slice(ws, c + 1, k), ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand) x),
cut_scores AS (
  SELECT x.lang, x.phrase, x.k, a, c, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.p1 JOIN f r ON r.lang = x.lang AND r.phrase = x.p2),
lowest AS (SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(list_slice(ws, s, s + 1), ' ') AS phrase, max(a) AS over_f
  FROM (SELECT *, unnest([1, 2]) AS s FROM cand WHERE k = 3) x GROUP BY 1, 2),
kept AS (
  SELECT z.* FROM lowest z LEFT JOIN inner_phrases i ON i.lang = z.lang AND i.phrase = z.phrase AND z.k = 2
  WHERE i.over_f IS NULL OR 100 * i.over_f < 50 * z.a),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op12_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5""",
    "op13_resample": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word FROM d),
target AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
spelled AS (
  SELECT word, lower(hex(encode(word))) AS h
  FROM (SELECT word FROM words UNION SELECT word FROM target) x),
-- CRC-32 a bit at a time, the low bits of a byte first; 3988292384 is its fixed polynomial.
bits AS (
  SELECT word, list_transform(range(0, 4 * len(h)), lambda i: (CAST(
    strpos('0123456789abcdef', substr(h, CAST(2 * (i // 8) + (CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END) AS BIGINT), 1)) AS BIGINT) - 1
    >> CAST(i % 4 AS BIGINT)) & 1) AS b FROM spelled),
bucket AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))), CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM bits),
s AS (SELECT bucket, count(*) AS s FROM words JOIN bucket USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN bucket USING (word) GROUP BY bucket),
all_of AS (SELECT (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) FROM s) AS s_all, (SELECT CAST(coalesce(sum(t), 0) AS DOUBLE) FROM t) AS t_all),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (s_all + 10000)
                            / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), all_of),
weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
draw AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN draw USING (doc_id)""",
}
