"""Importance resampling towards a target: hashed n-gram features, Gumbel top-k.

A text is lower-cased (A-Z) and split into words by Arrow kernels, all words
of a batch are dictionary-encoded, and a run of words is named by the pair
(run one shorter, last word): shifted dictionary indices.  A CRC is computed
once for each distinct word or pair of a batch; its remainder is the feature's
bucket.  The documents' and the target's bucket counts give each bucket a
gain, floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))); a document's weight is the
sum of its features' gains, taken by bucket and reduced by segment.  Gumbel
noise from a hash of its id is added, and the highest scores are drawn.

Two passes read the texts; between them goes one number for each bucket.  The
draw sorts (score, doc_id) by ranges and counts ranges, so equal scores or ids
may be many.

Defined results.  Null text: no words, weight 0.  Null doc_id: hashed as the
empty string, last among ties.  Repeated rows: each takes part, with one score.
No documents: no row; no target texts: gains as of T = 0.  Other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import copied, numbered, slices, stored

#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000


def text_features(texts: pa.Array, shortest: int, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the text it is of, and each text's words."""
    cut = pc.split_pattern_regex(pc.ascii_lower(copied(texts)), GAP)
    coded = pc.list_flatten(cut).dictionary_encode()
    word = [w.encode() for w in coded.dictionary.to_pylist()]
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    real = np.fromiter(map(bool, word), bool, len(word))[code]  # a gap at an end leaves an empty word
    code, owner = code[real], owner[real]
    n_words = np.bincount(owner, minlength=len(texts))
    found, owners = [], []
    run, at = code, np.arange(len(code))
    crc = np.fromiter(map(zlib.crc32, word), np.int64, len(word))
    for n in range(1, longest + 1):
        if n > 1:
            # A run of n at p: the run of n - 1 there and the word n - 1 places on, in one text.
            ok = at + n - 1 < len(code)
            ok[ok] = owner[at[ok]] == owner[at[ok] + n - 1]
            at = at[ok]
            pairs, run = np.unique(run[ok] * len(word) + code[at + n - 1], return_inverse=True)
            ahead, last = np.divmod(pairs, max(1, len(word)))
            crc = np.fromiter((zlib.crc32(b" " + word[w], c) for c, w in zip(crc[ahead].tolist(), last.tolist())),
                              np.int64, len(pairs))
        if n >= shortest:
            found.append((crc % buckets)[run] if len(run) else run)
            owners.append(owner[at])
    return np.concatenate(found), np.concatenate(owners), n_words


def bucket_counts(docs: DataFrame, shortest: int, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket: summed in the tasks, then by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            total += np.bincount(text_features(batch.column(0), shortest, longest, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at])})

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # one row a bucket at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight."""
    b, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in slices(batches):
            bucket, owner, n_words = text_features(batch.column(1), shortest, longest, len(gain))
            order = np.argsort(owner, kind="stable") if longest > shortest else slice(None)
            n = np.bincount(owner, minlength=batch.num_rows)
            run = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
            end = np.cumsum(n)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_words": pa.array(n_words, pa.int64()),
                "n_features": pa.array(n, pa.int64()), "weight": pa.array(run[end] - run[end - n], pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
             percent: int = 10, min_words: int = 20, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every row of ``docs``.

    Of the N documents with ``min_words`` words or more, floor(``percent`` N / 100) are drawn.
    """
    if not 1 <= shortest <= longest:
        raise ValueError("features are runs of 1 word or more")
    gain = gains(bucket_counts(docs, shortest, longest, buckets), bucket_counts(target, shortest, longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weights(docs, gain, shortest, longest).withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    ranked = numbered(scored.filter(able), [F.desc("score"), F.asc_nulls_last("doc_id")], "place", "draw")
    out = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    return (ranked.select(*out, rank.alias("rank"))
            .unionByName(scored.filter(~able).select(*out, F.lit(None).cast("long").alias("rank"))))
