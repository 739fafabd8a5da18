"""Benchmark decontamination by winnowing.

A k-gram of words has a hash; of every ``w`` consecutive k-grams the one of
smallest hash (the last, on ties) is kept.  Two texts that share a span of
``w + k - 1`` words keep the same k-gram of it, so benchmark windows of that
many words are all found from the kept hashes.  Kept hashes of documents are
joined with those of the benchmark; a hit is extended to every window of words
around it, which must equal a benchmark window word for word.

The benchmark's index is sent to the tasks while it has at most
``INDEX_WORDS`` words.  Beyond that the same steps run as Spark joins: kept
hashes pass a bitmap of fixed size, the windows around them are shuffled
and joined with the benchmark's windows.

Defined results.  Null text: no words, no hit.  Items without words, or null:
no windows.  Null item_id: its windows count as hits, but it is in no list.
Repeated item_ids count once; repeated documents each get a row.  Empty tables:
no rows, or nobody hit.  Other columns are ignored by the report and kept by
``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

#: Words of a benchmark window, and of a k-gram at most.
WINDOW = 10
K = 5
#: Benchmark words up to which its index is sent to the tasks, about 400 bytes each.
INDEX_WORDS = 200_000
#: Bits of the bitmap through which kept hashes pass before a shuffle.
BITMAP_BITS = 22

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in _SEPARATORS else c for c in range(256))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

REPORT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
          "contaminated boolean")


def words(text: bytes | None) -> list[bytes]:
    """Runs of letters a-z, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) or 1


def shape(length: int) -> tuple[int, int]:
    """(k, w) for windows of ``length`` words: w + k - 1 = length."""
    k = min(K, length)
    return k, length - k + 1


def kgrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams; no k-gram with a word of hash 0 can match, its hash is the largest."""
    n = len(hashes) - k + 1
    out = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for j in range(k):
        part = hashes[j:j + n]
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        known &= part != 0
    out[~known] = _NONE
    return out


def winnow(hashes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept k-grams."""
    if len(hashes) < k + w - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = kgrams(hashes, k)
    if w > 1:
        view = np.lib.stride_tricks.sliding_window_view(grams, w)
        at = np.unique(np.arange(len(view)) + (w - 1 - view[:, ::-1].argmin(axis=1)))
    else:
        at = np.arange(len(grams))
    at = at[grams[at] != _NONE]
    return at, grams[at]


def item_windows(text: bytes | None, window: int) -> list[bytes]:
    """The windows of an item, as space-joined words."""
    w = words(text)
    n = min(window, len(w))
    return [b" ".join(w[s:s + n]) for s in range(len(w) - n + 1)] if n else []


class Index:
    """The benchmark's words, kept hashes by window length, and windows."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.vocabulary: dict[bytes, int] = {}
        kept: dict[int, set[int]] = {}
        for item, text in items:
            w = words(text)
            if not w:
                continue
            length = min(window, len(w))
            hashes = np.fromiter((self.vocabulary.setdefault(x, word_hash(x)) for x in w), np.uint64, len(w))
            kept.setdefault(length, set()).update(winnow(hashes, *shape(length))[1].tolist())
            for span in item_windows(text, window):
                have = self.windows.get(span, ())
                if item is not None and item not in have:
                    have = (*have, item)
                self.windows[span] = have
        self.kept = {n: np.array(sorted(v), np.uint64) for n, v in kept.items()}

    def search(self, text: bytes | None) -> tuple[int, int, set[int]]:
        """(words, words hit, items) of a document."""
        w = words(text)
        n = len(w)
        if not n:
            return 0, 0, set()
        hashes = np.fromiter(map(self.vocabulary.get, w, repeat(0)), np.uint64, n)
        if not hashes.any():
            return n, 0, set()
        hit, items = np.zeros(n, bool), set()
        for length, kept in self.kept.items():
            k, width = shape(length)
            at, grams = winnow(hashes, k, width)
            if not len(at):
                continue
            place = np.searchsorted(kept, grams)
            place[place == len(kept)] = 0
            at = at[kept[place] == grams]
            if not len(at):
                continue
            starts = np.unique(at[:, None] - np.arange(width))
            for s in starts[(starts >= 0) & (starts <= n - length)].tolist():
                found = self.windows.get(b" ".join(w[s:s + length]))
                if found is not None:
                    hit[s:s + length] = True
                    items.update(found)
        return n, int(hit.sum()), items


def items_digest(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _index(benchmark: DataFrame, window: int) -> Index | None:
    """The index, if the benchmark has few enough words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > INDEX_WORDS * 12:
        return None
    rows = [(r[0], bytes(r[1]) if r[1] is not None else None) for r in items.collect()]
    if sum(len(words(t)) for _, t in rows) > INDEX_WORDS:
        return None
    return Index(rows, window)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, words hit, items found."""
    index = _index(benchmark, window)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    if index is None:
        return _joined_report(docs, benchmark, window).drop("key")
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shared.value.search(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([len(f[2]) for f in found], pa.int64()),
                 pa.array([items_digest(f[2]) for f in found], pa.string()),
                 pa.array([f[1] > 0 for f in found], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return docs.mapInArrow(search, REPORT)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs``, all columns, without the documents that hold a benchmark window."""
    index = _index(benchmark, window)
    if index is None:
        hit = (_joined_report(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                          F.col("text").cast("binary").alias("text")), benchmark, window)
               .filter("contaminated").select("key").distinct())
        own = _key(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
        return docs.join(hit, own == hit["key"], "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([shared.value.search(t)[1] == 0 for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def _key(doc_id: Column, text: Column) -> Column:
    """Tells documents apart: rows equal in doc_id, null or not, and text have one key."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.sha2(text, 256))


def _joined_report(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """The report by Spark joins, for a benchmark of any size, and each row's ``key``.

    Documents are told apart by doc_id and the hash of their text; rows equal
    in both share their result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))

    def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple[int | None, int, int, bytes]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                length = min(window, len(w))
                if length:
                    hashes = np.fromiter(map(word_hash, w), np.uint64, len(w))
                    out += [(None, length, int(x >> np.uint64(64 - BITMAP_BITS)), b"")
                            for x in winnow(hashes, *shape(length))[1]]
                    out += [(item, length, -1, span) for span in item_windows(text, window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in
                 enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                ["item_id", "length", "bucket", "span"])

    found = stored(items.mapInArrow(item_rows, "item_id long, length int, bucket long, span binary"), "windows")
    # Tasks merge the buckets to bits: a row of 2^15 bits, 2^(BITMAP_BITS - 15) rows a length at most.
    chunks = (found.filter("bucket >= 0").groupBy("length", F.shiftright("bucket", 15).alias("chunk"))
              .agg(F.bitmap_construct_agg(F.col("bucket").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect())
    bitmap = {}
    for length, chunk, bits in chunks:
        whole = bitmap.setdefault(length, np.zeros(1 << BITMAP_BITS, bool))
        part = whole[chunk << 15:(chunk + 1) << 15]
        part[:] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:len(part)].astype(bool)
    shared = spark.sparkContext.broadcast(bitmap)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: list[tuple[int, int, int, bytes]] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                hashes = np.fromiter(map(word_hash, w), np.uint64, len(w))
                for length, bits in shared.value.items():
                    at, grams = winnow(hashes, *shape(length))
                    at = at[bits[(grams >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)]]
                    starts = np.unique(at[:, None] - np.arange(shape(length)[1]))
                    out += [(key, length, s, b" ".join(w[s:s + length]))
                            for s in starts[(starts >= 0) & (starts <= len(w) - length)].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in
                 enumerate((pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                ["key", "length", "s", "span"])

    key = _key(F.col("doc_id"), F.col("text")).alias("key")
    spans = found.filter("bucket < 0").groupBy("length", "span").agg(F.collect_set("item_id").alias("items"))
    hits = (docs.filter("text is not null").select(key, "text").mapInArrow(
        candidates, "key string, length int, s long, span binary").distinct().join(spans, ["length", "span"]))
    n_hit = (hits.select("key", F.explode(F.sequence("s", F.col("s") + F.col("length") - 1)).alias("at"))
             .distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit")))
    per_doc = (hits.select("key", F.explode("items").alias("item")).distinct().groupBy("key")
               .agg(F.array_sort(F.collect_list(F.col("item").cast("string"))).alias("items")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = [len(words(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                                             ["key", "doc_id", "n_words"])

    rows = docs.select(key, "doc_id", "text").mapInArrow(count, "key string, doc_id long, n_words long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (rows.join(n_hit, "key", "left").join(per_doc, "key", "left")
            .select("key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.size(listed).cast("long").alias("n_items"),
                    F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
