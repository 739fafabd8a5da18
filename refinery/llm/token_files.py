"""Token ids in files: one zstandard dictionary, one frame per document.

A file (*shard*) holds a run of documents in id order:

    magic ``RTOK``, version u32, dictionary hash 32 bytes (sha256),
    document count u64,
    index: per document id i64, id present u8, frame offset u64, token count u64,
    frames.

All integers are little-endian.  A frame is the zstandard frame of the
document's ids as unsigned 32-bit integers; any document is read on its own
through the index.  The dictionary is trained on the serialized ids of a
sample of at most ``DICT_DOCS`` documents and kept beside the shards.

Documents are encoded and compressed where they are read; their frames, not
their texts, are then dealt by ranges of (doc_id, hash of the text) and put
together.  So an id with very many rows fills as many ranges as it needs.

Shards are rows (shard, content) of a Parquet table, so that Spark's commit
protocol holds for them, on any file system that Spark can write to, and a
lost executor leaves no half file.

Defined results.  Null or empty text: a document with only the end id.  Null
doc_id: first in order.  Repeated rows: each is a document of its own; rows of
one id stand in the order of their texts' hashes.  Empty table: no shard, no
row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, new_folder, slices, stored
from .tokens import encoder

#: The dictionary: documents and bytes per document it is trained on, its size.
DICT_DOCS = 1_000
DICT_DOC_BYTES = 32_768
DICT_BYTES = 65_536
#: Bytes of frames in a shard, beyond which the next document starts another.
SHARD_BYTES = 4 << 20
#: Frame bytes for each partition of the sort.
SORT_BYTES = 256 << 20

MAGIC = b"RTOK"
_HEAD = struct.Struct("<4sI32sQ")
_INDEX = np.dtype([("doc_id", "<i8"), ("present", "u1"), ("offset", "<u8"), ("n_tokens", "<u8")])


def encode_documents(texts: pa.Array, vocabulary: str, end_id: int, added_tokens: bool = False) -> list[memoryview]:
    """The bytes of each text's ids, ``end_id`` last.  Null is empty."""
    ids, at = encoder(vocabulary, True, added_tokens).encode(texts.fill_null(""))
    n = np.arange(len(at) - 1)
    out = np.empty(len(ids) + len(n), "<u4")
    ends = at[1:] + n
    out[ends] = end_id
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = ids
    held, to = memoryview(out).cast("B"), (4 * (ends + 1)).tolist()
    return [held[a:b] for a, b in zip([0, *to[:-1]], to)]


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, added_tokens: bool = False) -> bytes:
    """A dictionary from the documents of smallest hash; empty if there are too few.

    The sample is encoded in tasks, and at most ``DICT_DOC_BYTES`` of each
    document come to the driver.
    """
    def clipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            parts = [x[:DICT_DOC_BYTES].tobytes() for x in encode_documents(batch.column(1), vocabulary, end_id, added_tokens)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], ["doc_id", "part"])

    sample = hash_sample(docs, ["doc_id"], DICT_DOCS).select("doc_id", "text")
    parts = [r[1] for r in sample.mapInArrow(clipped, "doc_id long, part binary").orderBy("doc_id", "part").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, [bytes(x) for x in parts]).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=_dict(dictionary))


def _dict(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def shard_bytes(rows: list[tuple[int | None, int, bytes]], dictionary: bytes) -> bytes:
    """A shard's bytes from (doc_id, token count, frame)."""
    index = np.zeros(len(rows), _INDEX)
    sizes = np.fromiter((len(r[2]) for r in rows), np.uint64, len(rows))
    index["offset"] = np.cumsum(sizes) - sizes
    index["n_tokens"] = [r[1] for r in rows]
    index["present"] = [r[0] is not None for r in rows]
    index["doc_id"] = [r[0] or 0 for r in rows]
    head = _HEAD.pack(MAGIC, 1, hashlib.sha256(dictionary).digest(), len(rows))
    return b"".join([head, index.tobytes(), *(r[2] for r in rows)])


class Shard:
    """Reader of one shard's bytes; ``ids(i)`` touches only that document."""

    def __init__(self, content: bytes, dictionary: bytes):
        magic, version, digest, n = _HEAD.unpack_from(content)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        self.index = np.frombuffer(content, _INDEX, n, _HEAD.size)
        self.frames = memoryview(content)[_HEAD.size + n * _INDEX.itemsize:]
        self.ends = np.append(self.index["offset"][1:], len(self.frames)).astype(np.int64)
        self.reader = zstandard.ZstdDecompressor(dict_data=_dict(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, i: int) -> int | None:
        return int(self.index["doc_id"][i]) if self.index["present"][i] else None

    def raw(self, i: int) -> bytes:
        return self.reader.decompress(self.frames[int(self.index["offset"][i]):self.ends[i]],
                                      max_output_size=4 * int(self.index["n_tokens"][i]))

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), "<u4")


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int, added_tokens: bool = False) -> None:
    """Encode (doc_id, text), in ascending doc_id order, into shards at ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, vocabulary, end_id, added_tokens)
    spark.createDataFrame([(dictionary,)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def frames_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = _compressor(dictionary).compress
        for batch in slices(batches, 2048):
            found = encode_documents(batch.column(1), vocabulary, end_id, added_tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(x) // 4 for x in found], pa.int64()),
                 pa.array([compress(x) for x in found], pa.binary())], ["doc_id", "mark", "n_tokens", "frame"])

    marked = docs.withColumn("mark", F.xxhash64("text"))
    frames = stored(marked.mapInArrow(frames_of, "doc_id long, mark long, n_tokens long, frame binary"), "frames", "none")
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SORT_BYTES + 1)
    ordered = frames.repartitionByRange(parts, "doc_id", "mark").sortWithinPartitions("doc_id", "mark")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows: list[tuple[int | None, int, bytes]] = []
        held = number = 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()),
                 "content": pa.array([shard_bytes(rows, dictionary)], pa.binary())})

        for batch in slices(batches, 1024):
            for doc_id, n, frame in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                rows.append((doc_id, n, frame))
                held += len(frame)
                if held >= SHARD_BYTES:
                    yield shard()
                    rows, held, number = [], 0, number + 1
        if rows:
            yield shard()

    (ordered.mapInArrow(write, "part long, number long, content binary")
     .write.option("compression", "none").parquet(f"{path}/shards"))


def token_count(content: bytes) -> int:
    """All tokens of a shard, from its index."""
    n = _HEAD.unpack_from(content)[3]
    return int(np.frombuffer(content, _INDEX, n, _HEAD.size)["n_tokens"].sum())


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the token counts of the shards before to the place in the
    shard; only one row per shard is brought together for it.
    """
    found = spark.read.schema("dictionary binary").parquet(f"{path}/dictionary").first()
    dictionary = bytes(found[0]) if found else b""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            shard = Shard(batch.column(2)[0].as_py(), dictionary)
            count = shard.index["n_tokens"].astype(np.int64)
            crc = [zlib.crc32(shard.raw(i)) for i in range(len(shard))]
            n = len(shard)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([shard.doc_id(i) for i in range(n)], pa.int64()),
                "inside": pa.array(np.cumsum(count) - count),
                "n_tokens": pa.array(count), "ids_crc32": pa.array(crc, pa.int64()),
                "part": pa.array([batch.column(0)[0].as_py()] * n, pa.int64()),
                "number": pa.array([batch.column(1)[0].as_py()] * n, pa.int64())})

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            total = token_count(batch.column(2)[0].as_py())
            yield pa.RecordBatch.from_pydict({
                "part": batch.column(0), "number": batch.column(1), "total": pa.array([total], pa.int64())})

    shards = spark.read.schema("part long, number long, content binary").parquet(f"{path}/shards")
    return _with_starts(shards.mapInArrow(
        parse, "doc_id long, inside long, n_tokens long, ids_crc32 long, part long, number long"),
        shards.mapInArrow(totals, "part long, number long, total long"))


def _with_starts(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds each shard's start.  Shards of a part are summed within the part,
    the parts (as many as sort partitions) by one task."""
    from pyspark.sql import Window as W

    before = W.rowsBetween(W.unboundedPreceding, -1)
    parts = (totals.groupBy("part").agg(F.sum("total").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(
                 before.orderBy("part")), F.lit(0)).alias("part_start")))
    in_part = totals.select("part", "number", F.coalesce(F.sum("total").over(
        before.partitionBy("part").orderBy("number")), F.lit(0)).alias("shard_start"))
    starts = in_part.join(parts, "part").select(
        "part", "number", (F.col("part_start") + F.col("shard_start")).alias("shard_start"))
    return rows.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None,
                added_tokens: bool = False) -> DataFrame:
    """Write ``docs`` (doc_id, text) to shards and return what the files hold."""
    path = path or new_folder(docs.sparkSession, "token-files")
    write_shards(docs, path, vocabulary, end_id, added_tokens)
    return read_shards(docs.sparkSession, path)
