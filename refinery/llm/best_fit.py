"""Best-fit packing planned on counts of lengths.

Documents are encoded and cut into pieces of at most ``capacity`` tokens.  The
planner sees only how many pieces have each length: it goes from the longest
to the shortest and puts as many pieces at once as fit into the open sequences
with the least room that is still enough.  A plan row says that the pieces of
one length whose ranks lie in a range go to sequences of consecutive numbers,
at one offset.  Pieces get their slot by a join on length and rank.  The plan's
size depends on ``capacity`` alone, apart from the splitting of long ranges.

Defined results.  Null or empty text: one piece with only the end id.  Null or
repeated doc_id: every row is a document of its own.  Ties of length: any
order, no two pieces share a slot.  Empty table: no row.  Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stored
from .tokens import encoder

CAPACITY = 2048
#: Ranks of one block: plan ranges are split at its multiples, the join is on length and block.
RANK_BLOCK = 4096
#: Ranks are counted within hash groups of a length, so that no task sorts a whole length.
RANK_GROUPS = 64

PIECES = "row long, doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
           with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32[, ids binary]) of (doc_id, text).

    ``row`` tells rows of one doc_id apart.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        for batch in slices(batches, 1024):
            ids, at = encoder(vocabulary, False, added_tokens).encode(batch.column(2).fill_null(""))
            ids = ids.astype("<u4", copy=False)
            out: dict[str, list] = {k: [] for k in ("row", "doc_id", "piece", "start", "length", "crc", "ids")}
            for row, doc_id, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         at[:-1].tolist(), at[1:].tolist()):
                own = np.concatenate((ids[a:b], end))
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start:start + capacity].tobytes()
                    out["row"].append(row)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["crc"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            arrays = [pa.array(out["row"], pa.int64()), pa.array(out["doc_id"], pa.int64()),
                      pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                      pa.array(out["length"], pa.int32()), pa.array(out["crc"], pa.int64())]
            names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(out["ids"], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, count, first sequence, offset).

    Sequences with the same room are kept as ranges of numbers.  A piece goes
    to the least room that holds it, only if there is none to a new sequence;
    the next piece of its length then finds the least room in that same
    sequence while it fits.  So a range is filled in layers, one for each
    piece that a sequence takes.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, count)
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, n: int, room: int, each: int) -> None:
            nonlocal left, rank
            for k in range(each):
                rows.append((length, rank, n, first, capacity - room + k * length))
                rank += n
            left -= n * each
            if room > each * length:
                open_[room - each * length].append((first, n))

        def use(first: int, n: int, room: int) -> None:
            """Fill what is needed of the ``n`` sequences from ``first``, the last one maybe in part."""
            each = room // length
            full = min(n, left // each)
            if full:
                fill(first, full, room, each)
            if full < n and left:
                fill(first + full, 1, room, left)
                full += 1
            if full < n:
                open_[room].append((first + full, n - full))

        for room in range(length, capacity + 1):
            while left and open_.get(room):
                use(*open_[room].pop(), room)
        if left:
            n = -(-left // (capacity // length))
            use(sequences, n, capacity)
            sequences += n
    return rows


def _blocks(rows: list[tuple[int, int, int, int, int]], block: int) -> list[tuple[int, ...]]:
    """Plan ranges with the first and last rank block that they touch."""
    return [(length, rank // block, (rank + n - 1) // block, rank, n, first, offset)
            for length, rank, n, first, offset in rows]


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``found``, the stored pieces.

    Only the histogram (at most ``capacity`` rows) comes to the driver.
    """
    spark = found.sparkSession
    group = F.pmod(F.xxhash64("row", "piece"), F.lit(RANK_GROUPS)).cast("int")
    grouped = found.withColumn("g", group)
    counts = grouped.groupBy("length", "g").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "g", F.coalesce(F.sum("n").over(
        W.partitionBy("length").orderBy("g").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    ranked = (grouped.withColumn("r", F.row_number().over(W.partitionBy("length", "g").orderBy("row", "piece")) - 1)
              .join(before, ["length", "g"])
              .withColumn("rank", F.col("before") + F.col("r"))
              .withColumn("block", F.floor(F.col("rank") / RANK_BLOCK)))
    ranges = _blocks(plan(histogram, capacity), RANK_BLOCK)
    slots = (spark.createDataFrame(
        ranges, "length int, b0 long, b1 long, rank0 long, n long, sequence0 long, offset long")
        .repartition("length", "rank0")
        .select("*", F.explode(F.sequence("b0", "b1")).alias("block")).drop("b0", "b1"))
    inside = ranked["rank"] - slots["rank0"]
    return (ranked.join(slots, ["length", "block"]).filter((inside >= 0) & (inside < slots["n"]))
            .select("row", "doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence0") + inside).alias("sequence_id"), "offset"))


def best_fit(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
             added_tokens: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with the place that each has in its sequence.

    Encoded once: the pieces, without their ids, are stored in the shared folder.
    """
    found = stored(pieces(docs, vocabulary, end_id, capacity, added_tokens=added_tokens), "pieces")
    return pack(found, capacity).drop("row")


def sequences(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
              added_tokens: bool = False) -> DataFrame:
    """(sequence_id, n_tokens, ids binary): the packed sequences themselves."""
    found = stored(pieces(docs, vocabulary, end_id, capacity, with_ids=True, added_tokens=added_tokens), "pieces")
    placed = pack(found.drop("ids"), capacity).select("row", "piece", "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (found.join(placed, ["row", "piece"]).groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(0), lambda n, x: n + x["length"]).alias("n_tokens"),
                    F.aggregate("parts", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids")))
