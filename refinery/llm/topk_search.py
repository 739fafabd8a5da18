"""Exact top-k by integer inner product, block-at-a-time.

Rows are put in an order in which alike rows are near (their largest
components, then vec_id) and cut into *blocks*, ranges of ``BLOCK`` rows.  A
block keeps a forward index, the matrix of its rows, and for each term the
largest and the smallest component; a term here is a component with its sign.
A query's bound on a block is the sum over its terms of query component times
that extreme.  The query takes the blocks by falling bound, scores their
forward indexes, and stops when the next bound is below its k-th score.

On Spark: a query first scores its own block, which gives a k-th score to
start from.  Groups of ``GROUP`` queries meet the bounds of each shard (a
range of blocks), and only blocks that some query of the group can need are
sent to the cell (group, shard).  There each query goes through its blocks in
its own order.  A cell holds a group and a shard, whatever the table's size;
the best of all cells are ranked in the end.  Bounds are never below the
score, so the result is exact.

Defined results.  Vectors null or with null or non-finite components (also
after scaling) take no part; empty and zero vectors do.  Components missing
from a shorter vector count as zero.  A query's own row is left out; other
rows of its vec_id are not, and each is a query too.  Ties go to the smaller
vec_id.  Null vec_id: no part.  Scores beyond 64 bits are held at its ends
(and compared as such).  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, slices, stored

SCALE = 256.0
#: Rows of a block, blocks of a shard, queries of a group.
BLOCK, SHARD, GROUP = 256, 32, 1024
#: Scores below this are exact in doubles, with a place in a block of so many rows at most beside them.
MOST_ROWS = 1024
EXACT = 2.0 ** 53 / MOST_ROWS
_LOW, _HIGH = -2 ** 63, 2 ** 63 - 1


def scaled(embeddings: DataFrame, column: str, scale: float) -> DataFrame:
    """(vec_id, v, near): whole components as doubles, and a key that is alike for alike vectors."""
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            size = pc.list_value_length(lists).fill_null(-1).to_numpy()
            begin = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
            flat = pc.list_flatten(lists).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            for n in np.unique(size[size >= 0]).tolist():
                at = np.flatnonzero(size == n)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * flat[begin[at][:, None] + np.arange(n)])
                ok = np.isfinite(x).all(axis=1)
                at, x = at[ok], x[ok]
                near = np.zeros(len(at), np.int64)
                top = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :3]
                for d in top.T:
                    near = near * (2 * n) + 2 * d + (x[np.arange(len(at)), d] > 0)
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * n, pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), v, pa.array(near)], ["vec_id", "v", "near"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v")).filter("vec_id is not null")
    return rows.mapInArrow(turn, "vec_id long, v array<double>, near long")


def matrix(rows: list[list[float]] | list[np.ndarray]) -> np.ndarray:
    """Rows of one matrix, short ones filled with zeros."""
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def widened(x: np.ndarray, columns: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, columns - x.shape[1]))) if x.shape[1] < columns else x


def _whole(x: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def _size(q: np.ndarray, x: np.ndarray) -> float:
    """No inner product of the rows is larger."""
    with np.errstate(over="ignore"):
        return float(np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows: doubles where these are exact, else integers of 64 bits at most."""
    if _size(q, x) < EXACT:
        return q @ x.T
    found = _whole(q).dot(_whole(x).T)
    return np.array([[min(max(v, _LOW), _HIGH) for v in row] for row in found], dtype=object)


def best_of(s: np.ndarray, top: int) -> np.ndarray:
    """Columns of each row's ``top`` largest numbers, ties to the smaller column."""
    n = s.shape[1]
    if s.dtype == object:
        return np.array([sorted(range(n), key=lambda j: (-row[j], j))[:top] for row in s.tolist()], np.int64)
    key = s * n + np.arange(n - 1, -1, -1)
    if n > top:
        at = np.argpartition(-key, top - 1, axis=1)[:, :top]
    else:
        at = np.broadcast_to(np.arange(n), s.shape)
    return np.take_along_axis(at, np.argsort(-np.take_along_axis(key, at, 1), axis=1), 1)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The sum of term maxima of each query (rows) on each block (columns); infinite where doubles may not hold it."""
    if _size(q, np.concatenate([high, low])) >= EXACT:
        return np.full((len(q), len(high)), np.inf)
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


class Best:
    """The ``top`` best rows met so far by each of ``n`` queries."""

    def __init__(self, n: int, top: int):
        self.top = top
        self.found = [[] for _ in range(n)]  # (-score, vec_id, row)

    def add(self, at: np.ndarray, s: np.ndarray, cols: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray) -> None:
        for i, query in enumerate(at.tolist()):
            held, kth = self.found[query], self.kth(query)
            new = []
            for j in cols[i].tolist():
                score = int(s[i, j])
                if kth is not None and score < kth:
                    break
                if rows[j] != own[query]:
                    new.append((-score, int(ids[j]), int(rows[j])))
            if new:
                held.extend(new)
                held.sort()
                del held[self.top:]

    def kth(self, query: int) -> int | None:
        held = self.found[query]
        return -held[-1][0] if len(held) == self.top else None


def pack_block(table: pa.Table, top: int, every: int, block: int, shard: int) -> pa.Table:
    """A block's row: forward index, extremes, and its queries with the k-th score they find in it."""
    table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    ids, rows = table["vec_id"].to_numpy(), table["row"].to_numpy()
    x = matrix(table["v"].to_pylist())
    queries = np.flatnonzero(ids % every == 0)
    kth = []
    if len(queries):
        s = products(x[queries], x)
        best = Best(len(queries), top)
        best.add(np.arange(len(queries)), s, best_of(s, top + 1), ids, rows, rows[queries])
        kth = [best.kth(i) for i in range(len(queries))]
    return pa.table({
        "block": pa.array([int(rows[0]) // block], pa.int64()), "shard": pa.array([int(rows[0]) // (block * shard)], pa.int64()),
        "ids": [ids.astype("<i8").tobytes()], "rows": [rows.astype("<i8").tobytes()], "x": [x.astype("<f8").tobytes()],
        "high": pa.array([x.max(axis=0).tolist()], pa.list_(pa.float64())), "low": pa.array([x.min(axis=0).tolist()], pa.list_(pa.float64())),
        "queries": pa.array([queries.tolist()], pa.list_(pa.int64())), "kth": pa.array([kth], pa.list_(pa.int64()))})


_BLOCK_ROW = ("block long, shard long, ids binary, rows binary, x binary, high array<double>, low array<double>, "
              "queries array<long>, kth array<long>")


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_ids, rows and matrix of a block's row."""
    ids, rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
    return ids, rows, np.frombuffer(row["x"], "<f8").reshape(len(ids), -1)


def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vec_id, v, kth) of the queries in blocks' rows."""
    for batch in slices(batches, 16):
        for block in batch.to_pylist():
            ids, rows, x = unpack(block)
            at = np.array(block["queries"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[at]), pa.array(ids[at]), pa.array([r.tolist() for r in x[at]], pa.list_(pa.float64())),
                 pa.array(block["kth"], pa.int64())], ["row", "vec_id", "v", "kth"])


def group_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int | None]]:
    return table["row"].to_numpy(), table["vec_id"].to_numpy(), matrix(table["v"].to_pylist()), table["kth"].to_pylist()


def at_least(kth: int | None) -> float:
    """A double that no score of ``kth`` or more is below."""
    if kth is None:
        return -np.inf
    return float(kth) if abs(kth) < EXACT else float(np.nextafter(float(kth), -np.inf))


def needed(queries: pa.Table, blocks: pa.Table) -> pa.Table:
    """The blocks of a shard on which some query's bound reaches its k-th score so far."""
    rows, _, q, kth = group_of(queries)
    found = blocks.to_pylist()
    high, low = matrix([b["high"] for b in found]), matrix([b["low"] for b in found])
    width = max(q.shape[1], high.shape[1])
    reach = bounds(widened(q, width), widened(high, width), widened(low, width))
    floor = np.array([at_least(k) for k in kth])
    ok = (reach >= floor[:, None]).any(axis=0) if len(rows) else np.zeros(len(found), bool)
    kept = [b for b, use in zip(found, ok) if use]
    return pa.table({"grp": pa.array([b["grp"] for b in kept], pa.int64()),
                     "shard": pa.array([b["shard"] for b in kept], pa.int64()),
                     "block": pa.array([b["block"] for b in kept], pa.int64())})


def search_cell(queries: pa.Table, blocks: pa.Table, top: int) -> pa.Table:
    """The best rows of a shard's blocks for a group of queries."""
    own, q_ids, q, start = group_of(queries)
    found = blocks.to_pylist()
    unpacked = [unpack(b) for b in found]
    width = max([q.shape[1], *(x.shape[1] for _, _, x in unpacked)])
    q = widened(q, width)
    high = widened(matrix([b["high"] for b in found]), width)
    low = widened(matrix([b["low"] for b in found]), width)
    reach = bounds(q, high, low)
    order = np.argsort(-reach, axis=1, kind="stable")
    floor = np.array([at_least(k) for k in start])
    best = Best(len(q), top)
    live = np.arange(len(q))
    for turn in range(len(found)):
        block = order[live, turn]
        open_ = reach[live, block] >= floor[live]
        live, block = live[open_], block[open_]  # bounds only fall from here
        if not len(live):
            break
        for b in np.unique(block).tolist():
            at = live[block == b]
            ids, rows, x = unpacked[b]
            s = products(q[at], widened(x, width))
            cols = best_of(s, top + 1)
            hit = s[np.arange(len(at)), cols[:, 0]] >= floor[at]
            at = at[hit]
            best.add(at, s[hit], cols[hit], ids, rows, own)
            for i in at.tolist():
                floor[i] = max(floor[i], at_least(best.kth(i)))
    out = [(int(own[i]), int(q_ids[i]), vec_id, row, -score) for i in range(len(q)) for score, vec_id, row in best.found[i]]
    names = ["q_row", "query_id", "vec_id", "row", "score"]
    return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(names)})


def top_k(embeddings: DataFrame, every: int = 50, top: int = 5, column: str = "embedding",
          scale: float = SCALE, block: int = BLOCK, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose vec_id is divisible by ``every``."""
    if block > MOST_ROWS:
        raise ValueError(f"a block has {MOST_ROWS} rows at most")
    rows = numbered(stored(scaled(embeddings, column, scale), "scaled"), [F.col("near"), F.col("vec_id")], "row", "rows")
    blocks = stored(rows.select("row", "vec_id", "v", F.expr(f"row div {block}").alias("block")).groupBy("block")
                    .applyInArrow(lambda t: pack_block(t, top, every, block, shard), _BLOCK_ROW), "blocks")
    queries = stored(blocks.filter(F.size("queries") > 0).mapInArrow(
        query_rows, "row long, vec_id long, v array<double>, kth long"), "queries")
    groups = stored(numbered(queries, [F.col("row")], "place", "groups").withColumn(
        "grp", F.expr(f"place div {group}")).drop("place"), "query-groups")
    n_groups = (groups.agg(F.max("grp")).first()[0] or 0) + 1
    n_shards = (blocks.agg(F.max("shard")).first()[0] or 0) + 1
    each_group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long")))
    each_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long")))
    key = ["grp", "shard"]
    asked = groups.withColumn("shard", each_shard)
    extremes = blocks.select("block", "shard", "high", "low", each_group.alias("grp"))
    use = stored(asked.groupBy(*key).cogroup(extremes.groupBy(*key)).applyInArrow(
        needed, "grp long, shard long, block long"), "needed")
    sent = blocks.select("block", "ids", "rows", "x", "high", "low").join(use, "block")
    asked = asked.join(use.select(*key).distinct(), key, "left_semi")
    found = asked.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(
        lambda q, b: search_cell(q, b, top), "q_row long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
