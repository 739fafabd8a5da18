"""Approximate nearest neighbours over learned partitions.

A neighbour graph of a bounded sample (``SAMPLE_ROWS`` vectors of smallest
hash) is cut into balanced parts: nodes move to the part where most of their
neighbours are while it has room.  A small softmax classifier learns to tell a
vector's part, from the shares of its neighbours in each part.  Every row is
indexed under its most probable part; a query goes to its most probable parts,
and the rows there are reranked by exact cosine.  How many parts a query goes
to is measured: the fewest that hold ``RECALL`` of the true neighbours of
``TRIALS`` sampled vectors that the classifier has not seen.

A part is searched in cells of at most about ``CELL_ROWS`` candidates and
``CELL_QUERIES`` queries, so that a part that holds a third of all rows is
searched by many tasks; each cell gives the best few of its candidates.

Defined results.  Vectors that are null, empty, zero, of another dimension than
the most frequent one, or that hold null or non-finite components take no
part, nor do rows without vec_id.  Fewer candidates than asked for: all that
were found.  Ties: the smaller vec_id.  Repeated rows are candidates each, but
never of a query with their own vec_id.  Empty table: no row.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import hash_sample, slices, stored

SAMPLE_ROWS = 6_000
GRAPH_NEIGHBOURS = 10
#: Sampled rows for each part.
PART_ROWS = 375
RECALL = 0.96
TRIALS = 1_000
TOP = 5
CELL_ROWS = 8_192
CELL_QUERIES = 1_024
SEED = 7


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int = GRAPH_NEIGHBOURS) -> np.ndarray:
    """The k nearest others of each unit vector, in blocks of rows."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a:a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1,
                   rounds: int = 12) -> np.ndarray:
    """A part for each node, none with more than ``slack`` times its share.

    Starts from nodes dealt to random centres with room, then moves nodes to
    where most of their neighbours are, the most eager first.
    """
    rng = np.random.default_rng(SEED)
    n, room = len(x), int(np.ceil(slack * len(x) / parts))
    score = x @ x[rng.choice(n, parts, replace=False)].T
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for i in np.argsort(-score.max(axis=1), kind="stable"):
        for p in np.argsort(-score[i], kind="stable"):
            if size[p] < room:
                part[i], size[p] = p, size[p] + 1
                break
    # Edges count both ways.
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (both[0], part[both[1]]), 1.0)
        gain = votes.max(axis=1) - votes[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if size[to] < room:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


def fit_classifier(x: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Softmax weights (last row: bias) for soft targets, by accelerated gradient steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros((a.shape[1], target.shape[1]))
    ahead, t = w.copy(), 1.0
    step = 4.0 / (a * a).sum(axis=1).mean()
    for _ in range(rounds):
        z = a @ ahead * SCALE
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        new = ahead - step * (a.T @ (p - target) / len(a) + 1e-4 * ahead)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w * SCALE


SCALE = 8.0


@dataclass
class Router:
    """The classifier: most probable parts of unit vectors."""

    weights: np.ndarray
    dimension: int
    probes: int = 1

    @property
    def parts(self) -> int:
        return self.weights.shape[1]

    def probable(self, x: np.ndarray, probes: int) -> np.ndarray:
        z = x @ self.weights[:-1] + self.weights[-1]
        return np.argsort(-z, axis=1, kind="stable")[:, :probes]


def fit(vectors: DataFrame) -> Router | None:
    """A router from a sample of (vec_id, v); None without vectors."""
    dims = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return None
    dimension = int(dims[0][0])
    sample = hash_sample(vectors.filter(F.size("v") == dimension), ["vec_id"], SAMPLE_ROWS).select("v").toArrow()
    x = unit(np.array(sample.column(0).to_pylist(), np.float64))
    # Copies would only be each other's neighbours.
    x = np.unique(x, axis=0)
    parts = max(1, len(x) // PART_ROWS)
    if parts == 1:
        return Router(np.zeros((dimension + 1, 1)), dimension)
    graph = neighbour_graph(x)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    target[np.arange(len(x)), part] += graph.shape[1]
    target /= target.sum(axis=1, keepdims=True)
    order = np.random.default_rng(SEED).permutation(len(x))
    trial, known = order[:min(TRIALS, len(x) // 4)], order[min(TRIALS, len(x) // 4):]
    router = Router(fit_classifier(x[known], target[known]), dimension)
    router.probes = probes_needed(x, trial, router)
    return router


def probes_needed(x: np.ndarray, trial: np.ndarray, router: Router) -> int:
    """The fewest probes that find ``RECALL`` of the trial vectors' true neighbours in ``x``."""
    home = router.probable(x, 1)[:, 0]
    place = np.argsort(router.probable(x[trial], router.parts), axis=1)  # of each part, in the trial's order
    s = x[trial] @ x.T
    s[np.arange(len(trial)), trial] = -np.inf
    near = np.argpartition(-s, TOP - 1, axis=1)[:, :TOP]
    at = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    return int(at[int(np.ceil(RECALL * len(at))) - 1]) + 1


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter("vec_id is not null and size(v) > 0").filter(finite)
            .filter(F.exists("v", lambda x: x != 0)))


def _routed(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """(vec_id, v, part): a row for each of the most probable parts."""
    shared = vectors.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            to = shared.value.probable(unit(x), probes)
            n = to.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), n)),
                 batch.column(1).take(pa.array(np.repeat(np.arange(batch.num_rows), n))),
                 pa.array(to.ravel().astype(np.int32))], ["vec_id", "v", "part"])

    return vectors.mapInArrow(route, "vec_id long, v array<double>, part int")


def cell_best(queries: pd.DataFrame, rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """The ``top`` nearest rows of each query, by exact cosine."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                          "score": pd.Series(dtype="float64")})
    if not len(queries) or not len(rows):
        return empty
    rows = rows.sort_values("vec_id", kind="stable")
    ids, q_ids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    c, q = np.stack(rows["v"].to_list()), np.stack(queries["v"].to_list())
    c_norm, q_norm = np.sqrt((c * c).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    near = np.round((q / q_norm[:, None]) @ (c / c_norm[:, None]).T, 12)
    near[q_ids[:, None] == ids[None, :]] = -np.inf
    out_q, out_c, out_s = [], [], []
    for i in range(len(q)):
        s = near[i]
        if len(s) > top:
            edge = np.partition(s, len(s) - top)[len(s) - top]
            at = np.concatenate([np.flatnonzero(s > edge), np.flatnonzero(s == edge)[:top]])
        else:
            at = np.arange(len(s))
        at = at[np.isfinite(s[at])]
        # The same sum for equal vectors, whatever block they are in.
        score = (c[at] * q[i]).sum(axis=1) / (c_norm[at] * q_norm[i])
        out_q.append(np.full(len(at), q_ids[i]))
        out_c.append(ids[at])
        out_s.append(score)
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_c),
                         "score": np.concatenate(out_s)})


def nearest(embeddings: DataFrame, every: int = 50, top: int = TOP, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): neighbours of the rows whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    router = fit(vectors)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.filter(F.size("v") == router.dimension)
    rows = stored(_routed(vectors, router, 1), "indexed")
    queries = stored(_routed(vectors.filter(F.col("vec_id") % every == 0), router, probes or router.probes), "queries")
    # Cells of a part: as many blocks of rows and of queries as its size asks for.
    sizes = (rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("r_blocks"))
             .join(queries.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("q_blocks")),
                   "part"))
    sizes = F.broadcast(stored(sizes, "part-sizes"))  # a row for each part of the router

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v"), F.col(of)).cast("int")

    row_cells = (rows.join(sizes, "part").withColumn("r", block("r_blocks"))
                 .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
                 .select("part", "r", "q", "vec_id", "v"))
    query_cells = (queries.join(sizes, "part").withColumn("q", block("q_blocks"))
                   .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)))
                   .select("part", "r", "q", "vec_id", "v"))
    key = ["part", "r", "q"]
    found = query_cells.groupBy(*key).cogroup(row_cells.groupBy(*key)).applyInPandas(
        lambda q, r: cell_best(q, r, top), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
