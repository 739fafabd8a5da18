"""Exact search against all products in Python integers."""

import math
import random

import numpy as np
import pytest

from refinery.llm import topk_search as T
from refinery.llm.common import ship
from tests.llm.helpers import table

VECTORS = "vec_id long, embedding array<float>, label int, row int, block int, near string, x double"


def frame(spark, rows, kind="float"):
    ship(spark)
    return spark.createDataFrame([(*r, 0, 1, 2, "n", 3.0) for r in rows], VECTORS.replace("<float>", f"<{kind}>"))


def brute(rows, every=50, top=5):
    whole = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256.0 * x) for x in v):
            continue
        whole.append((vec_id, [math.floor(256.0 * x) for x in v]))
    out = []
    for i, (q, a) in enumerate(whole):
        if q % every == 0:
            near = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -2 ** 63), 2 ** 63 - 1), c)
                          for j, (c, b) in enumerate(whole) if j != i)[:top]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(near, 1)]
    return sorted(out, key=repr)


def vector(rng, n=8):
    return [rng.gauss(0, .3) for _ in range(n)]


def f32(rows):
    return [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_small_blocks_and_groups(spark):
    rng = random.Random(3)
    rows = [(i, vector(rng)) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(60)]  # one vector many times
    rows = f32(rows)
    found = T.top_k(frame(spark, rows), every=5, block=16, shard=4, group=8)
    assert table(found) == brute(rows, 5)


def test_edge_cases(spark):
    rng = random.Random(4)
    rows = [(i, vector(rng)) for i in range(0, 40)]
    rows += [(None, vector(rng)), (50, None), (100, [1.0, None] * 4), (150, [float("nan")] * 8), (200, [float("inf")] * 8),
             (250, []), (300, [0.0] * 8), (350, [.5, .25]), (400, vector(rng, 12)), (0, rows[0][1]), (0, vector(rng)), (-50, vector(rng))]
    rows = f32(rows)
    assert table(T.top_k(frame(spark, rows))) == brute(rows)
    assert table(T.top_k(frame(spark, []))) == []
    assert table(T.top_k(frame(spark, rows[:1]))) == []
    assert table(T.top_k(frame(spark, rows[1:9]))) == []


def test_products_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [x * 10.0 ** rng.choice([0, 5, 12, 200]) for x in vector(rng, 3)]) for i in range(30)]
    rows.append((60, [1e307, 0.0, 0.0]))
    assert table(T.top_k(frame(spark, rows, "double"), every=3)) == brute(rows, 3)


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(2)
    x, q = np.floor(rng.normal(0, 90, (64, 10))), np.floor(rng.normal(0, 90, (20, 10)))
    reach = T.bounds(q, x.max(axis=0)[None], x.min(axis=0)[None])[:, 0]
    assert (reach >= T.products(q, x).max(axis=1)).all()


def test_blocks_are_passed_over():
    """Clustered rows: a query's cell does not score blocks whose bound is below its k-th score."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    made, seen = [], []
    for b in range(6):
        v = np.zeros((32, 12))
        v[:, 2 * b:2 * b + 2] = np.floor(rng.uniform(100, 200, (32, 2)))
        rows = np.arange(32) + b * T.BLOCK
        made.append(T.pack_block(pa.table({"vec_id": rows + 1, "row": rows, "v": v.tolist()}), 5, 50, T.BLOCK, T.SHARD))
    blocks = pa.concat_tables(made).append_column("grp", pa.array([0] * 6))
    q = pa.table({"row": [10 ** 6], "vec_id": [10 ** 6], "v": [[0.0] * 4 + [150.0, 150.0] + [0.0] * 6], "kth": pa.array([1], pa.int64())})
    assert T.needed(q, blocks)["block"].to_pylist() == [2]
    products = T.products
    T.products = lambda a, b: seen.append(1) or products(a, b)
    try:
        T.search_cell(q, blocks, 5)
    finally:
        T.products = products
    assert len(seen) == 1


@pytest.mark.parametrize("top", [1, 3, 40])
def test_other_sizes(spark, top):
    rows = f32([(i, vector(random.Random(i), 4)) for i in range(30)])
    assert table(T.top_k(frame(spark, rows), every=10, top=top)) == brute(rows, 10, top)
