"""SimHash near-duplicates: fingerprints, shards, and a BK-tree in each shard.

A fingerprint has 64 bits in ``BLOCKS`` blocks.  Two of them that differ in at
most ``radius`` bits agree on at least ``BLOCKS - radius`` blocks, so each
distinct fingerprint goes to the shard of every choice of so many blocks and
no link is missed.  In a shard, a BK-tree has its children keyed by their
Hamming distance to the parent, and a search follows only the edges within
the radius.  A shard gives the links of a spanning forest, not all pairs.

A shard of more than ``SHARD_ROWS`` fingerprints is split into trees of that
size at most; its fingerprints are sent to each of its trees in blocks.
Components of the links are found by star contraction, checkpointed.

Defined results.  Null, empty or blank text: fingerprint zero, linked like any
other.  Repeated doc_ids, whatever their texts: a row each.  Null doc_id: a row
of its own, never the smallest of a component unless all are null.  Empty
table: no row.  Other columns are ignored by ``components`` and kept by
``representatives``, which decides row by row: each component, so each text,
keeps exactly one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, slices, stored

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
SEED = 42
SHARD_ROWS = 1024

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if over half of the shingles' XXH64 have it."""
    w = (text or b"").lower().split()
    n = len(w)
    if not n:
        return 0
    joined = b" ".join(w)
    h = xxhash.xxh64_digest
    if n <= shingle:
        digests = h(joined, SEED)
    else:
        length = np.fromiter(map(len, w), np.int64, n)
        end = np.cumsum(length + 1) - 1
        digests = b"".join([h(joined[a:b], SEED) for a, b in zip(
            (end - length)[:n - shingle + 1].tolist(), end[shingle - 1:].tolist())])
    a = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(a[:, j], minlength=256) @ _BITS for j in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(a)).tobytes(), "big")


def _mark() -> Column:
    """A hash that tells an id's texts apart."""
    return F.xxhash64("text", F.col("text").isNull())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp long): a hash of the text, the fingerprint's bits as a signed number."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))],
                                             ["doc_id", "mark", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark().alias("mark"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(hashed, "doc_id long, mark long, fp long")


class BKTree:
    """Numbers by Hamming distance: node = [number, {distance: child}]."""

    def __init__(self, numbers: Iterator[int] | list[int] = ()):
        self.root: list | None = None
        for x in numbers:
            self.add(x)

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = [x, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ x).bit_count()
            if not d:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [x, {}]
                return
            node = child

    def within(self, x: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            number, children = todo.pop()
            d = (number ^ x).bit_count()
            if d <= radius:
                found.append(number)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found


class Forest:
    """Union-find; ``join`` says whether it joined two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def shard_links(tree: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that span what ``radius`` connects between the tree and the queries."""
    if len(tree) == 2 and tree == queries:
        return [(tree[0], tree[1])] if (tree[0] ^ tree[1]).bit_count() <= radius else []
    bk, forest = BKTree(tree), Forest()
    return [(x, y) for x in queries for y in bk.within(x, radius) if x != y and forest.join(x, y)]


def _keys(radius: int, blocks: int) -> list[Column]:
    """A long for each choice of blocks: the choice's number mixed with the blocks' bits."""
    edge = [64 * b // blocks for b in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", edge[b]).bitwiseAND(F.lit((1 << (edge[b + 1] - edge[b])) - 1))
            for b in range(blocks)]
    return [F.xxhash64(F.lit(i), *(part[b] for b in choice))
            for i, choice in enumerate(combinations(range(blocks), blocks - radius))]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints within the radius.

    ``distinct``: (fp), stored, without repeats.  Shards are keyed by a hash of
    choice and bits; two shards that meet in a hash are searched as one.
    """
    keyed = distinct.select("fp", F.explode(F.array(*_keys(radius, blocks))).alias("key"))
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows)
    large = stored(large.select("key", F.ceil(F.col("n") / shard_rows).cast("int").alias("trees")), "hot-shards")
    if large.isEmpty():
        cells = keyed.select("key", F.lit(0).alias("tree"), F.lit(0).alias("block"), F.lit(True).alias("both"), "fp")
    else:
        part = F.pmod(F.xxhash64("fp", "key"), F.coalesce("trees", F.lit(1))).cast("int")
        dealt = keyed.join(large, "key", "left").select(
            "key", "fp", part.alias("own"), F.coalesce("trees", F.lit(1)).alias("trees"))
        cells = dealt.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other"))
        cells = cells.select("key", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("block"),
                             (F.col("own") <= F.col("other")).alias("both"), "fp")
    n = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cells = (cells.repartition(n, "key", "tree", "block")
             .sortWithinPartitions("key", "tree", "block", "fp"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

        out: list[tuple[int, int]] = []
        for (_, tree, block), cell in groupby(rows(), itemgetter(0, 1, 2)):
            cell = [(r[4] & 0xFFFFFFFFFFFFFFFF, r[3]) for r in cell]
            if len(cell) == 1:
                continue
            inside = [x for x, own in cell if own]
            out += shard_links(inside, inside if tree == block else [x for x, own in cell if not own], radius)
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return cells.mapInArrow(search, "a long, b long").distinct()


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternates two contractions until the links stand still: every node's
    larger neighbours, then its smaller ones, are tied to its least neighbour.
    """
    edges = checkpoint(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .filter("u <> v").distinct())
    last = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        edges = checkpoint(small.select("u", F.col("m").alias("v"))
                           .union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                           .filter("u <> v").distinct())


def _grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """(doc_id, mark, fp, first) of every row; ``first``: the first row of its component, by id (null last) and mark."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    distinct = stored(prints.groupBy("fp").agg(F.min(row).alias("first")), "distinct-fingerprints")
    roots = connected(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return prints.join(rooted.drop("first").join(smallest, "root").select("fp", "first"), "fp")


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    return _grouped(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the smallest id.

    Of rows of that id the one whose text has the smallest hash, and of rows
    alike in both one.  A null id comes after all others.
    """
    key = ["_sim_id", "_sim_null", "_sim_mark"]
    number = F.col("doc_id").cast("long")
    named = [F.coalesce(number, F.lit(0)), number.isNull()]
    found = stored(_grouped(docs, shingle, radius).select(
        *[c.alias(k) for c, k in zip([*named, F.col("mark")], key)],
        (~(number.eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")))).alias("goes")), "components")
    gone = found.filter("goes").select(*key).distinct()
    rows = docs.withColumns(dict(zip(key, [*named, _mark()])))
    # Dropped rows grow with the table: both sides are dealt by key at every size, never broadcast.
    kept = rows.join(gone.hint("merge"), key, "left_anti")
    twice = stored(found.filter("not goes").groupBy(*key).count().filter("count > 1").select(*key), "repeated")
    if not twice.isEmpty():
        one = kept.join(twice, key, "left_semi").dropDuplicates(key)
        kept = kept.join(twice, key, "left_anti").unionByName(one)
    return kept.select(docs.columns)
