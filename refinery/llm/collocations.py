"""Phrase collocations: pair counts by direct address, then pairs of pairs.

Texts are cut into pieces and words by Arrow in *blocks* of some MB; a block
keeps its words as codes of a dictionary of its own.  The dictionaries, not
the texts, are summed to word counts.  Words with the least count or more get
ids by falling frequency; a join of the dictionaries gives each block its ids.

Pairs (left id, right id) of a block are counted in *tiles*: where both ids
are below ``HEAD``, a tile of ``TILE`` x ``TILE`` cells is an array that numpy's
bincount addresses directly; all other pairs are sorted coordinates with
counts, in strips by their code.  Tiles and strips of all blocks are summed by
Spark tasks that hold one at a time; a tile's blocks are first summed in parts
of ``FAN_IN``.  The pairs with the least count or more are ranked by frequency
in turn, their ids go back to the blocks, and (pair, next word) is counted in
the same way, up to ``longest`` words.  Rare words and pairs drop out before
the next round, which loses nothing: a part is at least as frequent as the
whole.

A block, tile or strip is of bounded size; what grows is kept in tables.
Joins are on ids or on (lang, phrase), which are unique on one side.

Defined results.  Null text: empty.  Null lang: ``und``.  Null doc_id, repeated
rows: each row counts.  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import copied, numbered, slices, stored

#: Text bytes of a block.
BLOCK_BYTES = 16 << 20
#: Ids below HEAD are counted in dense tiles of TILE x TILE cells.
HEAD, TILE = 4096, 256
#: Pairs that a strip is meant to hold, blocks summed at a time.
STRIP_PAIRS, FAN_IN = 2_000_000, 64
#: The row that holds a block's ids.
IDS = -(1 << 40)

#: A-Z to a-z, tab to space, all that ends a piece to a full stop.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if c in b".,;:!?\n\v\f\r" else c for c in range(256))

_COUNTS = "block long, tile long, cells binary, counts binary"


# ---- blocks ------------------------------------------------------------------

def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of all words in order (-1: a piece ends), the words, and each code's text."""
    texts = copied(texts)
    _, offsets, data = texts.buffers()
    folded = pa.py_buffer(data.to_pybytes().translate(_FOLD) if data else b"")
    folded = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, folded])
    cut = pc.split_pattern(pc.replace_substring(folded, ".", " . "), " ")
    coded = pc.list_flatten(cut).dictionary_encode()
    words = coded.dictionary.to_pylist()
    place = {w: i for i, w in enumerate(words)}
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    code[code == place.get(".", -2)] = -1
    real = code != place.get("", -2)
    return code[real], words, owner[real]


def pack_block(block: int, texts: pa.Array, langs: list[str]) -> pa.RecordBatch:
    """A block's row: its dictionary by language, with counts, and its codes."""
    code, words, owner = words_of(texts)
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    lang = np.array([number[x] for x in langs], np.int64)[owner]
    # A text's end ends a piece.
    ends = np.flatnonzero(np.diff(owner)) + 1
    code, lang = np.insert(code, ends, -1), np.insert(lang, ends, 0)
    real = code >= 0
    both = lang * len(words) + code
    count = np.bincount(both[real], minlength=len(names) * len(words))
    used = np.flatnonzero(count)
    used = used[np.argsort(-count[used], kind="stable")]  # frequent words get small codes
    new = np.full(len(count), -1, np.int64)
    new[used] = np.arange(len(used))
    out = np.where(real, new[np.maximum(both, 0)], -1) if len(code) else np.empty(0, np.int64)
    first = np.concatenate([[True], (out[1:] >= 0) | (out[:-1] >= 0)]) if len(out) else np.empty(0, bool)
    lang_of, word_of = np.divmod(used, max(1, len(words)))
    return pa.RecordBatch.from_pydict({
        "block": pa.array([block], pa.int64()),
        "words": pa.array([[words[w] for w in word_of.tolist()]], pa.list_(pa.string())),
        "langs": pa.array([[names[x] for x in lang_of.tolist()]], pa.list_(pa.string())),
        "counts": pa.array([count[used].tolist()], pa.list_(pa.int64())),
        "codes": pa.array([squeezed(out[first] + 1)], pa.binary())})


def blocks_of(docs: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        texts, langs, held = [], [], 0
        for batch in slices(batches):
            texts.append(batch.column(0).cast(pa.large_string()))
            langs += batch.column(1).to_pylist()
            held += texts[-1].nbytes
            if held >= BLOCK_BYTES:
                yield pack_block(block, pa.concat_arrays(texts), langs)
                block, texts, langs, held = block + 1, [], [], 0
        if texts:
            yield pack_block(block, pa.concat_arrays(texts), langs)

    return docs.select(F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).mapInArrow(
        pack, "block long, words array<string>, langs array<string>, counts array<long>, codes binary")


# ---- tiles -------------------------------------------------------------------

def squeezed(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers from 0 on as bytes: differences if ``rising``, byte planes, zstandard."""
    if rising:
        numbers = np.diff(numbers, prepend=0)
    most = int(numbers.max(initial=0))
    size = next(k for k in (1, 2, 4, 8) if most < 1 << (8 * k))
    planes = numbers.astype(f"<u{size}").view(np.uint8).reshape(len(numbers), size).T
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def spread(held: bytes, rising: bool = False) -> np.ndarray:
    """The numbers of ``squeezed``."""
    size = held[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(held[1:]), np.uint8).reshape(size, -1)
    numbers = np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64)
    return np.cumsum(numbers) if rising else numbers


def tile_rows(block: int, code: np.ndarray, width: int, strips: int) -> list[tuple[int, int, bytes, bytes]]:
    """A block's counted pairs, code = left * width + right, as rows of ``_COUNTS``."""
    left, right = np.divmod(code, width)
    dense = (left < HEAD) & (right < HEAD)
    out = []
    tile = (left[dense] // TILE) * (HEAD // TILE) + right[dense] // TILE
    cell = (left[dense] % TILE) * TILE + right[dense] % TILE
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    at = np.flatnonzero(np.diff(tile, prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(tile)]):
        count = np.bincount(cell[a:b], minlength=TILE * TILE)
        used = np.flatnonzero(count)
        out.append((block, -1 - int(tile[a]), squeezed(used, True), squeezed(count[used])))
    codes, count = np.unique(code[~dense], return_counts=True)
    strip = codes % strips
    order = np.argsort(strip, kind="stable")  # codes stay sorted in a strip
    strip, codes, count = strip[order], codes[order], count[order]
    at = np.flatnonzero(np.diff(strip, prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(strip)]):
        out.append((block, int(strip[a]), squeezed(codes[a:b], True), squeezed(count[a:b])))
    return out


def tile_of(left: np.ndarray, right: np.ndarray, width: int, strips: int) -> np.ndarray:
    """The tile or strip that counts each pair."""
    dense = (left < HEAD) & (right < HEAD)
    return np.where(dense, -1 - ((left // TILE) * (HEAD // TILE) + right // TILE), (left * width + right) % strips)


def codes_of(tile: int, cells: np.ndarray, width: int) -> np.ndarray:
    """The pairs' codes from a tile's cells; a strip holds the codes themselves."""
    if tile >= 0:
        return cells
    across = HEAD // TILE
    return ((-1 - tile) // across * TILE + cells // TILE) * width + (-1 - tile) % across * TILE + cells % TILE


def _table(rows: list[tuple[int, int, bytes, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "tile": pa.array([r[1] for r in rows], pa.int64()),
                     "cells": pa.array([r[2] for r in rows], pa.binary()), "counts": pa.array([r[3] for r in rows], pa.binary())})


def counted(block: int, head: np.ndarray, word: np.ndarray, size: int, width: int, strips: int, last: bool) -> pa.Table:
    """Rows of a block: its ids (but in the ``last`` round), and counts of (run of ``size`` words, next word)."""
    left, right = head[:max(0, len(head) - size)], word[size:]
    both = (left >= 0) & (right >= 0)
    ids = [] if last else [(block, IDS, squeezed(head + 1) if size > 1 else b"", squeezed(word + 1))]
    return _table([*ids, *tile_rows(block, left[both] * width + right[both], width, strips)])


def first_counts(entries: pa.Table, blocks: pa.Table, width: int, strips: int, last: bool) -> pa.Table:
    """A block's codes turned into word ids, and its pairs of words."""
    row = blocks.to_pylist()[0]
    code = spread(row["codes"]) - 1
    ids = np.full(int(code.max(initial=-1)) + 2, -1, np.int64)  # the last place is for -1
    ids[entries["code"].to_numpy()] = entries["id"].to_numpy()
    word = ids[code]
    return counted(row["block"], word, word, 1, width, strips, last)


def next_counts(found: pa.Table, ids: pa.Table, size: int, width: int, strips: int, last: bool) -> pa.Table:
    """Runs of ``size`` words of a block get their ids, and are counted with the next word."""
    row = ids.to_pylist()[0]
    word = spread(row["counts"]) - 1
    head = spread(row["cells"]) - 1 if size > 2 else word
    code = np.concatenate([spread(x, True) for x in found["cells"].to_pylist()])
    new = np.concatenate([spread(x) for x in found["counts"].to_pylist()])
    order = np.argsort(code)
    code, new = code[order], new[order]
    end = word[size - 1:]
    before = head[:len(end)]
    asked = np.where((before >= 0) & (end >= 0), before * width + end, -1)
    at = np.minimum(np.searchsorted(code, asked), len(code) - 1)
    run = np.full(len(head), -1, np.int64)
    run[:len(end)] = np.where(code[at] == asked, new[at], -1)
    return counted(row["block"], run, word, size, width, strips, last)


def known_cells(pairs: pa.Table, counts: pa.Table, width: int) -> pa.Table:
    """Of each block's pairs in a tile, the frequent ones as (codes, new ids)."""
    code = pairs["code"].to_numpy()
    order = np.argsort(code)
    code, ids = code[order], pairs["id"].to_numpy()[order]
    out = []
    for row in counts.to_pylist():
        own = codes_of(row["tile"], spread(row["cells"], True), width)
        at = np.minimum(np.searchsorted(code, own), len(code) - 1)
        same = code[at] == own
        if same.any():
            out.append((row["block"], row["tile"], squeezed(own[same], True), squeezed(ids[at[same]])))
    return _table(out)


class TileSum:
    """The sum of one tile's or strip's rows."""

    def __init__(self, tile: int):
        self.tile, self.cells, self.counts, self.held = tile, [], [], 0
        self.dense = np.zeros(TILE * TILE, np.int64) if tile < 0 else None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[cells] += counts
            return
        self.cells.append(cells)
        self.counts.append(counts)
        self.held += len(cells)
        if len(self.cells) > 1 and self.held > STRIP_PAIRS * 4:
            cells, counts = self.done()
            self.cells, self.counts, self.held = [cells], [counts], len(cells)

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            used = np.flatnonzero(self.dense)
            return used, self.dense[used]
        cells, counts = np.concatenate(self.cells), np.concatenate(self.counts)
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order], counts[order]
        at = np.flatnonzero(np.diff(cells, prepend=-1))
        return cells[at], np.add.reduceat(counts, at)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(part, tile, cells, counts) of rows that come in the order of (tile, part)."""
    key, total = None, None
    for batch in slices(batches, 64):
        for part, tile, cells, counts in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if key != (part, tile):
                if total is not None:
                    yield *key, *total.done()
                key, total = (part, tile), TileSum(tile)
            total.add(spread(cells, True), spread(counts))
    if total is not None:
        yield *key, *total.done()


def frequent_pairs(counts: DataFrame, parts: int, width: int, least: int) -> DataFrame:
    """(l_id, r_id, f) of all pairs counted ``least`` times or more.

    ``parts``: how many blocks there are.  A tile's rows are summed in parts of
    ``FAN_IN`` until one is left.
    """
    def in_order(rows: DataFrame, parts: int) -> DataFrame:
        part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("long")
        rows = rows.select(part.alias("block"), "tile", "cells", "counts")
        return rows.repartition("tile", "block").sortWithinPartitions("tile", "block")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tile, cells, n in _sums(batches):
            yield _table([(part, tile, squeezed(cells, True), squeezed(n))]).to_batches()[0]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tile, cells, n in _sums(batches):
            often = n >= least
            left, right = np.divmod(codes_of(tile, cells[often], width), width)
            yield pa.RecordBatch.from_pydict({"l_id": pa.array(left, pa.int64()), "r_id": pa.array(right, pa.int64()),
                                              "f": pa.array(n[often], pa.int64())})

    rows = counts.filter(F.col("tile") != IDS)
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = in_order(rows, parts).mapInArrow(combine, _COUNTS)
    return in_order(rows, 1).mapInArrow(keep, "l_id long, r_id long, f long")


# ---- phrases -----------------------------------------------------------------

def ranked(phrases: DataFrame, label: str) -> DataFrame:
    """``phrases`` with an ``id``: 0, 1, 2 ... by falling f."""
    return stored(numbered(stored(phrases, label), [F.desc("f"), F.col("lang"), F.col("phrase")], "id", f"{label}-order"),
                  f"{label}-ids")


def phrase_counts(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of phrases of 1 to ``longest`` words met ``least`` times, and (lang, n) of all words."""
    blocks = stored(blocks_of(docs), "blocks")
    n_blocks = max(1, blocks.count())
    entry = F.posexplode(F.arrays_zip("words", "langs", "counts")).alias("code", "e")
    entries = blocks.select("block", entry).select(
        "block", "code", F.col("e.words").alias("phrase"), F.col("e.langs").alias("lang"), F.col("e.counts").alias("n"))
    totals = entries.groupBy("lang").agg(F.sum("n").alias("n"))
    words = ranked(entries.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "words")
    width, strips = _size(words)
    _fits(width, width)
    parts = [words]
    counts = None
    runs = words
    for size in range(1, longest):
        if size == 1:
            found = entries.join(words.select("lang", "phrase", "id"), ["lang", "phrase"]).select(F.col("block").alias("of"), "code", "id")
            count = _either_empty(partial(first_counts, width=width, strips=strips, last=longest == 2))
            counts = stored(found.groupBy("of").cogroup(blocks.select("block", "codes").groupBy("block"))
                            .applyInArrow(count, _COUNTS), "pairs")
        else:
            before, (n_runs, strips) = strips, _size(runs)
            _fits(n_runs, width)
            found = _ids_to_blocks(runs, counts, n_blocks, width, before)
            ids = counts.filter(F.col("tile") == IDS)
            count = _either_empty(partial(next_counts, size=size, width=width, strips=strips, last=size == longest - 1))
            counts = stored(found.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(count, _COUNTS), "runs")
        pairs = frequent_pairs(counts, n_blocks, width, least)
        pairs = (pairs.join(runs.select(F.col("id").alias("l_id"), "lang", F.col("phrase").alias("l")), "l_id")
                 .join(words.select(F.col("id").alias("r_id"), F.col("phrase").alias("r")), "r_id")
                 .select("lang", F.concat_ws(" ", "l", "r").alias("phrase"), "f", "l_id", "r_id"))
        runs = ranked(pairs, f"phrases-{size + 1}")
        parts.append(runs)
    out = None
    for size, part in enumerate(parts, 1):
        part = part.select("lang", "phrase", F.lit(size).alias("words"), "f")
        out = part if out is None else out.unionByName(part)
    return out, totals


def _size(runs: DataFrame) -> tuple[int, int]:
    """How many runs there are, and into how many strips their pairs go."""
    n, f = runs.agg(F.count(F.lit(1)), F.sum("f")).first()
    return max(1, n), 1 + (f or 0) // STRIP_PAIRS


def _fits(runs: int, words: int) -> None:
    if runs * words >= 1 << 62:
        raise OverflowError("codes of pairs do not fit 64 bits")


def _ids_to_blocks(runs: DataFrame, counts: DataFrame, n_blocks: int, width: int, strips: int) -> DataFrame:
    """The frequent pairs of each block with their ids, met tile by tile in parts of ``FAN_IN`` blocks."""
    salts = -(-n_blocks // FAN_IN)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, left, right = (batch.column(k).to_numpy() for k in range(3))
            yield pa.RecordBatch.from_pydict({"tile": pa.array(tile_of(left, right, width, strips)),
                                              "code": pa.array(left * width + right), "id": pa.array(ids)})

    pairs = (runs.select("id", "l_id", "r_id").mapInArrow(place, "tile long, code long, id long")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    rows = counts.filter(F.col("tile") != IDS).withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    key = ["tile", "salt"]
    return pairs.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
        _either_empty(partial(known_cells, width=width)), _COUNTS)


def _either_empty(count: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``count`` for a pair of groups; no rows if one of them is empty."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return count(left, right) if left.num_rows and right.num_rows else _table([])

    return both


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, percent: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    A phrase inside a longer one that is met ``percent`` of its times or more
    is left out.
    """
    found, totals = phrase_counts(docs, longest, least)
    found = stored(found, "phrases")
    candidates = found.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    w = F.split("phrase", " ")

    def part(begin: Column, size: Column) -> Column:
        return F.array_join(F.slice(w, begin, size), " ")

    # The lowest cut: every part of a candidate is in ``found``.
    k = F.col("k")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("p1", part(F.lit(1), k)).withColumn("p2", part(k + 1, F.col("words") - k)))
    cuts = (cuts.join(found.select("lang", F.col("phrase").alias("p1"), F.col("f").alias("l")), ["lang", "p1"])
            .join(found.select("lang", F.col("phrase").alias("p2"), F.col("f").alias("r")), ["lang", "p2"]))
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(1000000 as {wide}) * cast(a as {wide}) * cast(a as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = (cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "words", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # What a longer candidate covers.
    if longest > 2:
        inside = candidates.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        inside = (inside.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
                  .select("lang", part(F.col("begin"), F.col("size")).alias("phrase"), F.col("a").alias("over"))
                  .groupBy("lang", "phrase").agg(F.max("over").alias("over")))
        covered = F.col("over").isNotNull() & (F.col("over") * 100 >= F.col("a") * percent)
        scored = scored.join(inside, ["lang", "phrase"], "left").filter(~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
