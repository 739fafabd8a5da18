"""Token counts that follow edits.

A document keeps a tree over its pre-tokens: leaves hold the token counts of
segments of ``SEGMENT`` pre-tokens each, inner nodes the sums of their
children.  An edit replaces a span of characters.  Only the segments that it
touches are cut into pre-tokens and encoded again, together with as much
context as it takes for the cuts to fall in with the old ones; their leaves
are replaced and the sums on the way to the root are brought up to date.

Trees can be kept as a table (``trees``, or ``with_trees`` of a call) and given to
a later call, which finds them by id and a hash of the text.

The pattern of the tokenizer looks at most at the white space next to a
pre-token, so cuts fall in again at the first place, on either side, where an
unchanged character that is not white space ends an old segment and white
space begins the next.  Segments are cut only there.

Defined results.  Null text: empty, 0 tokens.  Null, empty or malformed edits
(null or reversed bounds): none.  Edits refer to the text before any of them,
are taken in order, and one that overlaps its predecessor is skipped and not
counted; bounds beyond the text are drawn in.  Null doc_id and repeated rows:
a row each.  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokens import ChunkEncoder, encoder

#: Characters that a segment has at least, where the text allows a cut.
SEGMENT = 256
#: Children of an inner node.
FAN = 8

TREES = "doc_id long, mark long, starts array<int>, counts array<long>"
COUNTS = ("doc_id long, n_tokens_before long, n_edits long, n_segments long, n_reencoded long, "
          "n_tokens_after long, token_delta long")
EDITS = "array<struct<start:int,end:int,text:string>>"

#: What the query's edits replace, and by what.
REDACTIONS = (
    (r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "<EMAIL>"),
    (r"\+?\d{1,2} \(\d{3}\) \d{3}-\d{4}", "<PHONE>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>"),
    (r"\b\d{16}\b", "<CARD>"),
    (r"\b[0-9a-f]{32,64}\b", "<SECRET>"),
)


class SumTree:
    """Sums over a list of leaves; ``replace`` changes a run of them.

    A run replaced by as many leaves updates their ancestors only.  Where the
    number of leaves changes, the levels above are rebuilt from the changed
    place to the right.
    """

    def __init__(self, leaves: list[int]):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([sum(below[i:i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def total(self) -> int:
        return self.levels[-1][0] if self.levels[-1] else 0

    def replace(self, at: int, end: int, leaves: list[int]) -> None:
        same = end - at == len(leaves)
        self.levels[0][at:end] = leaves
        low, high = at, max(at, end - 1)
        k = 0
        while len(self.levels[k]) > 1 or k + 1 < len(self.levels):
            below = self.levels[k]
            low, high = low // FAN, high // FAN
            if k + 1 == len(self.levels):
                self.levels.append([])
            above = self.levels[k + 1]
            last = high + 1 if same else -(-len(below) // FAN)
            above[low:(last if same else len(above))] = [
                sum(below[i * FAN:(i + 1) * FAN]) for i in range(low, last)]
            k += 1
            if not same and len(above) <= 1:
                del self.levels[k + 1:]
                break


_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])")


def segments(text: str, size: int = SEGMENT) -> list[int]:
    """Where segments begin: after at least ``size`` characters, before a space or
    line feed that follows a character that is not white space."""
    out, at = [0] if text else [], 0
    while m := _CUT.search(text, at + size):
        at = m.start()
        if at >= len(text):
            break
        out.append(at)
    return out


def parts(text: str, starts: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def token_counts(encode: ChunkEncoder, texts: list[str]) -> list[int]:
    if not texts:
        return []
    _, at = encode.encode(pa.array(texts, pa.large_string()))
    return (at[1:] - at[:-1]).tolist()


class CountedText:
    """A text, its segments and the tree of their token counts."""

    def __init__(self, text: str, encode: ChunkEncoder, starts: list[int] | None = None,
                 counts: list[int] | None = None):
        self.encode, self.text = encode, text
        self.starts = segments(text) if starts is None else starts
        self.tree = SumTree(token_counts(encode, parts(text, self.starts)) if counts is None else counts)
        self.reencoded = 0

    @property
    def total(self) -> int:
        return self.tree.total

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` by ``new``."""
        starts, text = self.starts, self.text
        # One character of context on either side decides whether a cut still stands.
        first = max(bisect_right(starts, max(start - 1, 0)) - 1, 0)
        last = bisect_right(starts, end)
        right = starts[last] if last < len(starts) else len(text)
        left = starts[first] if starts else 0
        part = text[left:start] + new + text[end:right]
        shift = len(new) - (end - start)
        self.text = text[:start] + new + text[end:]
        inside = [left + x for x in segments(part)]
        self.starts = starts[:first] + inside + [x + shift for x in starts[last:]]
        ends = [*(x - left for x in inside[1:]), len(part)]
        leaves = token_counts(self.encode, [part[x - left:b] for x, b in zip(inside, ends)])
        self.tree.replace(first, last, leaves)
        self.reencoded += len(leaves)


def counted(texts: list[str], encode: ChunkEncoder) -> list[CountedText]:
    """The texts with their trees; the segments of all are encoded in one call."""
    starts = [segments(t) for t in texts]
    counts = token_counts(encode, [p for t, s in zip(texts, starts) for p in parts(t, s)])
    out, at = [], 0
    for text, s in zip(texts, starts):
        out.append(CountedText(text, encode, s, counts[at:at + len(s)]))
        at += len(s)
    return out


def applied(doc: CountedText, edits: list[tuple[int, int, str]]) -> tuple[int, int, int, int, int]:
    """(tokens before, edits made, segments, segments encoded again, tokens after)."""
    text, before, n_segments = doc.text, doc.total, len(doc.starts)
    made, shift, reached = 0, 0, 0
    for start, end, new in edits:
        start, end = min(start, len(text)), min(end, len(text))
        if start < reached:
            continue
        doc.edit(start + shift, end + shift, new)
        shift += len(new) - (end - start)
        reached, made = max(end, start), made + 1
    return before, made, n_segments, doc.reencoded, doc.total


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that hide addresses, numbers and keys, in order of place."""
    found = [(m.start(), m.end(), new) for pattern, new in _REDACTIONS for m in pattern.finditer(text)]
    return sorted(found)


_REDACTIONS = [(re.compile(p), new) for p, new in REDACTIONS]


def _edit_list(edits: list[dict] | None) -> list[tuple[int, int, str]]:
    kept = [(e["start"], e["end"], e["text"] or "") for e in edits or () if e is not None
            and e["start"] is not None and e["end"] is not None and 0 <= e["start"] <= e["end"]]
    return sorted(kept, key=lambda e: e[0])


def _mark(text: Column) -> Column:
    """A hash that tells an id's texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def trees(docs: DataFrame, vocabulary: str, added_tokens: bool = False) -> DataFrame:
    """(doc_id, mark, starts, counts): each text's segments and their token counts, to be kept as a table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, True, added_tokens)
        for batch in slices(batches):
            found = counted([t or "" for t in batch.column(2).to_pylist()], encode)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_tree_columns(found)],
                                             ["doc_id", "mark", "starts", "counts"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(text).alias("mark"), text.alias("text")) \
        .mapInArrow(count, TREES)


def _tree_columns(found: list[CountedText]) -> list[pa.Array]:
    return [pa.array([d.starts for d in found], pa.list_(pa.int32())),
            pa.array([d.tree.levels[0] for d in found], pa.list_(pa.int64()))]


def edit_counts(docs: DataFrame, vocabulary: str, added_tokens: bool = False, kept: DataFrame | None = None,
                with_trees: bool = False) -> DataFrame:
    """Token counts of (doc_id, text, edits) before and after the edits.

    ``edits``: array of (start, end, text) by character.  Without the column,
    the edits are the text's redactions.  ``kept``: trees of an earlier call or
    of ``trees``; a text that has one there is not encoded again, only what its
    edits touch (``n_encoded`` segments in all).  ``with_trees`` adds the edited
    ``text`` and its tree (``mark``, ``starts``, ``counts``), to be kept in turn.
    """
    given, known = "edits" in docs.columns, kept is not None
    name = {x: i for i, x in enumerate(["doc_id", "text", *(["edits"] if given else []), *(["starts", "counts"] if known else [])])}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, True, added_tokens)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            lists = map(_edit_list, batch.column(name["edits"]).to_pylist()) if given else map(redactions, texts)
            have = batch.column(name["starts"]).to_pylist() if known else [None] * len(texts)
            new = iter(counted([t for t, s in zip(texts, have) if s is None], encode))
            held = batch.column(name["counts"]).to_pylist() if known else have
            found = [next(new) if s is None else CountedText(t, encode, s, n) for t, s, n in zip(texts, have, held)]
            out = [applied(doc, edits) for doc, edits in zip(found, lists)]
            cols = [pa.array([o[k] for o in out], pa.int64()) for k in range(5)]
            delta = pa.array([o[4] - o[0] for o in out], pa.int64())
            encoded = pa.array([o[3] + (o[2] if s is None else 0) for o, s in zip(out, have)], pa.int64())
            more = [pa.array([d.text for d in found], pa.string()), *_tree_columns(found)] if with_trees else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, delta, encoded, *more], names)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if given:
        columns.append(F.col("edits").cast(EDITS).alias("edits"))
    rows = docs.select(*columns)
    if known:
        key = ["_id", "_null", "_mark"]
        by = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()]
        table = (kept.select(*[c.alias(k) for c, k in zip([*by, F.col("mark")], key)], "starts", "counts").dropDuplicates(key))
        rows = rows.withColumns(dict(zip(key, [*by, _mark(F.col("text"))]))).join(table, key, "left").select(*name)
    schema = COUNTS + ", n_encoded long" + (", text string, starts array<int>, counts array<long>" if with_trees else "")
    names = [c.split()[0] for c in schema.split(", ")]
    found = rows.mapInArrow(count, schema)
    return found.withColumn("mark", _mark(F.col("text"))) if with_trees else found
