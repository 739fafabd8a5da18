"""Transcript parsing: roles of lines by a hidden Markov model, then canonical turns.

A state is a role and a place in its turn: its first line with a marker, a
later line, the blank line before a turn without marker, or the first line
after that.  A line shows a speaker marker (or none), whether it ends as a
question, and its length.  Frequencies on labelled transcripts give the
chances; Viterbi recovers the most probable states, and each recovered turn is
rendered as ``<|role|>``, its text, ``<|end|>``.

Viterbi runs over blocks of lines: a block is summed up by the best way from
each state before it to each state at its end, the blocks of a conversation
are chained, and then each block is walked again between its known ends.  Lines
are dealt to tasks by ranges of their whole order, and blocks are cut there by
count, so a conversation or a turn that holds a third of all rows is shared by
many tasks; one task only sees a small matrix for each of its blocks.

Defined results.  Null text: an empty line.  Null or unknown role: not learned
from.  Null conv_id: one conversation.  Null turn: before all others.  Rows of
one turn stand in the order of a hash of text and role; repeated rows are lines
of their own.  In training each copy of a turn is followed by the copies of the
next turn in equal shares, so a turn of k copies weighs k.  A marker is taken
off the lines that were found to be marked, other lines keep all they say.
Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stored

ROLES = ("system", "user", "assistant")
PLACES = ("marked", "later", "blank", "opened")
#: A state is role * 4 + place.  A turn begins with a marked line, or with a blank one and an opened one.
STATES = len(ROLES) * len(PLACES)

#: Words that mark a speaker, by role.
MARKERS = {
    "system": ("system", "context", "setup"),
    "user": ("user", "human", "question", "q", "customer", "instruction", "prompt"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "response"),
}
#: Styles in which the query writes transcripts: markers for system, user and assistant.
STYLES = (("System:", "User:", "Assistant:"), ("SYSTEM:", "Human:", "AI:"), ("Context:", "Q:", "A:"),
          ("<|system|>", "<|user|>", "<|assistant|>"), ("### System", "### Instruction", "### Response"),
          ("[setup]", "[customer]", "[agent]"))
#: One turn in so many is written without a marker, after a blank line.
UNMARKED = 8
#: Rows of ``conversations`` and lines that a block has at most.
BLOCK_TURNS = 64
BLOCK_LINES = 256
#: Blocks of a batch.
BATCH_BLOCKS = 256
FOLDS = 5

SYMBOLS = ("none", *ROLES, "blank")
LENGTHS = (40, 160)


def _pattern(role: str) -> str:
    """A marker at the start of a line: ``word:``, ``<|word|>``, ``[word]`` or ``### word``."""
    w = f"(?:{'|'.join(MARKERS[role])})"
    return rf"(?i)^\s*(?:\**{w}\**\s*:\**|<\|?{w}\|?>|\[{w}\]|#{{1,4}}\s*{w}\b:?)\s*"


def symbol() -> Column:
    """Number in SYMBOLS of the marker that ``line`` begins with."""
    out = F.when(F.trim("line") == "", F.lit(4))
    for i, role in enumerate(ROLES):
        out = out.when(F.col("line").rlike(_pattern(role)), F.lit(i + 1))
    return out.otherwise(F.lit(0))


def content() -> Column:
    """``line``, without its marker if it was found to be marked."""
    out = F.col("line")
    for i, role in enumerate(ROLES):
        out = F.when(F.col("is_marked") & (F.col("symbol") == i + 1), F.regexp_replace("line", _pattern(role), "")).otherwise(out)
    return out


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, said, copy, pos, role, line): turns written out as lines with speaker markers.

    The style goes by conversation; every ``UNMARKED``-th turn, by hash, has a
    blank line in place of its marker.  ``said`` is a hash of text and role,
    ``copy`` a number of each row's own.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    marker = F.lit("")
    for i, role in enumerate(ROLES):
        names = F.array(*(F.lit(s[i]) for s in STYLES))
        marker = F.when(F.col("role") == role, F.element_at(names, style.cast("int") + 1)).otherwise(marker)
    unmarked = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(UNMARKED)) == 0) | (marker == "")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    written = F.when(unmarked, F.concat(F.array(F.lit("")), lines)).otherwise(
        F.concat(F.array(F.concat(marker, F.lit(" "), F.element_at(lines, 1))), F.slice(lines, 2, 1 << 30)))
    # The copy's number is given before its lines are dealt out.
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "copy", F.monotonically_increasing_id())
    return numbered.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64("text", "role").alias("said"), "copy", "role",
        F.posexplode(written).alias("pos", "line"))


def observed(lines: DataFrame) -> DataFrame:
    """Adds ``symbol`` and ``seen``, the number of what the model sees of a line."""
    n = F.length("line")
    size = F.when(n < LENGTHS[0], 0).when(n < LENGTHS[1], 1).otherwise(2)
    asks = F.rtrim("line").endswith("?").cast("int")
    return lines.withColumn("symbol", symbol()).withColumn("seen", F.col("symbol") * 6 + asks * 3 + size)


@dataclass
class Chances:
    """Logarithms: first state, state to state, state to what is seen."""

    start: np.ndarray
    step: np.ndarray
    show: np.ndarray


def train(lines: DataFrame) -> Chances:
    """Smoothed frequencies of labelled, observed lines (conv_id, turn, pos, role, seen).

    Turns follow one another by an equi-join on the next turn's number, after
    the copies of a turn that are alike have been counted.
    """
    state = F.coalesce(*(F.when(F.col("role") == r, F.lit(4 * i)) for i, r in enumerate(ROLES)))
    known = lines.filter(F.col("role").isin(*ROLES)).select(
        "conv_id", "turn", "copy", "pos", "seen", state.alias("role"),
        (F.col("symbol") == 4).alias("blank")).filter(F.col("conv_id").isNotNull())
    lead = known.groupBy("conv_id", "turn", "copy", "role").agg(
        F.coalesce(F.max(F.when(F.col("pos") == 0, F.col("blank"))), F.lit(False)).alias("led"),
        F.count(F.lit(1)).alias("n"))
    lead = (lead.withColumn("later", F.greatest(F.col("n") - F.when(F.col("led"), 2).otherwise(1), F.lit(0)))
            .withColumn("last", F.when(F.col("later") > 0, 1).when(F.col("led"), 3).otherwise(0)))
    show = np.ones((STATES, len(SYMBOLS) * 6)) * 0.05
    place = (F.when(F.col("blank"), 2).when(F.col("pos") == 0, 0)
             .when((F.col("pos") == 1) & F.col("led"), 3).otherwise(1))
    for s, o, n in (known.join(lead, ["conv_id", "turn", "copy", "role"]).groupBy(
            (F.col("role") + place).alias("s"), "seen").count().collect()):
        show[s, o] += n
    step, start = np.ones((STATES, STATES)) * 0.05, np.ones(STATES) * 0.05
    for role, last, to, led, n in followed(lead).groupBy("role", "last", "next", "next_led").agg(F.sum("n")).collect():
        step[role + last, to + (2 if led else 0)] += n
    for role, led, turns, longer, more in lead.groupBy("role", "led").agg(
            F.count(F.lit(1)), F.count_if(F.col("later") > 0), F.sum(F.greatest(F.col("later") - 1, F.lit(0)))).collect():
        if led:
            step[role + 2, role + 3] += turns
        step[role + (3 if led else 0), role + 1] += longer
        step[role + 1, role + 1] += more
    for role, led, n in lead.filter("turn = 0").groupBy("role", "led").count().collect():
        start[role + (2 if led else 0)] += n
    return Chances(*(np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, step, show)))


def followed(lead: DataFrame) -> DataFrame:
    """(role, last, next, next_led, n): how often turns of (conv_id, turn, copy, role, led, last) follow one another.

    One row for each two kinds of neighbouring turns, however many copies they have.
    """
    kinds = lead.groupBy("conv_id", "turn", "role", "led", "last").agg(F.count(F.lit(1)).alias("n"))
    after = (lead.groupBy("conv_id", "turn", "role", "led").agg(F.count(F.lit(1)).alias("next_n"))
             .withColumn("share", F.col("next_n") / F.sum("next_n").over(W.partitionBy("conv_id", "turn")))
             .select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"),
                     F.col("led").alias("next_led"), "share"))
    return kinds.join(after, ["conv_id", "turn"]).select(
        "role", "last", "next", "next_led", (F.col("n") * F.col("share")).alias("n"))


def block_matrix(seen: np.ndarray, model: Chances) -> np.ndarray:
    """Best log chance of the lines from each state before them to each at their end."""
    best = None
    for o in seen:
        to = model.step + model.show[:, o][None, :]
        best = to if best is None else (best[:, :, None] + to[None, :, :]).max(axis=1)
    return best


def walk(seen: np.ndarray, model: Chances, before: int, end: int | None) -> np.ndarray:
    """The most probable states of the lines after state ``before`` (-1: none), the last being ``end``."""
    back = np.empty((len(seen), STATES), np.int8)
    score = model.start if before < 0 else model.step[before]
    score = score + model.show[:, seen[0]]
    for i in range(1, len(seen)):
        ways = score[:, None] + model.step
        back[i] = ways.argmax(axis=0)
        score = ways.max(axis=0) + model.show[:, seen[i]]
    out = np.empty(len(seen), np.int8)
    out[-1] = int(score.argmax()) if end is None else end
    for i in range(len(seen) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def blocks(lines: DataFrame) -> DataFrame:
    """(conv_id, block, copy, pos, seen): observed lines in order, a row for each block of them.

    Ranges of the whole order go to a task each, which cuts them at every new
    conversation, ``BLOCK_TURNS`` rows or ``BLOCK_LINES`` lines.  Blocks are
    numbered in order over all tasks.
    """
    parts = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = ["conv_id", "turn", "said", "copy", "pos"]
    most_turns, most_lines = BLOCK_TURNS, BLOCK_LINES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        number = TaskContext.get().partitionId() << 40
        conv, last, turns, block = None, None, 0, ([], [], [])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((
                    pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                ["conv_id", "block", "copy", "pos", "seen"])

        for batch in batches:
            for c, copy, pos, seen in zip(*(x.to_pylist() for x in batch.columns)):
                full = len(block[0]) == most_lines or (turns == most_turns and copy != last)
                if block[0] and (full or c != conv):
                    done.append((conv, number, *block))
                    number, turns, last, block = number + 1, 0, None, ([], [], [])
                    if len(done) == BATCH_BLOCKS:
                        yield batch_of(done)
                        done = []
                turns += copy != last
                conv, last = c, copy
                for to, x in zip(block, (copy, pos, seen)):
                    to.append(x)
        if block[0]:
            done.append((conv, number, *block))
        yield batch_of(done)

    return (lines.select(*ordered, "seen").repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered)
            .select("conv_id", "copy", "pos", "seen")
            .mapInArrow(cut, "conv_id long, block long, copy array<long>, pos array<int>, seen array<int>"))


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at, at[1:])]


def decode(lines: DataFrame, model: Chances) -> DataFrame:
    """Adds to observed lines ``role_pred`` and ``turn_no`` (from 0), ``is_blank`` and ``is_marked``
    by the state found, and the line's place (``block``, ``place``) in the order of all."""
    spark = lines.sparkSession
    shared = spark.sparkContext.broadcast(model)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cut = stored(blocks(lines), "line-blocks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # From no state at all, as if the conversation began here; then from each state.
            best = [np.vstack([walk_scores(seen, shared.value), block_matrix(seen, shared.value)]).ravel()
                    for seen in _lists(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.list_(pa.float64()))], ["conv_id", "block", "best"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(((c, b, m) for batch in batches for c, b, m in zip(
                *(x.to_pylist() for x in batch.columns))), itemgetter(0)):
            numbers, back, score = [], [], None
            for _, number, flat in rows:
                best = np.array(flat).reshape(STATES + 1, STATES)
                numbers.append(number)
                if score is None:
                    back.append(np.full(STATES, -1, np.int8))
                    score = best[0]
                else:
                    ways = score[:, None] + best[1:]
                    back.append(ways.argmax(axis=0).astype(np.int8))
                    score = ways.max(axis=0)
            end, ends, befores = int(score.argmax()), [], []
            for from_ in reversed(back):
                ends.append(end)
                end = int(from_[end])
                befores.append(end)
            yield pa.RecordBatch.from_pydict({
                "number": pa.array(numbers, pa.int64()), "before": pa.array(befores[::-1], pa.int32()),
                "end": pa.array(ends[::-1], pa.int32())})

    best = cut.select("conv_id", "block", "seen").mapInArrow(matrices, "conv_id long, block long, best array<double>")
    ends = (best.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block")
            .mapInArrow(chained, "number long, before int, end int"))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [walk(seen, shared.value, before, end) for seen, before, end in zip(
                _lists(batch.column(4)), batch.column(5).to_pylist(), batch.column(6).to_pylist())]
            inside = [np.cumsum((f % 4 == 0) | (f % 4 == 3)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([i.astype(np.int32) for i in inside], pa.list_(pa.int32())),
                 pa.array([int(i[-1]) for i in inside], pa.int64())],
                ["conv_id", "block", "copy", "pos", "state", "inside", "begun"])

    bounded = (cut.join(ends, F.col("block") == F.col("number"))
               .select("conv_id", "block", "copy", "pos", "seen", "before", "end"))
    found = stored(bounded.mapInArrow(
        states, "conv_id long, block long, copy array<long>, pos array<int>, state array<int>, inside array<int>, begun long"),
        "line-states")
    # Turns begun in the blocks before: one row a block.
    begun = found.select(F.col("block").alias("number"), F.coalesce(F.sum("begun").over(
        W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    numbered = found.join(begun, F.col("block") == F.col("number")).select(
        "block", "earlier", F.posexplode(F.arrays_zip("copy", "pos", "state", "inside")).alias("place", "x")).select(
        F.col("x.copy").alias("k"), F.col("x.pos").alias("p"), "block", "place",
        F.greatest(F.col("earlier") + F.col("x.inside") - 1, F.lit(0)).alias("turn_no"),
        F.element_at(F.array(*map(F.lit, ROLES)), F.floor(F.col("x.state") / 4).cast("int") + 1).alias("role_pred"),
        (F.col("x.state") % 4 == 2).alias("is_blank"), (F.col("x.state") % 4 == 0).alias("is_marked"))
    return lines.join(numbered, (F.col("copy") == F.col("k")) & (F.col("pos") == F.col("p"))).drop("k", "p")


def walk_scores(seen: np.ndarray, model: Chances) -> np.ndarray:
    """Best log chance of the lines, as a conversation's first, for each state at their end."""
    score = model.start + model.show[:, seen[0]]
    for o in seen[1:]:
        score = (score[:, None] + model.step).max(axis=0) + model.show[:, o]
    return score


def canonical(decoded: DataFrame) -> DataFrame:
    """(conv_id, turn_no, role, n_lines, text): the recovered turns, rendered."""
    lines = decoded.select("conv_id", "turn_no", "role_pred", F.struct(
        "block", "place", content().alias("line")).alias("x"), "is_blank")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n")
    return (lines.groupBy("conv_id", "turn_no").agg(
        F.max_by("role_pred", F.struct(~F.col("is_blank"), "x")).alias("role"),
        F.count(F.lit(1)).alias("n_lines"), joined.alias("body"))
        .select("conv_id", "turn_no", "role", "n_lines",
                F.concat(F.lit("<|"), "role", F.lit("|>\n"), F.btrim("body", F.lit(" \n\r\t")), F.lit("\n<|end|>")).alias("text")))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Transcripts of the conversations, parsed and rendered; learns from four folds of five, by conv_id."""
    lines = stored(observed(transcripts(conversations)), "transcript-lines")
    learn = lines.filter(F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS != 0)
    return canonical(decode(lines, train(learn)))
