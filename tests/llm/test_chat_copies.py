"""Repeated, null and crowded turns of transcripts."""

import numpy as np
from pyspark.sql import functions as F

from refinery.llm import chat_parse as c
from refinery.llm.common import ship, stored

ROW = "conv_id long, turn long, role string, text string"


def lines_of(spark, rows):
    ship(spark)
    return stored(c.observed(c.transcripts(spark.createDataFrame(rows, ROW))), "lines")


def _counts(model):
    """What the steps were learned from, without the 0.05 that each is given."""
    p = np.exp(model.step)
    return 0.05 * p / p.min(axis=1, keepdims=True) - 0.05


def test_copies_weigh_once_each(spark):
    """A conversation of k copies counts k times, and no pair of copies is made."""
    rows = [(7, i, ("user", "assistant")[i % 2], f"some words {i}") for i in range(6)]
    once, often = (_counts(c.train(lines_of(spark, rows * k))) for k in (1, 50))
    assert once.sum() > 5 and np.allclose(often, 50 * once)
    kinds = spark.createDataFrame([(1, t, k, 4, False, 1) for t in (0, 1) for k in range(50)],
                                  "conv_id long, turn long, copy long, role int, led boolean, last int")
    found = c.followed(kinds).collect()
    assert len(found) == 1 and found[0].n == 50


def test_blocks_have_a_bounded_number_of_lines(spark):
    rows = [(1, None, "user", "x")] * 700 + [(None, 3, "user", "a\nb")] * 700 + [(2, 0, "user", "long\n" * 3000)]
    rows += [(3, i, "user", "q") for i in range(200)]
    lines = lines_of(spark, rows)
    found = c.blocks(lines).select("conv_id", "block", F.size("seen").alias("n")).collect()
    assert sum(r.n for r in found) == lines.count()
    assert max(r.n for r in found) <= c.BLOCK_LINES
    assert len({r.block for r in found}) == len(found)


def test_hot_conversation_as_one_walk(spark):
    """Blocks of copies, null turns and long texts against one walk over each conversation."""
    rows = [(1, None, "user", f"x {i % 3}") for i in range(150)] + [(1, 4, "assistant", "a\n\nb: c?")] * 300
    rows += [(None, i % 2, ("user", "assistant")[i % 2], "word\n" * (i % 5)) for i in range(300)]
    lines = lines_of(spark, rows)
    model, found = c.train(lines), {}
    for r in c.decode(lines, model).orderBy("conv_id", "turn", "said", "copy", "pos").collect():
        found.setdefault(r.conv_id, []).append(r)
    assert sum(map(len, found.values())) == lines.count()
    for own in found.values():
        assert [(r.block, r.place) for r in own] == sorted((r.block, r.place) for r in own)
        path = c.walk(np.array([r.seen for r in own]), model, -1, None)
        assert [r.role_pred for r in own] == [c.ROLES[s // 4] for s in path]
        assert [r.turn_no for r in own] == list(np.maximum(np.cumsum((path % 4 == 0) | (path % 4 == 3)) - 1, 0))


def test_only_marked_lines_lose_a_marker(spark):
    lines = spark.createDataFrame(
        [(1, 0, 0, "User: hi", True, 2), (1, 0, 1, "Answer: 42", False, 3)],
        "conv_id long, turn_no long, place int, line string, is_marked boolean, symbol int").withColumns(
        {"block": F.lit(0), "role_pred": F.lit("user"), "is_blank": F.lit(False)})
    assert [r.text for r in c.canonical(lines).collect()] == ["<|user|>\nhi\nAnswer: 42\n<|end|>"]
