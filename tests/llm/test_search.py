"""Nearest neighbours, token counts after edits, transcripts."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from refinery.llm import chat_parse as c
from refinery.llm import edit_counts as e
from refinery.llm import neighbours as n
from refinery.llm.common import ship, stored
from refinery.llm.tokens import ChunkEncoder

from .helpers import SF, docs, table

BYTE = public_tokenizers.path("byte_bpe_50k.json")


# ---- neighbours -----------------------------------------------------------------------

def brute(rows, every, top):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and not any(x is None or not math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            s = sorted((-float((v * w).sum() / (math.sqrt((v * v).sum()) * math.sqrt((w * w).sum()))), j)
                       for j, w in ok if j != i)
            out[i] = [(j, -x) for x, j in s[:top]]
    return out


def test_exact_where_all_parts_are_probed(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(n, "PART_ROWS", 40)
    monkeypatch.setattr(n, "CELL_ROWS", 30)
    monkeypatch.setattr(n, "CELL_QUERIES", 3)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # a third of a part is one vector
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [None] + [1.0] * 5), (304, [float("nan")] + [1.0] * 5),
             (305, [float("inf")] * 6), (None, [1.0] * 6), (306, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("part", F.lit("clash"))
    found = {}
    for r in n.nearest(df, every=20, top=5, probes=100).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute(rows, 20, 5)
    assert found.keys() == expected.keys()
    for q, best in expected.items():
        assert [x[0] for x in found[q]] == [1, 2, 3, 4, 5]
        assert [x[1] for x in found[q]] == [x[0] for x in best]
        assert [x[2] for x in found[q]] == pytest.approx([x[1] for x in best], abs=1e-12)


def test_recall(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(n, "PART_ROWS", 100)
    table_ = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(1200)
    rows = [(r.vec_id, list(r.embedding)) for r in table_.collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute(rows, 20, 5)
    found = {}
    for r in n.nearest(df, every=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & {x[0] for x in best}) for q, best in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.9


def test_few_or_no_vectors(spark):
    ship(spark)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert n.nearest(empty).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in n.nearest(two).collect()] == [(0, 1, 1)]


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = n.unit(rng.normal(size=(600, 8)) + 3 * rng.normal(size=(1, 8)))
    part = n.balanced_parts(x, n.neighbour_graph(x), 6)
    assert np.bincount(part, minlength=6).max() <= math.ceil(1.1 * 100)


# ---- edits -----------------------------------------------------------------------------

def test_counts_as_if_encoded_anew(spark):
    encode = ChunkEncoder(BYTE, True)
    full = lambda t: len(encode.whole(t)) // 4
    rng = random.Random(1)
    alphabet = " \n\tabé'1.s"
    for _ in range(1500):
        doc = e.CountedText("".join(rng.choice(alphabet) for _ in range(rng.randrange(1500))), encode)
        assert doc.total == full(doc.text)
        for _ in range(3):
            a = rng.randint(0, len(doc.text))
            b = rng.randint(a, min(len(doc.text), a + rng.choice([0, 5, 400])))
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 3, 600])))
            old = doc.text
            doc.edit(a, b, new)
            assert doc.text == old[:a] + new + old[b:]
            assert doc.total == full(doc.text) == sum(doc.tree.levels[0])


def test_only_touched_segments_are_encoded():
    encode = ChunkEncoder(BYTE, True)
    doc = e.CountedText("some words of a text. " * 2000, encode)
    doc.edit(20_000, 20_004, "other")
    assert len(doc.starts) > 100 and doc.reencoded <= 3


def test_tree_of_sums():
    rng = random.Random(2)
    leaves = [rng.randrange(9) for _ in range(300)]
    tree = e.SumTree(list(leaves))
    for _ in range(400):
        a = rng.randint(0, len(leaves))
        b = rng.randint(a, min(len(leaves), a + 20))
        new = [rng.randrange(9) for _ in range(rng.choice([b - a, rng.randrange(30)]))]
        leaves[a:b] = new
        tree.replace(a, b, new)
        assert tree.total == sum(leaves)
        again = e.SumTree(list(leaves))
        assert tree.levels == again.levels


def test_given_edits_and_odd_rows(spark):
    encode = ChunkEncoder(BYTE, True)
    full = lambda t: len(encode.whole(t)) // 4
    rows = [(1, "one two three", [(4, 7, "2"), (0, 3, "uno"), (1, 2, "skipped")]), (2, None, [(0, 0, "new")]), (3, "", None),
            (4, "abc", []), (5, "abc", [(None, 2, "x"), (2, 1, "x"), (1, 99, "z"), None]), (None, "x y", [(3, 3, "!")]), (4, "abc", [])]
    df = docs(spark, []).sparkSession.createDataFrame(rows, f"doc_id long, text string, edits {e.EDITS}")
    found = table(e.edit_counts(df, BYTE).select("doc_id", "n_tokens_before", "n_edits", "n_tokens_after"))
    after = [(1, "one two three", 2, "uno 2 three"), (2, "", 1, "new"), (3, "", 0, ""), (4, "abc", 0, "abc"), (5, "abc", 1, "az"),
             (None, "x y", 1, "x y!"), (4, "abc", 0, "abc")]
    assert found == sorted([(d, full(a), k, full(b)) for d, a, k, b in after], key=repr)
    assert e.edit_counts(df.limit(0), BYTE).count() == 0


def test_kept_trees_save_the_encoding(spark):
    """A second call over a kept table encodes what its edits touch, a third over its own trees too."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 4)}" for _ in range(600))) for i in range(12)]
    rows += [(None, rows[0][1]), (3, rows[4][1]), rows[5], (50, None), (51, "")]
    df = docs(spark, rows, extra=True)

    def edits(at):
        return F.when(F.col("text").isNotNull(), F.array(F.struct(F.lit(at).alias("start"), F.lit(at + 5).alias("end"), F.lit("new one").alias("text"))))

    first = df.withColumn("edits", edits(700))
    plain = e.edit_counts(first, BYTE)
    kept = stored(e.trees(df, BYTE), "trees")
    assert kept.count() == len(rows)
    second = stored(e.edit_counts(first, BYTE, kept=kept, with_trees=True), "second")
    columns = [c for c in plain.columns if c != "n_encoded"]
    assert table(second.select(columns)) == table(plain.select(columns))
    total = {n: d.agg(F.sum("n_encoded")).first()[0] for n, d in (("plain", plain), ("second", second))}
    assert total["second"] == plain.agg(F.sum("n_reencoded")).first()[0] < total["plain"] / 5
    # The edited texts with their trees, edited again.
    again = second.select("doc_id", "text").withColumn("edits", edits(1500))
    third = e.edit_counts(again, BYTE, kept=second)
    sums = ["doc_id", "n_tokens_before", "n_edits", "n_tokens_after"]  # an edited tree may be cut in other places
    assert table(third.select(sums)) == table(e.edit_counts(again, BYTE).select(sums))
    assert third.agg(F.sum("n_encoded")).first()[0] == third.agg(F.sum("n_reencoded")).first()[0]
    # Texts that the table does not hold are encoded whole.
    other = df.withColumn("text", F.concat(F.lit("x "), "text")).withColumn("edits", edits(3))
    assert table(e.edit_counts(other, BYTE, kept=kept)) == table(e.edit_counts(other, BYTE))


def test_query_as_brute_force(spark):
    """Every document of the table, redacted and counted anew."""
    ship(spark)
    encode = ChunkEncoder(BYTE, True)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in e.edit_counts(df, BYTE).collect()}
    for r in df.collect():
        out, at, made = [], 0, 0
        for a, b, new in e.redactions(r.text):
            if a >= at:
                out += [r.text[at:a], new]
                at, made = b, made + 1
        text = "".join(out) + r.text[at:]
        own = found[r.doc_id]
        assert (own.n_tokens_before, own.n_edits, own.n_tokens_after) == (
            len(encode.whole(r.text)) // 4, made, len(encode.whole(text)) // 4)


# ---- transcripts -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def lines(spark):
    ship(spark)
    from refinery.llm.common import stored

    return stored(c.observed(c.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))), "lines")


def test_roles_are_recovered(lines):
    decoded = c.decode(lines, c.train(lines.filter(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 != 0)))
    rows = decoded.select("conv_id", "role", "role_pred").collect()
    held = [r for r in rows if zlib.crc32(str(r.conv_id).encode()) % 5 == 0]
    assert len(rows) == lines.count() and len(held) > 100
    assert sum(r.role == r.role_pred for r in held) / len(held) > 0.98


def viterbi(seen, model):
    score, back = model.start + model.show[:, seen[0]], []
    for o in seen[1:]:
        ways = score[:, None] + model.step
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + model.show[:, o]
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_blocks_as_one_walk(spark, lines, monkeypatch):
    """Viterbi by blocks of two turns against Viterbi over the whole conversation."""
    monkeypatch.setattr(c, "BLOCK_TURNS", 2)
    model = c.train(lines)
    found = {}
    for r in c.decode(lines, model).orderBy("conv_id", "turn", "copy", "pos").collect():
        found.setdefault(r.conv_id, []).append((r.seen, r.role_pred, r.turn_no))
    assert max(len(v) for v in found.values()) > 10
    for rows in found.values():
        path = viterbi([r[0] for r in rows], model)
        assert [r[1] for r in rows] == [c.ROLES[s // 4] for s in path]
        begun = np.maximum(np.cumsum([s % 4 in (0, 3) for s in path]) - 1, 0)
        assert [r[2] for r in rows] == list(begun)


def test_rendered_turns(spark):
    """A conversation's turns come back with their roles and texts."""
    ship(spark)
    sf = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = {}
    for r in c.format_chats(sf).orderBy("conv_id", "turn_no").collect():
        found.setdefault(r.conv_id, []).append(r.text)
    truth = {}
    for r in sf.orderBy("conv_id", "turn").collect():
        truth.setdefault(r.conv_id, []).append(f"<|{r.role}|>\n{r.text.strip()}\n<|end|>")
    same = sum(found[k] == truth[k] for k in truth)
    assert found.keys() == truth.keys() and same / len(truth) > 0.95


def test_odd_rows(spark):
    ship(spark)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, None, "x"), (1, 0, "user", "hi"), (None, 0, "user", "q?"),
            (None, None, "tool", "a\n\nb"), (2, 0, "system", ""), (3, 500, "user", "long\n" * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = c.observed(c.transcripts(df))
    found = c.format_chats(df.withColumn("block", F.lit(1)).withColumn("seen", F.lit("clash"))).collect()
    assert sum(r.n_lines for r in found) == lines.count()
    assert {r.conv_id for r in found} == {1, 2, 3, None}
    assert c.format_chats(df.limit(0)).count() == 0
