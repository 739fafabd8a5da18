import hashlib
import random
import re

import pytest

from refinery.llm import decontaminate as d

from .helpers import docs, table, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    """(n_words, n_hit, items) of each document, by looking at every place."""
    out = []
    for doc_id, text in rows:
        w = split(text)
        hit, found = set(), set()
        for item, it in items:
            v = split(it)
            n = min(10, len(v))
            spans = {tuple(v[s:s + n]) for s in range(len(v) - n + 1)} if n else set()
            for s in range(len(w) - n + 1) if n else ():
                if tuple(w[s:s + n]) in spans:
                    hit.update(range(s, s + n))
                    if item is not None:
                        found.add(item)
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.choice([0, 1, 2, 3, 5, 6, 9, 10, 11, 30]), 60)) for i in range(12)]
    items += [(3, words(rng, 14, 60)), (None, words(rng, 12, 60)), (20, None), (21, "... ;; "), (22, "a a a a a a a a a a a a")]
    rows = []
    for i in range(40):
        parts = [words(rng, rng.randrange(0, 40), 60)]
        if rng.random() < 0.7:
            v = split(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(v) - 8))
            parts += [", ".join(x.upper() for x in v[a:a + rng.randrange(8, 20)]), words(rng, 5, 60)]
        rows.append((i, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, " .,- "), (None, "a " * 15), (5, rows[5][1]), (103, "b " + "a " * 12 + "é a")]
    return rows, items


@pytest.mark.parametrize("limit", [d.INDEX_WORDS, 0])
def test_as_brute_force(spark, monkeypatch, limit):
    """With the index sent to tasks, and by joins."""
    monkeypatch.setattr(d, "INDEX_WORDS", limit)
    for seed in (1, 2):
        rows, items = case(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert table(d.report(docs(spark, rows, extra=True), bench)) == brute(rows, items)


@pytest.mark.parametrize("limit", [d.INDEX_WORDS, 0])
def test_clean_keeps_the_rest(spark, monkeypatch, limit):
    monkeypatch.setattr(d, "INDEX_WORDS", limit)
    rows, items = case(3)
    rows = [r for r in rows if r[0] is not None]
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = d.clean(docs(spark, rows), bench)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(b[0] for b in brute(rows, items) if not b[5])


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert table(d.report(docs(spark, [(1, "a b")]), bench))[0][:4] == (1, 2, 0, 0)
    assert d.report(docs(spark, []), spark.createDataFrame([(1, "x y")], "item_id long, text string")).count() == 0


def test_every_shared_span_is_kept():
    """Two texts that share w + k - 1 words keep the same k-gram of them."""
    import numpy as np

    rng = random.Random(5)
    for length in range(1, 11):
        k, w = d.shape(length)
        span = [rng.getrandbits(60) + 1 for _ in range(length)]
        kept = []
        for _ in range(2):
            text = [rng.getrandbits(60) + 1 for _ in range(30)] + span + [rng.getrandbits(60) + 1 for _ in range(30)]
            kept.append(set(d.winnow(np.array(text, np.uint64), k, w)[1].tolist()))
        inside = set(d.kgrams(np.array(span, np.uint64), k).tolist())
        assert kept[0] & kept[1] & inside


def test_query_against_its_oracle(spark):
    """Whole tables, against DuckDB."""
    import duckdb

    from refinery.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    found = con.execute(ORACLE["op1_decontamination"])
    columns = [c[0] for c in found.description]
    df = QUERIES["op1_decontamination"](spark, sf)
    assert df.columns == columns
    rows = sorted(found.fetchall())
    assert sum(r[-1] for r in rows) > 10
    assert sorted(tuple(r) for r in df.collect()) == rows
