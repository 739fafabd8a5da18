"""clean() keeps the same rows whether the benchmark is indexed or joined."""

import random

import pytest

from refinery.llm import decontaminate

from .helpers import docs, words


@pytest.mark.parametrize("limit", [200_000, 0])
def test_null_and_repeated_ids(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", limit)
    rng = random.Random(1)
    bench = [(i, words(rng, 30, 5000)) for i in range(5)]
    clean = [(None, "a clean text of no id"), (1, "clean one"), (1, "clean one"), (2, None), (None, None), (3, "")]
    leaks = [(None, "x " + bench[0][1]), (1, bench[1][1] + " y"), (2, bench[2][1])]
    found = decontaminate.clean(docs(spark, clean + leaks, extra=True),
                                spark.createDataFrame(bench, "item_id long, text string"))
    assert found.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(clean, key=repr)
