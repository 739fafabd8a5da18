"""The corpus pipeline on a small table with planted cases, and the entry's registrations."""

import random

import corpus_pipeline
from refinery.llm import best_fit, decontaminate, language, simhash
from refinery.llm.queries import QUERIES, WORD_BPE

from .helpers import DOCS, docs, table, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(rng):
    """(documents, benchmark, ids that go at each stage)."""
    def text(lang, n):
        common = {"en": "the and of to in is that it was for", "fr": "le la les des une est dans que pour avec"}[lang].split()
        return " ".join(rng.choice(common) if rng.random() < 0.5 else f"{lang}{rng.randrange(500):x}" for _ in range(n))

    rows = [(i, text("en" if i % 2 else "fr", rng.randrange(40, 200)), "en" if i % 2 else "fr") for i in range(60)]
    bench = [(i, words(rng, 30, 5000)) for i in range(5)]
    letterless = [(100, "123 456 .. !", "en"), (101, None, "fr"), (102, "", "en")]
    copies = [(200, rows[3][1], "en"), (201, rows[3][1].upper(), "en"), (202, rows[4][1].replace(" ", "\n"), "fr")]
    leaks = [(300, rows[7][1] + " " + " ".join(bench[2][1].split()[5:20]), "en"), (301, bench[0][1] + " " + text("fr", 30), "fr")]
    return rows, letterless, copies, leaks, bench


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    rows, letterless, copies, leaks, bench = planted(rng)
    all_ = rows + letterless + copies + leaks
    docs(spark, all_).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r[0] for r in all_}
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], (letterless, copies, leaks)):
        df = stage(spark, df, str(tmp_path))
        assert df.columns == COLUMNS
        kept -= {r[0] for r in gone}
        assert {r.doc_id for r in df.collect()} == kept, name
    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in placed} == kept == {r[0] for r in rows}
    ends = {}
    for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= best_fit.CAPACITY


def test_run_as_its_operators(spark):
    """run() over a given table, against the operators' own results one after another."""
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs(spark, [])
    kept = language.accepted(df)
    first = {r.doc_id for r in simhash.components(kept).collect() if r.doc_id == r.component_id}
    hit = {r.doc_id for r in decontaminate.report(df, bench).collect() if r.contaminated}
    expected = table(best_fit.pieces(df.filter(df.doc_id.isin(sorted(first - hit))), WORD_BPE).drop("row"))
    found = corpus_pipeline.run(spark, sf)
    assert table(found.select("doc_id", "piece", "start", "length", "ids_crc32")) == expected


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_them():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
