"""Letter junk and unlearned languages are rejected, short clean texts stay."""

import random

from refinery.llm import language

from .helpers import docs, ship

FOREIGN = [
    "il governo ha annunciato che le nuove misure saranno approvate dal parlamento nella prossima settimana",
    "de regering heeft aangekondigd dat de nieuwe maatregelen volgende week door het parlement worden goedgekeurd",
    "rząd ogłosił że nowe środki zostaną zatwierdzone przez parlament w przyszłym tygodniu",
    "hallitus ilmoitti että uudet toimet hyväksytään eduskunnassa ensi viikolla ja sen jälkeen",
    "правительство объявило что новые меры будут одобрены парламентом на следующей неделе"]


def test_planted_junk_and_short_texts(spark):
    ship(spark)
    rng = random.Random(1)
    clean = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(clean)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
                     for _ in range(n)) for n in (20, 40, 80, 300) for _ in range(25)]
    texts = [r.text for r in clean.filter(language.held_out()).select("text").limit(1000).collect()]
    short = [" ".join(t.split()[:n]) for t in texts for n in (2, 4, 8)]
    share = {}
    for name, group in (("clean", texts), ("short", short), ("junk", junk), ("foreign", FOREIGN)):
        share[name] = language.accepted(docs(spark, list(enumerate(group))), model).count() / len(group)
    print(share)
    assert share["clean"] > 0.985 and share["short"] > 0.985
    assert share["junk"] < 0.02 and share["foreign"] == 0


def test_few_rows_set_no_bar():
    bars = language.fit_bars({(0, 0): [0.9] * 20, (1, 0): [0.1, *[0.5] * 99]}, 2)
    assert bars[0, 0] == 0 and bars[1, 0] == 0.5 and language.fit_bars({(0, 0): [0.9] * 99}, 2)[0, 0].round(6) == 0.75 and not bars[:, 1].any()


def test_bars_come_from_all_rows(spark):
    """The same bars as from all scores at once, and scores of every row that was not learned from."""
    ship(spark)
    rng = random.Random(2)
    rows = [(k, x, rng.randrange(1 << language.SCORE_BITS) >> rng.randrange(3)) for k, x, n in
            ((0, 0, 5000), (1, 0, 33), (1, 1, 32), (2, 1, 700)) for _ in range(n)] + [(3, 1, 7)] * 400
    table = spark.createDataFrame(rows, "cut int, language int, key long")
    found = {}
    for k, x, key in rows:
        found.setdefault((k, x), []).append(key / (1 << language.SCORE_BITS))
    assert (language.fit_table_bars(table, 2) == language.fit_bars(found, 2)).all()
    assert not language.fit_table_bars(table.limit(0), 2).any()

    labelled = spark.createDataFrame([(i, "abcd " * 20, "en" if i % 2 else "fr") for i in range(6000)],
                                     "doc_id long, text string, lang string")
    seen, scores = [], language.bar_scores
    language.bar_scores = lambda docs, model, learned: seen.append((docs.count(), len(learned))) or scores(docs, model, learned)
    try:
        language.train(labelled)
    finally:
        language.bar_scores = scores
    (rows_, learned), = seen
    assert rows_ == labelled.filter(~language.held_out()).count() and learned < language.SAMPLE_ROWS < rows_
