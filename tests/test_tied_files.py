"""A few ties in a large wave: only the files that hold the tied keys are read whole to decide them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from refinery.operators.silver import SILVER_DATA_COLUMNS
from refinery.plans import upsert
from refinery.plans.store import TableStore
from refinery.schemas import SILVER
from refinery.session import fresh_workspace
from refinery.sources import eventlog
from refinery.sources.staged import load_bronze, read_bronze, read_placed

YEARS, EACH = range(2000, 2010), 200


def _bronze(spark, tmp_path, name, rows):
    f = tmp_path / f"{name}.jsonl"
    base = {"rating": 4, "text": "a", "asin": "A", "parent_asin": "P"}
    f.write_text("".join(json.dumps({**base, **r}) + "\n" for r in rows))
    out = f"{fresh_workspace(spark, 'tied ' + name)}/bronze"  # a blank: paths of files are escaped
    load_bronze(spark, str(f), out)
    return out


def _ms(year):
    return (year - 1970) * 31_557_600_000 + 86_400_000 * 40


@pytest.fixture(scope="module")
def waves(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("tied")
    many = [{"user_id": f"u{y}-{i}", "timestamp": _ms(y)} for y in YEARS for i in range(EACH)]
    ties = [{"user_id": "t", "timestamp": _ms(2003), "text": t, "title": u} for t in "xzy" for u in ("b", None, "c")]
    older = [{"user_id": "t", "timestamp": _ms(2001), "text": "zz"}]
    return _bronze(spark, tmp, "first", [{"user_id": "other", "timestamp": _ms(2002)}]), _bronze(spark, tmp, "wave", many + ties + older)


def _run(spark, waves):
    store = TableStore(spark, fresh_workspace(spark, "t-tied-files"))
    upsert.process_upsert(spark, waves[0], store)
    with eventlog.recording(spark, store.path("_events"), compress=False):
        r = upsert.process_upsert(spark, waves[1], store)
    expected = upsert.silver_source(read_bronze(spark, waves[1])).select(*SILVER_DATA_COLUMNS)
    got = store.read("silver", SILVER).filter("user_id <> 'other'").select(*SILVER_DATA_COLUMNS)
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0
    assert r.silver_actions["insert"] == len(YEARS) * EACH + 1
    history = eventlog.job_history(eventlog.read_events(spark, store.path("_events")))
    return [s["rows_read"] for s in history.filter(F.lower("query").contains("merge into silver (changed")).orderBy("start_time").collect()]


def test_a_tie_reads_the_files_of_its_key(spark, waves):
    reads = _run(spark, waves)
    assert len(reads) == 2 and reads[0] >= len(YEARS) * EACH
    # The tied key lies in two years' files; beside them the changes written so far are read, once or more.
    assert (reads[1] - 2 * EACH - 10) % (len(YEARS) * EACH + 1) == 0
    held = read_bronze(spark, waves[1]).count()
    two_years = read_placed(spark, waves[1], _files(spark, waves[1])).count()
    assert two_years == 2 * EACH + 10 and held == len(YEARS) * EACH + 10


def _files(spark, path):
    keys = spark.createDataFrame([("t", "A")], "user_id string, asin string")
    from refinery.sources.staged import files_of_keys
    files = files_of_keys(spark, path, keys, 10)
    assert len(files) == 2 and files_of_keys(spark, path, keys, 1) is None
    return files


@pytest.mark.parametrize("most", ["TIED_KEYS", "TIED_FILES"])
def test_more_ties_than_are_looked_up_read_all(spark, waves, monkeypatch, most):
    few = _run(spark, waves)[1]
    monkeypatch.setattr(upsert, most, 0)
    assert _run(spark, waves)[1] >= few + (len(YEARS) - 2) * EACH
