"""Golden unit tests: one hand-written line per method difference."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest

from refinery.operators import gold as gold_ops
from refinery.operators import silver as silver_ops
from refinery.sources.staged import read_bronze
from refinery.spec import BATCH, CLEAN, UPSERT


def _rows(spark, golden_bronze, spec):
    df = silver_ops.extract(read_bronze(spark, golden_bronze[0]), spec)
    return [r.asDict() for r in df.collect()]


def _titles(rows):
    return sorted(r["review_title"][:20] for r in rows)


def test_bronze_load_counts_rejects(golden_bronze):
    _, load = golden_bronze
    assert load.loaded_rows == 30
    assert load.rejected_lines == 2


def test_clean_filters(spark, golden_bronze):
    rows = _rows(spark, golden_bronze, CLEAN)
    kept = set(_titles(rows))
    rejected = {"no asin", "no rating", "bad rating", "rating 0.9", "rating 5.1", "before 1996",
                "2024 end", "2025 start", "no ts", "empty text", "no text"}
    assert not kept & rejected
    # upper bound 2024-01-01 is included (V2), JSON-null keys pass (V4)
    assert {"2024 start", "asin null", "user null", "1996 start", "2023 end", "rating 1"} <= kept
    assert len(rows) == 19


def test_batch_form_excludes_2024(spark, golden_bronze):
    spec = BATCH  # full [1996, 2024) range
    rows = _rows(spark, golden_bronze, spec)
    assert "2024 start" not in _titles(rows)
    assert len(rows) == 18
    y1996 = _rows(spark, golden_bronze, BATCH.for_year(1996))
    assert _titles(y1996) == ["1996 start"]
    y2023 = _rows(spark, golden_bronze, BATCH.for_year(2023))
    assert _titles(y2023) == ["2023 end"]


def test_upsert_filters_and_dedupe(spark, golden_bronze):
    rows = _rows(spark, golden_bronze, UPSERT)
    titles = _titles(rows)
    assert "asin null" not in titles and "user null" not in titles      # V4 value test
    assert "2024 start" in titles and "2024 end" in titles                # V2 [1996, 2025)
    assert "dup old" not in titles and "dup new" in titles                # W1 newest
    assert "tie low" not in titles and "tie high" in titles               # D5 tie-break
    assert len(rows) == 16


def test_review_id_forms(spark, golden_bronze):
    clean = {r["user_id"]: r for r in _rows(spark, golden_bronze, CLEAN)}
    ups = {r["user_id"]: r for r in _rows(spark, golden_bronze, UPSERT)}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert clean["U01"]["review_id"] == md5("U01A011275350400000")          # V1
    assert ups["U01"]["review_id"] == md5("U01|A01|1275350400000")
    # JSON null asin: row kept with NULL asin and NULL id
    nulls = [r for r in clean.values() if r["review_title"] == "asin null"]
    assert nulls and nulls[0]["asin"] is None and nulls[0]["review_id"] is None


def test_defaults_differ(spark, golden_bronze):
    clean = {r["user_id"]: r for r in _rows(spark, golden_bronze, CLEAN)}
    ups = {r["user_id"]: r for r in _rows(spark, golden_bronze, UPSERT)}
    assert clean["U19"]["helpful_vote"] == 0 and ups["U19"]["helpful_vote"] is None    # V6
    for u in ("U20", "U21", "U23"):                                                     # V7
        assert clean[u]["has_images"] is None and ups[u]["has_images"] is False
    assert clean["U22"]["has_images"] is False and ups["U22"]["has_images"] is False
    assert clean["U11"]["has_images"] is True
    assert len(clean["U24"]["review_title"]) == 500 and len(ups["U24"]["review_title"]) == 500  # D2


def test_timestamp_keeps_millis(spark, golden_bronze):
    clean = {r["user_id"]: r for r in _rows(spark, golden_bronze, CLEAN)}
    assert clean["U24"]["review_ts"] == dt.datetime(2011, 3, 4, 5, 6, 7, 891000)
    assert clean["U12"]["review_ts"] == dt.datetime(2023, 12, 31, 23, 59, 59, 999000)


@pytest.mark.parametrize("spec,has_null_group,rounded", [(CLEAN, True, True), (UPSERT, False, False)])
def test_gold_forms(spark, golden_bronze, spec, has_null_group, rounded):
    silver = silver_ops.extract(read_bronze(spark, golden_bronze[0]), spec)
    gold = {r["parent_asin"]: r for r in gold_ops.aggregate(silver, spec).collect()}
    assert (None in gold) == has_null_group                                      # V11
    p7 = gold["P7"]
    assert p7["verified_count"] == 0 and p7["unverified_count"] == 0             # G6
    assert p7["reviews_with_images"] == 1
    p6 = gold["P6"]
    if spec is CLEAN:
        assert p6["total_reviews"] == 4 and p6["avg_rating"] == 3.5
    else:
        assert p6["total_reviews"] == 2 and p6["avg_rating"] == 4.5
    p5 = gold["P5"]
    if spec is CLEAN:
        assert p5["helpful_votes_sum"] == 5
    else:
        assert p5["helpful_votes_sum"] == 5  # NULL helpful votes add nothing
    assert rounded == spec.round_avg


def test_rounding_half_up(spark):
    from pyspark.sql import functions as F
    from refinery.functions.scalar import round_half_up
    df = spark.createDataFrame([(3.025,), (2.675,), (1.0 / 3,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [3.03, 2.68, 0.33]


def test_integer_casts_round_like_number_casts(spark, tmp_path):
    from refinery.session import fresh_workspace
    from refinery.sources.staged import load_bronze
    f = tmp_path / "frac.jsonl"
    f.write_text('{"rating":4,"text":"t","asin":"A","user_id":"U","timestamp":1275350400000.6,'
                 '"helpful_vote":2.5}\n'
                 '{"rating":4,"text":"t","asin":"B","user_id":"U","timestamp":"1275350400000",'
                 '"helpful_vote":"7"}\n')
    out = f"{fresh_workspace(spark, 'frac')}/bronze"
    load_bronze(spark, str(f), out)
    rows = {r.asin: r for r in silver_ops.extract(read_bronze(spark, out), CLEAN).collect()}
    assert rows["A"].helpful_vote == 3
    assert rows["A"].review_ts == dt.datetime(2010, 6, 1, 0, 0, 0, 1000)
    assert rows["B"].helpful_vote == 7 and rows["B"].review_ts == dt.datetime(2010, 6, 1)


def test_strict_mode_fails_on_bad_cast(spark, golden_bronze):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    lenient = silver_ops.extract(read_bronze(spark, golden_bronze[0]), CLEAN)
    assert lenient.count() == 19
    strict = silver_ops.extract(read_bronze(spark, golden_bronze[0]), CLEAN, strict=True)
    with pytest.raises((PySparkException, Py4JJavaError)) as e:
        strict.count()
    assert "rating" in str(e.value)


def test_out_of_range_timestamp_is_rejected_not_fatal(spark, tmp_path):
    from refinery.session import fresh_workspace
    from refinery.sources.staged import load_bronze
    f = tmp_path / "huge.jsonl"
    f.write_text('{"rating":4,"text":"t","asin":"A","user_id":"U","timestamp":1000000000000000000}\n'
                 '{"rating":4,"text":"t","asin":"B","user_id":"U","timestamp":1275350400000}\n')
    out = f"{fresh_workspace(spark, 'huge')}/bronze"
    load = load_bronze(spark, str(f), out)
    assert load.loaded_rows == 2
    rows = silver_ops.extract(read_bronze(spark, out), UPSERT).collect()
    assert [r.asin for r in rows] == ["B"]


NULL_FIELD_LINES = {
    "rating": '{"rating":null,"title":"n-rating","text":"t","asin":"A1","parent_asin":"P","user_id":"U1","timestamp":1275350400000}',
    "timestamp": '{"rating":3,"title":"n-ts","text":"t","asin":"A2","parent_asin":"P","user_id":"U2","timestamp":null}',
    "text": '{"rating":3,"title":"n-text","text":null,"asin":"A3","parent_asin":"P","user_id":"U3","timestamp":1275350400000}',
    "title": '{"rating":3,"title":null,"text":"t","asin":"A4","parent_asin":"P","user_id":"U4","timestamp":1275350400000}',
    "parent_asin": '{"rating":3,"title":"n-parent","text":"t","asin":"A5","parent_asin":null,"user_id":"U5","timestamp":1275350400000}',
    "helpful_vote": '{"rating":3,"title":"n-helpful","text":"t","asin":"A6","parent_asin":"P","user_id":"U6","timestamp":1275350400000,"helpful_vote":null}',
    "verified_purchase": '{"rating":3,"title":"n-verified","text":"t","asin":"A7","parent_asin":"P","user_id":"U7","timestamp":1275350400000,"verified_purchase":null}',
}


def test_json_null_in_every_field(spark, tmp_path):
    from refinery.session import fresh_workspace
    from refinery.sources.staged import load_bronze
    f = tmp_path / "nulls.jsonl"
    f.write_text("\n".join(NULL_FIELD_LINES.values()) + "\n")
    out = f"{fresh_workspace(spark, 'nulls')}/bronze"
    assert load_bronze(spark, str(f), out).loaded_rows == 7
    for spec in (CLEAN, UPSERT):
        rows = {r.user_id: r for r in silver_ops.extract(read_bronze(spark, out), spec).collect()}
        # a JSON null rating, timestamp or text rejects the row in every method
        assert set(rows) == {"U4", "U5", "U6", "U7"}
        assert rows["U4"].review_title is None
        assert rows["U5"].parent_asin is None
        assert rows["U6"].helpful_vote == (0 if spec is CLEAN else None)
        assert rows["U7"].verified_purchase is None
    gold = {g.parent_asin for g in gold_ops.aggregate(
        silver_ops.extract(read_bronze(spark, out), CLEAN), CLEAN).collect()}
    assert gold == {"P", None}


def test_cut_values_are_counted_and_strict_refuses_them(spark, golden_bronze):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    bronze = read_bronze(spark, golden_bronze[0])
    for spec in (CLEAN, UPSERT):
        cut = Observation()
        silver_ops.extract(bronze, spec, cut=cut).collect()
        assert cut.get == {"asin": 0, "parent_asin": 0, "user_id": 0, "review_title": 1}
        with pytest.raises(Exception, match="title is longer than 500"):
            silver_ops.extract(bronze.filter(F.expr("variant_get(raw_json, '$.user_id', 'string') = 'U24'")),
                               spec, strict=True).collect()
