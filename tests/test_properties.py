"""Property tests: the DataFrame operators against brute force in Python."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.operators import gold as gold_ops
from refinery.operators.merge import ACTION, merge_plan
from refinery.spec import BATCH, UPSERT

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

KEYS = st.sampled_from(["k1", "k2", "k3", "k4", "k5", "k6"])
VAL = st.one_of(st.none(), st.integers(0, 3))
NOW = dt.datetime(2030, 1, 1)


def _brute_merge(target: dict, source: dict):
    out, actions = {}, {"insert": 0, "update": 0, "noop": 0, "keep": 0}
    for k in set(target) | set(source):
        if k not in target:
            out[k] = (source[k], NOW)
            actions["insert"] += 1
        elif k not in source:
            out[k] = target[k]
            actions["keep"] += 1
        elif target[k][0] != source[k]:
            out[k] = (source[k], NOW)
            actions["update"] += 1
        else:
            out[k] = target[k]
            actions["noop"] += 1
    return out, actions


@SETTINGS
@given(target=st.dictionaries(KEYS, VAL, max_size=6), source=st.dictionaries(KEYS, VAL, max_size=6))
def test_merge_plan_matches_brute_force(spark, target, source):
    old = dt.datetime(2020, 1, 1)
    t = spark.createDataFrame([(k, v, old) for k, v in target.items()],
                              "key string, v int, loaded_at timestamp_ntz")
    s = spark.createDataFrame([(k, v) for k, v in source.items()], "key string, v int")
    plan = merge_plan(t, s, ["key"], ["key", "v", "loaded_at"], ["v"], ["v"],
                      F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    rows = plan.collect()
    got = {r.key: (r.v, r.loaded_at) for r in rows}
    expected, actions = _brute_merge({k: (v, old) for k, v in target.items()}, source)
    assert got == expected
    counted = {a: 0 for a in actions}
    for r in rows:
        counted[r[ACTION]] += 1
    assert counted == actions


REVIEW = st.tuples(
    st.sampled_from(["P1", "P2", "P3", None]),          # parent_asin
    st.integers(1, 5).map(float),                       # rating
    st.sampled_from([True, False, None]),               # verified_purchase
    st.one_of(st.none(), st.integers(0, 9)),            # helpful_vote
    st.sampled_from([True, False, None]),               # has_images
    st.integers(1996, 2023),                            # year
    st.integers(0, 10_000),                             # seconds into the year
)


def _silver(spark, rows):
    data = [(p, r, v, h, i, dt.datetime(y, 1, 1) + dt.timedelta(seconds=s), y)
            for p, r, v, h, i, y, s in rows]
    return spark.createDataFrame(
        data, "parent_asin string, rating double, verified_purchase boolean, helpful_vote int, "
              "has_images boolean, review_ts timestamp_ntz, review_year int")


@SETTINGS
@given(rows=st.lists(REVIEW, min_size=1, max_size=30))
def test_partials_combine_to_the_direct_aggregate(spark, rows):
    silver = _silver(spark, rows)
    direct = {r.parent_asin: tuple(r) for r in gold_ops.aggregate(silver, BATCH).collect()}
    parts = gold_ops.partials(silver, "review_year")
    combined = {r.parent_asin: tuple(r) for r in gold_ops.combine_partials(parts, BATCH).collect()}
    assert combined == direct
    assert None not in direct


@SETTINGS
@given(rows=st.lists(REVIEW, min_size=1, max_size=30), year=st.integers(1996, 2023))
def test_replace_touched_equals_recompute(spark, rows, year):
    silver = _silver(spark, rows)
    before = gold_ops.aggregate(silver.filter(F.col("review_year") < year), BATCH)
    upto = silver.filter(F.col("review_year") <= year)
    touched = gold_ops.touched_keys(upto.filter(F.col("review_year") == year))
    recomputed = gold_ops.aggregate(gold_ops.rows_of_keys(upto, touched), BATCH)
    after = gold_ops.replace_keys(before, touched, recomputed)
    expected = gold_ops.aggregate(upto, BATCH)
    key = lambda df: sorted(tuple(r) for r in df.select(*expected.columns).collect())
    assert key(after) == key(expected)


@SETTINGS
@given(rows=st.lists(REVIEW, min_size=1, max_size=30))
def test_gold_counts_never_exceed_total(spark, rows):
    for r in gold_ops.aggregate(_silver(spark, rows), UPSERT).collect():
        assert r.verified_count + r.unverified_count <= r.total_reviews
        assert r.reviews_with_images <= r.total_reviews
        assert r.earliest_review_ts <= r.latest_review_ts


ROW = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 2)))


@SETTINGS
@given(a=st.lists(ROW, max_size=12), b=st.lists(ROW, max_size=12))
def test_multiset_differences_match_counter(spark, a, b):
    from collections import Counter

    from refinery.operators.reconcile import multiset_differences
    schema = "k string, v int"
    got = {(r.k, r.v, r.side): r.copies for r in multiset_differences(
        spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "a", "b").collect()}
    ca, cb = Counter(a), Counter(b)
    expected = {}
    for row in set(ca) | set(cb):
        if ca[row] != cb[row]:
            side = "only_a" if ca[row] > cb[row] else "only_b"
            expected[(row[0], row[1], side)] = abs(ca[row] - cb[row])
    assert got == expected


@SETTINGS
@given(a=st.dictionaries(st.sampled_from(["k1", "k2", "k3", None]), VAL, max_size=4),
       b=st.dictionaries(st.sampled_from(["k1", "k2", "k3", None]), VAL, max_size=4))
def test_keyed_differences_match_dicts(spark, a, b):
    from refinery.operators.reconcile import keyed_differences
    schema = "key string, v int"
    got = {r.key: (r.status, r.differing_columns) for r in keyed_differences(
        spark.createDataFrame(list(a.items()), schema), spark.createDataFrame(list(b.items()), schema),
        ["key"], ["v"], "a", "b").collect()}
    expected = {}
    for k in set(a) | set(b):
        if k not in b:
            expected[k] = ("only_a", "")
        elif k not in a:
            expected[k] = ("only_b", "")
        elif a[k] != b[k]:
            expected[k] = ("differs", "v")
    assert got == expected


def test_multiset_differences_tell_nulls_apart(spark):
    """A NULL and its neighbour that have changed places are differences."""
    from refinery.operators.reconcile import multiset_differences
    schema = "a int, b boolean, c string, d string"
    a = spark.createDataFrame([(1, None, None, "x"), (2, True, "q", None)], schema)
    b = spark.createDataFrame([(None, True, "x", None), (2, True, "q", None)], schema)
    c = spark.createDataFrame([(1, None, "x", None), (2, True, None, "q")], schema)
    for other in (b, c):
        found = multiset_differences(a, other).collect()
        assert len(found) == 2 * (2 if other is c else 1) and all(r.copies == 1 for r in found)
    assert multiset_differences(a, a).count() == 0
