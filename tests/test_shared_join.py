"""What a load shuffles and writes: one join for all kinds of input, closely packed staged files, bounded pieces."""

from __future__ import annotations

import glob
import gzip
import zlib

from refinery import fixtures
from refinery.sources import reviews, staged
from tests.conftest import SMALL_SF


def test_kinds_share_one_join(spark):
    base = fixtures.review_base(spark, SMALL_SF)
    assert base.count() == reviews.review_base(spark, SMALL_SF).count() > 0
    assert not base.exceptAll(reviews.review_base(spark, SMALL_SF)).take(1)
    path = f"{fixtures.fixture_paths(spark, SMALL_SF, 'base')[0].rsplit('/', 1)[0]}"
    before = fixtures.table_files(spark, path)
    for kind in ("wave1", "broken"):
        fixtures.bronze_for(spark, SMALL_SF, kind)
        lines = reviews.review_lines(fixtures.review_base(spark, SMALL_SF), **fixtures.KINDS[kind])
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert before and fixtures.table_files(spark, path) == before


def test_base_files_are_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(fixtures, "BASE_ROWS", 1000)
    monkeypatch.setattr(fixtures, "LAYOUT_VERSION", f"test-{tmp_path.name}")
    base = fixtures.review_base(spark, SMALL_SF)
    assert len(base.inputFiles()) >= base.count() / 1000 > 1


def test_staged_lines_are_packed_closely(spark, tmp_path):
    lines = reviews.review_lines(fixtures.review_base(spark, SMALL_SF)).coalesce(1)
    staged.stage_lines(lines, f"{tmp_path}/stage", compression="gzip", rebalance=False)
    packed = [open(f, "rb").read() for f in glob.glob(f"{tmp_path}/stage/*.gz")]
    fastest = sum(len(zlib.compress(gzip.decompress(p), 1)) for p in packed)
    assert packed and sum(map(len, packed)) < 0.8 * fastest


def test_pieces_hold_a_few_staged_files(spark):
    with staged._side_by_side(spark):
        assert staged._bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes")) <= 32 << 20
