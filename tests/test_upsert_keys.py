"""The upsert never makes one key of two by cutting."""

import json

import pytest

from refinery.operators import silver as silver_ops
from refinery.session import fresh_workspace
from refinery.sources.staged import load_bronze, read_bronze
from refinery.spec import CLEAN, UPSERT

PREFIX = {"asin": "A" * 25, "parent_asin": "P" * 25, "user_id": "U" * 50}


def _bronze(spark, tmp_path, key, **more):
    rows = [{"asin": "A", "parent_asin": "P", "user_id": "U", "rating": 4.0, "title": "t", "text": "x", "timestamp": 1275350400000 + i,
             key: PREFIX[key] + end, **more} for i, end in enumerate("12")]
    (tmp_path / "rows.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    out = f"{fresh_workspace(spark, 'keys')}/bronze"
    load_bronze(spark, str(tmp_path / "rows.jsonl"), out)
    return read_bronze(spark, out)


@pytest.mark.parametrize("key", PREFIX)
def test_longer_keys_fail(spark, tmp_path, key):
    bronze = _bronze(spark, tmp_path, key)
    with pytest.raises(Exception, match=f"{key} is longer than {len(PREFIX[key])}"):
        silver_ops.extract(bronze, UPSERT).collect()
    assert [r[key] for r in silver_ops.extract(bronze, CLEAN).collect()] == [PREFIX[key]] * 2


def test_rejected_rows_do_not_fail(spark, tmp_path):
    assert silver_ops.extract(_bronze(spark, tmp_path, "asin", rating=9.0), UPSERT).collect() == []
