"""The load makes a column of each of a record's fields and no more, and takes a whole time as it is."""

from __future__ import annotations

import glob
import json

from pyspark.sql import functions as F

from refinery.functions.scalar import epoch_ms_to_ts, epoch_ms_year
from refinery.functions.variant import array_size, whole_number
from refinery.session import fresh_workspace
from refinery.sources import staged

DEPTH = "spark.sql.variant.shredding.maxSchemaDepth"
DAY = 86_400_000
# Edges of years and of what is representable, rounding, and what is no number.
TIMES = [0, -1, 1, 915148799999, 915148800000, 915148799999.5, 915148799999.4, -0.5, "915148799999.6", "915148800000",
         "9e11", 1e12, True, "true", "x", "", None, {"a": 1}, [1], -62135596800000, -62135596800001, 253402300799999,
         253402300800000, 9223372036854775807, 9223372036854775808, 10 ** 40, -DAY, -DAY - 1, 951782400000, 4107542399999]


def _loaded(spark, label, records):
    base = fresh_workspace(spark, label)
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    staged.stage_lines(lines, f"{base}/stage", rebalance=False)
    staged.load_bronze(spark, f"{base}/stage", f"{base}/bronze", load_time="2024-06-30 00:00:00")
    return f"{base}/bronze"


def test_arrays_get_no_columns_of_their_own(spark):
    before = spark.conf.get(DEPTH, None)
    path = _loaded(spark, "t-levels", [{"asin": f"A{i}", "timestamp": 1, "images": [{"variant": "MAIN"}] * (i % 3)}
                                       for i in range(50)])
    assert spark.conf.get(DEPTH, None) == before
    files = glob.glob(f"{path.removeprefix('file:')}/review_year=1970/*.parquet")
    stored = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    for f in files:
        source = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(f), spark.sparkContext._jsc.hadoopConfiguration())
        reader = stored.open(source)
        columns = [".".join(c.getPath()) for c in reader.getFileMetaData().getSchema().getColumns()]
        reader.close()
        assert "raw_json.typed_value.asin.typed_value" in columns
        assert [c for c in columns if ".images." in c] == ["raw_json.typed_value.images.value"]
    sizes = staged.read_bronze(spark, path).groupBy(array_size("images").alias("n")).count().orderBy("n").collect()
    assert [tuple(r) for r in sizes] == [(0, 17), (1, 17), (2, 16)]


def test_load_year_is_the_year_of_the_typed_time(spark):
    path = _loaded(spark, "t-years", [{"n": i, "timestamp": t} for i, t in enumerate(TIMES)] + [{"n": -1}])
    rows = staged.read_bronze(spark, path, keep_year=True).select(
        staged.YEAR_COL, F.year(epoch_ms_to_ts(whole_number("timestamp"))).alias("typed")).collect()
    assert len(rows) == len(TIMES) + 1
    assert [r for r in rows if r[0] != r[1]] == []
    assert {1, 1969, 1970, 1998, 1999, 9999, None} <= {r[0] for r in rows}


def test_year_of_days_is_the_year_of_the_time(spark):
    near = spark.createDataFrame([(d,) for d in (-DAY, -1, 0, 1, DAY)], "near bigint")
    firsts = spark.sql("select unix_millis(cast(make_date(id, 1, 1) as timestamp)) a from range(1, 10000)")
    ms = firsts.crossJoin(near).select((F.col("a") + F.col("near")).alias("ms"))
    wrong = ms.filter(~epoch_ms_year(F.col("ms")).eqNullSafe(F.year(epoch_ms_to_ts(F.col("ms")))))
    assert wrong.count() == 0


def test_array_size_counts_any_element(spark):
    found = spark.sql("""select parse_json(j) raw_json, n from values ('{"images":[]}', 0), ('{"images":[null]}', 1),
        ('{"images":[1,"x",true,{"a":[1]},[2],null]}', 6), ('{"images":{"a":1}}', null), ('{"images":"[1]"}', null),
        ('{"images":null}', null), ('{}', null), ('[1]', null) t(j, n)""").filter(~array_size("images").eqNullSafe(F.col("n")))
    assert found.count() == 0
