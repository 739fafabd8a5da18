"""Bronze tables built from the driver tables, once per session and input.

``bronze_for`` stages the review records of ``sources.reviews`` as compressed
JSON-lines files and loads them into a Bronze table -- the same path a real
JSON dump takes.  The join behind the records is made once per input, as a table
that every kind reads: at scale it shuffles both sides.  Results are kept under the checkpoint workspace keyed by the
input folder and its files' sizes and times, so several queries of one run
share one load; a load that did not finish is simply redone.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from refinery.plans.store import CODEC, TableStore
from refinery.session import ensure_session_settings, workspace
from refinery.sources import reviews
from refinery.sources.staged import BronzeLoad, load_bronze, stage_lines

KINDS = {"all": {}, "wave1": {"wave": 1}, "wave2": {"wave": 2}, "broken": {"broken": True},
         "corrected": {"corrected": True}, "wide": {"wide": True}}
# Kinds staged in a folder for each value of a column.
FOLDERS = {"broken": ("l_linenumber",)}
# Bumped whenever staging or the Bronze layout changes, so cached fixture
# tables of an older layout are never reused.
LAYOUT_VERSION = "layout-9"
# Most rows of a file of the joined base table, so that the tasks that make text of it stay alike.
BASE_ROWS = 1_000_000
# Fixed load time of fixture Bronze rows, so no clock reaches compared output.
FIXTURE_LOAD_TIME = "2024-06-30 00:00:00"


def table_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and change time of every file of a table, on any file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().getName(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


def input_key(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(f"{LAYOUT_VERSION}:{sf_dir}".encode())
    for t in ("lineitem", "orders"):
        for name, size, modified in table_files(spark, f"{sf_dir}/{t}.parquet"):
            h.update(f"{t}:{name}:{size}:{modified}".encode())
    name = os.path.basename(sf_dir.rstrip("/")) or "data"
    return f"{name}-{h.hexdigest()[:10]}"


def fixture_paths(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, str]:
    base = workspace(spark, "fixtures", input_key(spark, sf_dir), kind)
    return f"{base}/stage", f"{base}/bronze"


def bronze_for(spark: SparkSession, sf_dir: str, kind: str = "all") -> str:
    """Path of the Bronze table of ``kind`` for ``sf_dir`` (built if needed)."""
    return load_fixture(spark, sf_dir, kind)[1]


def review_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews.review_base`` of ``sf_dir``, joined once for all kinds."""
    path = workspace(spark, "fixtures", input_key(spark, sf_dir), "base")
    probe = TableStore(spark, path)
    joined = reviews.review_base(spark, sf_dir)
    if not probe.marked(path):
        joined.write.mode("overwrite").option("compression", CODEC).option("maxRecordsPerFile", BASE_ROWS).parquet(path)
        probe.mark(path)
    return spark.read.schema(joined.schema).parquet(path)


def load_fixture(spark: SparkSession, sf_dir: str, kind: str = "all") -> tuple[str, str, BronzeLoad | None]:
    ensure_session_settings(spark)
    stage, bronze = fixture_paths(spark, sf_dir, kind)
    probe = TableStore(spark, bronze)
    if probe.marked(bronze):
        return stage, bronze, None
    if not probe.marked(stage):
        # The base table's files have dealt the lines out already.
        stage_lines(reviews.review_lines(review_base(spark, sf_dir), **KINDS[kind]), stage, compression="gzip",
                    folders=FOLDERS.get(kind, ()), rebalance=False)
        probe.mark(stage)
    load = load_bronze(spark, stage, bronze, load_time=FIXTURE_LOAD_TIME)
    probe.mark(bronze)
    return stage, bronze, load
