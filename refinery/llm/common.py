"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster
    session without it is refused, as executors see no local folder of the
    driver.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="run-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut at files in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def stored(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path for a new table in the shared folder (nothing is created)."""
    return f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def text_bytes(name: str) -> Column:
    """UTF-8 bytes of a string column, null as it is."""
    return F.col(name).cast("binary")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a worker holds few Python objects at a time.

    At the task's end the worker, which stays for later tasks, gives back what
    Arrow keeps in reserve.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def copied(texts: pa.Array) -> pa.LargeStringArray:
    """Texts in buffers of their own, nulls empty: some kernels misread a slice that was cast."""
    return texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()).fill_null("")


def numbered(rows: DataFrame, order: list[Column], name: str, label: str, part_rows: int = 2_000_000) -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2 ... without gaps, in ``order``.

    ``rows`` must read the same each time (a stored table).  They are sorted by
    ranges and stored with their place in a range; a row for each range is all
    that is brought together.  Rows alike in ``order`` are spread by their
    place in the input, so they may fill many ranges.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // part_rows)
    order = [*order, F.col("_salt")]
    placed = stored(rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
                    .sortWithinPartitions(*order).drop("_salt")
                    .withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    before = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + inside).drop("_part", "_before", "_at"))


def hash_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` whose keys have the smallest hashes.

    Only hashes are sorted; the rows are then read by the largest of those.
    """
    h = F.xxhash64(*keys)
    last = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.limit(0) if last is None else df.filter(h <= last).limit(rows)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


_SHIPPED: set[str] = set()
