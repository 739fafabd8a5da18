"""Staged JSON-lines files and the Bronze table (A1-A4, A3 rejects, P11).

Bronze keeps the raw record as a ``VARIANT`` plus its load time, exactly like
the reference.  One storage-only column is added: ``review_year``, the year of
the record's ``timestamp`` (NULL when absent or not a number).  Bronze is
written partitioned by it, so a yearly batch reads one partition instead of
scanning everything for each of 28 years (SURVEY section 4).  A second one,
``source_file``, says which staged file a row came from, for the load report.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from refinery.functions.scalar import epoch_ms_to_ts, epoch_ms_year, ntz
from refinery.functions.variant import field, whole_number, whole_number_of_record
from refinery.schemas import BRONZE

YEAR_COL = "review_year"
FILE_COL = "source_file"
# Bronze as stored: the reference's two columns, the source file and the partition column.
BRONZE_STORED = T.StructType(BRONZE.fields + [T.StructField(FILE_COL, T.StringType(), True),
                                              T.StructField(YEAR_COL, T.IntegerType(), True)])
# Lines that did not parse, kept beside Bronze (readers skip names with an underscore).
REJECTS = "_rejects"
REJECT = T.StructType([T.StructField(FILE_COL, T.StringType(), True), T.StructField("place", T.LongType(), True),
                       T.StructField("line", T.StringType(), True)])


#: Most rows of a staged file and of a Bronze file.  A compressed file, and a row
#: group, is read by one task: these bounds keep the tasks of a large table alike.
STAGED_ROWS, BRONZE_ROWS = 250_000, 100_000
#: Folders that a writing task keeps open side by side; rows beyond them are sorted.
OPEN_FOLDERS = 64
#: Staged bytes that a load's task reads at least, so that many small files don't become many smaller ones,
#: and at most, but for a larger file: packed text is many times as long, and a task reads all of it.
LOAD_BYTES, LOAD_MOST = 5 << 20, 24 << 20
#: Level of gzipped staged files: two thirds of the bytes of the fastest one for a microsecond more a line.
ZLIB_LEVEL = "FIVE"
#: Codec of Bronze's files.
PARQUET_CODEC = "zstd"
#: Levels of a record that get columns of their own in Bronze: its fields.  What lies in an array stays one
#: value, as nothing reads it apart and its columns cost a load a fifth of its time.
SHREDDED_LEVELS = 1


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Tasks write their folders side by side, without a sort (and its spill) of whole rows."""
    writers, most = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes"
    with _settings(spark, {writers: str(max(OPEN_FOLDERS, int(spark.conf.get(writers)))),
                           most: str(min(LOAD_MOST, _bytes(spark, spark.conf.get(most))))}):
        yield


@contextmanager
def _settings(spark: SparkSession, changed: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; those that were unset are so again."""
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size setting such as ``128MB`` in bytes."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def stage_lines(lines: DataFrame, path: str, compression: str = "none", folders: tuple[str, ...] = (),
                rebalance: bool = True) -> str:
    """Write JSON-lines text (column ``value``) as staged files.

    The files' number follows the data: none has more than ``STAGED_ROWS``
    lines, so that a compressed one, which one task reads, stays small.
    ``rebalance`` first deals the lines into pieces of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, whatever their text;
    without it tasks write the lines they hold, and no text is shuffled.
    ``folders`` are columns whose values get a folder each.
    """
    lines = lines.select("value", *folders)
    if rebalance:
        lines = lines.hint("rebalance", *folders)
    with _side_by_side(lines.sparkSession):
        (lines.write.mode("overwrite").option("compression", compression).option("zlib.compress.level", ZLIB_LEVEL)
         .option("maxRecordsPerFile", STAGED_ROWS).partitionBy(*folders).text(path))
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def year_partitioned(spark: SparkSession, bronze_path: str) -> bool:
    """Whether Bronze has the ``review_year=`` folder layout of ``load_bronze``."""
    p, fs = _fs(spark, bronze_path)
    if not fs.exists(p):
        return False
    return any(st.getPath().getName().startswith(f"{YEAR_COL}=") for st in fs.listStatus(p))


def year_present(spark: SparkSession, bronze_path: str, year: int) -> bool:
    """Whether ``year`` can hold rows: its partition exists (a listing, no
    scan); always True for a Bronze table without the year layout."""
    if not year_partitioned(spark, bronze_path):
        return True
    p, fs = _fs(spark, f"{bronze_path}/{YEAR_COL}={int(year)}")
    return bool(fs.exists(p))


def bronze_years(spark: SparkSession, bronze_path: str) -> set[int] | None:
    """Years with a partition, from one listing; None without the year layout."""
    if not year_partitioned(spark, bronze_path):
        return None
    p, fs = _fs(spark, bronze_path)
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return {int(n.split("=", 1)[1]) for n in names
            if n.startswith(f"{YEAR_COL}=") and n.split("=", 1)[1].lstrip("-").isdigit()}


def list_staged(spark: SparkSession, path: str) -> DataFrame:
    """``LIST @stage`` (A1): path, modification time and size of each file.

    ``content`` is never selected, so the binary-file source reads metadata
    only.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(path).select(F.col("path").alias("name"), F.col("length").alias("size"),
                               F.col("modificationTime").alias("last_modified"))
            .filter(~F.col("name").rlike(r"/(_|\.)[^/]*$")))


def read_staged(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON-lines -> one ``raw_json`` variant per line (A2).

    Compression is picked per file from its suffix; ``multiLine`` stays off, so
    every line is one record and files split across tasks.  In PERMISSIVE mode
    a line that does not parse comes back as a NULL variant (counted and
    dropped by ``load_bronze``); DROPMALFORMED drops it silently.
    """
    return (spark.read.option("singleVariantColumn", "raw_json").option("mode", mode)
            .option("recursiveFileLookup", "true").json(path))


def with_year(bronze: DataFrame) -> DataFrame:
    """Add the storage-only ``review_year`` partition column."""
    return bronze.withColumn(YEAR_COL, F.year(epoch_ms_to_ts(whole_number("timestamp"))))


def _with_load_year(raw: DataFrame) -> DataFrame:
    """``with_year`` of records that are held whole."""
    return raw.withColumn(YEAR_COL, epoch_ms_year(whole_number_of_record("timestamp")))


@dataclass
class BronzeLoad:
    path: str
    loaded_rows: int
    rejected_lines: int


def load_bronze(spark: SparkSession, stage_path: str, bronze_path: str,
                load_time=None, on_error: str = "continue") -> BronzeLoad:
    """COPY INTO bronze ... ON_ERROR='CONTINUE' (A3, A4, P11).

    One pass over the staged files: lines that do not parse are counted by an
    ``Observation`` on the same scan and left out; the rest are stamped with
    the load time and written partitioned by ``review_year``.  Each task writes
    the years it finds side by side, in files of at most ``BRONZE_ROWS`` rows:
    the raw data is neither shuffled nor sorted, and a year's files can be read
    by many tasks.

    Each row keeps its file's path.  If lines were rejected, a second pass over
    the staged text writes those down beside Bronze, for ``load_report``.

    ``on_error="abort"`` fails the load on the first line that does not parse
    (the JSON reader's FAILFAST mode) instead of skipping it.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError("on_error must be 'continue' or 'abort'")
    raw = read_staged(spark, stage_path, mode="PERMISSIVE" if on_error == "continue" else "FAILFAST")
    raw = raw.select("raw_json", F.col("_metadata.file_path").alias(FILE_COL))
    p, fs = _fs(spark, stage_path)
    if fs.exists(p):  # a glob is read as it is
        raw = raw.coalesce(max(1, -(-int(fs.getContentSummary(p).getLength()) // LOAD_BYTES)))
    obs = Observation("bronze_load")
    stamp = ntz(load_time) if load_time is not None else F.localtimestamp()
    out = (raw.observe(obs, F.count(F.lit(1)).alias("lines"),
                       F.count_if(F.col("raw_json").isNull()).alias("rejected"))
           .filter(F.col("raw_json").isNotNull())
           .withColumn("load_timestamp", stamp))
    with _side_by_side(spark), _settings(spark, {"spark.sql.variant.shredding.maxSchemaDepth": str(SHREDDED_LEVELS)}):
        (_with_load_year(out).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("compression", PARQUET_CODEC).option("maxRecordsPerFile", BRONZE_ROWS).partitionBy(YEAR_COL).parquet(bronze_path))
    if not bronze_years(spark, bronze_path) and not _null_year(spark, bronze_path):
        # Nothing was kept: adaptive execution drops an empty branch together
        # with what it observed, so the rejected lines are counted on their own.
        m = raw.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("raw_json").isNull()).alias("rejected")).first()
    else:
        m = obs.get
    if m["rejected"]:
        rejected_lines(spark, stage_path).write.mode("overwrite").parquet(f"{bronze_path}/{REJECTS}")
    return BronzeLoad(bronze_path, int(m["lines"] - m["rejected"]), int(m["rejected"]))


def rejected_lines(spark: SparkSession, stage_path: str) -> DataFrame:
    """(source_file, place, line) of the staged lines that are not JSON; places of a file rise from its first line on."""
    text = (spark.read.option("recursiveFileLookup", "true").text(stage_path)
            .select(F.col("_metadata.file_path").alias(FILE_COL), F.col("_metadata.file_block_start").alias("at"),
                    F.monotonically_increasing_id().alias("n"), "value"))
    bad = text.filter(F.try_parse_json("value").isNull() & F.col("value").rlike(r"\S"))
    # Rows of a split come in its order; a line is longer than nothing, so these places never cross.
    return bad.select(FILE_COL, (F.col("at") + F.col("n").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"),
                      F.col("value").alias("line"))


def load_report(spark: SparkSession, bronze_path: str) -> DataFrame:
    """COPY INTO's answer, by file (P11): lines, loaded rows, rejected lines, the first rejected one.

    Reads one column of Bronze and the rejected lines; a file without a line is
    not in it.
    """
    loaded = (spark.read.schema(BRONZE_STORED).parquet(bronze_path).groupBy(FILE_COL)
              .agg(F.count(F.lit(1)).alias("loaded_rows")))
    p, fs = _fs(spark, f"{bronze_path}/{REJECTS}")
    rejects = (spark.read.schema(REJECT).parquet(f"{bronze_path}/{REJECTS}") if fs.exists(p)
               else spark.createDataFrame([], REJECT))
    rejects = rejects.groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("rejected_lines"),
                                            F.min_by(F.left("line", F.lit(200)), "place").alias("first_rejected"))
    both = loaded.join(rejects, FILE_COL, "full_outer").na.fill(0, ["loaded_rows", "rejected_lines"])
    return both.select(FILE_COL, (F.col("loaded_rows") + F.col("rejected_lines")).alias("lines"),
                       "loaded_rows", "rejected_lines", "first_rejected")


def _null_year(spark: SparkSession, bronze_path: str) -> bool:
    p, fs = _fs(spark, f"{bronze_path}/{YEAR_COL}=__HIVE_DEFAULT_PARTITION__")
    return bool(fs.exists(p))


#: Columns that say where a Bronze row is: hash of its file's path, row number in the file.
PLACE = ("_file", "_row")


def read_placed(spark: SparkSession, bronze_path: str, files: list[str] | None = None) -> DataFrame:
    """Bronze with each row's place (Parquet's own row numbers): all of it, or the ``files`` of these paths."""
    schema = BRONZE_STORED if year_partitioned(spark, bronze_path) else BRONZE
    rows = spark.read.schema(schema).parquet(bronze_path)
    if files is not None:
        rows = rows.filter(F.col("_metadata.file_path").isin(files))
    return rows.select(
        *BRONZE.fieldNames(), F.xxhash64("_metadata.file_path").alias(PLACE[0]),
        F.col("_metadata.row_index").alias(PLACE[1]))


def files_of_keys(spark: SparkSession, bronze_path: str, keys: DataFrame, most: int) -> list[str] | None:
    """Paths of the Bronze files that hold a record with the fields of one of ``keys``; None if there are more
    than ``most``.  Of the records, these fields alone are read."""
    rows = spark.read.schema(BRONZE).parquet(bronze_path).select(
        *[field(k, "string").alias(k) for k in keys.columns], F.col("_metadata.file_path").alias(FILE_COL))
    found = rows.join(F.broadcast(keys), keys.columns, "left_semi").select(FILE_COL).distinct().limit(most + 1).collect()
    return [r[0] for r in found] if len(found) <= most else None


def read_bronze(spark: SparkSession, bronze_path: str, year: int | None = None,
                keep_year: bool = False) -> DataFrame:
    """Bronze as (raw_json, load_timestamp), read with its fixed schema.

    With ``year`` only that partition's folder is listed and read (the
    ``basePath`` keeps ``review_year`` as a column), so a yearly step never
    lists the other years' files.  A Bronze table without the year layout is
    read whole and gets ``review_year`` computed from the record.
    """
    if not year_partitioned(spark, bronze_path):
        df = with_year(spark.read.schema(BRONZE).parquet(bronze_path))
        if year is not None:
            df = df.filter(F.col(YEAR_COL) == int(year))
    elif year is None:
        df = spark.read.schema(BRONZE_STORED).parquet(bronze_path)
    elif year_present(spark, bronze_path, year):
        df = (spark.read.schema(BRONZE_STORED).option("basePath", bronze_path)
              .parquet(f"{bronze_path}/{YEAR_COL}={int(year)}"))
    else:
        df = spark.createDataFrame([], BRONZE_STORED)
    return df.drop(FILE_COL) if keep_year else df.drop(FILE_COL, YEAR_COL)
