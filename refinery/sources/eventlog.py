"""Spark's event log as a table: per-job time, rows, bytes and spill.

The reference reads its warehouse's query history (time, rows, bytes
scanned, spill) filtered by a session tag or by query text.  The Spark
counterpart is the event log, written when ``spark.eventLog.enabled`` is on.
It is read here as JSON-lines text, plain or compressed, in one file or
rolling ones, and parsed with explicit schemas; the per-task metrics are summed
per stage and per job with ordinary aggregations, so a long history is
processed like any other table.  ``recording`` writes a log of the jobs inside
it, also in a session that keeps none.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.scalar import round_half_up

_JOB_START = T.StructType([
    T.StructField("Job ID", T.IntegerType()),
    T.StructField("Submission Time", T.LongType()),
    T.StructField("Stage IDs", T.ArrayType(T.IntegerType())),
    T.StructField("Properties", T.MapType(T.StringType(), T.StringType())),
])
_JOB_END = T.StructType([
    T.StructField("Job ID", T.IntegerType()),
    T.StructField("Completion Time", T.LongType()),
    T.StructField("Job Result", T.StructType([T.StructField("Result", T.StringType())])),
])
_SQL_START = T.StructType([
    T.StructField("executionId", T.LongType()),
    T.StructField("time", T.LongType()),
])
_ACCUM_UPDATES = T.StructType([
    T.StructField("executionId", T.LongType()),
    T.StructField("accumUpdates", T.ArrayType(T.ArrayType(T.LongType()))),
])
# SQL metrics of file scans that stand for the warehouse's "partitions scanned"
# (fixed metric names of Spark's scan operators).
SCAN_METRICS = {"files_read": "number of files read", "partitions_read": "number of partitions read"}
_IO = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])
_TASK_END = T.StructType([
    T.StructField("Stage ID", T.IntegerType()),
    T.StructField("Task Metrics", T.StructType([
        T.StructField("Executor Run Time", T.LongType()),
        T.StructField("Memory Bytes Spilled", T.LongType()),
        T.StructField("Disk Bytes Spilled", T.LongType()),
        T.StructField("Input Metrics", _IO("Bytes Read", "Records Read")),
        T.StructField("Output Metrics", _IO("Bytes Written", "Records Written")),
        T.StructField("Shuffle Read Metrics", _IO("Remote Bytes Read", "Local Bytes Read")),
        T.StructField("Shuffle Write Metrics", _IO("Shuffle Bytes Written", "Shuffle Records Written")),
    ])),
])

HISTORY_COLUMNS = ["query_id", "jobs", "query", "description", "tags", "start_time", "total_sec",
                   "compile_sec", "execute_sec", "rows_read", "rows_written", "mb_scanned",
                   "shuffle_mb", "shuffle_bytes", "files_read", "partitions_read", "shuffle_records",
                   "bytes_spilled", "stages", "tasks", "result"]


def event_log_dir(spark: SparkSession) -> str:
    """This application's event log folder; an error if the session writes none."""
    base = spark.conf.get("spark.eventLog.dir", None)
    if spark.conf.get("spark.eventLog.enabled", "false").lower() != "true" or not base:
        raise RuntimeError("this session writes no event log: set spark.eventLog.enabled and spark.eventLog.dir, "
                           "or run the jobs in eventlog.recording")
    return f"{base.rstrip('/')}/*{spark.sparkContext.applicationId}*"


@contextmanager
def recording(spark: SparkSession, folder: str, compress: bool = True) -> Iterator[str]:
    """Write Spark's event log of the jobs run inside to a new folder in ``folder``; its path.

    Uses Spark's own log writer as one more listener of the running context
    (rolling files; zstd if ``compress``), whatever the session's settings.
    """
    sc = spark.sparkContext
    jvm, context = sc._jvm, sc._jsc.sc()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    conf = (context.getConf().clone().set("spark.eventLog.rolling.enabled", "true")
            .set("spark.eventLog.compress", str(compress).lower()).set("spark.eventLog.compression.codec", "zstd"))
    name = f"run-{uuid.uuid4().hex[:12]}"
    none = getattr(getattr(jvm.scala, "None$"), "MODULE$")
    writer = jvm.org.apache.spark.scheduler.EventLoggingListener(
        name, none, fs.makeQualified(p).toUri(), conf, sc._jsc.hadoopConfiguration())
    writer.start()
    context.addSparkListener(writer)
    try:
        yield f"{folder.rstrip('/')}/eventlog_v2_{name}"
    finally:
        context.listenerBus().waitUntilEmpty()  # events arrive behind the jobs
        context.removeSparkListener(writer)
        writer.stop()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of zstd files, some at a time; a line that a crash cut off is left out by its parse."""
    import zstandard

    for batch in batches:
        for content in batch.column(0):
            source = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(content.as_py()), read_across_frames=True)
            lines = []
            try:
                for line in io.TextIOWrapper(source, encoding="utf-8"):
                    lines.append(line.rstrip("\n"))
                    if len(lines) == 1000:
                        yield pa.RecordBatch.from_pydict({"value": lines})
                        lines = []
            except zstandard.ZstdError:  # the end of a file that was not closed
                pass
            if lines:
                yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw events: (event, json) per line; rolling and single-file logs alike, plain or zstd."""
    def files(format: str, **options: str) -> DataFrame:
        return spark.read.format(format).option("recursiveFileLookup", "true").options(**options).load(path)

    raw = (files("text").filter(~F.col("_metadata.file_name").rlike(r"\.zstd(\.|$)")).select("value")
           .unionByName(files("binaryFile", pathGlobFilter="*.zstd*").select("content").mapInArrow(_unpacked, "value string")))
    return raw.select(F.get_json_object("value", "$.Event").alias("event"), F.col("value").alias("json"))


def _ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def job_history(events: DataFrame) -> DataFrame:
    """One row per statement (SQL execution): text, tags, times, rows, bytes
    and spill summed over its jobs."""
    starts = (events.filter(F.col("event") == "SparkListenerJobStart")
              .select(F.from_json("json", _JOB_START).alias("e")).select(
                  F.col("e.`Job ID`").alias("job_id"),
                  F.col("e.`Submission Time`").alias("start_ms"),
                  F.col("e.`Stage IDs`").alias("stages"),
                  F.col("e.Properties").getItem("spark.job.description").alias("description"),
                  F.col("e.Properties").getItem("callSite.short").alias("call_site"),
                  F.col("e.Properties").getItem("spark.job.tags").alias("tags"),
                  F.coalesce(F.col("e.Properties").getItem("spark.sql.execution.root.id"),
                             F.concat(F.lit("job-"), F.col("e.`Job ID`").cast("string")))
                  .alias("query_id")))
    ends = (events.filter(F.col("event") == "SparkListenerJobEnd")
            .select(F.from_json("json", _JOB_END).alias("e")).select(
                F.col("e.`Job ID`").alias("job_id"),
                F.col("e.`Completion Time`").alias("end_ms"),
                F.col("e.`Job Result`.Result").alias("result")))
    m = "e.`Task Metrics`"
    tasks = (events.filter(F.col("event") == "SparkListenerTaskEnd")
             .select(F.from_json("json", _TASK_END).alias("e"))
             .groupBy(F.col("e.`Stage ID`").alias("stage_id")).agg(
                 F.count(F.lit(1)).alias("tasks"),
                 F.sum(f"{m}.`Executor Run Time`").alias("run_ms"),
                 F.sum(f"{m}.`Input Metrics`.`Records Read`").alias("rows_read"),
                 F.sum(f"{m}.`Output Metrics`.`Records Written`").alias("rows_written"),
                 F.sum(f"{m}.`Input Metrics`.`Bytes Read`").alias("bytes_read"),
                 F.sum(F.coalesce(F.col(f"{m}.`Shuffle Read Metrics`.`Remote Bytes Read`"), F.lit(0))
                       + F.coalesce(F.col(f"{m}.`Shuffle Read Metrics`.`Local Bytes Read`"), F.lit(0)))
                 .alias("shuffle_bytes"),
                 F.sum(f"{m}.`Shuffle Write Metrics`.`Shuffle Records Written`").alias("shuffle_records"),
                 F.sum(F.coalesce(F.col(f"{m}.`Memory Bytes Spilled`"), F.lit(0))
                       + F.coalesce(F.col(f"{m}.`Disk Bytes Spilled`"), F.lit(0))).alias("spill")))
    # A stage listed by several jobs (a reused, skipped stage) counts for the first.
    owner = (starts.select("job_id", F.explode("stages").alias("stage_id"))
             .groupBy("stage_id").agg(F.min("job_id").alias("job_id")))
    per_job = owner.join(tasks, "stage_id").groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_stages"), F.sum("tasks").alias("tasks"),
        F.sum("run_ms").alias("run_ms"), F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"), F.sum("bytes_read").alias("bytes_read"),
        F.sum("shuffle_bytes").alias("shuffle_bytes"), F.sum("shuffle_records").alias("shuffle_records"),
        F.sum("spill").alias("spill"))
    # Planning time: from the SQL execution's start to its first job.
    sql_starts = (events.filter(F.col("event").endswith("SparkListenerSQLExecutionStart"))
                  .select(F.from_json("json", _SQL_START).alias("e"))
                  .select(F.col("e.executionId").cast("string").alias("query_id"),
                          F.col("e.time").alias("sql_start_ms")))
    scans = _scan_metrics(events)
    # One row per statement: AQE runs a statement as several jobs.
    jobs = starts.join(ends, "job_id", "left").join(per_job, "job_id", "left")
    per_query = jobs.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.max(F.coalesce(F.col("description"), F.col("call_site"))).alias("description"),
        F.max("tags").alias("tags"),
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
        F.sum("n_stages").alias("stages"), F.sum("tasks").alias("tasks"),
        F.sum("run_ms").alias("run_ms"), F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"), F.sum("bytes_read").alias("bytes_read"),
        F.sum("shuffle_bytes").alias("shuffle_bytes"),
        F.sum("shuffle_records").alias("shuffle_records"), F.sum("spill").alias("spill"),
        F.min("result").alias("result"))   # JobFailed sorts before JobSucceeded
    per_query = per_query.join(sql_starts, "query_id", "left").join(scans, "query_id", "left")
    return per_query.select(
        "query_id", "jobs",
        F.left(F.col("description"), F.lit(60)).alias("query"),
        "description", "tags",
        _ms_to_ts(F.col("start_ms")).alias("start_time"),
        round_half_up((F.col("end_ms") - F.col("start_ms")) / 1000.0, 2).alias("total_sec"),
        round_half_up((F.col("start_ms") - F.col("sql_start_ms")) / 1000.0, 2).alias("compile_sec"),
        round_half_up(F.col("run_ms") / 1000.0, 2).alias("execute_sec"),
        F.coalesce("rows_read", F.lit(0)).alias("rows_read"),
        F.coalesce("rows_written", F.lit(0)).alias("rows_written"),
        round_half_up(F.coalesce("bytes_read", F.lit(0)) / 1024 / 1024, 1).alias("mb_scanned"),
        round_half_up(F.coalesce("shuffle_bytes", F.lit(0)) / 1024 / 1024, 1).alias("shuffle_mb"),
        F.coalesce("shuffle_bytes", F.lit(0)).alias("shuffle_bytes"),
        F.coalesce("files_read", F.lit(0)).alias("files_read"),
        F.coalesce("partitions_read", F.lit(0)).alias("partitions_read"),
        F.coalesce("shuffle_records", F.lit(0)).alias("shuffle_records"),
        F.coalesce("spill", F.lit(0)).alias("bytes_spilled"),
        F.coalesce("stages", F.lit(0)).alias("stages"), F.coalesce("tasks", F.lit(0)).alias("tasks"),
        "result")


def _scan_metrics(events: DataFrame) -> DataFrame:
    """Files and partitions read per SQL execution.

    Plan events name each SQL metric with its accumulator id; driver-side
    accumulator updates carry the values.  Both are joined on (execution,
    accumulator), keeping the last value of each accumulator.
    """
    plans = events.filter(F.col("event").endswith("SparkListenerSQLExecutionStart")
                          | F.col("event").endswith("SparkListenerSQLAdaptiveExecutionUpdate"))
    ids = []
    for out, name in SCAN_METRICS.items():
        pattern = f'"name":"{name}","accumulatorId":(\\d+)'
        ids.append(plans.select(
            F.get_json_object("json", "$.executionId").cast("long").alias("exec_id"),
            F.explode(F.regexp_extract_all("json", F.lit(pattern), 1)).alias("acc"),
            F.lit(out).alias("metric")))
    metric_ids = ids[0].unionByName(ids[1]).select(
        "exec_id", F.col("acc").cast("long").alias("acc"), "metric").distinct()
    updates = (events.filter(F.col("event").endswith("SparkListenerDriverAccumUpdates"))
               .select(F.from_json("json", _ACCUM_UPDATES).alias("e"))
               .select(F.col("e.executionId").alias("exec_id"), F.explode("e.accumUpdates").alias("u"))
               .select("exec_id", F.col("u")[0].alias("acc"), F.col("u")[1].alias("value"))
               .groupBy("exec_id", "acc").agg(F.max("value").alias("value")))
    joined = metric_ids.join(updates, ["exec_id", "acc"])
    return (joined.groupBy(F.col("exec_id").cast("string").alias("query_id"))
            .agg(*[F.sum(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in SCAN_METRICS]))


def has_tag(tag: str) -> Column:
    """The job carried ``tag`` (F13); session tags are stored with a prefix."""
    return F.exists(F.split(F.coalesce(F.col("tags"), F.lit("")), ","),
                    lambda t: (t == F.lit(tag)) | t.endswith(F.lit("-" + tag)))


#: States of statements, as run logs name them.
STATES = {"JobSucceeded": "SUCCEEDED", "JobFailed": "FAILED"}


def statement_report(history: DataFrame) -> DataFrame:
    """query, query_tag, state, rows_written of statements that wrote a table, rows as Spark's tasks counted them."""
    tag = F.regexp_extract(F.col("tags"), "(method=[a-z_]+)", 1)
    state = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])[F.col("result")]
    return history.select("query", tag.alias("query_tag"), state.alias("state"), "rows_written")


def query_history(history: DataFrame, tag: str | None = None, pattern: str | None = None,
                  k: int | None = None) -> DataFrame:
    """Jobs by tag (F13) and/or text pattern (F11, ILIKE), newest first."""
    if tag is not None:
        history = history.filter(has_tag(tag))
    if pattern is not None:
        history = history.filter(F.col("description").ilike(pattern))
    out = history.orderBy(F.col("start_time").desc(), F.col("query_id").desc())
    return out.limit(k) if k else out
