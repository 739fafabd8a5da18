"""Table storage for the layers.

Plain Parquet has no row-level DELETE / UPDATE / MERGE, and overwriting a
path that the same job reads loses data.  So every replace is a new
*snapshot*: the job writes ``<table>/v=<n>/`` in full, then the store puts its
own marker file beside the data, and the table switches to it.  The marker
does not depend on the session's committer settings.  Readers never see an
empty or half-written table, a failed write leaves the previous version
current, and a retry simply writes the next version.  A table that has
snapshots but no marked one is an error, never an empty table.

Partitioned tables live in generation folders ``<table>/g=<n>/``.  The yearly
ones overwrite single partitions with dynamic partition overwrite: a year can
be loaded again from its input.  A table whose rows cannot be had again
(the upsert's Silver) uses ``replace_partitions``: new partitions are first
written beside the table and marked, then moved in one by one; a run cut off
in between is finished by ``finish_replace``.  Other partitions' files stay as
they are.

Small changing values (``put_state``) are numbered files of which the newest
counts, so the old value stands until the new one is complete.  Run records
(``log``) are JSON-lines files written without a Spark job.

Paths go through the Hadoop FileSystem API so the same code works on a local
folder, HDFS or an object store.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_VERSION = re.compile(r"^v=(\d+)$")
# Name of the store's commit marker (readers skip names with an underscore).
MARKER = "_REFINERY_COMMITTED"
# Files of a log table, beyond which they are put together.
LOG_FILES = 200
# Codec of the tables' files: ids and fingerprints are most of a narrow row, and snappy leaves them as long.
CODEC = "zstd"


class TableStore:
    """Named tables under one root folder.

    ``keep`` snapshots of each table are retained at least (the current one and
    the one before it by default), and any that was replaced less than
    ``keep_sec`` ago, so that a reader has that long to finish.  Older versions
    and older generations of append-only tables are removed after a successful
    replace or reset.  ``keep=None`` retains everything.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int | None = 2,
                 keep_sec: float = 3600.0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.keep_sec = keep_sec

    # -- file system ---------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.exists(p))

    def _children(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p)]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write_text(self, path: str, text: str) -> None:
        """A small file that is written once: complete or absent."""
        part = f"{path}.part"
        p, fs = self._fs(part)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target, _ = self._fs(path)
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(p, target):
            raise OSError(f"cannot write {path}")

    def read_text(self, path: str) -> str | None:
        """First line of a small file, None if there is none."""
        lines = self.read_lines(path)
        return lines[0] if lines else None

    def read_lines(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        if not fs.exists(p):
            return []
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(p)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return list(iter(reader.readLine, None))
        finally:
            stream.close()

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def _move(self, path: str, to: str) -> None:
        """Rename; ``to`` must not exist."""
        p, fs = self._fs(path)
        target, _ = self._fs(to)
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"cannot move {path} to {to}")

    # -- small values ----------------------------------------------------------
    def _state_numbers(self, path: str) -> list[int]:
        folder, name = path.rsplit("/", 1)
        found = (re.fullmatch(re.escape(name) + r"\.(\d+)", c) for c in self._children(folder))
        return sorted(int(m.group(1)) for m in found if m)

    def put_state(self, path: str, text: str) -> None:
        """Set a changing value: a new number beside the old one, which goes afterwards."""
        old = self._state_numbers(path)
        self.write_text(f"{path}.{(old[-1] if old else 0) + 1:09d}", text)
        for n in old:
            self._delete(f"{path}.{n:09d}")

    def get_state(self, path: str) -> str | None:
        """The newest value's first line, None if there is none."""
        found = self._state_numbers(path)
        return self.read_text(f"{path}.{found[-1]:09d}") if found else None

    def size(self, path: str) -> int:
        """Bytes of a folder's files, 0 if it does not exist."""
        p, fs = self._fs(path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    def mark(self, path: str) -> None:
        """Declare the folder's contents complete."""
        self.write_text(f"{path}/{MARKER}", "ok\n")

    def marked(self, path: str) -> bool:
        return self._exists(f"{path}/{MARKER}")

    def _age_sec(self, path: str) -> float:
        p, fs = self._fs(path)
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0

    # -- snapshot tables -----------------------------------------------------
    def _version_numbers(self, name: str) -> list[int]:
        """Snapshot versions present (committed or not), ascending; one listing."""
        nums = []
        for child in self._children(self.path(name)):
            m = _VERSION.match(child)
            if m:
                nums.append(int(m.group(1)))
        return sorted(nums)

    def current(self, name: str) -> str | None:
        """Path of the newest committed snapshot, None if there is no snapshot.

        Probes commit markers from the newest version down, so the cost does
        not grow with the number of snapshots kept.  Snapshots without any
        marked one raise: their state is unknown, not empty.
        """
        versions = self._version_numbers(name)
        for v in reversed(versions):
            path = f"{self.path(name)}/v={v:06d}"
            if self.marked(path):
                return path
        if versions:
            raise RuntimeError(
                f"{self.path(name)} has snapshots but none is committed; a first write failed or its "
                f"marker {MARKER} was lost: mark the right one with TableStore.mark, or remove the folder")
        return None

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """Current snapshot or generation, or an empty frame of ``schema`` (never created)."""
        cur = self.current(name)
        if cur is not None:
            return self.spark.read.schema(schema).parquet(cur)
        if self.has_generation(name):
            return self.read_appended(name, schema)
        return self.spark.createDataFrame([], schema)

    def _next_path(self, name: str) -> str:
        versions = self._version_numbers(name)
        nxt = (versions[-1] + 1) if versions else 1
        return f"{self.path(name)}/v={nxt:06d}"

    def replace(self, name: str, df: DataFrame) -> str:
        """CREATE OR REPLACE / TRUNCATE + INSERT (A5, A9): write a new snapshot."""
        path = self._next_path(name)
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        self.mark(path)
        self.vacuum(name)
        return path

    def vacuum(self, name: str, keep: int | None = None) -> list[str]:
        """Remove snapshot versions older than the newest ``keep`` committed ones
        (and uncommitted leftovers below them) that were replaced at least
        ``keep_sec`` ago.  Returns removed paths."""
        keep = self.keep if keep is None else keep
        if keep is None:
            return []
        versions = self._version_numbers(name)
        committed = [v for v in versions
                     if self.marked(f"{self.path(name)}/v={v:06d}")]
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        # A snapshot was replaced when the committed one after it was marked.
        while oldest_kept != committed[0]:
            at = committed.index(oldest_kept)
            if self._age_sec(f"{self.path(name)}/v={oldest_kept:06d}/{MARKER}") >= self.keep_sec:
                break
            oldest_kept = committed[at - 1]
        removed = []
        for v in versions:
            if v >= oldest_kept:
                continue
            path = f"{self.path(name)}/v={v:06d}"
            self._delete(path)
            removed.append(path)
        return removed

    def create_if_absent(self, name: str, schema: T.StructType) -> None:
        """CREATE TABLE IF NOT EXISTS (A6): an empty first snapshot."""
        if self.current(name) is None:
            self.replace(name, self.spark.createDataFrame([], schema))

    def truncate(self, name: str, schema: T.StructType) -> None:
        """TRUNCATE TABLE (A13) as an empty snapshot."""
        self.replace(name, self.spark.createDataFrame([], schema))

    # -- append-only and partitioned tables ------------------------------------
    # These live in generation folders ``<table>/g=<n>/``; TRUNCATE starts a
    # new generation, so nothing is ever deleted in place.
    def _generation(self, name: str) -> int:
        gens = [int(c[2:]) for c in self._children(self.path(name)) if re.match(r"^g=\d+$", c)]
        return max(gens) if gens else 1

    def _gen_path(self, name: str) -> str:
        return f"{self.path(name)}/g={self._generation(name):06d}"

    def has_generation(self, name: str) -> bool:
        return any(re.match(r"^g=\d+$", c) for c in self._children(self.path(name)))

    def append(self, name: str, df: DataFrame) -> None:
        """INSERT INTO (A8): new files next to the old ones."""
        df.write.mode("append").option("compression", CODEC).parquet(self._gen_path(name))

    def read_appended(self, name: str, schema: T.StructType) -> DataFrame:
        path = self._gen_path(name)
        if not self._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    def log(self, name: str, rows: list[dict]) -> None:
        """INSERT of some small rows, durable when this returns; no Spark job.

        Beyond ``LOG_FILES`` files they are put together in a new generation.
        """
        path = self._gen_path(name)
        self.write_text(f"{path}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json",
                        "".join(json.dumps(r, default=lambda v: v.isoformat()) + "\n" for r in rows))
        files = sorted(c for c in self._children(path) if c.endswith(".json"))
        if len(files) > LOG_FILES:
            now = self._generation(name) + 1
            whole = f"{self.path(name)}/g={now:06d}.part"
            self._delete(whole)
            lines = [line for f in files for line in self.read_lines(f"{path}/{f}")]
            self.write_text(f"{whole}/{files[-1]}", "".join(line + "\n" for line in lines))
            self._move(whole, f"{self.path(name)}/g={now:06d}")
            self._drop_ended(name, now)

    def read_log(self, name: str, schema: T.StructType) -> DataFrame:
        path = self._gen_path(name)
        if not any(c.endswith(".json") for c in self._children(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(path)

    def reset_appended(self, name: str) -> None:
        """TRUNCATE of an append-only or partitioned table: a new generation.

        Generations ended at least ``keep_sec`` ago are removed."""
        now = self._generation(name) + 1
        p, fs = self._fs(f"{self.path(name)}/g={now:06d}")
        fs.mkdirs(p)
        self._drop_ended(name, now)

    def _drop_ended(self, name: str, now: int) -> None:
        """Remove generations that ended at least ``keep_sec`` ago."""
        if self.keep is None:
            return
        ended = None  # a generation ended when the one after it was begun
        for g in range(now - 1, 0, -1):
            later = f"{self.path(name)}/g={g + 1:06d}"
            if not self._exists(later):
                return
            if ended is None and self._age_sec(later) >= self.keep_sec:
                ended = g
            if ended is not None:
                self._delete(f"{self.path(name)}/g={g:06d}")

    def has_partition(self, name: str, column: str, value) -> bool:
        return self._exists(f"{self._gen_path(name)}/{column}={value}")

    def drop_partition(self, name: str, column: str, value) -> None:
        """Remove one partition: what an overwrite with no rows leaves standing."""
        self._delete(f"{self._gen_path(name)}/{column}={value}")

    def overwrite_partitions(self, name: str, df: DataFrame, partition_col: str) -> None:
        """Replace only the partitions present in ``df`` (dynamic overwrite)."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", CODEC).partitionBy(partition_col).parquet(self._gen_path(name)))

    def replace_partitions(self, name: str, df: DataFrame, column: str) -> None:
        """Replace the partitions that ``df`` holds; it may read the table itself.

        Written beside the table, marked, then moved in: until the mark the
        table is as it was, from then on ``finish_replace`` completes it.
        """
        staged = f"{self.path(name)}/_staged"
        self.finish_replace(name)
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(column).parquet(staged)
        self.mark(staged)
        self.finish_replace(name)

    def finish_replace(self, name: str) -> bool:
        """Move marked partitions in, also those of a run that was cut off; whether there were any."""
        staged = f"{self.path(name)}/_staged"
        if not self.marked(staged):
            self._delete(staged)
            return False
        for part in self._children(staged):
            if "=" in part:
                self._delete(f"{self._gen_path(name)}/{part}")
                self._move(f"{staged}/{part}", f"{self._gen_path(name)}/{part}")
        self._delete(staged)
        return True

    def replace_generation(self, name: str, df: DataFrame, column: str, notes: dict[str, str]) -> None:
        """The whole partitioned table anew, with small notes; it may read the table itself."""
        part = f"{self.path(name)}/_next"
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(column).parquet(part)
        for key, text in notes.items():
            self.write_text(f"{part}/_{key}", text)
        now = self._generation(name) + 1 if self.has_generation(name) else 1
        self._move(part, f"{self.path(name)}/g={now:06d}")
        self._drop_ended(name, now)

    def note(self, name: str, key: str) -> str | None:
        return self.read_text(f"{self._gen_path(name)}/_{key}")

    def partition_values(self, name: str, column: str) -> list[str]:
        return [c.split("=", 1)[1] for c in self._children(self._gen_path(name)) if c.startswith(f"{column}=")]

    def generation_size(self, name: str) -> int:
        """Bytes of the current generation."""
        return self.size(self._gen_path(name))

    def read_partitioned(self, name: str, schema: T.StructType) -> DataFrame:
        return self.read_appended(name, schema)

    def read_partition(self, name: str, schema: T.StructType, column: str, value) -> DataFrame:
        """One partition of a partitioned table, listing only its folder."""
        base = self._gen_path(name)
        path = f"{base}/{column}={value}"
        if not self._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(path)

    # -- SQL access ------------------------------------------------------------------
    def register_views(self, tables: dict[str, T.StructType], prefix: str = "",
                       partitioned: tuple[str, ...] = ()) -> list[str]:
        """Temp views over the current version of each table, so reports can
        be written in Spark SQL (``SELECT ... FROM run_metrics ...``)."""
        names = []
        for name, schema in tables.items():
            if name in partitioned:
                df = self.read_partitioned(name, schema)
            else:
                df = self.read(name, schema)
            view = f"{prefix}{name}"
            df.createOrReplaceTempView(view)
            names.append(view)
        return names

