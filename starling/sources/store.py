"""Versioned Parquet table store.

Data goes to folders that are never written again; which folders make up a table is said by one
append-only commit log ``<root>/_log/`` (one small text file per commit, written through Spark's
file commit protocol).  A reader takes the folders committed when it asks, so it never sees rows of a
write that failed, is still running, or came later.

* ``replace``: the table is the new folder.  A job may read a table and replace it in the same
  plan, and a failed job leaves the table as it was.
* ``append``: one more folder, published like any other.
* A table may be partitioned by one text column (``<root>/<table>/<column>=<value>/__v=<id>/``);
  ``replace_partitions`` then puts new rows in place of some of its values only and leaves the folders of
  all others alone.
* ``transaction``: all writes inside are published by one log file, or none of them.  Inside, reads see
  the writes already made.  ``mark_batch`` puts (stream, batch id) into the same commit.

One job writes at a time (a store object may be shared by its threads).  Works on any Hadoop-compatible
shared file system; the root defaults to a folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from starling.registry import Registry
from starling.session import work_dir

# what a line of the log does: start a table anew, add a folder, drop a partition, note a batch
CLEAR, PUT, DROP, BATCH = "clear", "put", "drop", "batch"
VERSION = "__v"
LOG = "seq long, op string, name string, folder string, partition string"
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None, registry: Registry | None = None):
        self.spark = spark
        self.root = (root or work_dir(spark, "warehouse")).rstrip("/")
        self.registry = registry
        self._tables: dict[str, list[tuple[str, str]]] | None = None   # (folder, partition) of every table, as this job sees it
        self._batches: dict[str, int] = {}                             # last batch noted of each stream
        self._schemas: dict[str, T.StructType] = {}                    # schemas of tables created empty here
        self._pending: list[tuple[str, str, str, str]] | None = None   # entries of an open transaction
        self._last = 0
        # loads may publish from several threads (concurrent Spark jobs); commits must not overlap
        self._lock = threading.RLock()

    # -- log ----------------------------------------------------------------------
    def _log_dir(self) -> str:
        return f"{self.root}/_log"

    def refresh_log(self) -> None:
        """Re-read the commit log (to see commits made by other jobs since)."""
        with self._lock:
            self._tables = None

    def log(self) -> DataFrame:
        """Every committed entry: seq, op, name, folder, partition."""
        try:
            return self.spark.read.schema(LOG).option("sep", "\t").csv(self._log_dir())
        except AnalysisException:
            return self.spark.createDataFrame([], LOG)

    def _state(self) -> dict[str, list[tuple[str, str]]]:
        with self._lock:
            if self._tables is None:
                self._tables, self._batches = {}, {}
                log = self.log()
                # only what still counts reaches the driver: entries since a table's last start, and each stream's last batch
                started = log.where(F.col("op") == CLEAR).groupBy("name").agg(F.max("seq").alias("from"))
                batches = (log.where(F.col("op") == BATCH).groupBy("name").agg(F.max(F.col("folder").cast("long")).alias("n"))
                           .select(F.lit(0).cast("long").alias("seq"), F.lit(BATCH).alias("op"), "name", F.col("n").cast("string").alias("folder"),
                                   F.lit(None).cast("string").alias("partition")))
                live = log.where(F.col("op") != BATCH).join(started, "name", "left").where("from IS NULL OR seq >= from")
                rows = live.select("seq", "op", "name", "folder", "partition").unionByName(batches).collect()
                for r in sorted(rows, key=lambda r: r["seq"]):
                    self._apply(r["op"], r["name"], r["folder"] or "", r["partition"] or "")
                    self._last = max(self._last, r["seq"])
            return self._tables

    def _apply(self, op: str, name: str, folder: str, partition: str) -> None:
        if op == BATCH:
            self._batches[name] = int(folder)
        elif op == CLEAR:
            self._tables[name] = []
        elif op == DROP:
            self._tables[name] = [f for f in self._tables.get(name, []) if f[1] != partition]
        else:
            self._tables.setdefault(name, []).append((folder, partition))

    def _commit(self, entries: Sequence[tuple[str, str, str, str]]) -> None:
        """Publish ``(op, name, folder, partition)`` entries with ONE small append to the commit log."""
        if not entries:
            return
        with self._lock:
            self._state()
            for e in entries:
                self._apply(*e)
            if self._pending is not None:
                self._pending.extend(entries)
                return
            first = max(self._last + 1, time.time_ns())
            self._last = first + len(entries)
            rows = [(first + i, *e) for i, e in enumerate(entries)]
            (self.spark.createDataFrame(rows, LOG).coalesce(1)
                 .write.mode("append").option("sep", "\t").csv(self._log_dir()))

    @contextmanager
    def transaction(self) -> Iterator[TableStore]:
        """Publishes everything written inside at its end, at once; after an error, nothing."""
        with self._lock:
            if self._pending is not None:
                raise RuntimeError("a transaction is open already")
            self._state()
            self._pending = []
        try:
            yield self
        except BaseException:
            with self._lock:
                self._pending, self._tables = None, None
            raise
        with self._lock:
            entries, self._pending = self._pending, None
            self._tables = None  # the entries are applied again, from what is committed
            self._commit(entries)

    # -- ledger of batches ---------------------------------------------------------
    def has_batch(self, stream: str, batch_id: int) -> bool:
        """Whether the batch (or a later one) of the stream is committed; batch ids only grow."""
        self._state()
        return self._batches.get(stream, -1) >= batch_id

    def mark_batch(self, stream: str, batch_id: int) -> None:
        self._commit([(BATCH, stream, str(batch_id), "")])

    # -- reads --------------------------------------------------------------------
    def exists(self, table: str) -> bool:
        """A03 ``check_source_database``: the table is committed (it may be empty)."""
        return table in self._state()

    def folders(self, table: str) -> list[str]:
        """Paths of the folders that make up the table now."""
        return [f"{self.root}/{table}/{f}" if not p else f"{self.root}/{table}/{p}/{VERSION}={f}" for f, p in self._state().get(table, [])]

    def read(self, table: str) -> DataFrame:
        held = self._state().get(table)
        if not held:
            schema = self._schemas.get(table)
            if schema is None and self.registry is not None and table in self.registry.tables:
                schema = self.registry[table].schema
            if schema is None or (held is None and table not in self._schemas and self.registry is None):
                raise KeyError(f"table {table!r} does not exist or has no schema in {self.root}")
            return self.spark.createDataFrame([], schema)
        column = held[0][1].partition("=")[0]
        if not column:
            return self.spark.read.parquet(*self.folders(table))
        # the schema is given, so that Spark takes partition values as text
        data = self.spark.read.parquet(self.folders(table)[0]).schema
        schema = T.StructType([f for f in data.fields if f.name not in (column, VERSION)]
                              + [T.StructField(column, T.StringType()), T.StructField(VERSION, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*self.folders(table)).drop(VERSION)

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    # -- writes -------------------------------------------------------------------
    def _write(self, table: str, df: DataFrame, partition_by: str | None) -> list[tuple[str, str, str, str]]:
        """Writes ``df`` to folders of its own; the entries that publish them."""
        version = f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        if partition_by is None:
            df.write.mode("error").parquet(f"{self.root}/{table}/{version}")
            return [(PUT, table, version, "")]
        base = f"{self.root}/{table}"
        # rows of a value go to one shuffle partition, which adaptive execution splits if it is large
        rows = df.withColumn(VERSION, F.lit(version)).hint("rebalance", F.col(partition_by))
        rows.write.mode("append").partitionBy(partition_by, VERSION).parquet(base)
        try:
            written = self.spark.read.option("basePath", base).parquet(f"{base}/*/{VERSION}={version}")
        except AnalysisException:  # no rows, no folders
            return []
        files = F.regexp_extract(F.col("_metadata.file_path"), rf"/{re.escape(partition_by)}=([^/]*)/", 1)
        return [(PUT, table, version, f"{partition_by}={r[0]}") for r in written.select(files).distinct().collect()]

    def partition_of(self, table: str) -> str | None:
        """The column the table is partitioned by."""
        held = self._state().get(table)
        return (held[0][1].partition("=")[0] or None) if held else None

    def replace(self, table: str, df: DataFrame, partition_by: str | None = None) -> None:
        """The table becomes ``df``; a partitioned table keeps its partition column if ``df`` has it."""
        kept = self.partition_of(table)
        partition_by = partition_by or (kept if kept in df.columns else None)
        self._commit([(CLEAR, table, "", ""), *self._write(table, df, partition_by)])
        self._schemas[table] = df.schema

    def append(self, table: str, df: DataFrame, partition_by: str | None = None) -> None:
        """A10: rows added in folders of their own (creates the table if missing); a partitioned table
        keeps its partition column."""
        self._schemas.setdefault(table, df.schema)
        start = [] if self.exists(table) else [(CLEAR, table, "", "")]
        self._commit([*start, *self._write(table, df, self.partition_of(table) or partition_by)])

    def append_counted(self, table: str, df: DataFrame, partition_by: str | None = None, value: str | None = None) -> int:
        """``append`` of rows that are computed once, on their way into the table; how many there were.
        Without rows nothing is published.  ``value``: the one value (a plain name) that all rows have in the
        partition column, so they need no shuffle by it."""
        column = self.partition_of(table) or partition_by
        if value is not None and column is not None and _PLAIN.fullmatch(value):
            version = f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
            df.drop(column).write.mode("error").parquet(f"{self.root}/{table}/{column}={value}/{VERSION}={version}")
            entries = [(PUT, table, version, f"{column}={value}")]
        else:
            entries = self._write(table, df, column)
        paths = [f"{self.root}/{table}/{f}" if not p else f"{self.root}/{table}/{p}/{VERSION}={f}" for _, _, f, p in entries]
        n = self.spark.read.parquet(*paths).count() if paths else 0
        if n:
            self._schemas.setdefault(table, df.schema)
            start = [] if self.exists(table) else [(CLEAR, table, "", "")]
            self._commit([*start, *entries])
        return n

    def replace_partitions(self, table: str, df: DataFrame, partition_by: str, values: Iterable[str | None]) -> None:
        """The rows of the ``values`` of the partition column become ``df``, which has no others; the
        folders of all other values stay.  A value without rows in ``df`` is gone afterwards."""
        if self.partition_of(table) not in (None, partition_by):
            raise ValueError(f"{table} is not partitioned by {partition_by}")
        gone = [(DROP, table, "", f"{partition_by}={DEFAULT_PARTITION if v is None else v}") for v in values]
        if bad := [v for v in values if v is not None and not _PLAIN.fullmatch(v)]:
            raise ValueError(f"partition values must be plain names: {bad[:3]}")
        start = [] if self.exists(table) else [(CLEAR, table, "", "")]
        added = self._write(table, df, partition_by)
        if other := {e[3] for e in added} - {e[3] for e in gone}:
            raise ValueError(f"rows of other partitions than those named: {sorted(other)[:3]}")
        self._commit([*start, *gone, *added])
        self._schemas.setdefault(table, df.schema)

    def compact(self, table: str) -> None:
        """The same rows in as few folders as possible (each append leaves one)."""
        self.replace(table, self.read(table), self.partition_of(table))

    def create(self, table: str, schema: T.StructType, refresh: bool = False) -> bool:
        """A13 for one table: (re)create empty; returns True if created.

        An empty table is an entry without folders; reads give an empty frame with the
        registered schema."""
        return bool(self.create_many([(table, schema)], refresh))

    def create_many(self, specs: list[tuple[str, T.StructType]], refresh: bool = False) -> list[str]:
        made = [(t, s) for t, s in specs if refresh or not self.exists(t)]
        for t, s in made:
            self._schemas[t] = s
        self._commit([(CLEAR, t, "", "") for t, _ in made])
        return [t for t, _ in made]

    def create_all(self, registry: Registry, refresh: bool = False) -> list[str]:
        """drop+create every table (refresh) or create the missing ones, in one commit."""
        self.registry = registry
        return self.create_many([(s.name, s.schema) for s in registry], refresh)

    def tables(self) -> dict[str, DataFrame]:
        names = self.registry.names() if self.registry is not None else []
        return {n: self.read(n) for n in names if self.exists(n) or self.registry is not None}
