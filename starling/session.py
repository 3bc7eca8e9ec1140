"""Session helpers: a tuned local session for tests/bench, and the shared work folder.

On a cluster the work folder is the one named by ``spark.checkpoint.dir`` (a shared
HDFS / object-store path).  Only when the session has none (local tests) do we create
one under the system temp folder and register it, so every writer in the library can
rely on ``work_dir(spark)``.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "starling",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _session_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  A local session without one gets a temporary
    folder; on a cluster executors would not see such a folder, so there it must be set."""
    d = _session_checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        d = tempfile.mkdtemp(prefix="starling-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for ``name`` under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/starling-work/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back: a lost executor costs its running
    tasks only, and the planner knows the true size (so it broadcasts a small batch by itself)."""
    path = work_dir(df.sparkSession, name)
    for made in _MADE:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths written by ``written`` inside ``working_tables``, innermost last.
_MADE: list[list[str]] = []


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[list[str]]:
    """For a job whose results are all stored when it ends: the working tables that ``written`` made
    inside (by any thread of the job) are deleted then, and shuffle files of its finished queries with them.  Yields their paths so far: one
    taken off the list is kept."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE[:] = [m for m in _MADE if m is not made]
        for path in made:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        settle(spark)


#: Bytecode a generated method may have before whole-stage code gives way to code split into small methods, and Spark's default.
#: HotSpot never compiles a method of more than 8,000 bytes: it stays interpreted, several times slower.
METHOD_LIMIT, COMPILED, SPARK_DEFAULT = "spark.sql.codegen.hugeMethodLimit", "8000", "65535"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For a job whose projections have many columns: no generated method that HotSpot would leave interpreted.
    A limit the user has set stays."""
    if spark.conf.get(METHOD_LIMIT, SPARK_DEFAULT) != SPARK_DEFAULT:
        yield
        return
    spark.conf.set(METHOD_LIMIT, COMPILED)
    try:
        yield
    finally:
        spark.conf.unset(METHOD_LIMIT)


def settle(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished queries now: it acts when the driver's
    garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain Python can touch test folders."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
