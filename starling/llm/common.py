"""Small helpers shared by the operators: shared-folder tables, Arrow batch output."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starling.session import work_dir

#: Text handled at once inside a task; longer single texts form a slice of their own.
SLICE_BYTES = 2 << 20
#: Rows that travel to a Python worker at once; a longer single row travels alone.
BATCH_BYTES = 2 * SLICE_BYTES
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


#: Paths written by ``stored`` inside ``working_tables``, innermost last.
_MADE: list[list[str]] = []


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``BATCH_BYTES``, unless the user has set a bound.

    Spark's own is 64 MB: a task's whole partition of texts or sets then stands as one batch in the
    executor's direct memory (twice while it grows) and again in the Python worker."""
    if _ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    Cuts the lineage at files every executor can see (a lost executor costs only its
    running tasks), pins non-deterministic ids, and gives the planner real sizes.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    df.write.parquet(path)
    if _MADE:
        _MADE[-1].append(path)
        settle(spark)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished jobs now: it acts when the driver's
    garbage is collected, which a driver with little to do may not come to for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def working_tables() -> Iterator[list[str]]:
    """Collects the paths of the tables written inside, for ``delete_tables``, and settles after each."""
    _MADE.append([])
    try:
        yield _MADE[-1]
    finally:
        _MADE.pop()


def delete_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes working tables on whatever file system holds them."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_slices(text: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and size + n > max_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield start, len(lengths)


def extended(df: DataFrame, inputs: list[str], new: list[tuple[str, T.DataType]], score,
             drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus columns computed row by row: ``score(*arrays)`` gets the ``inputs`` columns
    of a slice of rows (the first is the text) and returns the new columns' values, in order.

    One pass, no shuffle.  The other columns pass through, but for those of ``drop``; an
    input column that clashes with a new one is replaced by it.
    """
    small_batches(df.sparkSession)
    gone = {n.lower() for n, _ in new} | {n.lower() for n in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in new])
    arrow = to_arrow_schema(schema)
    # named by position, so that clashing names cannot confuse them
    wide = df.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(inputs)],
                     *[F.col(f"`{f.name}`").alias(f"kept{i}") for i, f in enumerate(kept)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                part = batch.slice(a, b - a).columns
                values = score(*part[:len(inputs)])
                columns = [c.cast(arrow.field(i).type) for i, c in enumerate(part[len(inputs):])]
                columns += [pa.array(v, type=arrow.field(len(kept) + i).type) for i, v in enumerate(values)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return wide.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_docs: int, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` (the first is the text) and ``quality`` for ``max_docs`` labelled documents (all of
    them if there are no more): one row for each of the doc_ids with the smallest hashes, the same for the same tables.

    ``labels`` has doc_id and quality (0 or 1; other values and null ids are left out).  An id is labelled once,
    with its smallest quality, and gives one document, that with the smallest text hash, however many rows repeat it.
    """
    ids = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = ids.count()
    enough = max_docs + 10 * max_docs**0.5 + 100  # ten deviations more than are wanted, so that few rows are sorted
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = (ids.where(place < F.lit(int(min(1.0, enough / max(n, 1)) * (1 << 30)))).orderBy(place, "doc_id").limit(max_docs)
              .select(F.col("doc_id").alias("picked_id"), F.col("quality").alias("picked_quality")))
    row = F.struct(F.xxhash64(F.col(f"`{columns[0]}`")), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return (docs.select(F.col("doc_id").alias("id"), row.alias("row")).join(F.broadcast(picked), F.col("id") == F.col("picked_id"))
            .groupBy("id", "picked_quality").agg(F.min("row").alias("row"))
            .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)], F.col("picked_quality").alias("quality")))
