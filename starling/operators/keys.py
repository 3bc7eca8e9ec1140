"""Keys: dense surrogate ids, readable composite ids, missing-id fill, incremental ids.

The central piece is :func:`row_index`, a distributed ``ROW_NUMBER() OVER (ORDER BY k)``.
A bare window without PARTITION BY moves every row into one task; instead we

1. range-partition by the order key (``repartitionByRange``: a sampled, balanced shuffle),
2. sort inside each partition and take the position in the partition
   (``monotonically_increasing_id`` minus ``partition_id << 33`` is exactly that),
3. write the rows to the shared work folder (compressed columns; a checkpoint's uncompressed rows
   take several times the space), so counts and positions come from the same materialised rows even
   if an executor is lost and a partition is recomputed,
4. add the prefix sum of per-partition counts: a table with one row per partition, so
   broadcasting it has a proven size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.functions.exprs import blank_to_null, hash_id, natural_key_text, text_key  # noqa: F401
from starling.session import ensure_checkpoint_dir, written

_PID, _LOC = "__pid", "__loc"


def _order_exprs(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def _ranged(df: DataFrame, order_by: Sequence[Column | str], num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # tie-breaker: a content hash, so a hot group of equal order keys (one value held by a
    # third of the rows) is spread over several range partitions instead of landing in one;
    # deterministic, so a recomputed task places every row in the same partition again
    exprs = _order_exprs(order_by) + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()]
    pid = F.spark_partition_id().cast("long")
    # without an explicit count AQE sizes the range partitions from the data (coalescing
    # keeps consecutive ranges, so the global order across partitions is preserved): a
    # 1,000-row dimension is not spread over thousands of empty tasks on a cluster
    ranged = df.repartitionByRange(num_partitions, *exprs) if num_partitions else df.repartitionByRange(*exprs)
    placed = (ranged
              .sortWithinPartitions(*exprs)
              .withColumn(_PID, pid)
              .withColumn(_LOC, F.monotonically_increasing_id() - F.shiftleft(pid, 33)))
    return written(placed, "ranged-rows") if _storable(placed) else placed.checkpoint(eager=True)


def _storable(df: DataFrame) -> bool:
    """Whether a Parquet file can hold the frame as it is."""
    names = [c.lower() for c in df.columns]
    return len(set(names)) == len(names) and not any(t in kind for _, kind in df.dtypes for t in ("void", "interval", "variant"))


def _partition_offsets(ranged: DataFrame) -> DataFrame:
    counts = ranged.groupBy(_PID).agg((F.max(_LOC) + 1).alias("__cnt"))
    # one row per partition: a single-task window here is bounded by the partition count
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_PID, F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))


def row_index(df: DataFrame, order_by: Sequence[Column | str], id_col: str = "id",
              start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following ``order_by`` (G01, C01 core).

    ``order_by`` should be a total order for reproducible ids; ties get some order.
    """
    ranged = _ranged(df, order_by, num_partitions)
    offsets = _partition_offsets(ranged)
    out = ranged.join(F.broadcast(offsets), _PID, "inner")
    return (out.withColumn(id_col, (F.lit(start) + F.col("__off") + F.col(_LOC)).cast("long"))
               .drop(_PID, _LOC, "__off"))


def dense_surrogate_key(df: DataFrame, key_cols: Sequence[str], id_col: str = "id",
                        start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """One id per distinct ``key_cols`` tuple, 1..n in key order."""
    keys = df.select(*key_cols).distinct()
    return row_index(keys, key_cols, id_col, start, num_partitions).select(id_col, *key_cols)


def positional_id(df: DataFrame, order_by: Sequence[str], prefix: str, id_col: str = "id",
                  offset: int = 0) -> DataFrame:
    """``<prefix>_<i>`` by position in ``order_by`` (i from ``offset``), e.g. f_0, f_1."""
    tmp = "__pos"
    out = row_index(df, order_by, tmp, start=offset)
    return out.withColumn(id_col, F.concat(F.lit(prefix + "_"), F.col(tmp).cast("string"))).drop(tmp)


def composite_text_key(df: DataFrame, id_col: str, prefix: str,
                       parts: Sequence[tuple[str, str]]) -> DataFrame:
    """Readable deterministic id, e.g. ``prot_<type>_d<days>``."""
    return df.withColumn(id_col, text_key(prefix, parts))


def fill_missing_ids(df: DataFrame, id_col: str, prefix: str, key_cols: Sequence[str],
                     random: bool = False) -> DataFrame:
    """NULL/blank ids become ``<prefix>_<32 hex>``; existing ids are kept.

    The hash is over ``key_cols`` (deterministic: reloads give the same id, Q6).  With
    ``random=True`` a uuid is used instead, like the reference's refresh mode.
    """
    gen = (F.concat(F.lit(prefix + "_"), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 32))
           if random else hash_id(prefix, *key_cols))
    if id_col not in df.columns:
        return df.withColumn(id_col, gen)
    return df.withColumn(id_col, F.when(blank_to_null(id_col).isNull(), gen).otherwise(F.col(id_col)))


def natural_key(df: DataFrame, out_col: str, cols: Sequence[str], sep: str = "|") -> DataFrame:
    """Null-tolerant trimmed composite key text."""
    return df.withColumn(out_col, natural_key_text(*cols, sep=sep))


def null_safe_cond(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def assign_incremental_keys(batch: DataFrame, dim: DataFrame | None, natural_cols: Sequence[str],
                            id_col: str) -> tuple[DataFrame, DataFrame]:
    """Ids for the batch's natural keys, reusing ids already in ``dim``.

    Unseen keys (null-safe comparison: a NULL part is a value, Q7) get max(id)+1.. in key
    order.  Returns (batch with ``id_col``, new dimension rows ``[id_col, *natural_cols]``).
    """
    keys = batch.select(*natural_cols).distinct()
    if dim is None:
        base = 0
        new_keys = keys
        existing = None
    else:
        existing = dim.select(id_col, *natural_cols)
        new_keys = keys.join(existing, null_safe_cond(keys, existing, natural_cols), "left_anti")
        base = existing.agg(F.max(id_col)).first()[0] or 0
    new_rows = row_index(new_keys, list(natural_cols), id_col, start=int(base) + 1).select(id_col, *natural_cols)
    mapping = new_rows if existing is None else existing.unionByName(new_rows)
    m = mapping.select(id_col, *[F.col(c).alias("__nk_" + c) for c in natural_cols])
    cond = None
    for c in natural_cols:
        e = batch[c].eqNullSafe(m["__nk_" + c])
        cond = e if cond is None else cond & e
    cols = [c for c in batch.columns if c != id_col]
    mapped = batch.join(m, cond, "left").select(*[batch[c] for c in cols], m[id_col])
    return mapped, new_rows
