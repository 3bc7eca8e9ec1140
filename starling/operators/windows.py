"""Per-key first/latest rows, sort + limit, distinct sort, union by name.

First/latest per key is written as ``min``/``max`` of a struct ``(order..., row...)``
grouped by key, not as ``row_number() OVER (PARTITION BY key)``: the aggregate is combined
map-side, so a key that holds a third of all rows is reduced in every map task and never
shipped whole to one reducer.  Struct comparison is lexicographic, and carrying the full
row after the order columns makes ties deterministic.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.operators.keys import row_index


def _pick_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], use_max: bool,
                  null_keys_distinct: bool) -> DataFrame:
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    # an order column travels once, as part of the order
    place = {c: f"__o{i}" for i, c in reversed(list(enumerate(order_by)))}
    payload = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                       *[F.col(f"`{c}`") for c in rest if c not in place])
    pick = F.max if use_max else F.min
    if not (null_keys_distinct and keys):
        picked = df.groupBy(*keys).agg(pick(payload).alias("__s"))
    else:
        # rows with a NULL key never conflict: they are grouped by their whole content (and the
        # partition they come from, which bounds the counts) and repeated as often as they occur,
        # so the input is read once and goes through one shuffle
        any_null = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        own = F.when(any_null, F.struct(payload.alias("row"), F.spark_partition_id().alias("part")))
        picked = (df.select(*keys, payload.alias("__s"), own.alias("__own")).groupBy(*keys, "__own")
                  .agg(pick("__s").alias("__s"), F.count(F.lit(1)).alias("__n"))
                  .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__own").isNull(), 1)
                                                             .otherwise(F.col("__n")).cast("int")))))
    return picked.select(*keys, *[F.col("__s").getField(place.get(c, c)).alias(c) for c in rest]).select(*cols)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  null_keys_distinct: bool = False) -> DataFrame:
    """First row per key in ``order_by`` order (``drop_duplicates(subset)`` with an
    explicit order, SURVEY Q1).  ``null_keys_distinct`` keeps every NULL-key row, as SQL
    UNIQUE does (Q3)."""
    return _pick_per_key(df, keys, order_by, False, null_keys_distinct)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key (``ORDER BY sk DESC LIMIT 1`` for every key at once)."""
    return _pick_per_key(df, keys, order_by, True, False)


def row_number_all(df: DataFrame, order_by: Sequence[str], id_col: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` without a single-partition window."""
    return row_index(df, order_by, id_col, start=1)


def _order(order_by: Sequence[Column | str | tuple[str, bool]]) -> list[Column]:
    out = []
    for o in order_by:
        if isinstance(o, tuple):
            c, asc = o
            out.append(F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last())
        elif isinstance(o, str):
            out.append(F.col(o).asc_nulls_first())
        else:
            out.append(o)
    return out


def sort_limit(df: DataFrame, order_by: Sequence, n: int) -> DataFrame:
    """ORDER BY + LIMIT n -> TakeOrderedAndProject (per-task top-n, then merge)."""
    return df.orderBy(*_order(order_by)).limit(n)


def sample_limit(df: DataFrame, n: int, order_by: Sequence | None = None) -> DataFrame:
    """LIMIT n preview; ordered (deterministic) when ``order_by`` is given."""
    return sort_limit(df, order_by, n) if order_by else df.limit(n)


def sort_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values, sorted (range-partitioned sort, no single task)."""
    return df.select(*cols).distinct().orderBy(*_order(cols))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames with differing columns; missing ones become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
