"""Join helpers.

Strategy: equi-joins are written declaratively and Spark/AQE choose the physical join.
AQE converts a sort-merge join to a broadcast join at runtime when the measured shuffle
size of one side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a checked
size), and splits skewed partitions of sort-merge joins (``skewJoin``).  No join here
carries a hint, so no plan depends on a row count taken beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_inner_multikey(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join on several same-named columns."""
    return left.join(right, list(on), "inner")


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL matches NULL (pandas ``merge`` semantics); the right-side
    key columns are dropped."""
    r = right.select(*[F.col(c).alias("__r_" + c) if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col("__r_" + c))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*["__r_" + c for c in on])


def anti_join(child: DataFrame, parent: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent``.

    Written as LEFT ANTI (not SQL ``NOT IN``, which returns nothing once the parent key
    has a NULL; SURVEY Q15).  Rows with a NULL child key are kept (no match)."""
    p = parent.select(*[F.col(rc).alias(f"__p{i}") for i, (_, rc) in enumerate(pairs)])
    cond = None
    for i, (lc, _) in enumerate(pairs):
        e = F.col(lc) == F.col(f"__p{i}")
        cond = e if cond is None else cond & e
    return child.join(p, cond, "left_anti")


def lookup_left(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str,
                out_col: str | None = None) -> DataFrame:
    """Dictionary lookup as a LEFT join; a miss gives NULL.

    ``lookup`` must be unique on ``lookup_key`` (dimensions are)."""
    lk = lookup.select(F.col(lookup_key).alias("__lk"), F.col(value).alias("__lv"))
    out = df.join(lk, F.col(key) == F.col("__lk"), "left").drop("__lk")
    return out.withColumnRenamed("__lv", out_col or value)


def join_one_to_many(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One-to-many inner join on a single key."""
    return left.join(right, on, "inner")
