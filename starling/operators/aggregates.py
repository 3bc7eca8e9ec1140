"""Aggregations (F01-F14).  Plain ``groupBy().agg()`` gets partial (map-side) aggregation
from Spark for free, so a hot key is combined inside each map task before the shuffle.

Exact quantiles: ``F.percentile`` keeps a value->count map per group and merges all of it
in one task, which does not hold for a continuous column at 100 TB.  ``exact_percentiles``
counts distinct values, ranks them with one range shuffle (same machinery as the dense
ids) and fetches only the values whose count interval holds a target rank.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.exprs import null_label
from starling.operators.keys import _LOC, _PID, _ranged
from starling.session import written


# ---------------------------------------------------------------- counts

def count_rows(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """COUNT(*) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "row_count") -> DataFrame:
    """(table, rows) for every table of a registry, one union of aggregates."""
    frames = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col)
              for n, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def count_distinct(df: DataFrame, cols: Sequence[str], alias: str = "distinct_count",
                   approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """COUNT(DISTINCT cols); ``approx`` switches to HyperLogLog++ for huge inputs."""
    if approx:
        c = cols[0] if len(cols) == 1 else F.struct(*cols)
        return df.agg(F.approx_count_distinct(c, rsd).alias(alias))
    return df.agg(F.count_distinct(*[F.col(c) for c in cols]).alias(alias))


def success_rate(df: DataFrame, flag_col: str, flag_value=1, digits: int = 1,
                 hits: str = "successes", total: str = "total", rate: str = "success_rate") -> DataFrame:
    """SUM(CASE flag=v), COUNT(*), round(100*hits/total, digits), 0 when empty."""
    agg = df.agg(F.sum(F.when(F.col(flag_col) == F.lit(flag_value), 1).otherwise(0)).cast("long").alias(hits),
                 F.count(F.lit(1)).alias(total))
    pct = F.round(F.lit(100.0) * F.col(hits) / F.nullif(F.col(total), F.lit(0)), digits)
    return agg.select(F.coalesce(F.col(hits), F.lit(0)).cast("long").alias(hits), total,
                      F.coalesce(pct, F.lit(0.0)).alias(rate))


def monthly_distinct(df: DataFrame, date_col: str, id_col: str, limit: int | None = 6,
                     latest: bool = False, month_col: str = "month", count_col: str = "cnt") -> DataFrame:
    """distinct ids per 'YYYY-MM', ascending; first ``limit`` months (oldest, as the
    reference does) or the newest ones with ``latest=True``.  NULL dates are a group."""
    g = (df.select(F.date_format(F.col(date_col), "yyyy-MM").alias(month_col), id_col)
           .groupBy(month_col).agg(F.count_distinct(id_col).alias(count_col)))
    if limit is None:
        return g
    order = F.col(month_col).desc_nulls_last() if latest else F.col(month_col).asc_nulls_first()
    return g.orderBy(order).limit(limit)


def count_by_dim_attribute(fact: DataFrame, dim: DataFrame, fk: str, pk: str, attr: str,
                           label_col: str = "label", count_col: str = "value",
                           unknown: str = "Unknown") -> DataFrame:
    """fact inner-join dimension, count per attribute value, NULL label -> Unknown."""
    # pre-aggregate the fact to one row per key before the join: a hot key is reduced
    # map-side and never shuffled row by row
    per_key = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    d = dim.select(F.col(pk).alias("__pk"), F.col(attr).alias("__attr"))
    j = per_key.join(d, F.col("__fk") == F.col("__pk"), "inner")
    g = j.groupBy("__attr").agg(F.sum("__n").cast("long").alias(count_col))
    return g.select(null_label("__attr", unknown).alias(label_col), count_col)


def value_counts(df: DataFrame, col: str, drop_null: bool = False, count_col: str = "count") -> DataFrame:
    """count per value; SQL GROUP BY keeps NULL, pandas' ``value_counts`` drops it."""
    src = df.where(F.col(col).isNotNull()) if drop_null else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def bucket_histogram(df: DataFrame, col: str, buckets: Sequence[tuple[str, float | None, float | None]],
                     label_col: str = "label", count_col: str = "value") -> DataFrame:
    """fixed buckets [lo, hi) with empty buckets reported as 0; NULLs skipped.

    The bucket table is a literal of len(buckets) rows (proven bound), so it is broadcast
    and the data side is only partially aggregated to one row per bucket per task.
    """
    x = F.col(col)
    expr = None
    for label, lo, hi in buckets:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & (x < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    counted = (df.where(x.isNotNull()).select(expr.alias("__b"))
                 .groupBy("__b").agg(F.count(F.lit(1)).alias("__n")))
    spark = df.sparkSession
    order = spark.createDataFrame([(b[0], i) for i, b in enumerate(buckets)],
                                  T.StructType([T.StructField(label_col, T.StringType()),
                                                T.StructField("bucket_order", T.IntegerType())]))
    # ``counted`` has at most len(buckets) + 1 rows (one per label, plus "no bucket")
    return (order.join(F.broadcast(counted), F.col(label_col) == F.col("__b"), "left")
            .select(label_col, F.coalesce(F.col("__n"), F.lit(0)).cast("long").alias(count_col),
                    "bucket_order"))


def null_profile(df: DataFrame, table: str, table_col: str = "table_name",
                 column_col: str = "column_name", count_col: str = "null_count") -> DataFrame:
    """NULL count of every column in ONE pass, returned long (table, column, count)."""
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"c{i}").alias("v"))
                      for i, c in enumerate(df.columns)])
    return wide.select(F.inline(pairs)).select(F.lit(table).alias(table_col),
                                               F.col("k").alias(column_col),
                                               F.col("v").cast("long").alias(count_col))


def duplicate_count(df: DataFrame, alias: str = "duplicate_rows") -> DataFrame:
    """rows - distinct rows (pandas ``duplicated().sum()``; NULLs compare equal).

    One scan and one shuffle; equal rows are counted together in the map tasks first, so a
    row repeated a billion times is one partial count per task.  Lazy."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias(alias))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact ``SELECT DISTINCT *``: one scan, one shuffle, map-side combined."""
    return df.dropDuplicates()


def drop_repeated_rows(df: DataFrame, few: int = 400_000) -> DataFrame:
    """``SELECT DISTINCT *`` of a frame that is cheap to read twice.  Equal rows have equal 64-bit
    fingerprints, so rows whose fingerprint occurs once are kept without a shuffle of the rows; the others
    are compared whole.  With more than ``few`` repeated fingerprints every row is compared whole."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    repeated = written(df.select(mark.alias("__fp")).groupBy("__fp").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__fp"),
                       "repeated-rows")
    n = repeated.count()
    if n == 0:
        return df
    if n > few:
        return written(df.dropDuplicates(), "distinct-rows")
    marked = df.withColumn("__fp", mark)
    once = marked.join(repeated, "__fp", "left_anti").drop("__fp")
    again = marked.join(repeated, "__fp", "left_semi").drop("__fp").dropDuplicates()
    return written(once.unionByName(again), "distinct-rows")


def value_or_null(df: DataFrame, col: str) -> Column:
    """The column as double if it is fractional, with NaN as NULL; other types as they are."""
    c = F.col(f"`{col}`")
    return F.nullif(c, F.lit(float("nan"))) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else c


def filled(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """NULL and NaN -> the column's value of ``fills``.  A whole-number column becomes double,
    as a mean or median of whole numbers may lie between two of them."""
    done = {c: F.coalesce(value_or_null(df, c).cast("double"), F.lit(float(v))) for c, v in fills.items() if v is not None}
    return df.withColumns(done) if done else df


def mean_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL and NaN -> column mean (one aggregate, then literal fills)."""
    return filled(df, df.agg(*[F.avg(value_or_null(df, c)).alias(c) for c in cols]).first().asDict())


# ---------------------------------------------------------------- exact quantiles

class RankedColumns:
    """The non-NULL values of several columns in order, after one ranked pass: values by rank.

    1. unpivot to (column, value) and count each distinct pair: partial aggregation turns
       a value held by a third of all rows into ONE row with a large count;
    2. range-partition the distinct pairs (balanced: no pair can be hot) and take running
       counts inside each partition (a window per range partition);
    3. the driver receives only per-partition and per-column totals (bounded by the
       partition and column counts) and fetches the pairs whose count interval holds a
       wanted rank.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str]) -> None:
        pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])
        counts = (df.select(F.inline(pairs))
                    .where(F.col("v").isNotNull() & ~F.isnan(F.col("v")))
                    .groupBy("k", "v").agg(F.count(F.lit(1)).alias("__c")))
        ranged = _ranged(counts, ["k", "v"], None)
        self._ranged = ranged
        self.count = dict.fromkeys(cols, 0) | {r["k"]: r["n"] for r in ranged.groupBy("k").agg(F.sum("__c").alias("n")).collect()}
        part_tot = sorted((r[_PID], r["n"]) for r in ranged.groupBy(_PID).agg(F.sum("__c").alias("n")).collect())
        self._starts, acc = [], 0                 # global rank where each range partition starts
        for pid, n in part_tot:
            self._starts.append((acc, pid))
            acc += n
        self._base, acc = {}, 0                   # global rank where each column starts
        for k in sorted(self.count):
            self._base[k] = acc
            acc += self.count[k]

    def at(self, wanted: Iterable[tuple[str, int]]) -> dict[tuple[str, int], tuple[float, int]]:
        """(column, rank from 0) -> (the value there, how many values of the column are not larger)."""
        places = {}
        for c, rank in set(wanted):
            start, pid = self._starts[bisect.bisect_right(self._starts, (self._base[c] + rank, math.inf)) - 1]
            places[c, rank] = (start, pid, self._base[c] + rank - start)
        if not places:
            return {}
        holds = [(F.col(_PID) == pid) & (F.col("__before") <= local) & (F.col("__before") + F.col("__c") > local)
                 for _, pid, local in set(places.values())]
        # running counts of the wanted range partitions only
        w = Window.partitionBy(_PID).orderBy(_LOC).rowsBetween(Window.unboundedPreceding, -1)
        near = self._ranged.where(F.col(_PID).isin(sorted({pid for _, pid, _ in places.values()}))).select(_PID, _LOC, "__c", "v")
        cum = near.withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0)))
        rows = cum.where(functools.reduce(lambda a, b: a | b, holds)).select(_PID, "__before", "__c", "v").collect()
        found = {}
        for (c, rank), (start, pid, local) in places.items():
            r = next(r for r in rows if r[_PID] == pid and r["__before"] <= local < r["__before"] + r["__c"])
            found[c, rank] = (r["v"], start + r["__before"] + r["__c"] - self._base[c])
        return found


def _between(position: float, value) -> float:
    """Linear interpolation of ``value(rank)`` at a position between ranks."""
    low, high = value(math.floor(position)), value(math.ceil(position))
    return low if position == math.floor(position) else low + (position - math.floor(position)) * (high - low)


def exact_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Exact ``quantile_cont`` (linear interpolation) of every column, all in one ranked pass."""
    if not cols:
        return {}
    ranked = RankedColumns(df, cols)
    places = {c: [p * (ranked.count[c] - 1) for p in probs] if ranked.count[c] else None for c in cols}
    found = ranked.at((c, f(x)) for c, xs in places.items() for x in xs or () for f in (math.floor, math.ceil))
    return {c: [None] * len(probs) if xs is None else [_between(x, lambda r, c=c: found[c, r][0]) for x in xs]
            for c, xs in places.items()}


def clean_statistics(df: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """One row per column: its median and the [lower, upper] quantiles it has once its missing values
    are replaced by that median, all from one ranked pass; (column_name, n, missing, median, low, high),
    NULL statistics where the column has no value."""
    total = df.count()
    ranked = RankedColumns(df, cols)
    used = [c for c in cols if ranked.count[c]]
    middle = {c: 0.5 * (ranked.count[c] - 1) for c in used}
    first = ranked.at((c, f(x)) for c, x in middle.items() for f in (math.floor, math.ceil))
    median = {c: _between(x, lambda r, c=c: first[c, r][0]) for c, x in middle.items()}
    # in the filled column the missing values lie together, behind the values up to the median
    below = {c: first[c, math.floor(x)][1] for c, x in middle.items()}
    missing = {c: total - ranked.count[c] for c in cols}

    def source(c: str, rank: int) -> int | None:
        """The rank among the column's own values of a rank of the filled column; None: a filled one."""
        if rank < below[c]:
            return rank
        return None if rank < below[c] + missing[c] else rank - missing[c]

    places = {c: [p * (total - 1) for p in (lower, upper)] for c in used}
    ranks = {(c, source(c, f(x))) for c, xs in places.items() for x in xs for f in (math.floor, math.ceil)}
    found = ranked.at(r for r in ranks if r[1] is not None)

    def value(c: str, rank: int) -> float:
        own = source(c, rank)
        return median[c] if own is None else found[c, own][0]

    rows = [(c, total, missing[c], median[c], *[_between(x, lambda r, c=c: value(c, r)) for x in places[c]]) if c in median
            else (c, total, missing[c], None, None, None) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column_name string, n long, missing long, median double, low double, high double")


def quantile_stats(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.5, 0.01, 0.99),
                   names: Sequence[str] = ("median", "p01", "p99"), approx: bool = False,
                   accuracy: int = 10000) -> DataFrame:
    """one row per column with its median / 1 % / 99 % quantiles."""
    spark = df.sparkSession
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                       for c in cols]).first()
        vals = {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    else:
        vals = exact_percentiles(df, cols, probs)
    schema = T.StructType([T.StructField("column_name", T.StringType())] +
                          [T.StructField(n, T.DoubleType()) for n in names])
    return spark.createDataFrame([(c, *[None if v is None else float(v) for v in vals[c]]) for c in cols],
                                 schema)


def keep_min_per_key(df: DataFrame, key_cols: Sequence[str], order_col: str) -> DataFrame:
    """keep, per key, the row with the smallest ``order_col`` (DELETE ... NOT MIN(rowid)).

    ``min(struct(order, row))`` aggregates partially on the map side, so a key holding a
    third of the data never lands whole in one task.
    """
    rest = [c for c in df.columns if c not in key_cols]
    payload = F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in rest if c != order_col],
                       F.col(order_col))
    g = df.groupBy(*key_cols).agg(F.min(payload).alias("__s"))
    return g.select(*key_cols, *[F.col("__s." + c).alias(c) for c in rest if c != order_col],
                    F.col("__s." + order_col).alias(order_col)).select(*df.columns)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SELECT DISTINCT col WHERE col IS NOT NULL."""
    return df.where(F.col(col).isNotNull()).select(col).distinct()
