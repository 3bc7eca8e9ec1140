"""Warehouse load operators (D01-D10, D12): dimensions, calendar, facts, bridge, and the
constraint semantics SQL tables give for free (insert-or-ignore, upsert).

All are pure ``DataFrame -> DataFrame``; the caller writes the result (sources.store).
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.exprs import iso_date, try_date
from starling.operators.joins import anti_join, join_null_safe
from starling.operators.keys import row_index
from starling.operators.windows import _pick_per_key, first_per_key
from starling.session import written


def build_dimension(df: DataFrame, cols: Sequence[str]) -> DataFrame | None:
    """Project key + attributes and de-duplicate; None when a column is missing."""
    if any(c not in df.columns for c in cols):
        return None
    return df.select(*cols).distinct()


def as_date(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.DateType):
        return F.col(col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(col))
    return try_date(col)


def calendar_rows(dates: DataFrame, date_col: str = "d") -> DataFrame:
    """Calendar attributes of a DATE column (D04 body)."""
    d = F.col(date_col)
    return dates.select(
        iso_date(d).alias("full_date"),
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"),
        F.year(d).alias("year"), F.weekofyear(d).alias("week"))


def build_dim_time(df: DataFrame, date_col: str, existing: DataFrame | None = None,
                   id_col: str = "time_id") -> DataFrame:
    """New calendar rows for the distinct valid dates of ``date_col``.

    Dates are de-duplicated after truncation to the day (repairs Q22); unparsable/NULL
    dates are dropped; ids continue after ``existing``'s max id, in date order."""
    if isinstance(df.schema[date_col].dataType, T.StringType):
        df = df.select(date_col).distinct()  # each text is parsed once
    dates = df.select(as_date(df, date_col).alias("d")).where(F.col("d").isNotNull()).distinct()
    rows = calendar_rows(dates)
    base = 0
    if existing is not None:
        rows = anti_join(rows, existing, [("full_date", "full_date")])
        base = existing.agg(F.max(id_col)).first()[0] or 0
    out = row_index(rows, ["full_date"], id_col, start=int(base) + 1)
    return out.select(id_col, "full_date", "day", "month", "month_name", "quarter", "year", "week")


def date_to_time_key(df: DataFrame, date_col: str, dim_time: DataFrame, out_col: str,
                     id_col: str = "time_id") -> DataFrame:
    """Map the row's date to ``time_id`` (LEFT join; unmatched/invalid -> NULL).

    dim_time has one row per calendar day, so the planner broadcasts it from its size."""
    key = iso_date(as_date(df, date_col))
    lk = dim_time.select(F.col("full_date").alias("__fd"), F.col(id_col).alias(out_col))
    return df.withColumn("__fd_key", key).join(lk, F.col("__fd_key") == F.col("__fd"), "left") \
             .drop("__fd_key", "__fd")


def project_fact(df: DataFrame, columns: Sequence[str], schema: T.StructType | None = None,
                 defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Select fact columns in order; absent ones take ``defaults`` (else NULL), typed by
    ``schema`` when given (D06: missing measures = 0)."""
    defaults = defaults or {}
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    out = []
    for c in columns:
        if c in df.columns:
            e = F.col(c)
        else:
            e = F.lit(defaults.get(c))
        if c in types:
            e = e.cast(types[c])
        out.append(e.alias(c))
    return df.select(*out)


def build_fact(raw: DataFrame, case_col: str, order_by: Sequence[str], columns: Sequence[str],
               schema: T.StructType | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """First row per case (explicit order), projected to the fact columns.  Only
    the columns that the fact or the order needs travel through the pick."""
    used = [c for c in dict.fromkeys([case_col, *order_by, *columns]) if c in raw.columns]
    first = first_per_key(raw.select(*used), [case_col], order_by, null_keys_distinct=True)
    return project_fact(first, columns, schema, defaults)


def build_bridge(raw: DataFrame, facts: DataFrame, case_col: str, sk_col: str, member_col: str,
                 unique_facts: bool = False) -> DataFrame:
    """Raw rows joined to their fact on the case -> distinct (sk, member) pairs.

    ``unique_facts``: the caller guarantees one fact per case and one case per sk (distinct pairs of
    case and member then give distinct pairs of sk and member)."""
    # de-duplicate (case, member) first: partial aggregation shrinks a hot case before
    # the join shuffles it
    r = raw.select(case_col, member_col).distinct()
    f = facts.select(case_col, sk_col)
    pairs = r.join(f, case_col, "inner").select(sk_col, member_col)
    return pairs if unique_facts else pairs.distinct()


def insert_or_ignore(target: DataFrame | None, batch: DataFrame, key_cols: Sequence[str],
                     order_by: Sequence[str], unique_batch: bool = False, cut_target: bool = False) -> DataFrame:
    """Rows of ``batch`` to append under INSERT OR IGNORE with one unique key.

    First row per key wins inside the batch (explicit order, Q1); keys already in
    ``target`` are ignored; rows with a NULL key part never conflict (SQL UNIQUE, Q3).
    ``unique_batch=True`` skips the in-batch pick when the caller guarantees one row per
    key (e.g. the output of :func:`build_fact`).

    ``cut_target`` is for a batch read from files (cheap to read twice, its size known): the target is
    first cut down to the batch's keys by a semi join, whose small side Spark broadcasts by its size (a
    left anti join's cannot be), so a small batch does not shuffle the target."""
    cand = batch if unique_batch else first_per_key(batch, key_cols, order_by, null_keys_distinct=True)
    if target is None:
        return cand
    held = rows_of_keys(target.select(*key_cols), batch, key_cols) if cut_target else target
    return anti_join(cand, held, [(k, k) for k in key_cols])


def rows_of_keys(target: DataFrame, batch: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is one of ``batch``'s (NULL key parts match nothing)."""
    keys = batch.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key_cols)]).distinct()
    cond = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(key_cols)])
    return target.join(keys, cond, "left_semi")


def insert_or_ignore_multi(target: DataFrame | None, batch: DataFrame,
                           key_sets: Sequence[Sequence[str]], order_col: str) -> DataFrame:
    """INSERT OR IGNORE with several unique keys, greedy in arrival order (Q2).

    Sequential semantics: walk rows by ``order_col``; keep a row iff none of its keys is
    taken yet.  Parallel rounds give the same result: a row that is first, among the
    undecided rows, in *every* one of its key groups is kept (all earlier rows sharing a
    key were rejected); then every undecided row sharing a key with a kept row is
    rejected.  Each round keeps at least the earliest undecided row, so the loop ends;
    rounds equal the longest conflict chain.  No cap: we run to the fixpoint and cut the
    lineage with a reliable ``checkpoint()`` each round.  ``order_col`` must be unique.
    """
    undecided = batch
    if target is not None:
        for ks in key_sets:
            undecided = anti_join(undecided, target, [(k, k) for k in ks])
    undecided = undecided.checkpoint(eager=True)
    kept_parts = []
    while not undecided.isEmpty():
        cand = undecided
        firsts = []
        for i, ks in enumerate(key_sets):
            not_null = None
            for k in ks:
                e = F.col(k).isNotNull()
                not_null = e if not_null is None else not_null & e
            m = (undecided.where(not_null).groupBy(*ks).agg(F.min(order_col).alias(f"__m{i}"))
                 .select(*[F.col(k).alias(f"__k{i}_{k}") for k in ks], f"__m{i}"))
            cond = None
            for k in ks:
                e = F.col(k) == F.col(f"__k{i}_{k}")
                cond = e if cond is None else cond & e
            cand = cand.join(m, cond, "left").drop(*[f"__k{i}_{k}" for k in ks])
            firsts.append(F.col(f"__m{i}").isNull() | (F.col(f"__m{i}") == F.col(order_col)))
        ok = firsts[0]
        for f in firsts[1:]:
            ok = ok & f
        kept = cand.where(ok).select(*batch.columns).checkpoint(eager=True)
        kept_parts.append(kept)
        rest = undecided.join(kept.select(order_col), order_col, "left_anti")
        for ks in key_sets:
            rest = anti_join(rest, kept, [(k, k) for k in ks])
        undecided = rest.checkpoint(eager=True)
    if not kept_parts:
        return batch.limit(0)
    out = kept_parts[0]
    for k in kept_parts[1:]:
        out = out.unionByName(k)
    return out


def upsert_last_wins(target: DataFrame | None, batch: DataFrame, key_cols: Sequence[str],
                     order_by: Sequence[str]) -> DataFrame:
    """The new table after INSERT ... ON CONFLICT(key) DO UPDATE (last row wins).

    = newest batch row per key  UNION  target rows whose key is not in the batch.
    (``MERGE INTO`` needs a table format with row-level writes; on plain Parquet this
    anti-join + union, written to a new version, is the equivalent.)"""
    latest = _pick_per_key(batch, key_cols, order_by, True, True)
    if target is None:
        return latest
    keep = anti_join(target, latest, [(k, k) for k in key_cols])
    return keep.unionByName(latest.select(*target.columns))


def upsert_partitions(store, table: str, batch: DataFrame, key_cols: Sequence[str], order_by: Sequence[str],
                      partition_by: str) -> list[str | None]:
    """D10 on a stored table partitioned by ``partition_by`` (few values, e.g. months): last row wins.

    The touched partitions are those of the batch and those that hold an old row of its keys; only
    they are read whole and written anew, in place of their old folders.  A key that changes partition
    leaves its old one.  Returns the touched values.  Rows with a NULL key part are added as they are."""
    latest = written(_pick_per_key(batch, key_cols, order_by, True, True), "upsert-batch")
    target = store.read_or_none(table)
    if target is None:
        store.replace(table, latest, partition_by)
        return [r[0] for r in latest.select(partition_by).distinct().collect()]
    old = rows_of_keys(target.select(*key_cols, partition_by), latest, key_cols).select(partition_by)
    touched = [r[0] for r in old.union(latest.select(partition_by)).distinct().collect()]
    if not touched:
        return []
    c = F.col(partition_by)
    inside = c.isin([v for v in touched if v is not None])
    inside = (inside | c.isNull()) if None in touched else inside
    keep = anti_join(target.where(inside), latest, [(k, k) for k in key_cols])
    store.replace_partitions(table, keep.unionByName(latest.select(*target.columns)), partition_by, touched)
    return touched


def fact_by_natural_keys(raw: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]],
                         how: str = "inner") -> DataFrame:
    """Resolve several dimension ids by their multi-column natural keys (null-safe)."""
    out = raw
    for dim, natural, id_col in lookups:
        out = join_null_safe(out, dim.select(id_col, *natural), list(natural), how)
    return out


def load_dimension_mode(store, table: str, cand: DataFrame, key_cols: Sequence[str], order_by: Sequence[str],
                        refresh: bool) -> DataFrame:
    """Refresh -> the table becomes this batch (keys still enforced, Q4);
    incremental -> the batch's new rows are appended to the current table (a batch without news
    writes nothing).  Returns the published table."""
    target = None if refresh else store.read_or_none(table)
    if target is None:
        store.replace(table, insert_or_ignore(None, cand, key_cols, order_by))
        return store.read(table)
    batch = written(cand, "dimension-batch")
    new = written(insert_or_ignore(target, batch, key_cols, order_by, cut_target=True).select(*target.columns), "dimension-rows")
    if not new.isEmpty():
        store.append(table, new)
    return store.read(table)


REJECTS = "row_id string, reject_reason string, source_file string, refused array<struct<column_name:string,value:string>>, record string"


def record_rejects(store, table: str, rows: DataFrame, reason: Column, source_file: Column | None = None,
                   refused: Column | None = None, record: Column | None = None) -> int:
    """Appends ``rows`` to the reject table, each distinct (reason, record, refused values) once however
    often it is loaded; how many were new.  ``record`` is the row's text, its columns as JSON if none is given."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]))
    empty = F.lit(None).cast("array<struct<column_name:string,value:string>>")
    kept = rows.select(reason.alias("reject_reason"), (source_file if source_file is not None else F.lit(None)).cast("string").alias("source_file"),
                       (refused if refused is not None else empty).alias("refused"),
                       (whole if record is None else F.coalesce(record, whole)).alias("record"))
    key = F.sha2(F.to_json(F.struct("reject_reason", "record", "refused")), 256)
    kept = written(kept.select(key.alias("row_id"), "*"), "rejects")
    if kept.isEmpty():
        return 0
    # whole records go through a shuffle only if one of them repeats
    unique = kept.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    held = store.read(table) if store.exists(table) and store.folders(table) else None
    return store.append_counted(table, insert_or_ignore(held, kept, ["row_id"], ["source_file"], unique_batch=unique, cut_target=True))
