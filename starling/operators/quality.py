"""Validation and repair.

Validation reads each table once per check family and returns small DataFrames (one row
per table / column / FK); nothing is collected to decide the status, which is itself an
aggregate (H05).  Foreign-key checks count orphans per distinct key: when the parent
broadcasts, Catalyst runs the anti-join map-side below the partial aggregate (no row
shuffle at all); otherwise the child is reduced to (fk, count) before the shuffle, so a
hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators.aggregates import drop_duplicate_rows, duplicate_count, null_profile, table_counts


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def check_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, duplicate_rows) for every table: one lazy plan, one scan a table."""
    return _union([duplicate_count(df).select(F.lit(n).alias("table_name"), "duplicate_rows") for n, df in tables.items()])


def check_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, null_count) for every column of every table."""
    return _union([null_profile(df, n) for n, df in tables.items()])


def check_required_nulls(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """NULL counts of the required columns (only those present), with a fail flag."""
    frames = []
    for n, cols in required.items():
        if n not in tables:
            continue
        df = tables[n]
        present = [c for c in cols if c in df.columns]
        if not present:
            continue
        frames.append(null_profile(df.select(*present), n))
    if not frames:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, column_name string, null_count long, failed boolean")
    return _union(frames).withColumn("failed", F.col("null_count") > 0)


def fk_orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One-row count of child rows whose non-NULL ``fk`` has no parent ``pk``
    (``LEFT JOIN ... WHERE fk IS NOT NULL AND pk IS NULL``)."""
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    pk_vals = parent.select(F.col(pk).alias("__pk"))
    orphans = keys.join(pk_vals, F.col("__fk") == F.col("__pk"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("invalid_count"))


def check_foreign_keys(tables: Mapping[str, DataFrame],
                       checks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(check_name, invalid_count) for each (child, fk, parent, pk); NULL fk allowed."""
    return _union([fk_orphan_count(tables[c], fk, tables[p], pk)
                   .select(F.lit(f"{c}.{fk} -> {p}.{pk}").alias("check_name"), "invalid_count")
                   for c, fk, p, pk in checks])


def validation_status(duplicates: DataFrame, required: DataFrame, fks: DataFrame) -> DataFrame:
    """One row, ``status`` = 1 if no duplicates, no NULL in required columns and no
    orphan FK, else -1 (NULLs in optional columns do not fail)."""
    fails = (duplicates.select(F.col("duplicate_rows").alias("n"))
             .unionByName(required.select(F.col("null_count").alias("n")))
             .unionByName(fks.select(F.col("invalid_count").alias("n"))))
    return fails.agg(F.when(F.coalesce(F.max("n"), F.lit(0)) > 0, F.lit(-1)).otherwise(F.lit(1))
                     .cast("int").alias("status"))


def validate(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]],
             fk_checks: Sequence[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Run H01-H05 + H13; returns the four report sheets (A12) and the status frame."""
    dups = check_duplicates(tables)
    nulls = check_nulls(tables)
    req = check_required_nulls(tables, required)
    fks = check_foreign_keys(tables, fk_checks)
    return {"tables": table_inventory(tables), "nulls": nulls, "fk_checks": fks,
            "duplicates": dups, "required": req, "status": validation_status(dups, req, fks)}


def repair_required_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any required column present."""
    present = [c for c in cols if c in df.columns]
    return df.na.drop("any", subset=present) if present else df


def repair_duplicates(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (one shuffle)."""
    return drop_duplicate_rows(df)


def _with_hit(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """``child`` with ``__hit``: true where its FK is a parent key.  NULL FKs match nothing; each gets a
    join key by a hash of its row, so that a hot NULL is spread over all partitions."""
    key = F.concat(F.lit("k"), F.col(pk).cast(child.schema[fk].dataType).cast("string"))
    keys = parent.where(F.col(pk).isNotNull()).select(key.alias("__pk")).distinct().withColumn("__hit", F.lit(True))
    alone = F.concat(F.lit("n"), F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]).cast("string"))
    own = F.when(F.col(fk).isNull(), alone).otherwise(F.concat(F.lit("k"), F.col(fk).cast("string")))
    return child.withColumn("__fk", own).join(keys, F.col("__fk") == F.col("__pk"), "left")


def repair_orphan_fk_to_null(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """FK values with no parent become NULL; other rows unchanged."""
    j = _with_hit(child, fk, parent, pk)
    return j.withColumn(fk, F.when(F.col("__hit"), F.col(fk))).select(*child.columns)


def repair_delete_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                          keep_null: bool = True) -> DataFrame:
    """Delete rows whose FK has no parent; NULL FKs are kept unless ``keep_null``
    is False (``DELETE ... WHERE fk NOT IN (SELECT pk ...)`` with the NULL-safe repair)."""
    keep = F.col("__hit").isNotNull()
    if keep_null:
        keep = keep | F.col(fk).isNull()
    return _with_hit(child, fk, parent, pk).where(keep).select(*child.columns)


def repair_fk_to_min(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """FK values with no parent are replaced by MIN(parent key)."""
    m = parent.agg(F.min(pk)).first()[0]
    fixed = F.when(F.col(fk).isNull() | F.col("__hit").isNotNull(), F.col(fk)).otherwise(
        F.lit(m).cast(child.schema[fk].dataType))
    return _with_hit(child, fk, parent, pk).withColumn(fk, fixed).select(*child.columns)


def repair_placeholder_parents(parent: DataFrame, child: DataFrame, fk: str, pk: str,
                               defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The parent table plus one placeholder row per orphan key of ``child``."""
    defaults = defaults or {}
    orphans = (child.where(F.col(fk).isNotNull()).select(F.col(fk).alias(pk)).distinct()
               .join(parent.select(pk), pk, "left_anti"))
    cols = []
    for f in parent.schema.fields:
        if f.name == pk:
            cols.append(F.col(pk).cast(f.dataType).alias(pk))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return parent.unionByName(orphans.select(*cols))


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table."""
    return table_counts(tables)


def schema_describe(df: DataFrame, table: str) -> DataFrame:
    """Column position, name, type and nullability (PRAGMA table_info)."""
    rows = [(table, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("cid", T.IntegerType()),
                           T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
                           T.StructField("nullable", T.BooleanType())])
    return df.sparkSession.createDataFrame(rows, schema)
