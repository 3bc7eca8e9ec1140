"""Cleaning, coercion and predicates (B01-B21).  Narrow transformations only (no shuffle)
except the exact-duplicate drop (B05) and the two statistics fills (B11, B12), whose
statistic is one aggregate and whose fill is a literal per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.exprs import (
    blank_to_null, contains_ci, strip_ws, iso_date, map_values as _map_values, null_label as _null_label,
    safe_ratio as _safe_ratio, try_date, try_integer, try_number,
)
from starling.operators.aggregates import drop_duplicate_rows, drop_repeated_rows, exact_percentiles, filled, value_or_null


class MissingColumnsError(ValueError):
    def __init__(self, missing: Sequence[str]):
        super().__init__(f"Missing required columns: {list(missing)}")
        self.missing = list(missing)


def _norm_name(c: str) -> str:
    return c.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Header names stripped, lower-cased, spaces -> '_'."""
    return df.toDF(*[_norm_name(c) for c in df.columns])


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new`` where ``old`` exists.  If both exist, the new column wins
    per record and the old one fills its NULLs (``patient_id`` -> ``female_id``)."""
    for old, new in aliases.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(new), F.col(old).cast(df.schema[new].dataType))).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add each missing column as a typed literal ``(value, type)``."""
    add = {c: F.lit(v).cast(t) for c, (v, t) in defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise :class:`MissingColumnsError` unless every required column is present."""
    miss = missing_columns(df, required)
    if miss:
        raise MissingColumnsError(miss)
    return df


def drop_exact_duplicates(df: DataFrame, reread: bool = False) -> DataFrame:
    """Remove fully identical rows (NULLs compare equal, as in pandas).  ``reread``: the frame is
    cheap to read twice, so only rows that may have an equal are shuffled."""
    return drop_repeated_rows(df) if reread else drop_duplicate_rows(df)


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where every column is NULL."""
    return df.na.drop("all", subset=list(subset) if subset else None)


def drop_any_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (optionally only among ``subset``)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def _string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Strip every string column (or the given ones)."""
    cols = list(cols) if cols is not None else _string_cols(df)
    return df.withColumns({c: strip_ws(c) for c in cols}) if cols else df


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Text -> number; bad or blank -> NULL.  Integer targets truncate via double."""
    conv = try_integer if to in ("int", "integer", "long", "bigint") else try_number
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: conv(c, to) for c in present}) if present else df


def parse_date_coerce(df: DataFrame, cols: Sequence[str], as_text: bool = True) -> DataFrame:
    """Text -> date, bad -> NULL; ``as_text`` keeps the 'YYYY-MM-DD' text form."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        d = try_date(c)
        out[c] = iso_date(d) if as_text else d
    return df.withColumns(out) if out else df


def fill_numeric_median(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """NULL and NaN -> the column's exact median (one ranked shuffle for all columns); a
    whole-number column becomes double."""
    if approx:
        return filled(df, df.agg(*[F.percentile_approx(value_or_null(df, c), 0.5).alias(c) for c in cols]).first().asDict())
    return filled(df, {c: v[0] for c, v in exact_percentiles(df, cols, [0.5]).items()})


def winsorize(df: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99,
              approx: bool = False) -> DataFrame:
    """Clip each column into its [lower, upper] quantiles (linear interpolation); NaN
    counts as NULL."""
    if approx:
        row = df.agg(*[F.percentile_approx(c, [lower, upper]).alias(c) for c in cols]).first().asDict()
        qs = {c: row[c] for c in cols}
    else:
        qs = exact_percentiles(df, cols, [lower, upper])
    out = {}
    for c in cols:
        lo, hi = qs[c] if qs[c] is not None else (None, None)
        if lo is None:
            continue
        x = value_or_null(df, c).cast("double")
        out[c] = F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
            F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))
    return df.withColumns(out) if out else df


def apply_clean_statistics(df: DataFrame, stats: DataFrame) -> DataFrame:
    """B11 and B12 by statistics fitted before (:func:`~starling.operators.aggregates.clean_statistics`):
    missing values -> the median, then clipped into [low, high].  A whole-number column keeps its type
    (half up).  ``stats`` has one row per column; a column it does not know stays as it is."""
    whole = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    out = {}
    for r in stats.collect():  # one row a column
        c = r["column_name"]
        if c not in df.columns or r["median"] is None:
            continue
        x = F.coalesce(value_or_null(df, c).cast("double"), F.lit(r["median"]))
        x = F.least(F.greatest(x, F.lit(r["low"])), F.lit(r["high"]))
        out[c] = F.round(x).cast(whole[c]) if c in whole else x
    return df.withColumns(out) if out else df


def refused_values(casts: Mapping[str, tuple[Column, Column]]) -> Column:
    """The values a cast refuses: ``casts`` maps a column name to (text, cast value); an array of
    (column_name, value) of the texts that are not blank and became NULL, in order, empty if none did."""
    kind = "array<struct<column_name:string,value:string>>"
    found = [F.when(blank_to_null(text).isNotNull() & cast.isNull(), F.struct(F.lit(name).alias("column_name"), text.alias("value")))
             for name, (text, cast) in casts.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull()).cast(kind) if found else F.array().cast(kind)


def fill_string_default(df: DataFrame, cols: Sequence[str] | None = None, exclude: Iterable[str] = (),
                        value: str = "Unknown") -> DataFrame:
    """NULL strings -> ``value``, except excluded (id) columns."""
    ex = set(exclude)
    cols = [c for c in (cols if cols is not None else _string_cols(df)) if c not in ex]
    return df.na.fill(value, subset=cols) if cols else df


def map_values(df: DataFrame, col: str, mapping: Mapping, default=None, out_col: str | None = None,
               source_col: str | None = None, only_if_null: bool = False) -> DataFrame:
    """``out_col = mapping[source_col]`` with a default (High->90, Medium->45, ...).

    The reference overwrites the target even when it has a value; ``only_if_null``
    keeps existing values."""
    out_col = out_col or col
    mapped = _map_values(source_col or col, mapping, default)
    if only_if_null and out_col in df.columns:
        mapped = F.coalesce(F.col(out_col), mapped)
    return df.withColumn(out_col, mapped)


def safe_ratio(df: DataFrame, num: str, den: str, out_col: str, default: float = 0.0) -> DataFrame:
    """Num / den with zero/NULL denominators -> default."""
    return df.withColumn(out_col, _safe_ratio(F.col(num).cast("double"), F.col(den).cast("double"), default))


def fill_from_column(df: DataFrame, target: str, source: str, cast: str | None = "int") -> DataFrame:
    """Missing ``target`` taken from ``source`` (column created when absent)."""
    src = F.col(source)
    val = F.coalesce(F.col(target), src) if target in df.columns else src
    return df.withColumn(target, val.cast(cast) if cast else val)


def filter_predicates(df: DataFrame, equals: Mapping[str, object] | None = None,
                      is_null: Sequence[str] = (), not_null: Sequence[str] = (),
                      isin: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Conjunction of ``=`` parameters, IS NULL, IS NOT NULL and membership."""
    cond = F.lit(True)
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    for c in is_null:
        cond = cond & F.col(c).isNull()
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c, vs in (isin or {}).items():
        cond = cond & F.col(c).isin(list(vs))
    return df.where(cond)


def search_rows_text(df: DataFrame, query: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose displayed text contains ``query`` (case-insensitive); '' = all."""
    if not query:
        return df
    return df.where(contains_ci(cols or df.columns, query))


def filter_status_contains(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """``lower(col)`` contains ``lower(value)``; empty selection = no filter."""
    if not value:
        return df
    return df.where(F.contains(F.lower(F.col(col)), F.lower(F.lit(value))))


def null_label(df: DataFrame, col: str, label: str = "Unknown", out_col: str | None = None) -> DataFrame:
    """NULL/'' label -> 'Unknown'."""
    return df.withColumn(out_col or col, _null_label(col, label))


def split_valid_rejected(df: DataFrame, rules: Mapping[str, Column],
                         reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Rows passing every rule, and the others with the first failed rule's name.

    Rules are "must hold" predicates; a NULL result counts as failed.  Both outputs come
    from the same scan (cache the input if both are written).
    """
    reason = None
    for name, pred in rules.items():
        bad = F.coalesce(~pred, F.lit(True))
        reason = F.when(bad, F.lit(name)) if reason is None else reason.when(bad, F.lit(name))
    tagged = df.withColumn(reason_col, reason if reason is not None else F.lit(None).cast("string"))
    valid = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return valid, rejected
