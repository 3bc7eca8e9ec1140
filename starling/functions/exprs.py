"""Column-expression helpers.  All return ``Column`` objects built from JVM-side
built-ins, so they stay inside whole-stage codegen; none of them is a Python UDF.

ANSI mode is on by default in Spark 4: ``cast('' as int)`` and ``1/0`` raise.  Every
helper here is written so dirty landing data turns into NULL instead of a failed job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The ASCII whitespace set (space, \t, \n, \x0b, \f, \r), as in regex \s.
WHITESPACE = " \t\n\x0b\f\r"


def strip_ws(c: ColumnOrName) -> Column:
    """Leading/trailing whitespace removed (spaces, tabs, newlines; ``str.strip``).
    Spark's one-argument ``trim`` removes spaces only; ``btrim`` with the whitespace set
    is a codegen'd character scan (no regex engine per row)."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: ColumnOrName) -> Column:
    """Stripped text, with '' turned into NULL (B08 + the landing-zone rule)."""
    return F.nullif(strip_ws(c), F.lit(""))


def try_number(c: ColumnOrName, to: str = "double") -> Column:
    """Text -> number, anything unparsable -> NULL (B09, ``to_numeric(errors='coerce')``)."""
    return blank_to_null(c).try_cast(to)


def try_integer(c: ColumnOrName, to: str = "int") -> Column:
    """Text -> integer: whole numbers exactly (ids above 2^53 keep every digit), others through
    double, so '12.7' becomes 12 (truncation) instead of NULL."""
    d = try_number(c, "double")
    bound = 2.0 ** 63 if to in ("long", "bigint") else 2.0 ** 31
    # out-of-range and NaN fail the guard and give NULL (a bare ANSI cast would raise)
    return F.coalesce(try_number(c, to), F.when(F.abs(d) < bound, d.cast(to)))


# Accepted layouts besides ISO dates and times, as (regex, date pattern).
OTHER_DATE_LAYOUTS = (("^[0-9]{8}$", "yyyyMMdd"), ("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
                      ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"))


def try_date(c: ColumnOrName) -> Column:
    """Text (or timestamp) -> DATE; unparsable -> NULL (B10, ``to_datetime(errors='coerce')``).

    ISO dates, alone or with a time (blank or T, any fraction of a second, zone or Z): the
    written day, whatever the zone; then the compact and slashed layouts (month before day).
    """
    s = blank_to_null(c)
    iso = F.when(s.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"), s.try_cast("timestamp_ntz").cast("date"))
    return F.coalesce(iso, *[F.when(s.rlike(r), F.try_to_date(s, f)) for r, f in OTHER_DATE_LAYOUTS])


def iso_date(c: ColumnOrName) -> Column:
    """DATE/TIMESTAMP -> 'YYYY-MM-DD' text (``strftime('%Y-%m-%d')``)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def slug(c: ColumnOrName, sep: str = "_") -> Column:
    """strip + lower + spaces -> ``sep`` (B01 header rule, UI status slug)."""
    return F.replace(F.lower(strip_ws(c)), F.lit(" "), F.lit(sep))


def null_label(c: ColumnOrName, label: str = "Unknown") -> Column:
    """NULL or '' -> label (B20, ``r[0] or 'Unknown'``)."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit(label))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """num / den with zero or NULL denominators -> ``default``."""
    return F.coalesce(_col(num) / F.nullif(_col(den), F.lit(0)), F.lit(default))


def map_values(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with a default for unmapped and NULL values."""
    c = _col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def natural_key_text(*cols: ColumnOrName, sep: str = "|") -> Column:
    """Null-tolerant composite key text (C06): each trimmed part as ``<length>:<text>``, joined by ``sep``.

    NULL and '' give a part without a length, so rows with missing parts still get one key.  The
    lengths make the text injective: parts that hold ``sep`` or look like another part cannot
    give the text of a different tuple.
    """
    parts = []
    for c in cols:
        text = blank_to_null(c)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("")))
    return F.concat_ws(sep, *parts)


def hash_id(prefix: str, *cols: ColumnOrName, hex_digits: int = 32) -> Column:
    """Deterministic id ``<prefix>_<hex>`` from the natural key (C04 repaired, Q6).

    32 hex digits = 128 bits: the expected number of colliding pairs among n keys is
    n^2 / 2^129, far below one even for 10^15 keys.
    """
    h = F.sha2(natural_key_text(*cols), 256)
    return F.concat(F.lit(prefix + "_"), F.substring(h, 1, hex_digits))


def text_key(prefix: str, parts: Iterable[tuple[str, ColumnOrName]], unknown: str = "unknown") -> Column:
    """Readable composite id (C02): ``prefix_<tag1><v1>_<tag2><v2>...``.

    Each value is slugged (lower, spaces -> '_'); NULL -> ``unknown``.  Spark ``concat``
    is NULL if any input is NULL, so every part is coalesced first.
    """
    pieces = [F.lit(prefix)]
    for tag, c in parts:
        pieces.append(F.lit("_" + tag))
        pieces.append(F.coalesce(slug(c), F.lit(unknown)))
    return F.concat(*pieces)


def contains_ci(cols: Iterable[ColumnOrName], needle: str) -> Column:
    """Case-insensitive substring test over the space-joined text of ``cols``."""
    hay = F.lower(F.concat_ws(" ", *[_col(c).cast("string") for c in cols]))
    return F.contains(hay, F.lower(F.lit(needle)))
