"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators.windows import union_by_name
from starling.sources.store import TableStore

_EXT = {"csv": "*.csv", "parquet": "*.parquet", "json": "*.json"}


class NoInputFilesError(FileNotFoundError):
    pass


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None):
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r


def _files(spark: SparkSession, paths: Sequence[str], fmt: str) -> list[str]:
    """The files of one extension under the paths; a path that does not exist raises."""
    try:
        found = spark.read.option("pathGlobFilter", _EXT[fmt]).text(list(paths)).inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoInputFilesError(str(e)) from e
    return sorted(unquote(f) for f in found)


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """CSV files by their header line (the first line with text); files without one are left out.
    One pass over the files' first blocks."""
    lines = (spark.read.text(list(files)).where(F.length(F.btrim("value")) > 0)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("line")))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(first, key=lambda r: r["file"]):
        out.setdefault(r["header"], []).append(unquote(r["file"]))
    return out


def _file_uri() -> Column:
    """The file of a row, spelt as ``DataFrame.inputFiles`` spells it (local files with three slashes)."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def _rows_by_file(spark: SparkSession, paths: Sequence[str], fmt: str) -> DataFrame:
    """(file, rows) of the files of one extension with a row.  No column is read: Parquet rows are counted
    from the footers, and a file without a readable footer gives no row."""
    reader = _reader(spark, fmt, T.StructType([T.StructField("none", T.StringType())]))
    rows = reader.option("pathGlobFilter", _EXT[fmt]).option("ignoreCorruptFiles", fmt == "parquet").load(list(paths))
    return rows.groupBy(_file_uri().alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def _unreadable(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Those of some Parquet files (the ones without a row) that cannot be opened, with the error; one by one."""
    out = {}
    for file in files:
        try:
            spark.read.parquet(unquote(file))
        except Exception as e:  # whatever the reader raises is the report
            out[file] = str(e).strip().split("\n")[0]
    return out


def files_report(spark: SparkSession, paths: str | Sequence[str], formats: Sequence[str] = ("csv", "parquet")) -> DataFrame:
    """What becomes of every file under the path(s): (file, format, size, status, rows, error).

    status is ``loaded`` (rows counted; 0 for a Parquet file without rows), ``empty`` (a CSV file without a
    row), ``unreadable`` (a Parquet file that cannot be opened, with its error) or ``skipped`` (another extension, format
    null).  Damage behind a sound footer shows only when the data is read.  A path that matches nothing raises.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        found = spark.read.format("binaryFile").load(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoInputFilesError(str(e)) from e
    sizes = found.select(_file_uri().alias("file"), "length")  # a scan leaves out files of no bytes
    fmt = F.regexp_extract("file", rf"\.({'|'.join(formats)})$", 1)
    listed = (spark.createDataFrame([(f,) for f in found.inputFiles()], "file string").join(sizes, "file", "left")
              .select("file", F.nullif(fmt, F.lit("")).alias("format"), F.coalesce("length", F.lit(0)).alias("size")))
    counts = [_rows_by_file(spark, paths, f) for f in formats]
    counted = listed.join(union_by_name(counts), "file", "left")
    rowless = [r["file"] for r in counted.where("format = 'parquet' AND rows IS NULL").select("file").collect()]
    bad = spark.createDataFrame(list(_unreadable(spark, rowless).items()), "file string, error string")
    status = (F.when(F.col("format").isNull(), "skipped").when(F.col("error").isNotNull(), "unreadable")
              .when((F.col("format") == "csv") & F.col("rows").isNull(), "empty").otherwise("loaded"))
    return counted.join(bad, "file", "left").select(
        "file", "format", "size", status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), "error")


def read_files_glob(spark: SparkSession, paths: str | Sequence[str], formats: Sequence[str] = ("csv", "parquet"),
                    csv_schema: T.StructType | None = None, bad_files: str = "fail") -> DataFrame:
    """Every CSV/Parquet file under the path(s)/glob(s), other extensions skipped,
    header names trimmed, frames unioned by column name.

    A path that matches nothing raises, and so does a file that cannot be read, but for
    ``bad_files="skip"``: then Parquet files that cannot be opened are left out (``files_report`` lists
    them), and damage behind a sound footer still raises.  Nothing found (or nothing readable)
    under the paths raises :class:`NoInputFilesError`.  Parquet files are one scan (schemas
    merged by name, pushdown kept).  CSV files are one scan per distinct header, so columns
    go by each file's own names whatever their order; they are text columns, or those of
    ``csv_schema`` cast by name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = []
    for fmt in formats:
        files = _files(spark, paths, fmt)
        if not files:
            continue
        if fmt == "csv":
            frames += [_csv_frame(spark, group, csv_schema) for group in _headers(spark, files).values()]
        else:
            if bad_files == "skip":
                full = {unquote(r["file"]) for r in _rows_by_file(spark, files, fmt).collect()}
                bad = _unreadable(spark, [f for f in files if f not in full])
                files = [f for f in files if f not in bad]
                if not files:
                    continue
            where = files if bad_files == "skip" else paths
            df = _reader(spark, fmt, None).option("mergeSchema", True).option("pathGlobFilter", _EXT[fmt]).load(where)
            frames.append(df.toDF(*[c.strip() for c in df.columns]))
    if not frames:
        raise NoInputFilesError(f"no {'/'.join(formats)} files under {paths}")
    return union_by_name(frames)


def _csv_frame(spark: SparkSession, files: Sequence[str], schema: T.StructType | None) -> DataFrame:
    df = _reader(spark, "csv", None).load(list(files))
    df = df.toDF(*[c.strip() for c in df.columns])
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    return df.select(*[F.col(f"`{c}`").cast(types[c]) if c in types else F.col(f"`{c}`") for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return _reader(spark, "csv", schema).load(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def csv_to_table(spark: SparkSession, csv_path: str, store: TableStore, table: str,
                 schema: T.StructType | None = None) -> tuple[DataFrame, int]:
    """Load a CSV, replace the table, count the rows back from the table."""
    store.replace(table, read_csv(spark, csv_path, schema))
    out = store.read(table)
    return out, out.count()


def read_raw_table(store: TableStore, table: str) -> DataFrame:
    """Check the table exists, then read it."""
    if not store.exists(table):
        raise FileNotFoundError(f"source table {table!r} not found in {store.root}")
    return store.read(table)


def csv_handoff(spark: SparkSession, src: str, dst: str, schema: T.StructType | None = None,
                transform=None) -> DataFrame:
    """One pipeline stage: CSV in -> (optional transform) -> CSV out; returns the
    frame read back from ``dst``."""
    df = read_csv(spark, src, schema)
    if transform is not None:
        df = transform(df)
    write_csv(df, dst)
    return read_csv(spark, dst, schema or df.schema)


def table_dump(store: TableStore, tables: Sequence[str], out_root: str, fmt: str = "parquet") -> dict[str, str]:
    """Export every table to ``out_root/<table>`` (Parquet or CSV)."""
    out = {}
    for t in tables:
        df = store.read(t)
        path = f"{out_root.rstrip('/')}/{t}"
        if fmt == "csv":
            write_csv(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
        out[t] = path
    return out


def quality_report_sink(sheets: Mapping[str, DataFrame], out_root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each validation sheet (tables, nulls, fk_checks, duplicates) to its folder."""
    out = {}
    for name, df in sheets.items():
        path = f"{out_root.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
        out[name] = path
    return out
