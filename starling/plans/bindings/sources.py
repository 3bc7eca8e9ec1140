"""A: scans, sources, sinks.  Every sink writes under the session's shared work folder
and the query returns what a reader sees afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators.clean import drop_any_null_rows
from starling.operators.quality import validate
from starling.plans.bindings.common import (
    ALL_TABLES, DIRTY_EVENTS_SQL, TABLE_COLUMNS, all_tables, bind, dirty_events, table,
)
from starling.sources.files import (
    csv_handoff, csv_to_table, files_report, quality_report_sink, read_files_glob, read_raw_table, table_dump, write_csv,
)
from starling.sources.landing import (
    append_checked_records, json_landing_sink, read_json_landing, staging_refresh, type_landing,
)
from starling.sources.store import TableStore
from starling.session import work_dir

EVENTS_TYPED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                             T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                             T.StructField("props", T.StringType()), T.StructField("saved_at", T.StringType())])
RUN_DATE = "20240115"
EVENTS_LANDED_SQL = """SELECT event_id, user_id, event_type, value, props,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS saved_at FROM events"""


def land_events(spark, sf) -> str:
    """Events submitted to the landing zone (one JSON line per event, ``dt=`` folders)."""
    landing = work_dir(spark, "landing")
    ev = table(spark, sf, "events")
    json_landing_sink(ev.select("event_id", "user_id", "event_type", "value", "props", "ts"), landing,
                      saved_at=F.col("ts"))
    return landing


def _landing_schema():
    names = [f.name for f in EVENTS_TYPED.fields] + ["dt"]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@bind("read_files_glob", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR)
  AS n_regionkey, NULL AS s_suppkey, NULL AS s_name, NULL AS r_regionkey, NULL AS r_name FROM nation
UNION ALL SELECT CAST(s_nationkey AS VARCHAR), NULL, NULL, CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL FROM supplier
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, r_regionkey, r_name FROM region""")
def q_read_files_glob(spark, sf):
    """One folder of CSV files with three headers (columns in another order, padded names,
    other columns) and Parquet files."""
    folder = work_dir(spark, "glob")
    n, key = table(spark, sf, "nation"), F.col("n_nationkey")
    even = F.coalesce(key % 2 == 0, F.lit(False))
    write_csv(n.where(even), folder, "append")
    write_csv(n.where(~even).select("n_regionkey", key.alias(" n_nationkey "), "n_name"), folder, "append")
    write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey")),
              folder, "append")
    table(spark, sf, "region").write.mode("append").parquet(folder)
    return read_files_glob(spark, folder)


def mixed_folder(spark, sf) -> str:
    """CSV and Parquet files, a file of another extension, and text under a Parquet file's name."""
    folder, aside = work_dir(spark, "mixed"), work_dir(spark, "aside")
    write_csv(table(spark, sf, "nation").select("n_nationkey", "n_name"), folder, "append")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.mode("append").parquet(folder)
    region = table(spark, sf, "region").select("r_name").coalesce(1)
    region.write.mode("append").text(folder)
    region.write.text(aside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(hadoop(f"{aside}/*.txt")):
        fs.rename(status.getPath(), hadoop(f"{folder}/broken.parquet"))
    return folder


@bind("read_files_skip_bad", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, NULL AS s_suppkey, NULL AS s_name
  FROM nation UNION ALL SELECT NULL, NULL, s_suppkey, s_name FROM supplier""")
def q_read_files_skip_bad(spark, sf):
    """The readable files of a folder with a broken one."""
    return read_files_glob(spark, mixed_folder(spark, sf), bad_files="skip")


@bind("files_report", """SELECT 'csv' AS format, 'loaded' AS status, COUNT(*) AS "rows", FALSE AS has_error FROM nation
UNION ALL SELECT 'parquet', 'loaded', COUNT(*), FALSE FROM supplier
UNION ALL SELECT 'parquet', 'unreadable', 0, TRUE UNION ALL SELECT NULL, 'skipped', 0, FALSE""")
def q_files_report(spark, sf):
    """What became of the files of that folder, summed over files alike (their number is the writer's)."""
    return (files_report(spark, mixed_folder(spark, sf)).groupBy("format", "status")
            .agg(F.sum("rows").alias("rows"), F.max(F.col("error").isNotNull()).alias("has_error")))


@bind("csv_to_table", "SELECT * FROM customer")
def q_csv_to_table(spark, sf):
    c = table(spark, sf, "customer")
    src = work_dir(spark, "csv-in")
    write_csv(c, src)
    out, _ = csv_to_table(spark, src, TableStore(spark), "customer_raw", c.schema)
    return out


@bind("read_raw_table", "SELECT * FROM orders")
def q_read_raw_table(spark, sf):
    store = TableStore(spark)
    store.replace("ivf_patients", table(spark, sf, "orders"))
    return read_raw_table(store, "ivf_patients")


@bind("read_json_landing", EVENTS_LANDED_SQL + f" WHERE strftime(ts, '%Y%m%d') = '{RUN_DATE}'")
def q_read_json_landing(spark, sf):
    landing = land_events(spark, sf)
    raw = read_json_landing(spark, landing, _landing_schema(), RUN_DATE, date_source="partition", multiline=False)
    return type_landing(raw, EVENTS_TYPED, aliases={}).drop("source_file", "dt")


@bind("staging_refresh", EVENTS_LANDED_SQL.replace(" FROM events", f", '{RUN_DATE}' AS load_date FROM events")
      + f" WHERE strftime(ts, '%Y%m%d') = '{RUN_DATE}'")
def q_staging_refresh(spark, sf):
    landing = land_events(spark, sf)
    staging = work_dir(spark, "staging")
    staging_refresh(spark, landing, staging, RUN_DATE, EVENTS_TYPED, date_source="partition", multiline=False)
    # a re-run of the same day replaces that day only
    out = staging_refresh(spark, landing, staging, RUN_DATE, EVENTS_TYPED, date_source="partition",
                          multiline=False)
    return out.drop("source_file", "dt")


@bind("append_checked_records", f"SELECT * FROM {DIRTY_EVENTS_SQL} WHERE value IS NOT NULL AND props IS NOT NULL")
def q_append_checked_records(spark, sf):
    target = work_dir(spark, "api-cases")
    append_checked_records(dirty_events(spark, sf), ["value", "props"], target, allow_null=False)
    return spark.read.parquet(target)


@bind("json_landing_sink", EVENTS_LANDED_SQL)
def q_json_landing_sink(spark, sf):
    landing = land_events(spark, sf)
    raw = read_json_landing(spark, landing, _landing_schema(), None, multiline=False)
    return type_landing(raw, EVENTS_TYPED, aliases={}).drop("source_file", "dt")


@bind("csv_handoff", "SELECT * FROM supplier")
def q_csv_handoff(spark, sf):
    s = table(spark, sf, "supplier")
    extract = work_dir(spark, "extract")
    write_csv(s, extract)                                   # extract step
    transformed = work_dir(spark, "transform")
    csv_handoff(spark, extract, transformed, s.schema, transform=drop_any_null_rows)   # transform step
    loaded = work_dir(spark, "load")
    return csv_handoff(spark, transformed, loaded, s.schema)                           # load step


@bind("write_replace", "SELECT * FROM customer WHERE c_acctbal >= 0")
def q_write_replace(spark, sf):
    store = TableStore(spark)
    store.replace("customer", table(spark, sf, "customer"))
    # replace a table by a frame computed from that same table (new version, then publish)
    store.replace("customer", store.read("customer").where(F.col("c_acctbal") >= 0))
    return store.read("customer")


@bind("write_append", "SELECT * FROM orders")
def q_write_append(spark, sf):
    store = TableStore(spark)
    o = table(spark, sf, "orders")
    store.replace("orders", o.where(F.col("o_orderstatus") == "F"))
    store.append("orders", o.where(~F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))))
    return store.read("orders")


@bind("table_dump", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("region", "nation", "supplier",
                                                                           "customer", "orders")))
def q_table_dump(spark, sf):
    store = TableStore(spark)
    names = ["region", "nation", "supplier", "customer", "orders"]
    for t in names:
        store.replace(t, table(spark, sf, t))
    out = work_dir(spark, "dump")
    paths = table_dump(store, names, out, fmt="csv")
    frames = [spark.read.option("header", True).csv(p).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(t).alias("table_name"), "row_count") for t, p in paths.items()]
    res = frames[0]
    for f in frames[1:]:
        res = res.unionByName(f)
    return res


def _null_sheet_sql() -> str:
    parts = []
    for t in ALL_TABLES:
        for c in TABLE_COLUMNS[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {t}")
    return " UNION ALL ".join(parts)


@bind("quality_report_sink", _null_sheet_sql())
def q_quality_report_sink(spark, sf):
    sheets = validate(all_tables(spark, sf), {"orders": ["o_orderkey", "o_custkey"]},
                      [("orders", "o_custkey", "customer", "c_custkey")])
    out = work_dir(spark, "quality-report")
    paths = quality_report_sink({k: sheets[k] for k in ("tables", "nulls", "fk_checks", "duplicates")}, out)
    return spark.read.parquet(paths["nulls"])
