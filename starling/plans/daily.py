"""The daily file load as one job: read a folder of files, sanitize, resolve dimension ids by
natural key, upsert the fact, report the rows loaded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.exprs import blank_to_null, try_date
from starling.operators.clean import coerce_numeric, drop_all_null_rows, require_columns, trim_strings
from starling.operators.keys import assign_incremental_keys
from starling.operators.load import record_rejects, upsert_last_wins, upsert_partitions
from starling.session import written
from starling.sources.files import read_files_glob
from starling.sources.store import TableStore

# Columns that are numbers whatever the files say.
NUMERIC_COLUMNS = (
    "female_age", "female_bmi", "amh_level", "fsh_level", "afc", "male_age", "semen_count_mill_per_ml",
    "motility_percent", "morphology_percent", "stimulation_days", "total_fsh_dose", "suggested_waiting_period_days",
    "e2_on_trigger", "endometrium_thickness", "follicles_18mm", "retrieved_oocytes", "mii_count", "mi_count",
    "gv_count", "injected_mii", "fertilized_oocytes", "fertilization_rate", "cleavage_d3", "blastocyst_d5",
    "good_embryos", "class_a_rate", "embryos_transferred", "success_probability_score")
# Dimension tables with their id and the columns that tell their rows apart.
DAILY_DIMENSIONS = {
    "dim_female": ("female_id", ("female_age", "female_bmi", "amh_level", "fsh_level", "afc")),
    "dim_male": ("male_id", ("male_age", "male_factor", "semen_count_mill_per_ml", "motility_percent",
                             "morphology_percent")),
    "dim_protocol": ("protocol_id", ("protocol_type", "stimulation_days", "total_fsh_dose", "trigger_type",
                                     "recommended_protocol")),
    "dim_outcome": ("outcome_id", ("risk_level", "response_type", "suggested_waiting_period_days", "failure_reason",
                                   "doctor_recommendation")),
}
# Measures of the fact.
DAILY_MEASURES = ("e2_on_trigger", "endometrium_thickness", "retrieved_oocytes", "fertilization_rate",
                  "pregnancy_test_result", "clinical_pregnancy", "live_birth", "success_probability_score")
FACT, MONTH, REJECTED_DAILY = "fact_ivf_cycle", "case_month", "rejected_daily"


@dataclass(frozen=True)
class DailyLoad:
    """What one run did: the fact rows inserted or updated, the dimensions it had no columns for."""

    fact_rows: int
    skipped_dimensions: tuple[str, ...]
    months: tuple[str | None, ...] = ()  # the months of the fact that were written anew


def sanitize(df: DataFrame) -> DataFrame:
    """Rows that are all NULL dropped, text trimmed, the numeric columns made numbers."""
    return coerce_numeric(trim_strings(drop_all_null_rows(df)), NUMERIC_COLUMNS)


def run_daily_load(spark: SparkSession, paths: str | Sequence[str], store: TableStore, order_by: Sequence[str],
                   key: str = "case_id", month_of: str | None = None) -> DailyLoad:
    """Loads the files into ``store`` in one commit; of rows that share a case the last by ``order_by``
    wins, over the file rows as over the stored ones.  Dimension rows are matched null-safe on all their
    columns and only new ones are appended; a dimension whose columns are not all there is skipped and
    its id stays NULL.  The fact is partitioned by ``case_month``, the month of the column ``month_of``
    (the first of ``order_by`` if none is given; NULL where it is no date); only months of the files'
    rows, or of stored rows of their cases, are written anew.

    Rows without a case have no key to be updated by: they go to ``rejected_daily``, each distinct one
    once.  Loading a file twice changes nothing."""
    df = sanitize(require_columns(read_files_glob(spark, paths), [key, *order_by]))
    df = written(df.withColumn(key, blank_to_null(key)), "daily-files")  # read the files once
    with store.transaction():
        record_rejects(store, REJECTED_DAILY, df.where(F.col(key).isNull()), F.lit(f"null_{key}"))
        return _load_cases(df.where(F.col(key).isNotNull()), store, order_by, key, month_of or order_by[0])


def _load_cases(df: DataFrame, store: TableStore, order_by: Sequence[str], key: str, month_of: str) -> DailyLoad:
    skipped = []
    for table, (id_col, columns) in DAILY_DIMENSIONS.items():
        if any(c not in df.columns for c in columns):
            skipped.append(table)
            df = df.withColumn(id_col, F.lit(None).cast("long"))
            continue
        df, new = assign_incremental_keys(df, store.read_or_none(table), list(columns), id_col)
        new = written(new, "dimension-rows")
        if not store.exists(table) or not new.isEmpty():
            store.append(table, new)
    ids = [id_col for id_col, _ in DAILY_DIMENSIONS.values()]
    known = [c if c in df.columns else F.lit(None).cast("string").alias(c) for c in DAILY_MEASURES]
    order = [f"__order{i}" for i in range(len(order_by))]
    fact = df.select(key, *ids, *known, F.date_format(try_date(month_of), "yyyy-MM").alias(MONTH),
                     *[F.col(c).alias(o) for c, o in zip(order_by, order, strict=True)])
    fact = written(upsert_last_wins(None, fact, [key], order).drop(*order), "daily-cases")
    months = upsert_partitions(store, FACT, fact, [key], [], MONTH)
    return DailyLoad(fact.count(), tuple(skipped), tuple(sorted(months, key=lambda m: (m is None, m or ""))))
