"""Dashboard / profile reports (I01-I07), each one lazily planned query.

Column names default to the clinic star schema; every name is a parameter so the same
report runs on any star (the test bindings use TPC-H-derived stars).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.operators.aggregates import bucket_histogram, count_by_dim_attribute
from starling.operators.clean import filter_status_contains, search_rows_text
from starling.operators.windows import latest_per_key, sort_limit

# The dashboard's five age buckets (label, lower bound incl., upper bound excl.).
AGE_BUCKETS = [("<30", None, 30), ("30–34", 30, 35), ("35–39", 35, 40), ("40–44", 40, 45), ("45+", 45, None)]


def dashboard_kpis(fact_cycle: DataFrame, fact_transfer: DataFrame, patient_col: str = "female_id",
                   flag_col: str = "live_birth", flag_value=1) -> DataFrame:
    """total_patients, active_cycles, live_births, total_transfers, success_rate.

    Both facts are scanned once and combined by a UNION + one aggregate (no join)."""
    u = (fact_cycle.select(F.col(patient_col).cast("string").alias("__p"), F.lit(None).cast("int").alias("__f"),
                           F.lit(1).alias("__src"))
         .unionByName(fact_transfer.select(F.lit(None).cast("string").alias("__p"),
                                           F.when(F.col(flag_col) == F.lit(flag_value), 1).otherwise(0).alias("__f"),
                                           F.lit(2).alias("__src"))))
    a = u.agg(F.count_distinct("__p").alias("total_patients"),
              F.count_if(F.col("__src") == 1).alias("active_cycles"),
              F.coalesce(F.sum(F.when(F.col("__src") == 2, F.col("__f"))), F.lit(0)).cast("long").alias("live_births"),
              F.count_if(F.col("__src") == 2).alias("total_transfers"))
    rate = F.round(F.lit(100.0) * F.col("live_births") / F.nullif(F.col("total_transfers"), F.lit(0)), 1)
    return a.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def dashboard_monthly(fact: DataFrame, dim_time: DataFrame, fk: str = "cycle_start_time_id",
                      pk: str = "time_id", date_col: str = "full_date", patient_col: str = "female_id",
                      limit: int | None = 6, latest: bool = False, days: str | None = None,
                      month_col: str = "cycle_month") -> DataFrame:
    """Distinct patients per 'YYYY-MM' of the cycle date; first ``limit`` months
    ascending (the reference's ``ORDER BY month LIMIT 6``), or the newest with ``latest``.

    ``days``: a condition on the calendar (e.g. one year's quarter).  Where the fact is stored by month
    (``month_col``), it is joined on the month as well, so that Spark reads only the months whose days
    passed the condition (dynamic partition pruning)."""
    calendar = dim_time if days is None else dim_time.where(days)
    t = calendar.select(F.col(pk).alias("__pk"), F.substring(F.col(date_col).cast("string"), 1, 7).alias("month"))
    on, stored = F.col(fk) == F.col("__pk"), [month_col] if month_col in fact.columns else []
    for c in stored:
        on = on & (F.col(c) == F.col("month"))
    j = fact.select(fk, patient_col, *stored).join(t, on, "inner")
    g = j.groupBy("month").agg(F.count_distinct(patient_col).alias("cnt"))
    if limit is None:
        return g
    return sort_limit(g, [("month", not latest)], limit)


def dashboard_outcomes(fact: DataFrame, dim_outcome: DataFrame, fk: str = "outcome_id",
                       pk: str = "outcome_id", attr: str = "risk_level") -> DataFrame:
    """Cases per risk level (fact inner-join dimension); NULL label -> Unknown."""
    return count_by_dim_attribute(fact, dim_outcome, fk, pk, attr)


def dashboard_age(dim_female: DataFrame, age_col: str = "female_age",
                  buckets: Sequence = AGE_BUCKETS) -> DataFrame:
    """Patients per age bucket, empty buckets included."""
    return bucket_histogram(dim_female, age_col, buckets)


def patients_list(dim_female: DataFrame, id_col: str = "female_id", n: int | None = 5,
                  search: str | None = None, status: str | None = None) -> DataFrame:
    """Patient ids with the placeholder status/visit columns; optional text search
    (B18) and status filter (B19); first ``n`` by id."""
    df = dim_female.select(F.col(id_col).cast("string").alias("patient_id"), F.lit("-").alias("last_visit"),
                           F.lit("Unknown").alias("status"), F.lit("-").alias("next_appointment"))
    df = search_rows_text(df, search or "")
    df = filter_status_contains(df, "status", status)
    return sort_limit(df, ["patient_id"], n) if n else df


def patient_profile(fact_cycle: DataFrame, fact_transfer: DataFrame, dim_female: DataFrame,
                    dim_male: DataFrame, dim_doctor: DataFrame, dim_outcome: DataFrame,
                    dim_time: DataFrame, nested: bool = False) -> DataFrame:
    """For EVERY patient in dim_female, the latest cycle (max cycle_sk) with
    female/male/doctor/outcome attributes and its date, plus the latest transfer
    (max transfer_sk) of that cycle's case - the reference's three dependent per-patient
    queries as one plan.  Latest-per-key uses map-side ``max(struct)`` aggregation."""
    fc = fact_cycle.select("cycle_sk", "case_id", "female_id", "male_id", "doctor_id", "outcome_id",
                           "cycle_start_time_id", "retrieved_oocytes", "blastocyst_d5")
    latest = latest_per_key(fc.where(F.col("female_id").isNotNull()), ["female_id"], ["cycle_sk"])
    f = dim_female.select(F.col("female_id").alias("__fid"), "female_age", "female_bmi")
    m = dim_male.select(F.col("male_id").alias("dm_male_id"), "male_age", "male_factor")
    d = dim_doctor.select(F.col("doctor_id").alias("__did"), "doctor_recommendation")
    o = dim_outcome.select(F.col("outcome_id").alias("__oid"), "risk_level", "response_type")
    t = dim_time.select(F.col("time_id").alias("__tid"), F.col("full_date").alias("cycle_date"))
    basic = (latest.join(f, F.col("female_id") == F.col("__fid"), "inner")
                   .join(m, F.col("male_id") == F.col("dm_male_id"), "left")
                   .join(d, F.col("doctor_id") == F.col("__did"), "left")
                   .join(o, F.col("outcome_id") == F.col("__oid"), "left")
                   .join(t, F.col("cycle_start_time_id") == F.col("__tid"), "left"))
    ft = fact_transfer.select("transfer_sk", "case_id", "transfer_time_fk", "embryos_transferred",
                              "pregnancy_test_result", "live_birth", "outcome_id")
    lt = latest_per_key(ft.where(F.col("case_id").isNotNull()), ["case_id"], ["transfer_sk"])
    o2 = o.select(F.col("__oid").alias("__oid2"), F.col("response_type").alias("transfer_outcome"))
    t2 = t.select(F.col("__tid").alias("__tid2"), F.col("cycle_date").alias("transfer_date"))
    tr = (lt.join(t2, F.col("transfer_time_fk") == F.col("__tid2"), "left")
            .join(o2, F.col("outcome_id") == F.col("__oid2"), "left")
            .select(F.col("case_id").alias("__tcase"), "transfer_sk", "transfer_date", "embryos_transferred",
                    "pregnancy_test_result", F.col("live_birth").alias("transfer_live_birth"), "transfer_outcome"))
    out = basic.join(tr, F.col("case_id") == F.col("__tcase"), "left").select(
        "female_id", "cycle_sk", "case_id", "female_age", "female_bmi", F.col("dm_male_id").alias("male_id"),
        "male_age", "male_factor", "doctor_recommendation", "risk_level", "response_type",
        "cycle_date", "retrieved_oocytes", "blastocyst_d5",
        "transfer_sk", "transfer_date", "embryos_transferred", "pregnancy_test_result",
        "transfer_live_birth", "transfer_outcome")
    if not nested:
        return out
    return out.select(
        "female_id",
        F.struct("case_id", "female_id", "female_age", "female_bmi", "male_id", "male_age", "male_factor",
                 "doctor_recommendation", "risk_level", "response_type").alias("basic"),
        F.struct(F.col("cycle_date").alias("date"), F.col("retrieved_oocytes").alias("retrieved"),
                 F.col("blastocyst_d5").alias("blast_d5"), F.col("risk_level").alias("status")).alias("latest_cycle"),
        F.when(F.col("transfer_sk").isNotNull(), F.struct(
            F.col("transfer_date").alias("date"), "embryos_transferred",
            F.col("pregnancy_test_result").alias("preg_test"), F.col("transfer_live_birth").alias("live_birth"),
            F.col("transfer_outcome").alias("outcome"))).alias("transfer"))


def warehouse_summary(dim_female: DataFrame, dim_male: DataFrame, dim_protocol: DataFrame,
                      fact_transfer: DataFrame, protocol_col: str = "protocol_type",
                      outcome_col: str = "outcome_id") -> DataFrame:
    """Long-form (metric, label, value): female and male counts, protocol
    distribution, outcome counts of the transfers."""
    def total(df, name):
        return df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("metric"), F.lit(None).cast("string").alias("label"), "value")

    def dist(df, col, name):
        return df.groupBy(col).agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("metric"), F.col(col).cast("string").alias("label"), "value")

    return (total(dim_female, "total_female").unionByName(total(dim_male, "total_male"))
            .unionByName(dist(dim_protocol, protocol_col, "protocol_distribution"))
            .unionByName(dist(fact_transfer, outcome_col, "outcome_counts")))

