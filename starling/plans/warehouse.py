"""The warehouse load (D11) and the repair pass (H10) for the clinic preset.

Load = clean -> key -> dimensions -> calendar -> facts -> bridge.  Every step is a lazy
DataFrame; actions happen only at the sinks.  Each table is written as a new version
(dimensions: old rows + inserted rows) or appended (facts), so re-reading a table while
loading it is safe, and loading the same input twice leaves every table unchanged
(keys: deterministic hashes of natural keys / case ids; inserts: insert-or-ignore).
Raw rows without a case id have no key to be ignored by: they go to the table
``rejected_raw`` (each distinct row once) and nowhere else.  Rows with values that a cast refuses
are loaded with NULL there, and recorded in the same table with those values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.exprs import blank_to_null, hash_id, natural_key_text, try_date, try_integer, try_number
from starling.operators.clean import (
    apply_clean_statistics, drop_exact_duplicates, fill_string_default, map_values, normalize_columns, refused_values,
    rename_aliases, require_columns, safe_ratio,
)
from starling.operators.keys import assign_incremental_keys, fill_missing_ids, row_index
from starling.operators.load import (
    REJECTS, as_date, build_bridge, build_dim_time, date_to_time_key, insert_or_ignore, insert_or_ignore_multi, project_fact,
    record_rejects, rows_of_keys,
)
from starling.operators.aggregates import clean_statistics, duplicate_count, null_profile
from starling.operators.joins import anti_join, join_null_safe
from starling.operators.sketches import quantile_sketches, sketched_statistics
from starling.operators.windows import first_per_key
from starling.operators.quality import (
    fk_orphan_count, repair_delete_orphans, repair_duplicates, repair_orphan_fk_to_null, repair_required_nulls,
    validate,
)
from starling.registry import CLINIC_FK_CHECKS, Registry, clinic_registry
from starling.session import compiled_methods, working_tables, written
from starling.sources.store import TableStore

# Column renames between generations of the raw table.
RAW_ALIASES = {"mii_count": "m2_count", "injected_mii": "injected_m2", "patient_id": "female_id"}
# Shared dimensions whose id is derived from the natural key, with id prefix.
HASHED_DIMENSIONS = {"dim_protocol": "prot", "dim_outcome": "out", "dim_embryo": "emb"}
# Person dimensions whose id is derived from the case id when absent.
PERSON_IDS = {"female_id": "f", "male_id": "m"}
REQUIRED_RAW = ["case_id"]
# Cycle measures that are 0 where the raw data has no such column.
ZERO_MEASURES = ("e2_on_trigger", "endometrium_thickness", "follicles_18mm", "gv_count", "injected_m2",
                 "fertilized_oocytes", "cleavage_d3", "blastocyst_d5", "good_embryos")
# Without these raw columns there is no transfer to load.
TRANSFER_INPUTS = ("et_date", "embryos_transferred")
# Waiting period in days by risk level, and for every other level.
WAITING_DAYS = {"High": 90, "Medium": 45, "Low": 30}
DEFAULT_WAITING_DAYS = 30
# measures the clean stage computes from others
DERIVED_MEASURES = ("suggested_waiting_period_days", "class_a_rate")
REJECTED, STATISTICS, SKETCHES = "rejected_raw", "clean_statistics", "quantile_sketches"
ORDER_COL, REFUSED = "__row_ord", "__refused"
# columns the load computes itself (never taken from the raw input)
DERIVED_COLUMNS = ("doctor_id", "time_id", "cycle_start_time_id", "transfer_time_fk")


def _typed(df: DataFrame, name: str, dtype: T.DataType):
    if name not in df.columns:
        return F.lit(None).cast(dtype)
    src = df.schema[name].dataType
    if isinstance(src, T.StringType) and not isinstance(dtype, T.StringType):
        if isinstance(dtype, (T.IntegerType, T.LongType)):
            return try_integer(name, dtype.simpleString())
        return try_number(name, dtype.simpleString())
    if isinstance(dtype, T.StringType):
        return blank_to_null(name)
    return F.col(name).cast(dtype)


def type_raw(raw: DataFrame, registry: Registry, order_by: Sequence[str] | None = None) -> DataFrame:
    """The raw wide table with the star's columns and types: header normalisation, renames, required
    columns, typed attributes, doctor natural key, row order, and the values that casts refused
    (``REFUSED``: an array of column name and original text)."""
    df = rename_aliases(normalize_columns(raw), RAW_ALIASES)
    require_columns(df, REQUIRED_RAW)
    order = [normalize_columns_name(c) for c in (order_by or ["case_id"])]
    void = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    df = df.withColumn(ORDER_COL, F.struct(*[F.col(c).cast("string").alias(c) if c in void else F.col(c) for c in order]))
    typed, casts = {}, {}
    for spec in registry:
        for f in spec.schema.fields:
            if f.name in typed or f.name.endswith("_sk") or f.name in DERIVED_COLUMNS or f.name == spec.partition:
                continue
            if spec.name == "dim_time":
                continue
            typed[f.name] = _typed(df, f.name, f.dataType)
            if f.name in df.columns and isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType):
                casts[f.name] = (F.col(f.name), typed[f.name])
    typed["case_id"] = blank_to_null("case_id")
    for c in ("doctor_name", "doctor_recommendation", "et_date"):
        typed[c] = blank_to_null(c) if c in df.columns else F.lit(None).cast("string")
    if "et_date" in df.columns and not isinstance(df.schema["et_date"].dataType, (T.StringType, T.NullType)):
        typed["et_date"] = F.col("et_date")
    elif "et_date" in df.columns:
        casts["et_date"] = (F.col("et_date").cast("string"), try_date("et_date"))
    df = df.select(*[e.alias(n) for n, e in typed.items()], ORDER_COL, refused_values(casts).alias(REFUSED))
    return df.withColumn("doctor_name", F.coalesce(F.col("doctor_name"), F.lit("Unknown")))


def add_ids(df: DataFrame, registry: Registry) -> DataFrame:
    """Generated ids: persons' from the case, shared dimensions' from their natural key."""
    for col, prefix in PERSON_IDS.items():
        df = fill_missing_ids(df, col, prefix, ["case_id"])
    for dim, prefix in HASHED_DIMENSIONS.items():
        spec = registry[dim]
        df = fill_missing_ids(df, spec.key[0], prefix, list(spec.natural_key))
    return df


def prepare_raw(raw: DataFrame, registry: Registry, order_by: Sequence[str] | None = None) -> DataFrame:
    """Clean + key the raw wide table.  Exact duplicates are dropped by the caller (identical raw
    rows stay identical through these deterministic steps)."""
    return add_ids(type_raw(raw, registry, order_by), registry)


def clean_rows(df: DataFrame, store: TableStore, registry: Registry, raw_columns: Iterable[str], refresh: bool,
               sketched: bool = False) -> DataFrame:
    """The clean stage: every measure and numeric attribute of the raw data gets its missing values
    filled with the column's median and is clipped to its 1 % and 99 % quantiles; text that is no id
    becomes 'Unknown' where it is missing; the waiting period follows the risk level; the rate of good
    embryos is theirs over those transferred (0 without any).

    The statistics are fitted on the rows of a refreshing load (or of the first one), stored in the
    table ``clean_statistics``, and reused by every later load, so a batch is cleaned alike whatever
    else is in it.  ``sketched``: every load adds its own quantile sketches (table
    ``quantile_sketches``) and is cleaned by the estimates of all loads so far, without a ranked pass."""
    numbers = [f.name for f in df.schema.fields if f.name in raw_columns and isinstance(f.dataType, T.NumericType)
               and f.name not in DERIVED_MEASURES]
    if sketched:
        own = written(quantile_sketches(df, numbers), "quantile-sketches")
        (store.replace if refresh else store.append)(SKETCHES, own)
        store.replace(STATISTICS, sketched_statistics(store.read(SKETCHES)))
    elif refresh or not store.exists(STATISTICS):
        store.replace(STATISTICS, clean_statistics(df, numbers))
    df = apply_clean_statistics(df, store.read(STATISTICS))
    df = map_values(df, "suggested_waiting_period_days", WAITING_DAYS, DEFAULT_WAITING_DAYS, source_col="risk_level")
    df = safe_ratio(df, "good_embryos", "embryos_transferred", "class_a_rate")
    ids = {f.name for f in df.schema.fields if f.name.endswith("_id")}
    return fill_string_default(df, exclude={*ids, "et_date"})


def normalize_columns_name(c: str) -> str:
    return c.strip().lower().replace(" ", "_")


def _dimension_candidates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # one row per distinct dimension row, remembering where it first appears
    return df.groupBy(*cols).agg(F.min(ORDER_COL).alias(ORDER_COL))


def _first_rows(df: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of ``rows`` (the distinct dimension rows of ``df``, read from files) the first of every key.  Where they
    first appear is looked up only for keys with several rows: that takes a sort of all their raw rows."""
    several = written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*key), "repeated-keys")
    if several.isEmpty():
        return rows
    raw = df.select(*rows.columns, ORDER_COL).join(several, list(key), "left_semi")
    firsts = first_per_key(_dimension_candidates(raw, rows.columns), key, [ORDER_COL]).select(*rows.columns)
    return rows.join(several, list(key), "left_anti").unionByName(firsts)


def _held(store: TableStore, table: str) -> DataFrame | None:
    """The table, or None while it has no rows to compare with."""
    return store.read(table) if store.folders(table) else None


def _insert_dimension(store: TableStore, spec, df: DataFrame, id_from_natural_key: bool = False
                      ) -> tuple[int, int]:
    target = _held(store, spec.name)
    keys = spec.unique_keys()
    one_key = len(keys) <= 1 or id_from_natural_key
    cand = df.select(*spec.columns).distinct() if one_key else _dimension_candidates(df, spec.columns)
    if spec.name in HASHED_DIMENSIONS:
        # a missing part is a value of the natural key here (Q7, Q24), so it is compared as text
        keys = [spec.key, ("__nk",)]
        cand, target = [d if d is None else d.withColumn("__nk", natural_key_text(*spec.natural_key)) for d in (cand, target)]
    cand = written(cand, "dimension-batch")
    if one_key:
        # one key, or ids hashed from the natural key: inside the batch equal natural keys
        # have equal ids, so picking the first row per id is the greedy result; against
        # the table every unique key is still checked
        firsts = _first_rows(df, cand.select(*spec.columns), keys[0])
        if spec.name in HASHED_DIMENSIONS:
            firsts = firsts.withColumn("__nk", natural_key_text(*spec.natural_key))
        new = insert_or_ignore(target, firsts, list(keys[0]), [], unique_batch=True, cut_target=True)
        for extra in keys[1:] if target is not None else ():
            new = anti_join(new, rows_of_keys(target.select(*extra), cand, extra), [(k, k) for k in extra])
    else:
        ranked = row_index(cand, [ORDER_COL], "__seq")
        new = insert_or_ignore_multi(target, ranked, keys, "__seq").drop("__seq")
    new = written(new.select(*spec.columns), "dimension-rows")
    inserted = new.count()
    if inserted:
        store.append(spec.name, new)
    return cand.count(), inserted


def _append_fact(store: TableStore, spec, cand: DataFrame, sk_col: str | None) -> tuple[int, int]:
    """Insert-or-ignore ``cand`` (already unique on the fact's key) and append it, with
    surrogate keys continuing after the table's max (those it brings, if the table is empty)."""
    target = _held(store, spec.name)
    numbered = sk_col in cand.columns and target is None
    if target is not None:
        cand = written(cand, "fact-batch")
    key = list(spec.natural_key or spec.key)
    order = [ORDER_COL] if ORDER_COL in cand.columns else key
    new = insert_or_ignore(target, cand, key, order, unique_batch=True, cut_target=True)
    if sk_col is not None and not numbered:
        base = 0 if target is None else target.agg(F.max(sk_col)).first()[0] or 0
        new = row_index(new.drop(sk_col), order, sk_col, start=int(base) + 1)
    inserted = store.append_counted(spec.name, new.select(*spec.columns), spec.partition)
    return inserted if target is None else cand.count(), inserted


def _set_aside(store: TableStore, df: DataFrame, refresh: bool) -> None:
    """Records the rows without a case and the values that casts refused in ``rejected_raw`` (refresh:
    starts it anew)."""
    if refresh and store.exists(REJECTED):
        store.replace(REJECTED, store.spark.createDataFrame([], REJECTS))
    no_case, refused = F.col("case_id").isNull(), F.col(REFUSED)
    aside = no_case | (F.size(refused) > 0)
    if df.select("case_id", REFUSED).where(aside).isEmpty():  # two columns tell, mostly, that the others need no reading
        return
    rows = df.where(aside).drop(ORDER_COL)
    reason = F.when(no_case, "null_case_id").otherwise("refused_values")
    record = F.to_json(F.struct(*sorted(c for c in rows.columns if c != REFUSED)))
    record_rejects(store, REJECTED, rows, reason, refused=F.when(F.size(refused) > 0, refused), record=record)


def _holds_other_ids(store: TableStore, spec, prefix: str) -> bool:
    """Whether the published dimension has a natural key under another id than the one derived from it."""
    return not store.read(spec.name).where(F.col(spec.key[0]) != hash_id(prefix, *spec.natural_key)).isEmpty()


def resolve_hashed_ids(df: DataFrame, store: TableStore, reg: Registry, dims: Sequence[str]) -> DataFrame:
    """The same natural key gets the same id in every row and every batch (Q24): a row's given
    or derived id gives way to the id under which the published dimension holds its key."""
    for dim in dims:
        spec = reg[dim]
        key, nk = spec.key[0], list(spec.natural_key)
        held = store.read(dim).select(natural_key_text(*nk).alias("__nk"), F.col(key).alias("__held"))
        df = (df.withColumn("__nk", natural_key_text(*nk)).join(held, "__nk", "left")
                .withColumn(key, F.coalesce("__held", key)).drop("__nk", "__held"))
    return df


def run_full_etl(raw: DataFrame, store: TableStore, refresh: bool = True,
                 order_by: Sequence[str] | None = None, registry: Registry | None = None, clean: bool | str = False) -> DataFrame:
    """Load ``raw`` into the star.  Returns the F14 summary (table, processed, inserted).

    ``refresh`` recreates empty tables first; otherwise the load is incremental.  Either
    way keys are enforced (Q4) and a second run with the same input inserts nothing.
    ``clean`` runs the clean stage (:func:`clean_rows`) between typing and keying; "sketch" runs it on
    merged quantile sketches."""
    with working_tables(raw.sparkSession), compiled_methods(raw.sparkSession):
        return _load(raw, store, refresh, order_by, registry or clinic_registry(), clean)


def _load(raw: DataFrame, store: TableStore, refresh: bool, order_by: Sequence[str] | None, reg: Registry, clean: bool | str) -> DataFrame:
    spark = raw.sparkSession
    store.create_all(reg, refresh)
    raw_columns = set(rename_aliases(normalize_columns(raw), RAW_ALIASES).columns)
    typed = type_raw(raw, reg, order_by)
    ids = {*PERSON_IDS, *(reg[d].key[0] for d in HASHED_DIMENSIONS)}
    if not clean:
        typed = add_ids(typed, reg)
    # the typed rows are written once, with their ids but without the columns that the raw table lacks, and once
    # more when they are cleaned: a dozen passes read them, and each would derive those values again
    absent = {f.name: F.lit(None).cast(f.dataType) for f in typed.schema.fields
              if f.name not in raw_columns and f.name not in (ORDER_COL, REFUSED, "doctor_name") and (clean or f.name not in ids)}
    typed = written(typed.drop(*absent), "typed-rows")
    typed = drop_exact_duplicates(typed, reread=True).withColumns(absent)
    if clean:
        loaded = clean_rows(typed.where(F.col("case_id").isNotNull()), store, reg, raw_columns, refresh, clean == "sketch")
        typed = loaded.unionByName(typed.where(F.col("case_id").isNull()).select(
            *[F.col(c).cast(loaded.schema[c].dataType).alias(c) for c in loaded.columns]))
        typed, absent = drop_exact_duplicates(written(add_ids(typed, reg), "cleaned-rows"), reread=True), {}
    summary = []
    _set_aside(store, typed, refresh)
    df = typed.where(F.col("case_id").isNotNull())

    # doctors: incremental integer ids on the null-safe natural key
    doc = reg["dim_doctor"]
    _, new_doctors = assign_incremental_keys(df, _held(store, "dim_doctor"), list(doc.natural_key), "doctor_id")
    new_doctors = written(new_doctors.select(*doc.columns), "dimension-rows")
    n_doc = new_doctors.count()
    if n_doc:
        store.append("dim_doctor", new_doctors)
    summary.append(("dim_doctor", n_doc, n_doc))

    def load_calendar():
        old_time = _held(store, "dim_time")
        new_time = written(build_dim_time(df, "et_date", old_time), "dimension-rows")
        n_time = new_time.count()
        if n_time:
            store.append("dim_time", new_time)
        return ("dim_time", n_time, n_time)

    # the dimensions and the calendar are independent: submit them as concurrent Spark
    # jobs so small per-table jobs share the executors instead of running back to back
    dims = ("dim_female", "dim_male", "dim_protocol", "dim_outcome", "dim_embryo")
    hashed = {n for n in HASHED_DIMENSIONS if reg[n].key[0] not in raw_columns}
    with ThreadPoolExecutor(max_workers=len(dims) + 1) as pool:
        futures = [pool.submit(lambda n=n: (n, *_insert_dimension(store, reg[n], df, n in hashed))) for n in dims]
        futures.append(pool.submit(load_calendar))
        summary.extend(f.result() for f in futures)
    dim_time = store.read("dim_time")

    fc, ft = reg["fact_ivf_cycle"], reg["fact_transfer"]
    # both facts take the first row per case: pick it once, over the columns they use, and look
    # the dimension ids up afterwards.  Ids that are all derived need no lookup while the dimension has no others.
    resolved = [d for d, prefix in HASHED_DIMENSIONS.items()
                if reg[d].key[0] in raw_columns or not refresh and _holds_other_ids(store, reg[d], prefix)]
    # columns without any value need not travel
    empty = {c: e for c, e in absent.items() if c not in ids}
    needed = [*fc.columns, *ft.columns, *doc.natural_key, "et_date", *(c for d in resolved for c in reg[d].natural_key)]
    needed = [c for c in dict.fromkeys(needed) if c in df.columns and c not in empty]
    firsts = first_per_key(df.select(*needed, ORDER_COL), ["case_id"], [ORDER_COL]).withColumns(empty)
    keyed = join_null_safe(firsts, store.read("dim_doctor"), list(doc.natural_key), "left")
    keyed = resolve_hashed_ids(keyed, store, reg, [d for d in resolved if d != "dim_embryo"])
    keyed = date_to_time_key(keyed, "et_date", dim_time, "cycle_start_time_id")
    month = F.date_format(as_date(keyed, "et_date"), "yyyy-MM")
    keyed = keyed.withColumns({s.partition: month for s in (fc, ft) if s.partition})
    keyed = keyed.withColumn("transfer_time_fk", F.col("cycle_start_time_id"))
    keyed = keyed.select(*[c for c in dict.fromkeys([*fc.columns, *ft.columns]) if c in keyed.columns and c not in empty], ORDER_COL)
    fresh = _held(store, "fact_ivf_cycle") is None and _held(store, "fact_transfer") is None
    if fresh:  # both facts number the same rows in the same order: once for both
        firsts = row_index(keyed, [ORDER_COL], "cycle_sk")
        firsts = firsts.withColumn("transfer_sk", F.col("cycle_sk"))
    else:
        firsts = written(keyed, "first-rows")
    zero = [c for c in ZERO_MEASURES if c not in raw_columns]
    cyc = project_fact(firsts.drop(*zero), [c for c in [*fc.columns, ORDER_COL] if fresh or c != "cycle_sk"], fc.schema, defaults={c: 0 for c in zero})
    summary.append(("fact_ivf_cycle", *_append_fact(store, fc, cyc, "cycle_sk")))

    if all(c in raw_columns for c in TRANSFER_INPUTS):
        tr = project_fact(firsts, [c for c in [*ft.columns, ORDER_COL] if fresh or c != "transfer_sk"], ft.schema)
        summary.append(("fact_transfer", *_append_fact(store, ft, tr, "transfer_sk")))
    else:
        summary.append(("fact_transfer", 0, 0))

    be = reg["fact_transfer_embryo"]
    embryo = reg["dim_embryo"]
    members = df.select("case_id", *embryo.key, *embryo.natural_key)
    if "dim_embryo" in resolved:
        members = resolve_hashed_ids(members.distinct(), store, reg, ["dim_embryo"])
    bridge = build_bridge(members.where(F.col("embryo_id").isNotNull()), store.read("fact_transfer"),
                          "case_id", "transfer_sk", "embryo_id", unique_facts=fresh)
    summary.append(("fact_transfer_embryo", *_append_fact(store, be, bridge, None)))

    schema = "table_name string, processed long, inserted long"
    return spark.createDataFrame([(t, int(p), int(i)) for t, p, i in summary], schema)


def run_validation(store: TableStore, registry: Registry | None = None,
                   fk_checks=CLINIC_FK_CHECKS) -> dict[str, DataFrame]:
    """H01-H05 over every registered table of the store."""
    reg = registry or clinic_registry()
    tables = {n: store.read(n) for n in reg.names()}
    required = {s.name: list(s.required) for s in reg if s.required}
    return validate(tables, required, fk_checks)


def run_repairs(store: TableStore, registry: Registry | None = None) -> DataFrame:
    """Skip when validation passes; else H06 -> H07 -> H08 -> H09 in order.

    Each step rewrites (as a new version) only the tables found dirty: rewriting a clean
    100 TB fact would be pure waste.  Decisions come from one validation pass whose
    sheets are small (one row per table / required column / FK check) and are collected
    once.  Removing rows (H06, H07) cannot create duplicates or fact FK orphans, so only
    the bridge is re-checked after its parent fact changed, plus the one FK the validator
    does not cover.  The final status re-checks only rewritten tables and the FK checks
    that touch them; everything else keeps its first-pass count."""
    reg = registry or clinic_registry()
    sheets = run_validation(store, reg)
    req = {(r["table_name"], r["column_name"]): r["null_count"] for r in sheets["required"].collect()}
    dups = {r["table_name"]: r["duplicate_rows"] for r in sheets["duplicates"].collect()}
    fks = {r["check_name"]: r["invalid_count"] for r in sheets["fk_checks"].collect()}

    def status() -> DataFrame:
        ok = not any(req.values()) and not any(dups.values()) and not any(fks.values())
        return store.spark.createDataFrame([(1 if ok else -1,)], "status int")

    if not (any(req.values()) or any(dups.values()) or any(fks.values())):
        return status()
    changed = set()
    for spec in reg:                                                            # H06
        if any(n for (t, _), n in req.items() if t == spec.name):
            store.replace(spec.name, repair_required_nulls(store.read(spec.name), spec.required))
            changed.add(spec.name)
    for spec in reg:                                                            # H07
        if dups.get(spec.name):
            store.replace(spec.name, repair_duplicates(store.read(spec.name)))
            changed.add(spec.name)
    for child, fk, parent, pk in (("fact_transfer", "transfer_time_fk", "dim_time", "time_id"),    # H08
                                  ("fact_ivf_cycle", "cycle_start_time_id", "dim_time", "time_id"),
                                  ("fact_transfer", "doctor_id", "dim_doctor", "doctor_id"),
                                  ("fact_ivf_cycle", "doctor_id", "dim_doctor", "doctor_id")):
        name = f"{child}.{fk} -> {parent}.{pk}"
        dirty = fks[name] > 0 if name in fks else \
            fk_orphan_count(store.read(child), fk, store.read(parent), pk).first()[0] > 0
        if dirty:
            store.replace(child, repair_orphan_fk_to_null(store.read(child), fk, store.read(parent), pk))
            changed.add(child)
    b = store.read("fact_transfer_embryo")                                      # H09
    dirty = any(n and k.startswith("fact_transfer_embryo.") for k, n in fks.items())
    if not dirty and "fact_transfer" in changed:
        dirty = fk_orphan_count(b, "transfer_sk", store.read("fact_transfer"), "transfer_sk").first()[0] > 0
    if dirty:
        # ``NOT IN`` semantics: a NULL key is not deleted (NULL transfer_sk rows were
        # already removed as required-column NULLs by H06)
        b = repair_delete_orphans(b, "transfer_sk", store.read("fact_transfer"), "transfer_sk", keep_null=True)
        b = repair_delete_orphans(b, "embryo_id", store.read("dim_embryo"), "embryo_id", keep_null=True)
        store.replace("fact_transfer_embryo", b)
        changed.add("fact_transfer_embryo")
    # final status: re-check what was rewritten
    for t in changed:
        df = store.read(t)
        dups[t] = duplicate_count(df).first()[0]
        spec = reg[t]
        if spec.required:
            for r in null_profile(df.select(*[c for c in spec.required if c in df.columns]), t).collect():
                req[(t, r["column_name"])] = r["null_count"]
    for child, fk, parent, pk in CLINIC_FK_CHECKS:
        if child in changed or parent in changed:
            fks[f"{child}.{fk} -> {parent}.{pk}"] = \
                fk_orphan_count(store.read(child), fk, store.read(parent), pk).first()[0]
    return status()
