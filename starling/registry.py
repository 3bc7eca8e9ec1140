"""Table registry: schema, primary key, natural (UNIQUE) key and foreign keys per table.

Spark has no constraints; the engine enforces them as operators (insert-or-ignore,
validation, repair) driven by these specs.  ``clinic_registry()`` is the star schema of
the treatment-case preset (7 dimensions, 2 facts, 1 bridge).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()                 # primary key (may be a surrogate)
    natural_key: tuple[str, ...] = ()         # UNIQUE constraint, if any
    surrogate: bool = False                   # key is generated 1..n (AUTOINCREMENT)
    foreign_keys: tuple[ForeignKey, ...] = ()
    required: tuple[str, ...] = ()            # columns that must not be NULL
    partition: str | None = None              # text column the stored table is partitioned by

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def unique_keys(self) -> list[tuple[str, ...]]:
        """Every key set a row must be unique on (PK if not generated, plus UNIQUE)."""
        keys = []
        if self.key and not self.surrogate:
            keys.append(self.key)
        if self.natural_key:
            keys.append(self.natural_key)
        return keys


@dataclass
class Registry:
    tables: dict[str, TableSpec] = field(default_factory=dict)

    def add(self, spec: TableSpec) -> "Registry":
        self.tables[spec.name] = spec
        return self

    def __getitem__(self, name: str) -> TableSpec:
        return self.tables[name]

    def __iter__(self):
        return iter(self.tables.values())

    def names(self) -> list[str]:
        return list(self.tables)


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def _schema(spec: str) -> T.StructType:
    """``"name type, ..."`` -> StructType (no Spark session needed)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# Tables and columns of the clinic star.
def clinic_registry(partitioned: bool = False) -> Registry:
    """``partitioned``: the facts carry and are stored by the month ('yyyy-MM') of their date."""
    def by_month(columns: str, month: str) -> dict:
        return {"schema": _schema(f"{columns}, {month} string" if partitioned else columns), "partition": month if partitioned else None}

    r = Registry()
    r.add(TableSpec("dim_female", _schema(
        "female_id string, female_age int, female_bmi double, amh_level double, fsh_level double, afc int"),
        key=("female_id",)))
    r.add(TableSpec("dim_male", _schema(
        "male_id string, male_age int, male_factor string, semen_count_mill_per_ml double, "
        "motility_percent double, morphology_percent double"),
        key=("male_id",)))
    r.add(TableSpec("dim_protocol", _schema(
        "protocol_id string, protocol_type string, stimulation_days int, total_fsh_dose int, "
        "trigger_type string, recommended_protocol string"),
        key=("protocol_id",),
        natural_key=("protocol_type", "stimulation_days", "total_fsh_dose", "trigger_type",
                     "recommended_protocol")))
    r.add(TableSpec("dim_doctor", _schema(
        "doctor_id bigint, doctor_name string, doctor_recommendation string"),
        key=("doctor_id",), surrogate=True, natural_key=("doctor_name", "doctor_recommendation")))
    r.add(TableSpec("dim_outcome", _schema(
        "outcome_id string, risk_level string, response_type string, "
        "suggested_waiting_period_days int, failure_reason string"),
        key=("outcome_id",),
        natural_key=("risk_level", "response_type", "suggested_waiting_period_days", "failure_reason")))
    r.add(TableSpec("dim_embryo", _schema(
        "embryo_id string, fresh_et_stage string, grading string, class_a_rate double"),
        key=("embryo_id",), natural_key=("fresh_et_stage", "grading", "class_a_rate")))
    r.add(TableSpec("dim_time", _schema(
        "time_id bigint, full_date string, day int, month int, month_name string, quarter int, "
        "year int, week int"),
        key=("time_id",), surrogate=True, natural_key=("full_date",)))
    r.add(TableSpec("fact_ivf_cycle", **by_month(
        "cycle_sk bigint, case_id string, female_id string, male_id string, protocol_id string, "
        "doctor_id bigint, outcome_id string, cycle_start_time_id bigint, e2_on_trigger double, "
        "endometrium_thickness double, follicles_18mm int, retrieved_oocytes int, m2_count int, "
        "gv_count int, injected_m2 int, fertilized_oocytes int, fertilization_rate double, "
        "cleavage_d3 int, blastocyst_d5 int, good_embryos int", "cycle_month"),
        key=("cycle_sk",), surrogate=True, natural_key=("case_id",),
        foreign_keys=(ForeignKey("female_id", "dim_female", "female_id"),
                      ForeignKey("male_id", "dim_male", "male_id"),
                      ForeignKey("protocol_id", "dim_protocol", "protocol_id"),
                      ForeignKey("doctor_id", "dim_doctor", "doctor_id"),
                      ForeignKey("outcome_id", "dim_outcome", "outcome_id"),
                      ForeignKey("cycle_start_time_id", "dim_time", "time_id")),
        required=("case_id", "female_id", "male_id")))
    # the reference declares no UNIQUE here (each incremental run re-appended all cases);
    # repaired: case_id is the natural key
    r.add(TableSpec("fact_transfer", **by_month(
        "transfer_sk bigint, case_id string, transfer_time_fk bigint, doctor_id bigint, "
        "embryos_transferred int, pregnancy_test_result string, clinical_pregnancy int, "
        "live_birth int, outcome_id string, success_probability_score double", "transfer_month"),
        key=("transfer_sk",), surrogate=True, natural_key=("case_id",),
        foreign_keys=(ForeignKey("transfer_time_fk", "dim_time", "time_id"),
                      ForeignKey("doctor_id", "dim_doctor", "doctor_id"),
                      ForeignKey("outcome_id", "dim_outcome", "outcome_id")),
        required=("case_id",)))
    r.add(TableSpec("fact_transfer_embryo", _schema("transfer_sk bigint, embryo_id string"),
        key=("transfer_sk", "embryo_id"),
        foreign_keys=(ForeignKey("transfer_sk", "fact_transfer", "transfer_sk"),
                      ForeignKey("embryo_id", "dim_embryo", "embryo_id")),
        required=("transfer_sk",)))
    return r


# The five foreign-key checks of the validator (child, fk column, parent, parent column).
CLINIC_FK_CHECKS = (
    ("fact_ivf_cycle", "cycle_start_time_id", "dim_time", "time_id"),
    ("fact_transfer", "transfer_time_fk", "dim_time", "time_id"),
    ("fact_transfer", "doctor_id", "dim_doctor", "doctor_id"),
    ("fact_transfer_embryo", "transfer_sk", "fact_transfer", "transfer_sk"),
    ("fact_transfer_embryo", "embryo_id", "dim_embryo", "embryo_id"),
)
