"""Validation (H01-H05) of a warehouse that grows by batches: each batch is checked against stored
state, and old rows are not read again.

State, in the table store:

* ``check_rows``: a 128-bit fingerprint of every distinct row, by table;
* ``check_keys``: every parent key seen, by parent column;
* ``check_orphans``: child rows without a parent yet, counted by check and key (signed: a parent that
  arrives later takes its children out);
* ``check_totals``: what each batch adds to the sheets (row counts, duplicates, NULLs, orphans).

A batch's state and its id are one commit, so a batch checked twice counts once.  All lookups cut the
state down to the batch's keys by a semi join, whose small side Spark broadcasts by its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.operators.aggregates import null_profile
from starling.operators.joins import anti_join
from starling.operators.load import rows_of_keys
from starling.operators.quality import validation_status
from starling.session import working_tables, written

ROWS, KEYS, ORPHANS, TOTALS = "check_rows", "check_keys", "check_orphans", "check_totals"
TOTALS_SCHEMA = "sheet string, name string, column_name string, n long"
Check = tuple[str, str, str, str]  # child, fk column, parent, pk column


def check_name(check: Check) -> str:
    child, fk, parent, pk = check
    return f"{child}.{fk} -> {parent}.{pk}"


def fingerprint(df: DataFrame) -> F.Column:
    """128 bits of a whole row; a NULL is a value of its own."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))


class IncrementalChecks:
    def __init__(self, store, fk_checks: Sequence[Check], required: Mapping[str, Sequence[str]], name: str = "checks") -> None:
        self.store, self.fk_checks, self.required, self.name = store, list(fk_checks), dict(required), name

    def _state(self, table: str, column: str, value: str) -> DataFrame | None:
        held = self.store.read_or_none(table)
        return None if held is None else held.where(F.col(column) == value)

    def _unseen(self, table: str, column: str, value: str, batch: DataFrame, key: str) -> DataFrame:
        """Rows of ``batch`` whose key the state lacks.  The state is cut down to the keys of a batch much
        smaller than it; for any other batch that would be a second join of the same size."""
        held = self._state(table, column, value)
        if held is None:
            return batch
        held = held.select(key)
        return anti_join(batch, rows_of_keys(held, batch, [key]) if batch.count() * 8 < held.count() else held, [(key, key)])

    def _rows(self, table: str, df: DataFrame) -> list[tuple]:
        counted = written(df.groupBy(fingerprint(df).alias("row_id")).agg(F.count(F.lit(1)).alias("n")), "fingerprints")
        new = self._unseen(ROWS, "table_name", table, counted, "row_id").select("row_id", F.lit(table).alias("table_name"))
        n = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        fresh = self.store.append_counted(ROWS, new, "table_name", value=table)
        nulls = [("nulls", table, r["column_name"], r["null_count"]) for r in null_profile(df, table).collect()]  # one row a column
        return [("rows", table, None, n), ("duplicates", table, None, n - fresh), *nulls]

    def _parents(self, parent: str, pk: str, df: DataFrame) -> list[tuple]:
        """Notes the batch's parent keys; children that waited for them are orphans no more."""
        label = f"{parent}.{pk}"
        keys = written(df.where(F.col(pk).isNotNull()).select(F.col(pk).cast("string").alias("key")).distinct(), "parent-keys")
        new = written(self._unseen(KEYS, "parent", label, keys, "key").withColumn("parent", F.lit(label)), "new-parent-keys")
        if new.isEmpty():
            return []
        self.store.append_counted(KEYS, new, "parent", value=label)
        out = []
        for check in self.fk_checks:
            waiting = self._state(ORPHANS, "check_id", self._id(check)) if check[2:] == (parent, pk) else None
            if waiting is None:
                continue
            found = rows_of_keys(waiting, new, ["key"]).groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
            found = written(found.select("key", (-F.col("n")).alias("n"), F.lit(self._id(check)).alias("check_id")), "found-parents")
            out.append(self._orphans(check, found))
        return out

    def _children(self, check: Check, df: DataFrame) -> list[tuple]:
        child, fk, parent, pk = check
        counted = df.where(F.col(fk).isNotNull()).groupBy(F.col(fk).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        counted = written(counted, "child-keys")
        lost = self._unseen(KEYS, "parent", f"{parent}.{pk}", counted, "key").withColumn("check_id", F.lit(self._id(check)))
        return [self._orphans(check, written(lost, "orphans"))]

    def _orphans(self, check: Check, rows: DataFrame) -> tuple:
        n = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if n:
            self.store.append_counted(ORPHANS, rows, "check_id", value=self._id(check))
        return ("fk_checks", check_name(check), None, n)

    @staticmethod
    def _id(check: Check) -> str:
        return f"{check[0]}.{check[1]}-{check[2]}.{check[3]}"

    def add(self, batch: Mapping[str, DataFrame], batch_id: int) -> None:
        """Checks one batch of rows of any tables; nothing if the batch is committed already."""
        if self.store.has_batch(self.name, batch_id):
            return
        with working_tables(self.store.spark), self.store.transaction():
            totals = [t for table, df in batch.items() for t in self._rows(table, df)]
            for parent, pk in dict.fromkeys(c[2:] for c in self.fk_checks):
                if parent in batch:
                    totals += self._parents(parent, pk, batch[parent])
            for check in self.fk_checks:
                if check[0] in batch:
                    totals += self._children(check, batch[check[0]])
            self.store.append(TOTALS, self.store.spark.createDataFrame(totals, TOTALS_SCHEMA))
            self.store.mark_batch(self.name, batch_id)

    def totals(self) -> DataFrame:
        """(sheet, name, column_name, n) over all batches; a few rows a table."""
        held = self.store.read_or_none(TOTALS)
        held = self.store.spark.createDataFrame([], TOTALS_SCHEMA) if held is None else held
        return held.groupBy("sheet", "name", "column_name").agg(F.sum("n").alias("n"))

    def sheets(self) -> dict[str, DataFrame]:
        """The sheets and the status that ``validate`` gives for the whole tables."""
        t = self.totals()
        required = [(a, c) for a, cs in self.required.items() for c in cs]
        need = self.store.spark.createDataFrame(required, "table_name string, column_name string")
        nulls = t.where("sheet = 'nulls'").select(F.col("name").alias("table_name"), "column_name", F.col("n").alias("null_count"))
        dups = t.where("sheet = 'duplicates'").select(F.col("name").alias("table_name"), F.col("n").alias("duplicate_rows"))
        fks = t.where("sheet = 'fk_checks'").select(F.col("name").alias("check_name"), F.col("n").alias("invalid_count"))
        req = nulls.join(need, ["table_name", "column_name"]).withColumn("failed", F.col("null_count") > 0)
        tables = t.where("sheet = 'rows'").select(F.col("name").alias("table_name"), F.col("n").alias("row_count"))
        return {"tables": tables, "nulls": nulls, "fk_checks": fks, "duplicates": dups, "required": req, "status": validation_status(dups, req, fks)}
