"""Corpus pipeline: language ID, quality rules, near-duplicate removal, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``; all but the last return the columns of ``documents``.

A stage's working tables last until the next stage begins: by then its result is written, and nothing
reads them any more.

Nulls, empty tables, repeated rows and other columns, in every stage: columns beyond those of
``documents`` are ignored and dropped; an empty table gives an empty one; repeated rows are decided alike
(and by the near-duplicate stage reduced to one); each stage's docstring says what a null or empty
text becomes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm.common import delete_tables, settle, small_batches, stored, working_tables
from starling.operators.keys import dense_surrogate_key

# SQL cannot express trained models, the banded search or the packing plan; tests/llm holds the
# stages against brute force instead.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE_SCORE = 0.5


_held: list[str] = []  # working tables of the stage before


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first deletes the working tables of the stage before (but those ``docs`` reads)."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _held:
            read = docs.inputFiles()
            kept = [p for p in _held if any(p.split(":", 1)[-1] in f for f in read)]
            delete_tables(spark, [p for p in _held if p not in kept])
            _held[:] = kept
        settle(spark)
        small_batches(spark)
        with working_tables() as made:
            out = function(spark, docs, sf_dir)
        _held.extend(made)
        return out
    return run_stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty texts are) and those whose best language is unsure."""
    from starling.llm.lang_id import UNKNOWN, identify, train
    found = identify(docs.select(*COLUMNS), train(docs))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule (null and empty texts do) or are mostly boilerplate lines."""
    from starling.llm.line_crf import fit_lines, label_documents
    crf = fit_lines(docs, _table(spark, sf_dir, "labels"))
    return label_documents(docs.select(*COLUMNS), crf).where("kept").select(*COLUMNS)


def _with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``row``: the number of its file and its place there, the same in every scan (a
    table that comes from no file is written first)."""
    try:
        placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        return stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    files = stored(dense_surrogate_key(placed, ["file"], "number"), "pipeline-files")  # one row a file
    return placed.join(files, "file").select(*COLUMNS, (F.shiftleft("number", 40) + F.col("at")).alias("row"))


@stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: the one with the smallest doc_id (null ids last), then
    the smallest hash of the text and other columns.  Null and empty texts all stay.  Rows are told
    apart by an id of their own."""
    from starling.llm.jaccard_groups import jaccard_components
    docs = _with_row_ids(docs)
    found = stored(jaccard_components(docs.select(F.col("row").alias("doc_id"), *COLUMNS[1:]))
                   .select(F.col("doc_id").alias("row"), "component_id"), "near-duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *COLUMNS[1:], "row"))
    kept = docs.withColumn("text", F.xxhash64("text")).join(found, "row").groupBy("component_id").agg(first.alias("first")).select("first.row")
    others = found.select("row").join(kept, "row", "left_anti")
    return docs.join(others, "row", "left_anti").select(*COLUMNS)


@stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts hold none and stay."""
    from starling.llm.decontaminate import find_leaks
    return find_leaks(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark")).where("size(leaks) = 0").select(*COLUMNS)


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their places in windows of 2048 ids; a null or empty text is its
    closing id alone."""
    from starling.llm.packing import pack
    return pack(docs).drop("ids")


STAGES = [("language_id", language_stage), ("quality_rules", quality_stage), ("jaccard_join", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        result = function(spark, docs, sf_dir)
        with working_tables() as path:
            docs = stored(result, f"pipeline-{name}")
        delete_tables(spark, before)  # the input of the stage, itself a stage's result
        before = path
    delete_tables(spark, _held)
    _held.clear()
    return docs
