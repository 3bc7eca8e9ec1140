"""The ``opN_<name>`` queries: each operator over its whole table, with its DuckDB SQL where
SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import license_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def bind(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@bind("op3_warc", """
WITH base AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html) AS n, sha256(html) AS digest FROM base),
g AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to, url
FROM d LEFT JOIN g USING (digest)
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.warc import archive_round_trip
    return archive_round_trip(spark, table(spark, sf_dir, "pages"))


@bind("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.sharding import feistel_shards
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return feistel_shards(docs, ["doc_id"], shards=24, seed=7).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@bind("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.packing import pack
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


@bind("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.line_crf import fit_lines, label_documents
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crf = fit_lines(docs, table(spark, sf_dir, "labels"))
    return label_documents(docs, crf, drop=("text",))


@bind("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.lang_id import identify, train
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = train(docs.where("NOT held_out"))
    return identify(docs.select("doc_id", "text", "held_out"), model, drop=("text",))


@bind("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.quality_fm import score_documents, train
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    machine = train(docs.where("NOT held_out"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return (score_documents(docs.select("doc_id", "text", "n_chars", "held_out"), machine, drop=("text", "n_chars"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


@bind("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.jaccard_groups import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@bind("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.decontaminate import leak_pairs
    return leak_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@bind("op1_license_scan", license_scan.oracle_sql())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(table(spark, sf_dir, "documents"))


@bind("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.masked_lm import pseudo_likelihood
    return pseudo_likelihood(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))


@bind("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.whitening import whitened_rows
    return whitened_rows(table(spark, sf_dir, "embeddings"))


@bind("op12_topk_search")
def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.topk_search import top_products
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@bind("op13_code_compression")
def op13_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starling.llm.vector_codes import vector_codes
    return vector_codes(table(spark, sf_dir, "embeddings"))
