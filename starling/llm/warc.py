"""Operator 3: WARC archives as a PySpark Python data source.

``spark.read.format("warc")`` plans one input partition per group of archive files (large
files alone, small ones together up to ``partition_bytes``), takes equality, IN and null
predicates on ``record_type`` and the other header columns down to the reader, parses each
record's headers first, and seeks past the block of a record that no predicate wants
(gzip members are inflated but not parsed or decoded).  ``option("payload", "false")`` skips every payload.

``df.write.format("warc")`` writes one archive per task and a manifest on commit: files of
failed or repeated task attempts are never read.

Paths are opened with ``pyarrow.fs`` in the tasks, so they may be ``file:``, ``hdfs:``,
``s3:`` or ``gs:`` locations that all executors see.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull,
    IsNull, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, BinaryType

from starling.llm.common import stored
from starling.session import work_dir

SCHEMA = StructType([
    StructField("record_type", StringType()), StructField("record_id", StringType()),
    StructField("target_uri", StringType()), StructField("warc_date", StringType()),
    StructField("content_type", StringType()), StructField("content_length", LongType()),
    StructField("refers_to_id", StringType()), StructField("declared_digest", StringType()),
    StructField("headers", MapType(StringType(), StringType())), StructField("payload", BinaryType()),
])
# header fields behind the columns (fixed names of the WARC format)
FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
          "warc_date": "WARC-Date", "content_type": "Content-Type", "refers_to_id": "WARC-Refers-To",
          "declared_digest": "WARC-Payload-Digest"}
HTTP = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)
        self.paths = paths


class Written(WriterCommitMessage):
    def __init__(self, name: str | None) -> None:
        self.name = name


def _wanted(filters: list[tuple[str, tuple | None]], row: dict) -> bool:
    return all(row[c] is not None if values is None else row[c] in values for c, values in filters)


def _headers(stream) -> dict[str, str] | None:
    """The next record's header fields, or None at the end of the archive."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    out: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:  # a folded line
            out[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        out[name] = value.strip()
    return out


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP header, if it has one."""
    if headers.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def records(stream, filters: list, with_payload: bool) -> Iterator[dict]:
    """Rows of one archive: headers first; the block is read only for a wanted record."""
    while (headers := _headers(stream)) is not None:
        length = int(headers.get("Content-Length", 0))
        row = {c: headers.get(f) for c, f in FIELDS.items()} | {"content_length": length, "headers": headers}
        if with_payload and _wanted(filters, row):
            block = stream.read(length)
            if len(block) != length:
                raise ValueError(f"truncated record {row['record_id']}")
            yield row | {"payload": _payload(headers, block)}
            continue
        stream.seek(length, io.SEEK_CUR)
        if _wanted(filters, row):
            yield row | {"payload": None}


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    raw = system.open_input_file(name)
    return gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw, 1 << 16)


def _listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the archives under ``path``: those of its manifests, else all."""
    system, name = fs.FileSystem.from_uri(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(fs.FileSelector(name))
    manifests = [f for f in found if f.base_name.endswith(MANIFEST)]
    archives = [f for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
    if manifests:
        names = {x for m in manifests for x in json.loads(system.open_input_file(m.path).read())}
        if missing := names - {f.base_name for f in archives}:
            raise FileNotFoundError(f"archives of the manifest are missing: {sorted(missing)[:3]}")
        archives = [f for f in archives if f.base_name in names]
    return [(f"{path.rstrip('/')}/{f.base_name}", f.size) for f in sorted(archives, key=lambda f: f.base_name)]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.filters: list[tuple[str, tuple | None]] = []

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in FIELDS:
                yield f
            elif isinstance(f, EqualTo | EqualNullSafe):
                self.filters.append((column, (f.value,)))
            elif isinstance(f, In):
                self.filters.append((column, tuple(f.value)))
            elif isinstance(f, IsNotNull):
                self.filters.append((column, None))
            elif isinstance(f, IsNull):
                self.filters.append((column, (None,)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        out, held, size = [], [], 0
        for path, n in _listed(self.path):
            if held and size + n > self.partition_bytes:
                out.append(Files(held))
                held, size = [], 0
            held, size = [*held, path], size + n
        return out + [Files(held)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(SCHEMA)
        rows, size = [], 0
        for path in partition.paths:
            with _open(path) as stream:
                for row in records(stream, self.filters, self.with_payload):
                    rows.append(row | {"headers": list(row["headers"].items())})
                    size += len(row["payload"] or b"") + 500
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _clean(value: str) -> str:
    """Header values hold no line breaks."""
    return " ".join(value.splitlines()) if "\n" in value or "\r" in value else value


def record_bytes(row: dict) -> bytes:
    """One WARC record of a row with the columns of SCHEMA (null columns are left out)."""
    payload = row.get("payload") or b""
    block = payload
    if (row.get("content_type") or "").startswith("application/http") and row.get("record_type") == "response":
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
    fields = {f: row.get(c) for c, f in FIELDS.items()} | dict(row.get("headers") or {})
    fields["Content-Length"] = str(len(block))
    head = "".join(f"{k}: {_clean(str(v))}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.gz = str(options.get("compression", "none")).lower() == "gzip"
        self.run = uuid.uuid4().hex[:12]
        system, name = fs.FileSystem.from_uri(self.path)
        system.create_dir(name, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        task = TaskContext.get()
        system, folder = fs.FileSystem.from_uri(self.path)
        name = (f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{self.run}.warc" + ".gz" * self.gz)
        out = None
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    out = system.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
                data = record_bytes(batch.slice(i, 1).to_pylist()[0])
                out.write(gzip.compress(data, 6, mtime=0) if self.gz else data)  # one gzip member a record
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages: list) -> None:
        system, folder = fs.FileSystem.from_uri(self.path)
        names = sorted(m.name for m in messages if m is not None and m.name)
        with system.open_output_stream(f"{folder}/{self.run}{MANIFEST}") as out:
            out.write(json.dumps(names).encode())


class WarcSource(DataSource):
    """Options: ``path``; reading: ``payload``, ``partition_bytes``; writing: ``compression`` (gzip)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, min_revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """WARC records (columns of SCHEMA) of ``pages`` (page_id, url, html).

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes the smallest page_id
    keeps the payload as a response (every row of that id, should it repeat; all of them if
    every id is null); the others become revisits that refer to it.  Null html is an empty
    payload, a null url or page_id leaves its field out.  Only digests of payloads that repeat
    are joined back, so payloads are shuffled only if that table is too large to broadcast.
    """
    base = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
                 .withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html").cast("long")))
    copies = stored(base.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest")
                        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"), "warc-copies")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    extra = F.map_filter(F.create_map(
        F.lit("Page-Id"), F.col("page_id").cast("string"), F.lit("Payload-Length"), F.col("bytes").cast("string"),
        F.lit("WARC-Profile"), F.when(revisit, F.lit(REVISIT_PROFILE))), lambda k, v: v.isNotNull())
    return base.join(copies, "digest", "left").select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        urn("page_id").alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"),
        F.lit(HTTP).alias("content_type"), F.lit(None).cast("long").alias("content_length"),
        F.when(revisit, urn("first_id")).alias("refers_to_id"), digest.alias("declared_digest"),
        extra.alias("headers"), F.when(~revisit, F.encode("html", "UTF-8")).alias("payload"))


def write_pages(pages: DataFrame, path: str, compression: str = "none", **options) -> str:
    """Write ``pages`` as WARC archives under ``path`` (seen by all executors)."""
    register(pages.sparkSession)
    (page_records(pages, **options).write.format("warc").option("compression", compression)
        .mode("append").save(path))
    return path


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A response's size and digest come from the payload that was read; a revisit's from its
    headers (its payload is skipped).  An empty table gives an empty result.
    """
    path = write_pages(pages, work_dir(spark, "warc"))
    page_id = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    columns = lambda size, digest: [
        F.col("headers")["Page-Id"].cast("long").alias("page_id"), size.cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", page_id("refers_to_id").alias("refers_to"),
        F.col("target_uri").alias("url")]
    full = (read_records(spark, path).where("record_type = 'response'")
            .select(*columns(F.length("payload"), F.sha2("payload", 256))))
    bare = (read_records(spark, path, payload=False).where("record_type = 'revisit'")
            .select(*columns(F.col("headers")["Payload-Length"], F.substring_index("declared_digest", ":", -1))))
    return full.unionByName(bare)
