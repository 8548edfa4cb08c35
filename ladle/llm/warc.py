"""Web archives (WARC 1.1) as a data source: written record by record, read back header by header."""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith,
    WriterCommitMessage,
)

from ladle.session import ensure_checkpoint_dir, scratch

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, refers_to string, "
    "content_length long, http_length long, payload binary"
)
# Fixed values of the format: column -> header.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
BATCH_BYTES = 8 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI (local, HDFS, object stores) and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def _clean(value: str) -> str:
    """A header value is one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row, payload: bytes) -> bytes:
    """A record: version, headers, a blank line, the block, two line ends. A revisit's block ends after the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['http_length']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = ["WARC/1.1"]
    head += [f"{name}: {_clean(row[column])}" for column, name in HEADERS.items() if row[column] is not None]
    head += [f"WARC-Profile: {SAME_PAYLOAD}"] * revisit
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Writer(DataSourceWriter):
    """Files go to a folder of the job first; only those of tasks that were committed move beside the others."""

    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex[:12]
        self.file_bytes = int(options.get("file_mb", "64")) << 20
        self.zipped = options.get("compression", "gzip") == "gzip"

    def write(self, rows: Iterator) -> Written:
        store, root = filesystem(self.path)
        folder = f"{root}/_tmp-{self.job}"
        store.create_dir(folder, recursive=True)
        paths, out = [], None
        for row in rows:
            if out is None or out.tell() >= self.file_bytes:
                if out is not None:
                    out.close()
                paths.append(f"{folder}/part-{uuid.uuid4().hex}.warc" + ".gz" * self.zipped)
                out = store.open_output_stream(paths[-1], compression=None)
            data = record_bytes(row, bytes(row["payload"] or b""))
            if self.zipped:  # a member for each record, as archives have it
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = member.compress(data) + member.flush()
            out.write(data)
        if out is not None:
            out.close()
        return Written(paths)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        if self.overwrite:
            for info in store.get_file_info(pafs.FileSelector(root)):
                if info.is_file:
                    store.delete_file(info.path)
        for message in messages:
            for path in message.paths if message else []:
                store.move(path, f"{root}/{path.rpartition('/')[2]}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        folder = f"{root}/_tmp-{self.job}"
        if store.get_file_info(folder).type != pafs.FileType.NotFound:
            store.delete_dir(folder)


def _headers(stream) -> dict[str, str]:
    found: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def records(stream, wanted, payloads: bool) -> Iterator[tuple]:
    """The records of a stream that ``wanted`` (of the header columns) keeps. What isn't wanted is skipped over unread: a
    seek in a plain file, an inflated but never copied or parsed stretch in a zipped one."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        head = _headers(stream)
        length = int(head.get("content-length", 0))
        columns = {column: head.get(name.lower()) for column, name in HEADERS.items()}
        if not wanted(columns):
            stream.seek(length, io.SEEK_CUR)
            continue
        http_length, payload, left = None, None, length
        if head.get("content-type", "").startswith("application/http"):
            status = stream.readline()
            start = stream.tell()
            http = _headers(stream)
            left -= len(status) + stream.tell() - start
            http_length = int(http["content-length"]) if "content-length" in http else None
        if payloads and columns["record_type"] != "revisit":
            payload = stream.read(left)
            if len(payload) < left:
                raise ValueError(f"record {columns['record_id']} is cut short")
        else:
            stream.seek(left, io.SEEK_CUR)
        yield (*columns.values(), length, http_length, payload)


class Reader(DataSourceReader):
    """A partition is a set of whole files of about ``partition_mb``. Filters on header columns (=, IN, starts with) are
    taken over and tested before a block is touched. ``payload=false`` leaves every payload undecoded."""

    def __init__(self, path: str, options: dict):
        self.path = path
        self.payloads = options.get("payload", "true") != "false"
        self.bytes = int(options.get("partition_mb", "64")) << 20
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append(("in", column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append(("in", column, tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append(("starts", column, f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = filesystem(self.path)
        infos = [store.get_file_info(root)]
        if infos[0].type == pafs.FileType.Directory:
            infos = store.get_file_info(pafs.FileSelector(root))
        files = sorted((i.size, i.path) for i in infos if i.is_file and i.path.endswith((".warc", ".warc.gz")))
        groups: list[list[str]] = []
        room = 0
        for size, path in reversed(files):
            if size > room:
                groups.append([])
                room = self.bytes
            groups[-1].append(path)
            room -= size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        schema = pa.schema(
            [(c, pa.string()) for c in HEADERS]
            + [("content_length", pa.int64()), ("http_length", pa.int64()), ("payload", pa.binary())]
        )
        tests = self.tests

        def wanted(columns: dict) -> bool:
            for kind, column, value in tests:
                got = columns[column]
                if got is None or not (got in value if kind == "in" else got.startswith(value)):
                    return False
            return True

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
                for row in records(stream, wanted, self.payloads):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``, both with SCHEMA's columns."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """A record per page. Of pages with equal payloads of ``least_bytes`` or more, that with the largest page_id is the
    response and others revisit it; rows that share the largest page_id are all responses. Null html is an empty payload; a
    null page_id is below every other."""
    ensure_checkpoint_dir(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", F.col("url").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("http_length"),
    )
    repeated = (
        rows.filter(F.col("http_length") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first_page"))
        .filter("n > 1")
        .select(F.col("digest").alias("its_digest"), "first_page")
        .checkpoint()  # a table of its own, so that a digest with very many pages can be split in the join
    )
    joined = rows.join(repeated, (F.col("digest") == F.col("its_digest")) & (F.col("http_length") >= least_bytes), "left")
    revisit = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit("sha1:"), F.col("digest")).alias("payload_digest"),
        F.when(revisit, urn(F.col("first_page"))).alias("refers_to"),
        F.lit(0).cast("long").alias("content_length"),
        "http_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(rows: DataFrame, folder: str, **options: str) -> None:
    """Write records (columns of SCHEMA) as archives into a folder. ``content_length`` is filled in by the writer."""
    register(rows.sparkSession)
    rows.write.format("warc").options(**options).mode("append").save(folder)


def read_archive(spark: SparkSession, folder: str, record_type: str | None = None, **options: str) -> DataFrame:
    """The records of an archive, or those of a type: the source tests it on the headers and skips other blocks. Every scan carries a filter, which all records pass (a record has a type): a scan without
    any would be planned with the filters of the scan before it."""
    register(spark)
    wanted = F.col("record_type").isNotNull() if record_type is None else F.col("record_type") == record_type
    return spark.read.format("warc").options(**options).load(folder).filter(wanted)


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, read them back in two scans, each with its record type as a pushed filter: payload sizes and digests
    of responses from the payload that was read, those of revisits from their headers, with no payload decoded."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    write_archive(page_records(pages), folder)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) AS bigint)")
    whole, headers = read_archive(spark, folder, "response"), read_archive(spark, folder, "revisit", payload="false")
    return whole.unionByName(headers).select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("http_length")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
