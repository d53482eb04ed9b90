"""WARC archives as a Spark data source.

``format("warc")`` writes one WARC/1.1 record per row and reads archives back.

Writing: a task writes files of bounded size under names of its own; the
commit writes a manifest that names the files of the committed tasks, so what
a lost or repeated task has left behind is never read.  A response record's
block is an HTTP response whose body is the gzip-encoded payload; the record
itself isn't compressed, so a reader can skip a block by its length.  A
revisit record (identical-payload-digest profile) has headers only.

Reading: one partition per file.  Equality filters on record_type, on the
payload digest and on the record's ids are pushed down and compared with the
parsed headers; the block of a record that is filtered out, or of any record
when payloads aren't asked for, is skipped without being read or decoded.
Decoded payloads are checked against the digest in the header.

Both sides use pyarrow's file systems, so a path may be any URI they know.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceArrowWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from dimweave.llm.common import shared_path, written

MANIFEST = "_manifest.json"
FILE_BYTES = 64 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
ENCODED_URI = "WARC-Target-URI-Percent-Encoded"  # our own
_LINE_BREAK = re.compile("[\r\n]")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(row, date: str) -> bytes:
    """A row's record.  A url that a header can't hold as it is (line breaks,
    white space at its ends) is percent-encoded under a name of its own."""
    payload = bytes(row["payload"] or b"")
    revisit = row["record_type"] == "revisit"
    body = b""
    if not revisit:
        packed = gzip.compress(payload, compresslevel=3, mtime=0)
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\nContent-Length: %d\r\n\r\n%s" % (len(packed), packed)
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _id(row["page_id"]),
        "WARC-Date": date,
        "WARC-Target-URI": row["url"],
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": _id(row["refers_to"]) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if row["url"] is not None and (row["url"] != row["url"].strip() or _LINE_BREAK.search(row["url"])):
        headers |= {"WARC-Target-URI": None, ENCODED_URI: quote(row["url"], safe="")}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return b"".join([VERSION, b"\r\n", head.encode(), b"\r\n", body, b"\r\n\r\n"])


def read_records(file, wanted=lambda headers: True, payloads: bool = True) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the wanted records of a seekable file; the
    payload is None where it isn't asked for or the record has none."""
    while line := file.readline():
        if line.strip() != VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        length = int(headers["content-length"])
        if not wanted(headers):
            file.seek(length + 4, io.SEEK_CUR)
            continue
        payload = None
        if payloads and length:
            head, _, body = file.read(length).partition(b"\r\n\r\n")
            payload = gzip.decompress(body) if b"content-encoding: gzip" in head.lower() else body
            if f"sha1:{payload_digest(payload)}" != headers["warc-payload-digest"]:
                raise ValueError(f"payload digest of {headers['warc-record-id']} differs")
            file.seek(4, io.SEEK_CUR)
        else:
            file.seek(length + 4, io.SEEK_CUR)
        yield headers, payload


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int, int]]  # name, bytes, records


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str):
        self.path, self.date = path, date

    def write(self, iterator) -> Written:
        system, where = fs.FileSystem.from_uri(self.path)
        system.create_dir(where, recursive=True)
        files, out, name, size, records = [], None, "", 0, 0
        for row in (row for batch in iterator for row in batch.to_pylist()):
            if out is None:
                name, size, records = f"part-{uuid.uuid4().hex}.warc", 0, 0
                out = system.open_output_stream(f"{where}/{name}", compression=None)
            raw = record(row, self.date)
            out.write(raw)
            size += len(raw)
            records += 1
            if size >= FILE_BYTES:
                out.close()
                files.append((name, size, records))
                out = None
        if out is not None:
            out.close()
            files.append((name, size, records))
        return Written(files)

    def commit(self, messages) -> None:
        system, where = fs.FileSystem.from_uri(self.path)
        system.create_dir(where, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{where}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        system, where = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for name, *_ in m.files if m is not None else []:
                system.delete_file(f"{where}/{name}")


class WarcFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


#: Columns whose equality filters are answered from the headers.
_FROM_HEADERS = {
    "record_type": lambda h: h["warc-type"],
    "page_id": lambda h: _page_of(h["warc-record-id"]),
    "refers_to": lambda h: _page_of(h.get("warc-refers-to")),
    "payload_digest": lambda h: h["warc-payload-digest"].removeprefix("sha1:"),
    "payload_bytes": lambda h: int(h["warc-payload-length"]),
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads = path, payloads
        self.accepted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and column in _FROM_HEADERS:
                self.accepted.append((column, frozenset([f.value])))
            elif isinstance(f, In) and column in _FROM_HEADERS:
                self.accepted.append((column, frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        system, where = fs.FileSystem.from_uri(self.path)
        with system.open_input_stream(f"{where}/{MANIFEST}") as f:
            files = json.loads(f.read())
        return [WarcFile(f"{self.path}/{name}") for name, *_ in files] or [WarcFile("")]

    def _wanted(self, headers: dict[str, str]) -> bool:
        return all(_FROM_HEADERS[c](headers) in values for c, values in self.accepted)

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        schema = pa.schema([(c, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in SCHEMA.split(", "))])
        system, where = fs.FileSystem.from_uri(partition.value)
        rows, size = [], 0
        with io.BufferedReader(system.open_input_file(where), 1 << 18) as file:
            for h, payload in read_records(file, self._wanted, self.payloads):
                uri = h.get("warc-target-uri")
                values = {c: get(h) for c, get in _FROM_HEADERS.items()}
                if ENCODED_URI.lower() in h:
                    uri = unquote(h[ENCODED_URI.lower()])
                rows.append(values | {"url": uri, "payload": payload})
                size += len(payload or b"")
                if len(rows) >= 5000 or size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcDataSource(DataSource):
    """Options: path; payloads (default true): decode response payloads; date:
    the records' WARC-Date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], self.options.get("date", "1970-01-01T00:00:00Z"))


def archive_rows(pages: DataFrame) -> DataFrame:
    """The records to write for pages (page_id, url, html): payload is the
    html in UTF-8 (null: empty); of pages with equal payloads the one with the
    largest page_id is the response and the others revisit it.

    Payloads are compared by SHA-1.  The response of every payload that occurs
    more than once is found by a pre-aggregated count and maximum; payloads
    that make up more than their share of a shuffle partition (at most as many
    as there are partitions, hence broadcast) are joined in place, the others
    by a shuffle join in which no key can be hot.  Pages without an id are
    responses only if no page with an id has the same payload; pages that share
    the largest id are all responses.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    groups = rows.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.filter("n > 1"), "payload-groups")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, rows.count() // parts)
    # at most 2 * parts groups can have more rows than that
    hot = F.broadcast(groups.filter(F.col("n") > share).select(F.col("sha").alias("hot_sha"), F.col("keeper").alias("hot_keeper"), F.lit(True).alias("is_hot")))
    rows = rows.join(hot, rows["sha"] == F.col("hot_sha"), "left")
    # the others by digest; those that have their response already, spread by id
    key = F.when(F.col("is_hot"), F.concat(F.lit(b"hot"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))).otherwise(F.col("sha"))
    rest = groups.filter(F.col("n") <= share).select(F.col("sha").alias("key"), "keeper")
    joined = rows.withColumn("key", key).join(rest, "key", "left").withColumn("keeper", F.coalesce("hot_keeper", "keeper"))
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
        "payload",
    )


def write_archives(pages: DataFrame, path: str | None = None) -> str:
    """Write pages as WARC files below ``path`` (default: a fresh folder below
    the shared checkpoint folder) and return it.  An empty table gives an
    archive without records."""
    spark = pages.sparkSession
    spark.dataSource.register(WarcDataSource)
    path = path or shared_path(spark, "warc")
    archive_rows(pages).write.format("warc").mode("append").save(path)
    return path


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of an archive: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (both of the full payload) and payload (null
    for revisits and where it isn't asked for)."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)
