"""WARC archives: records written from captures, read back, and assembled into one nested row per capture.

A capture is a request, a response (or a revisit of an earlier one with the same payload) and a metadata record. Each record has its own
WARC-Record-ID; the request and the metadata name the response's in WARC-Concurrent-To.

Each record is a gzip member of its own, as readers that seek expect it. Spark's text writer takes the members' bytes as they are; what it must
write between two rows is an empty gzip member, which every reader passes over.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .session import cut, key_of, shared_dir, small_batches
from .text import column_bytes, in_pieces

END = b"\r\n\r\n"
#: An empty gzip member.
BETWEEN = gzip.compress(b"", mtime=0)
WRITTEN = "WARC-Date: 2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, uri string, concurrent_to array<string>, refers_to string, payload_digest string, content_type string, head string, body binary"


def _id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5('|'.join(map(str, parts)).encode()).hexdigest())}>"


def _base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, fields: list[tuple[str, str | None]], content_type: str, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", WRITTEN, *[f"{k}: {v}" for k, v in fields if v is not None], f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _line(text: str | None) -> str | None:
    """A header value: without the characters that would end it."""
    return None if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def records(captures: DataFrame, per_file: int = 1 << 26) -> DataFrame:
    """Of captures (id long, no long, sha string, url string, body binary, first_id long, first_no long): the records, three for each, as record binary, a gzip member each.

    first_id and first_no name the capture that this one revisits, or are null. archive counts the archives of a task, from 0: a new one begins
    once the records of the last one have so many bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = filled = 0
        for batch in in_pieces(batches):
            ids, nos, shas, urls, bodies, first_ids, first_nos = (batch.column(k) for k in range(7))
            data, offsets = column_bytes(bodies)
            out: list[bytes] = []
            for k, (page, no, sha, url, first_id, first_no) in enumerate(zip(*(c.to_pylist() for c in (ids, nos, shas, urls, first_ids, first_nos)), strict=True)):
                payload = data[offsets[k] : offsets[k + 1]].tobytes()
                main, uri, digest = _id("response", page, no, sha), _line(url), f"sha1:{_base32_sha1(payload)}"
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
                common = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest)]
                if first_no is None:
                    out.append(_record("response", main, common, "application/http;msgtype=response", http + payload))
                else:
                    profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                    out.append(_record("revisit", main, [*common, profile, ("WARC-Refers-To", _id("response", first_id, first_no, sha))], "application/http;msgtype=response", http))
                out.append(_record("request", _id("request", page, no, sha), [("WARC-Target-URI", uri), ("WARC-Concurrent-To", main)], "application/http;msgtype=request", f"GET {uri or ''} HTTP/1.1\r\n\r\n".encode()))
                about = "" if page is None else f"pageId: {page}\r\n"
                out.append(_record("metadata", _id("metadata", page, no, sha), [("WARC-Target-URI", uri), ("WARC-Concurrent-To", main)], "application/warc-fields", about.encode()))
            members, archives = [gzip.compress(r, 6, mtime=0) for r in out], []
            for member in members:
                if filled >= per_file:
                    archive, filled = archive + 1, 0
                filled += len(member)
                archives.append(archive)
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(archives, pa.int32())], names=["record", "archive"])

    return captures.select("id", "no", "sha", "url", "body", "first_id", "first_no").mapInArrow(run, "record binary, archive int")


def captures(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Finds equal payloads: of those of at least so many bytes, all but the one with the smallest id revisit it.

    A null html is an empty payload. A null id comes after all others. Rows with the same id and payload are told apart by a number in the
    order of their urls, and the first of them counts as the smallest. Only (id, number, payload hash) are aggregated, not payloads, before
    the shuffle; the join back is one that Spark splits where a payload is very common.
    """
    body = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id).cast("long").alias("id"), key_of(id).alias("key"), F.col(url).alias("url"), body.alias("body"), F.sha2(body, 256).alias("sha"))
    rows = rows.withColumn("no", F.row_number().over(Window.partitionBy("key", "sha").orderBy("url")).cast("long"))
    narrow = pages.select(F.sha2(body, 256).alias("sha"), key_of(id).alias("key"), F.col(id).cast("long").alias("first_id"), F.octet_length(body).alias("n"))
    firsts = cut(narrow.where(F.col("n") >= least).groupBy("sha").agg(F.min("key").alias("first_key"), F.min("first_id").alias("first_id"), F.count("*").alias("c")).where("c > 1").drop("c"))
    met = rows.join(firsts, "sha", "left")
    again = F.col("first_key").isNotNull() & ((F.col("key") != F.col("first_key")) | (F.col("no") > 1))
    return met.select("id", "no", "sha", "url", "body", F.when(again, F.col("first_id")).alias("first_id"), F.when(again, F.lit(1).cast("long")).alias("first_no"))


def write(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, per_file: int = 1 << 26) -> None:
    """Writes the archives of all pages to a folder (archive=0, 1, ...), a gzip member for each record.

    A file is closed once it has so many bytes, so it has at most one record more, however pages of different sizes follow each other. An empty
    table gives a folder without archives.
    """
    small_batches(pages.sparkSession)
    raw = records(captures(pages, id, url, html, least), per_file)
    lines = raw.select(F.col("record").cast("string").alias("value"), "archive").write.partitionBy("archive")
    lines.option("encoding", "ISO-8859-1").option("lineSep", BETWEEN.decode("latin-1")).text(path)


def _parse(archive: BinaryIO) -> Iterator[tuple]:
    """The records of an archive, one after the other; what is held is one record."""
    while line := archive.readline():
        if not line.startswith(b"WARC/1."):
            continue
        fields: dict[str, list[str]] = {}
        while (line := archive.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda name, f=fields: f.get(name, [None])[0]
        block, content, inner = archive.read(int(one("content-length") or 0)), one("content-type") or "", ""
        if content.startswith("application/http"):
            top, _, block = block.partition(END)
            inner = top.decode("utf-8", "replace")
        yield one("warc-record-id"), one("warc-type"), one("warc-target-uri"), fields.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-payload-digest"), content, inner, block


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives of a folder and those within it, whatever their names; body is the payload (of an HTTP record, what follows its head, which is in head).

    Spark hands a task the compressed files one by one; they are inflated and handed on record by record, so no archive is ever in memory as a
    whole. Archives may be gzipped by record, gzipped as a whole, or plain. Fields are found by name in any case; a record is as long as its
    Content-Length says, so payloads may hold anything, line ends and WARC headers included.
    """
    small_batches(spark)
    names = [f.name for f in spark.createDataFrame([], RECORD).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
        packed = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in in_pieces(batches, 1):
            rows: list[tuple] = []
            size = 0
            content = io.BytesIO(batch.column(0)[0].as_py())
            gzipped = content.getbuffer()[:2] == b"\x1f\x8b"
            for row in _parse(io.BufferedReader(gzip.GzipFile(fileobj=content), 1 << 16) if gzipped else content):
                rows.append(row)
                size += len(row[-1])
                if len(rows) == 2000 or size > 1 << 23:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content").mapInArrow(run, RECORD)


def assemble(found: DataFrame, columns: tuple[str, ...] = ("type", "uri", "refers_to", "payload_digest", "head", "body")) -> DataFrame:
    """One row per capture: record_id and the columns of the response or revisit, request struct, metadata array.

    Requests and metadata are joined to the response that they name in WARC-Concurrent-To (of several, the first); a request or metadata
    record that names none that is there has no capture and is left out. A capture without a request has a null one, without metadata an
    empty array.
    """
    mains = found.where("type in ('response', 'revisit')").select("record_id", *columns)
    others = found.where("type not in ('response', 'revisit')").select(F.element_at("concurrent_to", 1).alias("record_id"), F.struct("type", F.col("record_id").alias("id"), "uri", "head", "body").alias("part"))
    parts = others.where("record_id is not null").groupBy("record_id").agg(F.collect_list("part").alias("parts"))
    met = mains.join(parts, "record_id", "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<struct<type:string,id:string,uri:string,head:string,body:binary>>")))
    of = lambda kind: F.filter("parts", lambda p: p["type"] == kind)
    return met.withColumns({"request": F.get(of("request"), 0), "metadata": of("metadata")}).drop("parts")


def resolved(found: DataFrame) -> DataFrame:
    """assemble()'s rows with page_id (from the metadata), and for revisits the payload's bytes and the page of the response they refer to."""
    fields = F.get(F.col("metadata"), 0)["body"].cast("string")
    sized = found.withColumn("own", F.octet_length("body").cast("long"))  # before the join, which then needs no payloads
    named = assemble(sized, ("type", "uri", "refers_to", "payload_digest", "own")).withColumn("page_id", F.regexp_extract(fields, r"(?m)^pageId: (-?\d+)", 1).try_cast("long"))
    slim = cut(named.select("record_id", "type", "uri", "refers_to", F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "page_id", "own", F.col("request").isNotNull().alias("has_request")))
    targets = slim.where("type = 'response'").join(slim.where("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct(), "record_id", "left_semi")
    targets = cut(targets.select(F.col("record_id").alias("_to"), F.col("page_id").alias("to_page"), F.col("own").alias("to_bytes")))
    return slim.join(targets, slim.refers_to == targets._to, "left").select("page_id", F.when(F.col("type") == "revisit", F.col("to_bytes")).otherwise(F.col("own")).alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"), F.col("to_page").alias("refers_to"), F.col("uri").alias("url"), "has_request")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"  # stays: it is what the operator makes
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return resolved(read(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB SQL for op7. SHA-1 in base32: eight groups of five hexadecimal digits, each of four characters.
OP7_SQL = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, h, sha1(h) as x, min(page_id) over (partition by h) as first_id from p)
select page_id, octet_length(encode(h)) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(x, 1 + 5 * (i // 4), 5) as integer) >> (15 - 5 * (i % 4))) & 31), 1)), '') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from q
"""
