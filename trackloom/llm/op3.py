"""op3: pages as ARC archives, converted to WARC with revisits, and read back."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import warc
from trackloom.llm.common import prepare, remove, shared_dir, table

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
PAGE, REFERS = "X-Page-Id", "WARC-Refers-To-Page"


def http_block(html: bytes, page_id: int | None) -> bytes:
    """An HTTP response that carries the page's id, as a crawler's own header."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE}: {'' if page_id is None else page_id}\r\nContent-Length: {len(html)}\r\n\r\n".encode() + html


def made_date(page_id: int | None) -> str:
    """A 14-digit date for a page, whose table has none: as many seconds into 2001 as its id says, within 20 years."""
    return (datetime(2001, 1, 1) + timedelta(seconds=(page_id or 0) % (20 * 365 * 86400))).strftime("%Y%m%d%H%M%S")


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC archives of (page_id, url, html): version 1 and 2 files by turns."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        version, written = 1, 0
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                page_id, url, html = page_id.as_py(), url.as_py(), html.as_py()
                if written % warc.FILE_RECORDS == 0:  # the writer begins a file here
                    version = 1 + (page_id or 0) % 2
                    yield (warc.arc_filedesc(version, "pages.arc"),)
                    written += 1
                written += 1
                block = http_block((html or "").encode("utf-8", "surrogatepass"), page_id)
                target = " ".join((url or "unknown:").split()) or "unknown:"
                yield (warc.arc_line(version, target, made_date(page_id), "text/html", len(block), "pages.arc").encode() + b"\n" + block,)

    schema = pa.schema([("record", pa.binary())])
    warc.write(pages.select("page_id", "url", "html").mapInArrow(lambda batches: warc.in_batches(records(batches), schema), "record binary"), path, "\n")


def converted(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """(page_id, bytes, digest, record_id, record): the WARC records of ARC archives, deflated; page_id from the HTTP headers.

    Unless `whole`, records are null: what finding repeated payloads needs is read without making them.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for file, pieces in warc.archives(batches):
            for old in warc.read_arc(pieces, file):
                new = warc.convert(old)
                headers, payload = old.http()
                page_id = headers.get(PAGE.lower())
                record = zlib.compress(warc.warc_bytes(new), 1) if whole else None  # it goes through a shuffle
                yield int(page_id) if page_id else None, len(payload), new.fields["WARC-Payload-Digest"].partition(":")[2], new.fields["WARC-Record-ID"], record

    schema = pa.schema([("page_id", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string()), ("record_id", pa.string()), ("record", pa.binary())])
    return warc.read(spark, path).mapInArrow(lambda batches: warc.in_batches(rows(batches), schema), "page_id bigint, bytes bigint, digest string, record_id string, record binary")


def with_revisits(records: DataFrame, digests: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """`records` with first_page and first_record, null for those that stay responses; `digests` are the same records without bytes.

    Records of payloads of `least` bytes or more that an earlier page has too become revisits of the first such page.

    The first page of each digest comes from a partial aggregate; only digests of several records are
    joined back, so the records of one hot digest are spread by Spark's skew join.
    """
    found = digests.where(F.col("bytes") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id")).alias("first"))
    several = found.where("n > 1").select(F.col("digest").alias("_digest"), F.col("first.page_id").alias("first_page"), F.col("first.record_id").alias("first_record"))
    return records.join(several, (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= least), "left").drop("_digest")


def write_warc(records: DataFrame, path: str) -> None:
    """WARC archives of with_revisits()."""

    def revised(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        for batch in batches:
            for page_id, first, first_id, data in zip(*(batch.column(c) for c in ("page_id", "first_page", "first_record", "record")), strict=True):
                page_id, first, first_id, data = page_id.as_py(), first.as_py(), first_id.as_py(), zlib.decompress(data.as_py())
                if first_id is not None and page_id != first:
                    record = warc.revisit(next(warc.read_warc(data)), first_id)
                    record.fields.pop("Content-Length")
                    data = warc.warc_bytes(warc.Record(record.fields | {REFERS: str(first)}, record.block))
                yield (data,)

    schema = pa.schema([("record", pa.binary())])
    warc.write(records.select("page_id", "first_page", "first_record", "record").mapInArrow(lambda batches: warc.in_batches(revised(batches), schema), "record binary"), path, "\r\n\r\n")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A row per WARC record: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, target_uri, warc_date, refers_to_record."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, pieces in warc.archives(batches):
            for r in warc.read_warc(pieces):
                headers, payload = r.http()
                page_id, refers, kind = headers.get(PAGE.lower()), r.fields.get(REFERS), r.fields["WARC-Type"]
                n = int(headers["content-length"]) if kind == "revisit" else len(payload)
                yield int(page_id) if page_id else None, n, r.fields["WARC-Payload-Digest"].partition(":")[2], kind, int(refers) if refers else None, r.fields["WARC-Record-ID"], r.fields["WARC-Target-URI"], r.fields["WARC-Date"], r.fields.get("WARC-Refers-To")

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("refers_to_record", pa.string())])
    return warc.read(spark, path).mapInArrow(lambda batches: warc.in_batches(rows(batches), schema), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, target_uri string, warc_date string, refers_to_record string")


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """`pages` written to `folder`/arc, converted to `folder`/warc, and read back; the ARC archives go once they are converted.

    A page is a revisit if it isn't the first of its payload, so repeated rows of the first page are
    responses too. A null page_id comes after all others. A file has at most FILE_RECORDS records, of any sizes.
    Every record has an identifier of its own, and the date made_date() gives its page.
    """
    spark = pages.sparkSession
    prepare(spark)
    write_arc(pages, f"{folder}/arc")
    write_warc(with_revisits(converted(spark, f"{folder}/arc"), converted(spark, f"{folder}/arc", whole=False)), f"{folder}/warc")
    remove(spark, f"{folder}/arc")
    return read_back(spark, f"{folder}/warc")


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_pages(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: What the archives must hold, without archives.
ORACLE = """
with p as (select page_id, coalesce(html, '') html from pages), d as (select page_id, strlen(html)::bigint payload_bytes, sha256(html) payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) first from d)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id > first then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 100 and page_id > first then first end refers_to from f
"""
