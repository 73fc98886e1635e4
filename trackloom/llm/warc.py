"""ARC archives read, converted to WARC, written and read back.

An ARC record is a header line, then as many bytes as the line declares, then a line end. Version 1 lines
hold url, address, date, type and length; version 2 lines hold url, address, date, type, result code,
checksum, location, offset, file name and length. The first record of a file, `filedesc://`, states the
version. Some writers left out fields or put spaces into urls, so a line is read from its end: the fixed
fields are the last ones, and what is before them is the url.

The converter synthesises what ARC lacks: record identifiers (a name-based UUID of file, offset, url, date and
payload digest, so that no two records share one and a second conversion makes the same), W3C timestamps from
14-digit dates, the record type, and SHA-256 digests of block and payload.

Archives are files of whole records. They are written with Spark's text writer, a row per record with the
record's own end as line separator, so any file system that Spark writes to will do, and a lost task is
written again. They are read with Spark's text reader, in pieces between blank lines, and parsed as they come,
so a task holds a record and a batch of pieces, whatever the size of the file.

Nulls: a null payload is empty, a null url is `unknown:`. Payloads may hold any bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_RECORDS = 4096
#: Fields of a header line after the url, by version.
ARC_FIELDS = {1: ("address", "date", "type", "length"), 2: ("address", "date", "type", "code", "checksum", "location", "offset", "filename", "length")}
EPOCH = "19700101000000"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:trackloom:warc")
END = b"\r\n\r\n"
#: Bytes of records that a task hands on at once, about.
BATCH_BYTES = 4 << 20


class Pieces:
    """An archive's bytes, from pieces that END parted; `at` is the offset read so far. The last piece may have `lost` an END."""

    def __init__(self, pieces: Iterable[bytes], lost: bool = True):
        self.pieces, self.lost, self.held, self.from_, self.at, self.first = iter(pieces), lost, b"", 0, 0, True

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held = self.held[self.from_ :] + (b"" if self.first else END) + piece
        self.from_, self.first = 0, False
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before the next `mark`, which is passed; None if there is none."""
        seen = self.from_
        while (end := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - self.from_ - len(mark))
            if not self.more():
                return None
        out = self.held[self.from_ : end]
        self.at, self.from_ = self.at + end - self.from_ + len(mark), end + len(mark)
        return out

    def exactly(self, n: int) -> bytes:
        """The next `n` bytes; ValueError if there are fewer."""
        parts, have = [self.held[self.from_ :]], len(self.held) - self.from_
        while have < n and (piece := next(self.pieces, None)) is not None:
            parts += [piece] if self.first else [END, piece]
            have, self.first = have + len(piece) + len(END) * (not self.first), False
        if self.lost and have + len(END) == n:
            parts.append(END)  # the reader took the file's last one for a separator
        self.held, self.from_ = b"".join(parts), 0
        if len(self.held) < n:
            raise ValueError(f"{n} bytes are declared at byte {self.at}; {have} are left")
        out = self.held[:n]
        self.from_, self.at = n, self.at + n
        return out

    def skip(self, blank: bytes) -> bool:
        """Passes bytes of `blank`; False at the end."""
        while True:
            while self.from_ < len(self.held) and self.held[self.from_] in blank:
                self.from_, self.at = self.from_ + 1, self.at + 1
            if self.from_ < len(self.held):
                return True
            if not self.more():
                return False


def pieces_of(data: bytes | Iterable[bytes]) -> Pieces:
    return Pieces([data], lost=False) if isinstance(data, bytes) else Pieces(data)


@dataclass
class Record:
    """A record of either format: header fields, and the block that follows them."""

    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    place: str = ""

    def http(self) -> tuple[dict[str, str], bytes]:
        """The headers of an HTTP response in the block, lower-case names, and its payload; none: the block."""
        if not self.block.startswith(b"HTTP/"):
            return {}, self.block
        head, _, payload = self.block.partition(b"\r\n\r\n")
        lines = head.decode("latin-1").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def arc_line(version: int, url: str, date: str, mime: str, length: int, filename: str = "-", address: str = "0.0.0.0", code: str = "200") -> str:
    """A header line of an ARC record."""
    values = {"address": address, "date": date, "type": mime, "code": code, "checksum": "-", "location": "-", "offset": "0", "filename": filename, "length": str(length)}
    return " ".join([url, *(values[f] for f in ARC_FIELDS[version])])


def arc_filedesc(version: int, filename: str) -> bytes:
    """The first record of an ARC file, without its end."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    body = f"{version} 0 trackloom\n{names}\n".encode()
    return arc_line(version, f"filedesc://{filename}", EPOCH, "text/plain", len(body), filename).encode() + b"\n" + body


def read_arc(data: bytes | Iterable[bytes], file: str = "") -> Iterator[Record]:
    """The records of an ARC file, but its `filedesc://`. A declared length beyond the file's end raises ValueError."""
    source, version = pieces_of(data), 1
    while source.skip(b"\r\n"):
        at = source.at
        line = source.until(b"\n")
        words = (line or b"").decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        if words[0].startswith("filedesc://"):
            block = source.exactly(int(words[-1])) if words[-1].isdigit() else b""
            version = 2 if block.startswith(b"2") else 1
            continue
        names = ARC_FIELDS[version]
        if line is None or len(words) <= len(names) or not words[-1].isdigit():
            raise ValueError(f"not an ARC header line at byte {at}")
        fields = dict(zip(names, words[-len(names) :], strict=True)) | {"url": " ".join(words[: -len(names)]), "version": str(version)}
        yield Record(fields, source.exactly(int(fields["length"])), f"{file}:{at}")


def w3c_date(arc_date: str) -> str:
    """`yyyymmddhhmmss`, or a longer or shorter run of its digits, as a WARC timestamp; others: the epoch."""
    digits = (arc_date if arc_date.isdigit() and len(arc_date) >= 4 else EPOCH)[:14]
    digits = digits + EPOCH.replace("1970", "0000")[len(digits) :] if len(digits) < 14 else digits
    try:
        return datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(place: str, url: str, date: str, payload_digest: str) -> str:
    """The identifier of the record at a place, `file:offset`."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{place} {url} {date} {payload_digest}')}>"


def convert(record: Record) -> Record:
    """The WARC record of an ARC record: a response if its block is one of HTTP, else a resource."""
    headers, payload = record.http()
    digest = hashlib.sha256(payload).hexdigest()
    date = w3c_date(record.fields["date"])
    url = record.fields["url"]
    kind = "response" if headers or record.block.startswith(b"HTTP/") else "resource"
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(record.place, url, date, digest),
        "WARC-Date": date,
        "WARC-Target-URI": url,
        "WARC-IP-Address": record.fields["address"],
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(record.block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response" if kind == "response" else record.fields["type"],
    }
    return Record({k: v for k, v in fields.items() if v not in ("-", "0.0.0.0")}, record.block)


def revisit(record: Record, refers_to: str, refers_to_uri: str | None = None) -> Record:
    """A revisit in a response's stead: the HTTP headers stay, the payload goes."""
    head = record.block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n" if record.block.startswith(b"HTTP/") else b""
    own = {"WARC-Record-ID": record_id(record.fields["WARC-Record-ID"], "revisit", refers_to, "")}
    fields = record.fields | own | {"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": refers_to, "WARC-Block-Digest": f"sha256:{hashlib.sha256(head).hexdigest()}"}
    return Record(fields | ({"WARC-Refers-To-Target-URI": refers_to_uri} if refers_to_uri else {}), head)


def warc_bytes(record: Record) -> bytes:
    """A WARC record without its end, which the writer adds."""
    lines = [f"{k}: {' '.join(v.splitlines())}" for k, v in record.fields.items()]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(record.block)}", "", ""]).encode("utf-8", "surrogateescape") + record.block


def read_warc(data: bytes | Iterable[bytes]) -> Iterator[Record]:
    """The records of a WARC file, by their declared lengths."""
    source = pieces_of(data)
    while source.skip(b"\r\n"):
        at = source.at
        head = source.until(END)
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record at byte {at}")
        fields = {k: v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "surrogateescape").split("\r\n")[1:])}
        yield Record(fields, source.exactly(int(fields["Content-Length"])))


def write(records: DataFrame, path: str, separator: str) -> None:
    """Archives from the binary column `record`, as gzip files; each record is followed by `separator`."""
    records.select(F.col("record").cast("string").alias("value")).write.mode("overwrite").option("lineSep", separator).option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, piece): the pieces of each archive between ENDs, in order. A file is gzip as written, so that one task reads it."""
    rows = spark.read.option("lineSep", END.decode()).option("pathGlobFilter", "*.gz").text(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("piece"))


def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(file, pieces) of each archive in a partition of read(); each must be read before the next."""
    rows = ((file, piece.as_py()) for batch in batches for file, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
    for file, found in groupby(rows, lambda r: r[0]):
        yield file, (piece for _, piece in found)


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of any sizes as batches of about BATCH_BYTES."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += 64 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if held > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
