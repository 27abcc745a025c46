"""Legacy ARC archives to WARC.

An ARC file starts with a version block that declares version 1 or 2 and so the fields of the header lines: five in version 1, ten in
version 2, always from the URL to the length. Records are cut by their declared lengths, never by content. The converter synthesises what
WARC has and ARC lacks: record identifiers (from the archive's path and the record's place in it), ISO timestamps, record types, and
block and payload digests. Records with equal payloads become one response and revisits of it.

Archives are written with Spark's text writer, whose line separator is the end mark of a record, gzip-compressed, so that they can be
in any store Spark can reach. They are read as text with a separator that cuts them into small pieces; a task puts the pieces
together again by the declared lengths and holds one record at a time. Gzip files are never split, so a file's pieces stay in order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored
from tidemark.session import scratch_path

BREAK = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields by ARC version, as its version block declares them. Fixed values.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_RECORD = (
    "record_id string, target_uri string, date string, type string, content_type string, page_id long, "
    "payload_bytes long, payload_digest string, block binary, head_bytes int"
)
_READ = (
    "record_id string, target_uri string, date string, record_type string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to long, refers_to_record string, intact boolean"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(archive: str, place: int) -> str:
    """A version 5 style UUID of the archive's path and the record's place in it."""
    h = bytearray(hashlib.sha1(f"{archive}#{place}".encode()).digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x50, h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


class Pieces:
    """A byte stream put together from the pieces of one file."""

    def __init__(self) -> None:
        self.data, self.at, self.fed = bytearray(), 0, False

    def feed(self, piece: bytes) -> None:
        if self.at:
            del self.data[: self.at]
            self.at = 0
        if self.fed:  # whether the separator stands behind the last piece is not known, so it goes before the next
            self.data += BREAK
        self.data += piece
        self.fed = True

    def line_end(self, mark: bytes) -> int:
        return self.data.find(mark, self.at)

    def skip(self, blanks: bytes) -> None:
        while self.at < len(self.data) and self.data[self.at] in blanks:
            self.at += 1

    def take(self, end: int) -> bytes:
        out = bytes(self.data[self.at : end])
        self.at = end
        return out


class CutShort(ValueError):
    """A file that ends inside a record."""


def _finish(pieces: Pieces, header: dict | None) -> None:
    pieces.skip(b"\r\n")
    left = len(pieces.data) - pieces.at
    if header is not None or left:
        raise CutShort(f"the last record is cut short, {left} bytes of it are there, its header says {header}")


def _http_header(block: bytes, name: bytes) -> bytes | None:
    for line in block.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip()
    return None


def _number(value: bytes | None) -> int | None:
    return int(value) if value and value.lstrip(b"-").isdigit() else None


class ArcParser:
    """Records (header fields, content) of one ARC file, version block included."""

    def __init__(self) -> None:
        self.pieces, self.version, self.header = Pieces(), None, None

    def feed(self, piece: bytes) -> Iterator[tuple[dict, bytes]]:
        self.pieces.feed(piece)
        while True:
            if self.header is None:
                self.pieces.skip(b"\r\n")
                end = self.pieces.line_end(b"\n")
                if end < 0:
                    return
                self.header = self._header(self.pieces.take(end).decode("utf-8", "replace"))
                self.pieces.at += 1
            end = self.pieces.at + self.header["Archive-length"]
            if end > len(self.pieces.data):
                return
            content = self.pieces.take(end)
            if self.header["URL"].startswith("filedesc:"):
                self.version = int(content.split(None, 1)[0])
            header, self.header = self.header, None
            yield header, content

    def finish(self) -> None:
        """Raise when the file ended inside a record."""
        _finish(self.pieces, self.header)

    def _header(self, line: str) -> dict:
        names = ARC_FIELDS[self.version or 1].split()
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no header line of ARC version {self.version}: {line[:200]!r}")
        return dict(zip(names, values)) | {"Archive-length": int(values[-1])}


class WarcParser:
    """Records (header fields, block) of one WARC file."""

    def __init__(self) -> None:
        self.pieces, self.header = Pieces(), None

    def feed(self, piece: bytes) -> Iterator[tuple[dict, bytes]]:
        self.pieces.feed(piece)
        while True:
            if self.header is None:
                self.pieces.skip(b"\r\n")
                end = self.pieces.line_end(BREAK)
                if end < 0:
                    return
                lines = self.pieces.take(end).decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record: {lines[0][:200]!r}")
                self.header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.pieces.at += len(BREAK)
            end = self.pieces.at + int(self.header["content-length"])
            if end > len(self.pieces.data):
                return
            block = self.pieces.take(end)
            header, self.header = self.header, None
            yield header, block

    def finish(self) -> None:
        """Raise when the file ended inside a record."""
        _finish(self.pieces, self.header)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    pieces = spark.read.option("lineSep", BREAK.decode()).text(path)
    return pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


def _records(batches: Iterator[pa.RecordBatch], parser: type) -> Iterator[tuple[str, dict, bytes]]:
    """(file, header, content) of every record; files are told apart by their whole path."""
    file, parse = None, None

    def end() -> None:
        try:
            if parse is not None:
                parse.finish()
        except CutShort as cut:
            raise CutShort(f"{file}: {cut}") from None

    for batch in batches:
        for name, piece in zip(batch.column("file"), batch.column("value")):
            if name.as_py() != file:
                end()
                file, parse = name.as_py(), parser()
            for header, content in parse.feed(piece.as_py()):
                yield file, header, content
    end()


def _batched(rows: Iterator[tuple], schema: pa.Schema, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(","))])


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "20000101000000") -> None:
    """Write pages as ARC archives: tasks with an even number in version 1, the others in version 2.

    A page becomes an HTTP response whose header carries the page id. Null html is an empty payload, a null url a dash; blanks in a url are escaped.
    """
    ship(pages.sparkSession)

    def record(version: int, uri: str, page: int | None, payload: bytes) -> bytes:
        head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
        head += [] if page is None else [f"X-Page-Id: {page}"]
        block = "\r\n".join(head).encode() + BREAK + payload
        middle = " 200 - - 0 -" if version == 2 else ""
        return f"{uri} 0.0.0.0 {date} text/html{middle} {len(block)}\n".encode() + block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        version = 1 + task % 2
        about = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n"
        # The version block's own header line has the five fields of version 1.
        yield pa.RecordBatch.from_arrays([pa.array([f"filedesc://{task}.arc 0.0.0.0 {date} text/plain {len(about)}\n{about}".encode()])], ["value"])
        for batch in batches:
            out = []
            for page, uri, text in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html")):
                uri = "".join(f"%{ord(c):02X}" if c in " \t\r\n\v\f" else c for c in uri) if uri else "-"
                out.append(record(version, uri, page, (text.as_py() or "").encode()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(run, "value binary")
    _write(rows, path, "\n")


def _write(rows: DataFrame, path: str, separator: str) -> None:
    text = rows.select(F.col("value").cast("string"))
    text.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def convert_arc(spark: SparkSession, path: str | list[str], payloads: bool = True) -> DataFrame:
    """The records of ARC archives with what WARC needs. Without ``payloads`` blocks are left out.

    Version blocks become ``warcinfo``, HTTP documents ``response``, others ``resource``. Identifiers come from the whole path of an
    archive, so archives of one name in several folders do not clash. An archive that ends inside a record is an error that names it.
    """
    ship(spark)
    schema = _arrow(_RECORD)

    def rows(batches):
        file, place = None, 0
        for name, header, content in _records(batches, ArcParser):
            place = place + 1 if name == file else 0
            file = name
            uri, day = header["URL"], header["Archive-date"]
            date = f"{day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z"
            split = content.find(BREAK) + len(BREAK) if content.startswith(b"HTTP/") else 0
            kind = "warcinfo" if uri.startswith("filedesc:") else "response" if split >= len(BREAK) else "resource"
            payload = content[split:]
            mime = "application/http;msgtype=response" if kind == "response" else header["Content-type"]
            page = _number(_http_header(content[:split], b"x-page-id")) if split else None
            yield (
                record_urn(name, place), uri, date, kind, mime, page, len(payload), sha1_base32(payload),
                content if payloads else None, split,
            )

    return _lines(spark, path).mapInArrow(lambda batches: _batched(rows(batches), schema), _RECORD)


def revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(record_id, first): for every response whose payload an earlier page has, that first response.

    Of equal payloads of at least ``least_bytes`` bytes the smallest page id is first, null ids last.
    """
    same = records.filter((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
    order = F.struct(F.isnull("page_id").alias("no_id"), "page_id", "record_id", "target_uri", "date")
    first = same.groupBy("payload_digest", "payload_bytes").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return same.join(first, ["payload_digest", "payload_bytes"]).filter(F.col("record_id") != F.col("first.record_id")).select("record_id", "first")


def write_warc(records: DataFrame, first: DataFrame, path: str) -> None:
    """Write records as WARC 1.1; those in ``first`` become revisits with the HTTP header alone as their block."""
    marked = records.join(first.select(F.col("record_id").alias("again_id"), F.col("first")), F.col("record_id") == F.col("again_id"), "left").select(
        "record_id", "target_uri", "date", "type", "content_type", "payload_digest", "block", "head_bytes",
        F.col("first.record_id").alias("first_id"), F.col("first.page_id").alias("first_page"),
        F.col("first.target_uri").alias("first_uri"), F.col("first.date").alias("first_date"),
    )

    def record(urn, uri, date, kind, mime, payload_digest, block, head, first_id, first_page, first_uri, first_date) -> bytes:
        lines = ["WARC/1.1", f"WARC-Type: {kind if first_id is None else 'revisit'}", f"WARC-Record-ID: {urn}", f"WARC-Date: {date}"]
        if kind == "warcinfo":
            block, mime = b"software: tidemark\r\nformat: WARC File Format 1.1\r\nisPartOf: " + uri.encode() + b"\r\n", "application/warc-fields"
        else:
            lines.append(f"WARC-Target-URI: {uri}")
            lines.append(f"WARC-Payload-Digest: sha1:{payload_digest}")
        if first_id is not None:
            block = block[:head]
            lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {first_id}", f"WARC-Refers-To-Target-URI: {first_uri}", f"WARC-Refers-To-Date: {first_date}"]
            lines += [] if first_page is None else [f"X-Refers-To-Page-Id: {first_page}"]
        lines += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
        return "\r\n".join(lines).encode() + BREAK + block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((record(*(x.as_py() for x in row)),) for batch in batches for row in zip(*batch.columns))
        yield from _batched(rows, pa.schema([("value", pa.binary())]))

    _write(marked.mapInArrow(run, "value binary"), path, BREAK.decode())


def read_warc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The response, resource and revisit records of WARC archives; ``intact`` says that all digests fit the bytes read.

    A revisit's payload size and digest are those of the payload that it stands for. An archive that ends inside a record is an error.
    """
    ship(spark)
    schema = _arrow(_READ)

    def rows(batches):
        for _, header, block in _records(batches, WarcParser):
            kind = header["warc-type"]
            if kind == "warcinfo":
                continue
            split = block.find(BREAK) + len(BREAK) if block.startswith(b"HTTP/") else 0
            head, digest = block[:split], header["warc-payload-digest"].removeprefix("sha1:")
            intact = header["warc-block-digest"] == f"sha1:{sha1_base32(block)}" and (kind == "revisit" or digest == sha1_base32(block[split:]))
            yield (
                header["warc-record-id"], header["warc-target-uri"], header["warc-date"], kind, _number(_http_header(head, b"x-page-id")),
                _number(_http_header(head, b"content-length")) if kind == "revisit" else len(block) - split, digest,
                _number(header.get("x-refers-to-page-id", "").encode()), header.get("warc-refers-to"), intact,
            )

    return _lines(spark, path).mapInArrow(lambda batches: _batched(rows(batches), schema), _READ)


def archive_pages(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages to ARC archives, those to WARC archives, and the records read back from these; see ``read_warc``.

    One record per page. Null html counts as empty; null ids and urls, repeated rows and an empty table are kept as they are.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, page_id, url, html)
    narrow = stored(convert_arc(spark, arc, payloads=False).drop("block", "content_type", "head_bytes"), "arc-records")
    write_warc(convert_arc(spark, arc), stored(revisits(narrow, least_bytes), "revisits"), warc)
    return read_warc(spark, warc)
