"""Legacy archives: ARC files (versions 1 and 2) converted to WARC files, repeated payloads as revisits.

A reader takes an ARC file record by record: the version block says which fields a header line has, the
line's declared length says where the record ends. A record becomes a WARC record with an identifier
made of its archive and place, its date in ISO form, its type (``response`` for HTTP responses, else
``resource``), and SHA-1 digests of block and payload. Of records with equal payloads the one with the
largest key stays whole; the others become ``revisit`` records that name it.

Which record stays is settled on small rows (file, place, key, digest); payloads are read from the archive
where they are needed and never shuffled. Archives lie in the shared folder under names of their own, and
count only when their task's row is committed, so a repeated task leaves no double.

In ``archive_round_trip`` a null html is an empty payload, a null url is written as ``-``, a null page id
is smaller than all others and stays null, repeated rows are records of their own, other columns are
ignored, and an empty table gives no rows."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.cluster import cut_lineage, shared_folder
from pagesmith.llm.common import Rows, clean, dealt_by_file, rows_of, utf8

#: The fields of a record's header line, by ARC version.
FIELDS = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
NO_KEY = -(2**63)
KEY_HEADER = b"X-Page-Id"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Members:
    """The gzip members of a file as separate byte strings, read piece by piece from any member's start."""

    def __init__(self, source, piece: int = 1 << 18):
        self.source, self.piece = source, piece
        self.at, self.held = 0, b""

    def seek(self, at: int) -> None:
        if at != self.at:
            self.source.seek(at)
            self.at, self.held = at, b""

    def read(self) -> tuple[int, bytes] | None:
        """(place, content) of the next member."""
        start, unpack, out, used = self.at, zlib.decompressobj(31), [], 0
        while not unpack.eof:
            data = self.held or self.source.read(self.piece)
            if not data:
                if used:
                    raise ValueError(f"archive ends inside the member at {start}")
                return None
            out.append(unpack.decompress(data))
            self.held = unpack.unused_data
            used += len(data) - len(self.held)
        self.at = start + used
        return start, b"".join(out)


def gzip_member(data: bytes, level: int = 2) -> bytes:
    pack = zlib.compressobj(level, wbits=31)
    return pack.compress(data) + pack.flush()


class ArcRecord(NamedTuple):
    url: bytes
    ip: bytes
    date: bytes
    mime: bytes
    status: bytes
    block: bytes


def arc_version_block(name: str, version: bytes, date: bytes) -> bytes:
    body = version + b" 0 pagesmith\n" + FIELDS[version] + b"\n"
    rest = b"" if version == b"1" else b" 200 - - 0 " + name.encode()
    return b"filedesc://" + name.encode() + b" 0.0.0.0 " + date + b" text/plain" + rest + b" %d\n" % len(body) + body + b"\n"


def arc_record(record: ArcRecord, version: bytes, name: str, offset: int) -> bytes:
    url = record.url.translate(None, b"\r\n").replace(b" ", b"%20").replace(b"\t", b"%09") or b"-"
    fields = [url, record.ip, record.date, record.mime]
    if version == b"2":
        digest = hashlib.md5(record.block).hexdigest().encode()
        fields += [record.status, digest, b"-", b"%d" % offset, name.encode()]
    return b" ".join([*fields, b"%d" % len(record.block)]) + b"\n" + record.block + b"\n"


def arc_fields(version_block: bytes) -> list[bytes]:
    """The field names that an archive's version block declares for its record lines."""
    lines = version_block.split(b"\n")
    if not lines[0].startswith(b"filedesc://") or len(lines) < 3:
        raise ValueError("an ARC file begins with a filedesc:// record")
    version = lines[1].split(b" ")[0]
    if version not in FIELDS:
        raise ValueError(f"unknown ARC version {version!r}")
    return FIELDS[version].split(b" ")


def parse_arc_record(data: bytes, fields: list[bytes]) -> ArcRecord:
    """A record by its header line; fields are counted from the right, as old urls may hold blanks."""
    line, _, rest = data.partition(b"\n")
    values = dict(zip(fields, line.rstrip(b"\r").rsplit(b" ", len(fields) - 1), strict=True))
    length = int(values[b"Archive-length"])
    if length < 0 or length > len(rest):
        raise ValueError(f"declared length {length}, but {len(rest)} bytes follow")
    return ArcRecord(values[b"URL"], values[b"IP-address"], values[b"Archive-date"], values[b"Content-type"],
                     values.get(b"Result-code", b"-"), rest[:length])


def iso_date(date: bytes) -> str:
    """ARC dates have 8 to 14 digits; what is missing is the start of the period."""
    digits = date.decode("ascii", "replace")
    if not digits.isdigit() or len(digits) < 8:
        return "1970-01-01T00:00:00Z"
    full = digits[:14] + "00000000000000"[len(digits[:14]) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Header (with its blank line) and payload of an HTTP response; other blocks are all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    at = block.find(b"\r\n\r\n")
    return (block[: at + 4], block[at + 4 :]) if at >= 0 else (block, b"")


def header_value(header: bytes, name: bytes) -> bytes | None:
    for line in header.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{archive}#{offset}')}>"


def to_warc(record: ArcRecord, own_id: str, refers_to: str | None = None) -> bytes:
    """The WARC record that says what the ARC record said; a revisit if ``refers_to`` names another."""
    header, payload = http_parts(record.block)
    kind = "revisit" if refers_to else "response" if header else "resource"
    block = header if refers_to else record.block
    mime = "application/http;msgtype=response" if header else record.mime.decode("ascii", "replace")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own_id}", f"WARC-Date: {iso_date(record.date)}",
        f"WARC-Target-URI: {record.url.decode('utf-8', 'replace')}", f"WARC-IP-Address: {record.ip.decode('ascii', 'replace')}",
        f"Content-Type: {mime}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}"]
    if refers_to:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {refers_to}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a WARC record; digests and lengths are held against the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n" or f"sha1:{sha1_base32(block)}" != fields["warc-block-digest"]:
        raise ValueError(f"broken record {fields['warc-record-id']}")
    return fields, block


class Files:
    """Writes the files of a task, one after the other, and remembers a row for each."""

    def __init__(self, folder: str, ending: str, most: int = FILE_BYTES):
        self.place, self.base = fs.FileSystem.from_uri(folder)
        self.ending, self.most, self.attempt = ending, most, uuid.uuid4().hex
        self.part, self.number, self.sink, self.at, self.rows = TaskContext.get().partitionId(), 0, None, 0, []

    @property
    def name(self) -> str:
        return f"{self.part:06d}-{self.number:05d}-{self.attempt}.{self.ending}"

    def write(self, data: bytes) -> None:
        if self.sink is None:
            self.place.create_dir(self.base, recursive=True)
            self.sink = self.place.open_output_stream(f"{self.base}/{self.name}", compression=None)
        self.sink.write(data)
        self.at += len(data)

    def full(self) -> bool:
        return self.at >= self.most

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.rows.append(self.name)
            self.sink, self.at, self.number = None, 0, self.number + 1

    def table(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.rows, pa.string())], ["file"])


def _write_arcs(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder, "arc.gz")
        for key, url, html in rows_of(batches, "page_id", "url", "html"):
            second = datetime(1996, 1, 1) + timedelta(seconds=abs(key or 0) % 10**8)
            date = second.strftime("%Y%m%d%H%M%S").encode()
            version = b"1" if (files.part + files.number) % 2 else b"2"
            if files.sink is None:
                files.write(gzip_member(arc_version_block(files.name, version, date)))
            named = b"" if key is None else KEY_HEADER + b": %d\r\n" % key
            head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + named + b"Content-Length: %d\r\n\r\n" % len(html)
            record = ArcRecord(url or b"-", b"0.0.0.0", date, b"text/html", b"200", head + html)
            files.write(gzip_member(arc_record(record, version, files.name, files.at)))
            if files.full():
                files.close()
        files.close()
        yield files.table()

    return run


def _scan_arcs(folder: str):
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("key", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        out = Rows(schema)
        for (name,) in rows_of(batches, "file"):
            with place.open_input_file(f"{base}/{name}") as source:
                members = Members(source)
                fields = arc_fields(members.read()[1])
                while member := members.read():
                    offset, data = member
                    header, payload = http_parts(parse_arc_record(data, fields).block)
                    key = header_value(header, KEY_HEADER)
                    if out.add(name, offset, NO_KEY if key is None else int(key), sha1_base32(payload), len(payload)):
                        yield out.take()
        yield from out.rest()

    return run


def _convert(arcs: str, warcs: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by file and place."""
        place, base = fs.FileSystem.from_uri(arcs)
        files, opened, source, members, fields = Files(warcs, "warc.gz"), None, None, None, []
        for name, offset, to_file, to_offset in rows_of(batches, "file", "offset", "to_file", "to_offset"):
            if name != opened:
                if source is not None:
                    source.close()
                opened, source = name, place.open_input_file(f"{base}/{name}")
                members = Members(source)
                fields = arc_fields(members.read()[1])
            members.seek(offset)
            record = parse_arc_record(members.read()[1], fields)
            refers_to = None if to_file is None else record_id(to_file, to_offset)
            files.write(gzip_member(to_warc(record, record_id(name, offset), refers_to)))
            if files.full():
                files.close()
        if source is not None:
            source.close()
        files.close()
        yield files.table()

    return run


def _read_warcs(folder: str):
    names = [("id", pa.string()), ("key", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("kind", pa.string()), ("to", pa.string())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        out = Rows(pa.schema(names))
        for (name,) in rows_of(batches, "file"):
            with place.open_input_file(f"{base}/{name}") as source:
                members = Members(source)
                while member := members.read():
                    fields, block = parse_warc(member[1])
                    header, payload = http_parts(block)
                    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                    if kind != "revisit" and digest != sha1_base32(payload):
                        raise ValueError(f"payload of {fields['warc-record-id']} has another digest")
                    key = header_value(header, KEY_HEADER)
                    if out.add(fields["warc-record-id"], NO_KEY if key is None else int(key), int(fields["warc-payload-length"]),
                               digest, kind, fields.get("warc-refers-to")):
                        yield out.take()
        yield from out.rest()

    return run


def convert_archives(files: DataFrame, arcs: str, warcs: str, least_bytes: int = 0) -> DataFrame:
    """Convert the ARC files named in ``files`` (``file``); returns the WARC files written (``file``).

    Payloads of fewer than ``least_bytes`` are never revisits."""
    n_files = files.count()
    seen = cut_lineage(dealt_by_file(files, n_files).mapInArrow(
        _scan_arcs(arcs), "file string, offset long, key long, digest string, size long"))
    last = seen.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max(F.struct("key", "file", "offset")).alias("o"), F.count("*").alias("n")).where("n > 1")
    named = last.select("digest", F.col("o.file").alias("to_file"), F.col("o.offset").alias("to_offset"))
    large = F.when(F.col("size") >= least_bytes, F.col("digest")).alias("digest")
    rows = seen.select("file", "offset", large).join(named, "digest", "left")
    itself = (F.col("file") == F.col("to_file")) & (F.col("offset") == F.col("to_offset"))
    rows = rows.select("file", "offset", *[F.when(~itself, F.col(c)).alias(c) for c in ("to_file", "to_offset")])
    return cut_lineage(dealt_by_file(rows, n_files).sortWithinPartitions("file", "offset").mapInArrow(_convert(arcs, warcs), "file string"))


def read_warcs(files: DataFrame, folder: str) -> DataFrame:
    """``id, key, size, digest, kind, to`` of every record in the files."""
    return dealt_by_file(files, files.count()).mapInArrow(
        _read_warcs(folder), "id string, key long, size long, digest string, kind string, to string")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as ARC files, these as WARC files, and what the WARC files hold: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``."""
    folder = f"{shared_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    arcs, warcs = f"{folder}/arc", f"{folder}/warc"
    rows = pages.select(F.col("page_id").cast("long"), utf8("url").alias("url"), utf8("html").alias("html"))
    written = cut_lineage(rows.mapInArrow(_write_arcs(arcs), "file string"))
    records = cut_lineage(read_warcs(convert_archives(written, arcs, warcs, least_bytes), warcs))
    whole = records.where("kind != 'revisit'").select(F.col("id").alias("to"), F.col("key").alias("to_key"))
    return records.join(whole, "to", "left").select(
        clean(F.col("key")).alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), clean(F.col("to_key")).alias("refers_to"))
