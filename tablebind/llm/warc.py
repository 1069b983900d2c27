"""Legacy ARC archives, their conversion to WARC, and reading both."""

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebind.functions.names import col
from tablebind.llm.common import map_batches
from tablebind.plans.checkpoints import checkpointed, new_folder, stored
from tablebind.plans.joins import lookup

#: Records in one archive file at most, its description included, and bytes of it (or one record).
FILE_RECORDS, FILE_BYTES = 1000, 256 << 20
#: Bytes of an archive that are unpacked at once, bytes of a batch of rows, and the longest header line.
CHUNK, BATCH_BYTES, LINE_BYTES = 1 << 20, 32 << 20, 1 << 16
#: Archives are packed fast: an eighth more room for half of the time.
LEVEL = "BEST_SPEED"
DATE = "20000101000000"
ADDRESS = "0.0.0.0"
PAGE_HEADER = b"X-Page-Id: "
#: Names of the fields of an ARC header line, by version of the format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tablebind:arc")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _as_texts(records: list[bytes]):
    """Batches of records, so that long ones stand in batches of their own."""
    begin = held = 0
    for k, record in enumerate(records):
        if held and held + len(record) > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(records[begin:k], pa.binary())], ["value"])
            begin, held = k, 0
        held += len(record)
    yield pa.RecordBatch.from_arrays([pa.array(records[begin:], pa.binary())], ["value"])


def _write(records: DataFrame, path: str, end: str, codec: str, per_file: int) -> None:
    """Records as they are, each followed by ``end``, in files of ``per_file`` records.

    A path that already exists is refused; the writer publishes files when a task commits, so a
    lost executor leaves no half file.
    """
    (
        records.select(col("value").cast("string").alias("value"))
        .write.option("lineSep", end)
        .option("compression", codec)
        .option("zlib.compress.level", LEVEL)
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


def _per_file(rows: DataFrame, size: Column) -> int:
    """Records that are sure to fit a file, by the longest payload; two at least, as a file opens with
    its description."""
    most = rows.agg(F.max(size)).first()[0] or 0
    return int(min(max(FILE_BYTES // (most + LINE_BYTES), 2), FILE_RECORDS))


def _address(url: str | None) -> str:
    """A page's address without blanks; none is taken for a file description."""
    if url and url.startswith("filedesc:"):
        url = url.replace(":", "%3A", 1)
    return quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]") or "about:blank"


def _arc_record(url: str, date: str, body: bytes, version: int, offset: int, status: str) -> bytes:
    kind = b"text/plain" if url.startswith("filedesc:") else b"text/html"
    fields = [url.encode(), ADDRESS.encode(), date.encode(), kind]
    if version == 2:
        checksum = hashlib.md5(body).hexdigest()
        fields += [status.encode(), checksum.encode(), b"-", str(offset).encode(), b"-"]
    return b" ".join([*fields, str(len(body)).encode()]) + b"\n" + body


def write_arc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    versions: tuple[int, ...] = (1, 2),
    date: str = DATE,
    codec: str = "gzip",
) -> None:
    """Pages as ARC files, each opened by its file description; tasks take turns at versions."""
    rows = pages.select(
        col(id_col).cast("string").alias("id"),
        col(url_col).cast("string").alias("url"),
        col(html_col).cast("binary").alias("html"),
        F.spark_partition_id().alias("task"),
    )
    per_file = _per_file(rows, F.octet_length("html"))

    def records(batches):
        n = offset = 0
        for batch in batches:
            out = []
            for key, url, html, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                version = versions[task % len(versions)]
                if n % per_file == 0:
                    about = f"{version} 0 tablebind\n{ARC_FIELDS[version]}\n".encode()
                    name = f"filedesc://{task}-{n // per_file}.arc"
                    out.append(_arc_record(name, date, about, version, 0, "200"))
                    n, offset = n + 1, len(out[-1]) + 1
                page = PAGE_HEADER + key.encode() + b"\r\n" if key is not None else b""
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + page
                body = head + b"\r\n" + (html or b"")
                out.append(_arc_record(_address(url), date, body, version, offset, "200"))
                n, offset = n + 1, offset + len(out[-1]) + 1
            yield from _as_texts(out)

    _write(map_batches(rows, records, "value binary"), path, "\n", codec, per_file)


def unzipped(data: bytes):
    """The content of a gzip file of any number of members in pieces; other content as it is.

    A member that is cut off or damaged ends the content where it does.
    """
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at, member = 0, zlib.decompressobj(31)
    while at < len(data):
        piece = data[at : at + CHUNK]
        at += len(piece)
        try:
            while piece:
                out = member.decompress(piece, CHUNK)
                if out:
                    yield out
                piece = member.unconsumed_tail
            while not member.eof and (out := member.decompress(b"", CHUNK)):
                yield out
        except zlib.error:
            return
        if member.eof:
            at -= len(member.unused_data)
            while data[at : at + 1] == b"\0":
                at += 1
            if data[at : at + 2] != b"\x1f\x8b":
                return
            member = zlib.decompressobj(31)


class Reader:
    """Content that comes in pieces; only what is not yet taken is in memory."""

    def __init__(self, pieces):
        self.pieces, self.held, self.at, self.offset = iter(pieces), b"", 0, 0

    def fill(self, n: int) -> bool:
        """Whether ``n`` bytes are there."""
        if len(self.held) - self.at >= n:
            return True
        parts, have = [self.held[self.at :]], len(self.held) - self.at
        for piece in self.pieces:
            parts.append(piece)
            have += len(piece)
            if have >= n:
                break
        self.held, self.at = b"".join(parts), 0
        return have >= n

    def peek(self, n: int, start: int = 0) -> bytes:
        """The bytes from ``start`` to ``n``, as far as there are."""
        self.fill(n)
        return self.held[self.at + start : self.at + n]

    def skip(self, n: int) -> None:
        self.at += n
        self.offset += n

    def until(self, mark: bytes, most: int) -> bytes | None:
        """What comes before ``mark``, within ``most`` bytes; the mark is not taken."""
        want = 1024
        while True:
            more = self.fill(min(want, most))
            found = self.held.find(mark, self.at, self.at + min(want, most))
            if found >= 0:
                return self.held[self.at : found]
            if not more or want >= most:
                return None
            want *= 4


@dataclass(frozen=True)
class Damage:
    """What is no record: where it begins, and why."""

    offset: int
    reason: str


#: What a header line of either version ends with, and the line at which a lost reader goes on.
SIZED = re.compile(rb"^\S.* [0-9]+\r?$", re.S)
PLAUSIBLE = re.compile(rb"^[A-Za-z][A-Za-z0-9+.-]*:\S* .* [0-9]+\r?$", re.S)


def parse_arc(pieces):
    """(version, fields by name, body) of each record; a description sets the version.

    A header line that is none, or whose length does not fit, gives a ``Damage`` instead; reading
    goes on at the next line that looks like a header line.
    """
    reader = Reader([pieces] if isinstance(pieces, bytes) else pieces)
    version, names, lost = 1, ARC_FIELDS[1].split(), False
    while reader.fill(1):
        if reader.peek(1) in b"\r\n":
            reader.skip(1)
            continue
        begin = reader.offset
        line = reader.until(b"\n", LINE_BYTES)
        size = len(line) + 1 if line is not None else len(reader.peek(LINE_BYTES))
        found, reason = None, "no header line"
        if line is not None and (PLAUSIBLE if lost else SIZED).match(line):
            found, reason = _arc_fields(reader, line, size, version, names)
        if found is None:
            if not lost:
                yield Damage(begin, reason)
            lost = True
            reader.skip(size)
            continue
        lost = False
        version, names, fields, length = found
        reader.skip(size)
        body = reader.peek(length)
        reader.skip(length)
        yield version, fields, body


def _arc_fields(reader: Reader, line: bytes, size: int, version: int, names: list[str]):
    """(version, field names, fields, length of the body) of a header line, or None and why not."""
    text = line.rstrip(b"\r").decode("utf-8", "replace")
    length = int(text.rpartition(" ")[2])
    if not reader.fill(size + length):
        return None, f"a record of {length} bytes is cut off"
    if reader.peek(size + length + 1, size + length) not in (b"", b"\n", b"\r"):
        return None, f"no line end after {length} bytes"
    if text.startswith("filedesc:"):
        told = reader.peek(size + length, size).split(None, 1)[:1]
        if told not in ([b"1"], [b"2"]):
            return None, "an unknown version"
        version = int(told[0])
        names = ARC_FIELDS[version].split()
    values = text.rsplit(" ", len(names) - 1)
    if len(values) != len(names):
        return None, f"not the fields of version {version}"
    return (version, names, dict(zip(names, values, strict=True)), length), ""


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """The head with its blank line, and the payload; without a head all is payload."""
    head, blank, payload = body.partition(b"\r\n\r\n")
    return (head + blank, payload) if blank and head.startswith(b"HTTP/") else (b"", body)


def _page_id(head: bytes) -> int | None:
    found = re.search(rb"^" + PAGE_HEADER + rb"(-?\d+)\r?$", head, re.M)
    return int(found[1]) if found else None


def read_arc(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """One row per archived page: file, n, page_id, url, date, mime, digest, size, record_id and,
    if asked for, head and payload. Damaged places are left out; see ``damaged_records``."""
    names = ["file", "n", "page_id", "url", "date", "mime", "digest", "size", "record_id"]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string()]
    schema = (
        "file string, n long, page_id long, url string, date string, mime string, "
        "digest string, size long, record_id string"
    )
    if payloads:
        names, kinds = [*names, "head", "payload"], [*kinds, pa.binary(), pa.binary()]
        schema += ", head binary, payload binary"

    def rows(file, content):
        for n, record in enumerate(parse_arc(unzipped(content))):
            if isinstance(record, Damage) or record[1]["URL"].startswith("filedesc:"):
                continue
            _, fields, body = record
            head, payload = split_http(body)
            digest = payload_digest(payload)
            own = uuid.uuid5(_IDS, f"{file.rpartition('/')[2]} {n} {fields['URL']} {digest}")
            row = (file, n, _page_id(head), fields["URL"], fields["Archive-date"])
            row += (fields["Content-type"], digest, len(payload), f"<urn:uuid:{own}>")
            yield len(body), row + (head, payload) if payloads else row

    return _read(spark, path, rows, names, kinds, schema)


def damaged_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per place of ARC files that is no record: file, offset (in the unpacked file) and
    reason. Reading goes on behind it at the next line that looks like a record's."""

    def rows(file, content):
        for record in parse_arc(unzipped(content)):
            if isinstance(record, Damage):
                yield 100, (file, record.offset, record.reason)

    kinds = [pa.string(), pa.int64(), pa.string()]
    return _read(spark, path, rows, ["file", "offset", "reason"], kinds, "file string, offset long, reason string")


def _read(spark: SparkSession, path: str, rows, names: list[str], kinds: list[pa.DataType], schema: str) -> DataFrame:
    """What ``rows`` of (file, content) gives, as (bytes, row), in batches of bounded size."""

    def read(batches):
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, held = [], 0
                for size, row in rows(file, content):
                    out.append(row)
                    held += size
                    if len(out) == FILE_RECORDS or held > BATCH_BYTES:
                        yield _batch(out, names, kinds)
                        out, held = [], 0
                yield _batch(out, names, kinds)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_batches(files, read, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def _iso(date: str) -> str:
    d = (date + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def convert_arc(
    spark: SparkSession, source: str, target: str, least: int = 0, codec: str = "gzip"
) -> None:
    """ARC files as WARC files.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page_id
    (then the last file and record) is a response; the others are revisits of it. Digests of
    payloads that repeat are found by one grouped maximum, which combines before the shuffle.
    """
    index = stored(read_arc(spark, source, payloads=False))
    per_file = _per_file(index, F.col("size"))
    index = index.where(F.col("size") >= least)
    place = F.struct("page_id", "file", "n", "record_id", "url", "date")
    repeated = (
        index.groupBy("digest", "size")
        .agg(F.max(place).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select(
            "digest",
            "size",
            F.col("first.record_id").alias("first_id"),
            F.col("first.url").alias("first_url"),
            F.col("first.date").alias("first_date"),
        )
    )
    rows = lookup(
        read_arc(spark, source, payloads=True), checkpointed(repeated), ["digest", "size"], "left"
    )
    rows = rows.select(
        "url", "date", "mime", "digest", "record_id", "first_id", "first_url", "first_date",
        "head", "payload", F.spark_partition_id().alias("task"),
    )

    def records(batches):
        n = 0
        for batch in batches:
            out = []
            for url, date, mime, digest, own, first, first_url, first_date, head, payload, task in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if n % per_file == 0:
                    info = uuid.uuid5(_IDS, f"info {task} {n} {own}")
                    headers = [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{info}>"),
                        ("WARC-Date", _iso(date)),
                        ("Content-Type", "application/warc-fields"),
                    ]
                    out.append(_warc_record(headers, b"software: tablebind\r\nformat: WARC 1.1\r\n"))
                    n += 1
                revisit = first is not None and first != own
                kind = "application/http; msgtype=response" if head else mime
                headers = [
                    ("WARC-Type", "revisit" if revisit else "response" if head else "resource"),
                    ("WARC-Record-ID", own),
                    ("WARC-Date", _iso(date)),
                    ("WARC-Target-URI", url),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("Content-Type", kind),
                ]
                if revisit:
                    headers += [
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", first),
                        ("WARC-Refers-To-Target-URI", first_url),
                        ("WARC-Refers-To-Date", _iso(first_date)),
                    ]
                block = head if revisit else head + payload
                headers.append(("WARC-Block-Digest", f"sha1:{payload_digest(block)}"))
                out.append(_warc_record(headers, block))
                n += 1
            yield from _as_texts(out)

    _write(map_batches(rows, records, "value binary"), target, "\r\n\r\n", codec, per_file)


def parse_warc(pieces):
    """(headers by lower-case name, block) of each record."""
    reader = Reader([pieces] if isinstance(pieces, bytes) else pieces)
    while reader.fill(1):
        head = reader.until(b"\r\n\r\n", LINE_BYTES)
        first, *lines = (head or reader.peek(200)).decode("utf-8", "replace").split("\r\n")
        if head is None or not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:200]}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        reader.skip(len(head) + 4)
        block = reader.peek(length)
        if len(block) < length:
            raise ValueError(f"record of {length} bytes ends after {len(block)}")
        reader.skip(length)
        yield headers, block
        if reader.peek(4) != b"\r\n\r\n":
            raise ValueError("a record is not followed by two line ends")
        reader.skip(4)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record: type, record_id, refers_to (a record_id), page_id, url, digest
    (of the header) and, but for revisits, payload_bytes and payload_digest of the payload read."""
    names = "type record_id refers_to page_id url digest payload_bytes payload_digest".split()
    kinds = [*[pa.string()] * 3, pa.int64(), *[pa.string()] * 2, pa.int64(), pa.string()]

    def rows(_, content):
        for headers, block in parse_warc(unzipped(content)):
            kind = headers["warc-type"]
            if kind == "warcinfo":
                continue
            head, payload = split_http(block)
            full = kind != "revisit"
            yield (
                100,
                (
                    kind,
                    headers["warc-record-id"],
                    headers.get("warc-refers-to"),
                    _page_id(head),
                    headers.get("warc-target-uri"),
                    headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                    len(payload) if full else None,
                    payload_digest(payload) if full else None,
                ),
            )

    schema = (
        "type string, record_id string, refers_to string, page_id long, url string, "
        "digest string, payload_bytes long, payload_digest string"
    )
    return _read(spark, path, rows, names, kinds, schema)


def archived(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    folder: str | None = None,
    least: int = 0,
) -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC, read the WARC files back: one row per page with
    page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id), url.

    A null html is an empty payload, a null url ``about:blank``; a null page_id comes back null and
    counts as the smallest. Equal rows each have a record: one is the response. An empty table
    gives empty archives and no rows. Files stay in ``folder`` (below the shared folder unless
    named): ``arc`` and ``warc``.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    write_arc(pages, f"{folder}/arc", id_col, url_col, html_col)
    convert_arc(spark, f"{folder}/arc", f"{folder}/warc", least)
    read = stored(read_warc(spark, f"{folder}/warc"))
    full = read.where("type <> 'revisit'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("full_id"),
        F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest"),
    )
    revisits = read.where("type = 'revisit'").join(full, "refers_to", "left")
    return (
        read.where("type <> 'revisit'")
        .select(
            "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
            F.lit(None).cast("long").alias("refers_to"), "url",
        )
        .union(
            revisits.select(
                "page_id", "full_bytes", "full_digest", "type", "full_id", "url",
            )
        )
    )
