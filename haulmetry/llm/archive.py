"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

``write_arc`` puts pages into ARC files, ``convert`` parses ARC files into WARC files, ``read_warc``
reads those. Every file is written by one task, gzipped a record at a time, and known by a row of a
manifest; what a lost attempt left behind is in no manifest.

The parser goes by what the file says: its version block names the version and so the fields of a
header line, and the line's last field is the length of what follows, whatever that holds.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import file_system, new_path, slices, staged

#: The fields of a record's header line, by version of the format.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
#: Fixed value: profile of a revisit record that names an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVED = "20240101000000"
LEVEL = 1
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "arc-record")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str, date: str, digest: str) -> str:
    """The same record always has the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {url} {date} {digest}')}>"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# Writing ARC


def arc_start(version: int, name: str, date: str = ARCHIVED) -> bytes:
    """The version block that opens a file."""
    body = f"{version} 0 haulmetry\n{' '.join(FIELDS[version])}\n"
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
    values["Archive-length"] = str(len(body))
    return f"{' '.join(values.get(f, '-') for f in FIELDS[version])}\n{body}\n".encode()


def arc_record(version: int, url: str, content: bytes, offset: int, name: str, date: str = ARCHIVED) -> bytes:
    """One record: header line, the response as it came, and an empty line."""
    values = {
        "URL": url,
        "IP-address": "0.0.0.0",
        "Archive-date": date,
        "Content-type": "text/html",
        "Result-code": "200",
        "Checksum": "-",
        "Location": "-",
        "Offset": str(offset),
        "Filename": name,
        "Archive-length": str(len(content)),
    }
    return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + content + b"\n"


def _arc_file(folder: str, version: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context, stream, offset, records = TaskContext.get(), None, 0, 0
    name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}.arc.gz"
    for batch in slices(batches, 64):
        if stream is None:
            fs, path = file_system(folder)
            fs.create_dir(path, recursive=True)
            stream = fs.open_output_stream(f"{path}/{name}", compression=None)
            start = _gzip(arc_start(version, name))
            stream.write(start)
            offset = len(start)
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            # Header fields have no spaces; a missing URL gets a name made of the page's id.
            safe = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
            head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            head += "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
            content = head.encode() + b"\r\n" + (html or "").encode("utf-8", "surrogatepass")
            data = _gzip(arc_record(version, safe, content, offset, name))
            stream.write(data)
            offset += len(data)
            records += 1
    if stream is not None:
        stream.close()
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": pa.array([records], pa.int64())})


def write_arc(
    pages: DataFrame, folder: str | None = None, version: int = 1, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write pages, a null html as an empty payload; returns ``path`` and ``records`` of each file."""
    folder = folder or new_path(pages.sparkSession, "arc")
    source = pages.select(pages[page_id].cast("bigint"), pages[url].cast("string"), pages[html].cast("string"))
    return staged(source.mapInArrow(partial(_arc_file, folder, version), "path string, records bigint"), "arc")


# Reading either


class Members:
    """The gzip members of a stream, one after the other, and where each begins; a plain stream is one member."""

    def __init__(self, stream, size: int = 1 << 18):
        self.stream, self.size = stream, size

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        at, data = 0, self.stream.read(self.size)
        if data[:2] != b"\x1f\x8b":
            yield 0, data + b"".join(iter(lambda: self.stream.read(self.size), b""))
            return
        while data:
            z, out, used = zlib.decompressobj(31), [], 0
            while True:
                out.append(z.decompress(data))
                used += len(data) - len(z.unused_data)
                data = z.unused_data
                if z.eof:
                    break
                data = self.stream.read(self.size)
                if not data:
                    raise ValueError("the last member is cut off")
            yield at, b"".join(out)
            at += used
            data = data or self.stream.read(self.size)


def arc_records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Member offset, header fields and content of each record of an ARC stream, gzipped or plain."""
    fields: tuple[str, ...] = ()
    for offset, data in Members(stream):
        at = 0
        while at < len(data):
            end = data.find(b"\n", at)
            line = data[at : end if end >= 0 else len(data)].strip(b"\r")
            if not line:
                at = end + 1 if end >= 0 else len(data)
                continue
            values = line.decode("utf-8", "replace").split(" ")
            if end < 0 or not values[-1].isdigit():
                raise ValueError(f"not a header line: {line[:80]!r}")
            length = int(values[-1])
            body = data[end + 1 : end + 1 + length]
            if len(body) < length:
                raise ValueError(f"a record of {length} bytes holds {len(body)}")
            at = end + 1 + length
            if values[0].startswith("filedesc:"):
                version = body.split(b" ", 1)[0].strip()
                fields = FIELDS[int(version)]
                continue
            if len(values) != len(fields):
                raise ValueError(f"{len(values)} fields where the version has {len(fields)}")
            yield offset, dict(zip(fields, values, strict=True)), body


def split_response(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, the header block with its empty line, and the payload of a stored response."""
    if not content.startswith(b"HTTP/"):
        return {}, b"", content
    end = content.find(b"\r\n\r\n")
    head = content[: end + 4] if end >= 0 else content
    pairs = (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}, head, content[len(head) :]


# Converting


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What deciding about a record needs: no payloads."""
    for batch in batches:
        for arc in batch.column(0).to_pylist():
            fs, path = file_system(arc)
            rows = []
            with fs.open_input_stream(path, compression=None) as stream:
                for n, (_, fields, content) in enumerate(arc_records(stream)):
                    head, _, payload = split_response(content)
                    page = head.get("x-page-id")
                    digest = payload_digest(payload)
                    url, date = fields["URL"], fields["Archive-date"]
                    page = int(page) if page is not None else None
                    rows.append((arc, n, page, len(payload), digest, url, date, record_id(page, url, date, digest)))
            names = ["path", "n", "page_id", "bytes", "digest", "url", "date", "id"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


_PARSED = "path string, n bigint, page_id bigint, bytes bigint, digest string, url string, date string, id string"


def warc_date(date: str) -> str:
    """ARC's fourteen digits (or fewer: the rest counts as its first value) as a WARC date."""
    full = (date + "00000101000000"[len(date) :])[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _block_digest(block: bytes) -> str:
    return f"sha1:{payload_digest(block)}"


def _converted(folder: str, arc: str, rows: pa.Table) -> pa.Table:
    """Writes the WARC file of one ARC file: its payloads are streamed, decisions are rows of the group."""
    context = TaskContext.get()
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    name = f"{arc.rsplit('/', 1)[1].split('.')[0]}-{context.taskAttemptId()}.warc.gz"
    decisions = {r["n"]: r for r in rows.to_pylist()}
    source, arc_path = file_system(arc)
    records = 0
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out, source.open_input_stream(arc_path, compression=None) as stream:
        info = f"software: haulmetry\r\nformat: WARC File Format 1.1\r\ndescription: converted from {arc.rsplit('/', 1)[1]}\r\n".encode()
        out.write(_gzip(warc_record([
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMES, name)}>"),
            ("WARC-Date", warc_date(ARCHIVED)),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ], info)))
        for n, (_, fields, content) in enumerate(arc_records(stream)):
            d = decisions[n]
            _, head, _ = split_response(content)
            block = content if d["keeper_id"] is None else head
            headers = [
                ("WARC-Type", "response" if d["keeper_id"] is None else "revisit"),
                ("WARC-Record-ID", d["id"]),
                ("WARC-Date", warc_date(fields["Archive-date"])),
                ("WARC-Target-URI", fields["URL"]),
                ("WARC-IP-Address", fields["IP-address"]),
                ("WARC-Payload-Digest", f"sha1:{d['digest']}"),
                ("WARC-Block-Digest", _block_digest(block)),
                ("WARC-Identified-Payload-Type", fields["Content-type"]),
                ("X-Payload-Length", str(d["bytes"])),
            ]
            if d["keeper_id"] is not None:
                headers += [
                    ("WARC-Profile", SAME_PAYLOAD),
                    ("WARC-Refers-To", d["keeper_id"]),
                    ("WARC-Refers-To-Target-URI", d["keeper_url"]),
                    ("WARC-Refers-To-Date", warc_date(d["keeper_date"])),
                    ("X-Refers-To-Page", str(d["keeper_page"])),
                ]
            headers.append(("Content-Type", "application/http;msgtype=response" if head else fields["Content-type"]))
            out.write(_gzip(warc_record(headers, block)))
            records += 1
    return pa.table({"path": [f"{folder}/{name}"], "records": pa.array([records], pa.int64())})


def convert(arcs: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Convert ARC files (column ``path``) to WARC files; returns ``path`` and ``records`` of each.

    Of records with equal payloads of ``least_bytes`` or more, that of the largest page id (and then
    the largest identifier) is a response, and the others revisit it. A record without page id is
    a response, and none revisits it. Records that are equal in everything are told apart by their
    place, so one of them is the response.
    """
    spark = arcs.sparkSession
    folder = folder or new_path(spark, "warc")
    parsed = staged(arcs.select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(_parsed, _PARSED), "parsed")
    rank = F.struct("page_id", "id", "path", "n")
    same = parsed.where(F.col("page_id").isNotNull() & (F.col("bytes") >= least_bytes))
    keepers = (
        same.groupBy("digest", "bytes")
        .agg(F.count("*").alias("times"), F.max(F.struct("page_id", "id", "path", "n", "url", "date")).alias("k"))
        .where("times > 1")
    )
    joined = parsed.join(keepers, ["digest", "bytes"], "left")
    revisit = (
        F.col("k").isNotNull()
        & F.col("page_id").isNotNull()
        & (F.col("bytes") >= least_bytes)
        & (rank != F.struct("k.page_id", "k.id", "k.path", "k.n"))
    )
    decided = joined.select(
        "path", "n", "id", "digest", "bytes",
        *[F.when(revisit, F.col(f"k.{c}")).alias(f"keeper_{a}") for c, a in (("id", "id"), ("page_id", "page"), ("url", "url"), ("date", "date"))],
    )

    def to_warc(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _converted(folder, key[0].as_py(), rows)

    return staged(decided.groupBy("path").applyInArrow(to_warc, "path string, records bigint"), "warc")


# Reading WARC


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    for _, data in Members(stream):
        at = 0
        while at < len(data):
            end = data.find(b"\r\n\r\n", at)
            lines = data[at:end].decode("utf-8").split("\r\n")
            if end < 0 or not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            length = int(headers["content-length"])
            yield headers, data[end + 4 : end + 4 + length]
            at = end + 4 + length + 4


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for warc in batch.column(0).to_pylist():
            fs, path = file_system(warc)
            rows = []
            with fs.open_input_stream(path, compression=None) as stream:
                for headers, block in warc_records(stream):
                    kind = headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    if headers["warc-block-digest"] != _block_digest(block):
                        raise ValueError(f"{headers['warc-record-id']}: its block is not what was written")
                    head, _, payload = split_response(block)
                    page = int(head["x-page-id"]) if "x-page-id" in head else None
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"{headers['warc-record-id']}: its payload is not what was written")
                    size = len(payload) if kind == "response" else int(headers["x-payload-length"])
                    refers = headers.get("x-refers-to-page")
                    rows.append((page, size, digest, kind, int(refers) if refers else None, headers["warc-target-uri"], headers["warc-record-id"], headers["warc-date"]))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id", "date"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_warc(warcs: DataFrame) -> DataFrame:
    """One row per response or revisit of WARC files (column ``path``); digests are checked while reading."""
    parts = int(warcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return warcs.select("path").repartition(parts, "path").mapInArrow(
        _pages,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint,"
        " target_uri string, record_id string, date string",
    )
