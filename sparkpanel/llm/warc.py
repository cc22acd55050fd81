"""WARC archives: a writer and a splittable reader.

Archives are concatenated gzip members, one record each.  Every write task makes one file
in a shared folder under a name of its own attempt and reports it; only reported files are
read, so a task that is run again after a loss leaves nothing behind that counts.

The reader cuts files into byte ranges.  A task looks for the gzip magic in its range and
validates each candidate: the member must inflate and begin with a version line, complete
named headers and a content length.  A task owns the records whose member starts inside
its range and reads past the end of the range to finish the last one; after a member it
goes on at the member's end.  Members are read in chunks, never a whole file.  (Bytes that
look like a whole archive member inside another member could be mistaken for a record
only if they are stored uncompressed and a range starts between; UTF-8 payloads hold no
gzip magic.)

Payload digests are checked on reading; a corrupt member raises instead of being skipped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.llm.common import join_weighted, materialise
from sparkpanel.session import scratch_path
from sparkpanel.sources.files import resolve_path

MAGIC = b"\x1f\x8b\x08"
CHUNK, PIECE = 1 << 20, 1 << 15
RANGE_BYTES = 32 << 20
#: reading tasks; beyond it a task gets several ranges
MAX_TASKS = 20_000
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, bytes long, records long"
RECORD = ("path string, offset long, page_id long, url string, record_type string, refers_to long, "
          "payload_bytes long, payload_digest string, payload binary")


def _plain(path: str) -> str:
    """``file:/x`` (Hadoop's short form) as a local path."""
    return path.removeprefix("file:") if re.match("file:/(?!/)", path) else path


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str:
    """The URL with control characters and blanks percent-encoded (a header is one line)."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url or "")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member: response with the payload, or revisit with its digest and size only."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def choose_responses(pages: DataFrame, min_bytes: int = 0, html: str = "html", key: str = "page_id") -> DataFrame:
    """(page_id, refers_to) for every page that revisits: its payload, of at least ``min_bytes``,
    is that of a page with a smaller id.  Rows that share the smallest id are all responses."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    d = materialise(pages.select(F.col(key).alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
                    .where(F.col("n") >= min_bytes), "digests")
    firsts = materialise(d.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("c"))
                         .where("c > 1"), "firsts")
    hit = join_weighted(d, firsts, "digest", "c", d.count())
    return hit.where("refers_to is not null and not (page_id <=> refers_to)").select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, html: str = "html", key: str = "page_id",
               url: str = "url", date: str = DATE) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder``; returns the manifest (a written table).

    Null html: empty payload.  Null url: no target header.  Null key: an id without number.
    Of equal payloads of at least ``min_bytes`` bytes the one with the smallest key is a
    response and the others revisit it; smaller payloads are all responses.  Repeated rows
    are records each: rows that share the smallest key are all responses.  Payloads of any
    length are one member.  Other columns, whatever their names, are not read.  Empty table:
    an empty manifest.
    """
    revisits = choose_responses(pages, min_bytes, html, key)
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), text.alias("html"), F.sha1(text.cast("binary")).alias("digest"))
    j = rows.join(revisits, rows["page_id"].eqNullSafe(revisits["page_id"]) & (rows["digest"] == revisits["digest"]), "left") \
        .select(rows["page_id"], "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for r in batch.slice(i, 256).to_pylist():
                    if out is None:
                        filesystem, inner = resolve_path(_plain(path))
                        filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = filesystem.open_output_stream(inner, compression=None)
                    data = record_bytes(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["refers_to"], date)
                    out.write(data)
                    size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                                             ["path", "bytes", "records"])

    return materialise(j.mapInArrow(run, MANIFEST), "manifest")


class _Window:
    """A file's bytes from a position on, read in chunks and dropped behind."""

    def __init__(self, handle, position: int):
        self.handle, self.start, self.data, self.ended = handle, position, b"", False
        handle.seek(position)

    def more(self) -> bool:
        chunk = b"" if self.ended else self.handle.read(CHUNK)
        self.ended = not chunk
        self.data += chunk
        return not self.ended

    def drop(self, position: int) -> None:
        if position - self.start >= CHUNK:  # now and then: every slice copies what remains
            self.data = self.data[position - self.start:]
            self.start = position


def _headers(plain: bytes) -> dict[str, str] | None:
    """Named fields of a decoded member's start, None while or if it is no complete record head."""
    head, blank, _ = plain.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"WARC/1."):
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def _member(window: _Window, at: int) -> tuple[bytes, int, bool] | None:
    """(decoded bytes, end position, whether it is a record) of the member at ``at``; None if there is none.

    A candidate whose head does not validate is given up as soon as that is known.
    """
    unpack, plain, position, checked = zlib.decompressobj(31), [], at, False
    size = 0
    while True:
        if position >= window.start + len(window.data) and not window.more():
            if checked:
                raise ValueError(f"archive ends inside the record at {at}")
            return None
        piece = window.data[position - window.start:position - window.start + PIECE]
        try:
            out = unpack.decompress(piece)
        except zlib.error:
            if checked:
                raise
            return None
        plain.append(out)
        size += len(out)
        position += len(piece) - len(unpack.unused_data)
        if not checked:
            start = b"".join(plain)
            if not b"WARC/1.".startswith(start[:7]) if len(start) < 7 else not start.startswith(b"WARC/1."):
                return (start, position, False) if unpack.eof else None
            if b"\r\n\r\n" in start:
                if _headers(start) is None:
                    return None
                checked = True
        if unpack.eof:
            return b"".join(plain), position, checked


def _number(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def _parse(path: str, offset: int, plain: bytes) -> tuple:
    fields = _headers(plain)
    body = plain[plain.index(b"\r\n\r\n") + 4:]
    length = int(fields["content-length"])
    if len(body) < length:
        raise ValueError(f"record at {path}:{offset} is shorter than its content length")
    head, _, payload = body[:length].partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    declared = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    if kind == "response" and digest and digest_of(payload) != digest:
        raise ValueError(f"payload digest differs at {path}:{offset}")
    size = int(declared[1]) if kind == "revisit" and declared else len(payload)
    return (path, offset, _number(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind,
            _number(fields.get("warc-refers-to")), size, digest or digest_of(payload), payload if kind == "response" else None)


def records_in(path: str, start: int, end: int) -> Iterator[tuple]:
    """Records whose gzip member starts in [start, end)."""
    filesystem, inner = resolve_path(_plain(path))
    with filesystem.open_input_file(inner) as handle:
        window = _Window(handle, start)
        at = start
        while at < end:
            found = window.data.find(MAGIC, at - window.start)
            if found < 0:
                # keep two bytes: the magic may lie across two chunks
                at = max(at, window.start + len(window.data) - 2)
                window.drop(at)
                if not window.more():
                    return
                continue
            at = window.start + found
            if at >= end:
                return
            window.drop(at)
            member = _member(window, at)
            if member is None:
                at += 1
                continue
            plain, stop, record = member
            if record:
                yield _parse(path, at, plain)
            at = stop
            window.drop(stop)


def read_warc(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the files in ``manifest`` (path, bytes), by byte ranges of ``range_bytes``.

    A record belongs to the range its member starts in, however far it reaches beyond it.  Bytes
    that look like a member but decode to no record are skipped; a record cut off by the end
    of the file fails.  Empty manifests and files have no records.
    """
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                                                   F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("end"))
    names = [c.split()[0] for c in RECORD.split(", ")]
    arrow = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = RECORD if with_payload else RECORD.rpartition(", ")[0]
    names, arrow = (names, arrow) if with_payload else (names[:-1], arrow[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(arrow)], names)

        for batch in batches:
            for r in batch.to_pylist():
                rows, size = [], 0
                for record in records_in(r["path"], r["start"], r["end"]):
                    rows.append(record)
                    size += len(record[-1] or b"") if with_payload else 0
                    if len(rows) >= 1000 or size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    # one range is a task's worth of work: deal them out evenly, whatever their row size
    n = ranges.count()
    return ranges.repartition(max(1, min(n, MAX_TASKS))).mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and read the archives back, without payloads: one row per row of
    ``pages``, with the cases of ``write_warc``."""
    manifest = write_warc(pages, scratch_path(spark, "warc"), min_bytes)
    return read_warc(spark, manifest, range_bytes, with_payload=False)
