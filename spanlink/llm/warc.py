"""WARC archives of pages, and a salvage reader.

Writing: every record is a gzip member of its own. Payloads of MIN_REVISIT bytes or more that occur again are stored once, in the
response with the largest page_id; the others are revisit records that name it. Groups are counted on digests, without payloads. The
table of repeated digests is broadcast when its rows have been counted, so payloads don't move; a longer one meets them in a join
that adaptive execution can split, as it has one row per digest.

Reading: a record counts when its member inflates with a right checksum, its header parses, its lengths fit and its digests
agree, as far as they are of a known kind (SHA-1, SHA-256, MD5, in hex or base32). Otherwise the reader looks for the next member or version
line after the failed start, tries there, and so on; the bytes between the last good record and the next are logged as a gap.
Members and bare records may alternate in a file, and a record may have any length that the rest of the file has room for. A
member is inflated no further than its header says.

Defined cases: null html is an empty payload; a null url is an empty target; a null page_id is written as such and comes
back as null; rows with the same page_id and payload are the same record written twice and both responses when that id is the
largest; an empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import broadcast_if_small, materialize, shared_dir, table
from spanlink.llm.files import reading, replacing

MIN_REVISIT = 1000
#: A task starts another file after so many bytes.
FILE_BYTES = 64 << 20
#: Nothing is known about capture times here, and reruns must give the same bytes.
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A longer header is damage.
MAX_HEADER = 1 << 20
#: Repeated digests, 28 bytes each, beyond which their table is shuffled instead of broadcast.
BROADCAST_DIGESTS = 500_000
_CHUNK = 1 << 18
_KINDS = {"sha1": "sha1", "sha256": "sha256", "md5": "md5"}
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A whole record, before compression; with refers_to it is a revisit and the payload stays out."""
    block = _HTTP + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class Damaged(ValueError):
    """What starts here isn't a valid record."""


@dataclass
class Found:
    """A record, or with `reason` a gap."""

    offset: int
    length: int
    headers: dict[str, str] | None = None
    payload: bytes | None = None
    reason: str | None = None


class _Window:
    """The bytes of a stream from `at` on, as far as they have been asked for."""

    def __init__(self, stream):
        self.stream, self.buf, self.at, self.ended = stream, bytearray(), 0, False

    def fill(self, n: int) -> int:
        while len(self.buf) < n and not self.ended:
            more = self.stream.read(max(_CHUNK, n - len(self.buf)))
            self.ended = not more
            self.buf += more
        return len(self.buf)

    def drop(self, n: int) -> None:
        del self.buf[:n]
        self.at += n


def _header(raw: bytes) -> tuple[dict[str, str], int]:
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/1.") or end < 0:
        raise Damaged("no version line or an endless header")
    headers = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        headers[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,12}", headers.get("content-length", "")):
        raise Damaged("no content length")
    return headers, end + 4


def _agrees(said: str | None, data: bytes) -> bool:
    """Whether a labelled digest is that of the data; one of an unknown kind says nothing."""
    label, _, value = (said or "").partition(":")
    kind = _KINDS.get(label.strip().lower().replace("-", ""))
    if not kind:
        return True
    own = hashlib.new(kind, data).digest()
    return value.strip().lower() == own.hex() or value.strip().upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")


def _checked(headers: dict[str, str], block: bytes) -> bytes | None:
    """The payload, None for a revisit; digests must agree."""
    if not _agrees(headers.get("warc-block-digest"), block):
        raise Damaged("block digest")
    if headers.get("warc-type") != "response":
        return None
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        _, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("an endless HTTP header")
    if not _agrees(headers.get("warc-payload-digest"), payload):
        raise Damaged("payload digest")
    return payload


def _bare(w: _Window) -> tuple[dict[str, str], bytes | None, int]:
    w.fill(MAX_HEADER)
    headers, start = _header(bytes(w.buf[:MAX_HEADER]))
    end = start + int(headers["content-length"])
    if w.fill(end + 4) < end + 4 or w.buf[end : end + 4] != b"\r\n\r\n":
        raise Damaged("the record doesn't end where its length says")
    return headers, _checked(headers, bytes(w.buf[start:end])), end + 4


def _member(w: _Window) -> tuple[dict[str, str], bytes | None, int]:
    z, raw, at, end = zlib.decompressobj(31), bytearray(), 0, None
    while not z.eof:
        piece = z.unconsumed_tail
        if not piece:
            if w.fill(at + 1) <= at:
                raise Damaged("a truncated member")
            piece = bytes(w.buf[at : at + _CHUNK])
            at += len(piece)
        try:
            raw += z.decompress(piece, _CHUNK << 4)
        except zlib.error as e:
            raise Damaged(f"member: {e}") from None
        if end is None and (len(raw) >= MAX_HEADER or z.eof or b"\r\n\r\n" in raw):
            headers, start = _header(bytes(raw[:MAX_HEADER]))
            end = start + int(headers["content-length"])
        if end is not None and len(raw) > end + 4:
            break
    if end is None or raw[end:] != b"\r\n\r\n":
        raise Damaged("the record doesn't end where its length says")
    return headers, _checked(headers, bytes(raw[start:end])), at - len(z.unused_data)


def salvage(stream) -> Iterator[Found]:
    """All valid records of a stream in order, and the gaps between them."""
    w, gap, reason = _Window(stream), None, ""
    while w.fill(10):
        try:
            headers, payload, size = (_member if w.buf[:2] == b"\x1f\x8b" else _bare)(w)
        except Damaged as e:
            if gap is None:
                gap, reason = w.at, str(e)
            while True:  # to the next possible start
                hit = _START.search(w.buf, 1)
                if hit:
                    w.drop(hit.start())
                    break
                w.drop(max(0, len(w.buf) - 6) if not w.ended else len(w.buf))
                if w.ended:
                    break
                w.fill(len(w.buf) + 1)
            continue
        if gap is not None:
            yield Found(gap, w.at - gap, reason=reason)
            gap = None
        yield Found(w.at, size, headers, payload)
        w.drop(size)
    if gap is not None:
        yield Found(gap, w.at - gap, reason=reason)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to) from (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    base = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.unhex(F.sha1(html)).alias("digest"), (F.octet_length(html) >= MIN_REVISIT).alias("large"))
    again = base.where("large").groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null")
    again = broadcast_if_small(materialize(again.select("digest", "kept")), BROADCAST_DIGESTS)
    refers_to = F.when(F.col("large") & ~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return base.join(again, "digest", "left").select("page_id", "url", "html", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html) under `folder`; returns (path, records, bytes), one row per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")], strict=True))
        row, k, done = next(rows, None), 0, []
        while row is not None:
            path, size, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{k:04d}.warc.gz", 0, 0
            with replacing(path) as out:
                while row is not None and size < FILE_BYTES:
                    page_id, url, html, refers_to = row
                    raw = member(record(page_id, url, html.encode(), refers_to))
                    out.write(raw)
                    size, n, row = size + len(raw), n + 1, next(rows, None)
            done.append((path, n, size))
            k += 1
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    return materialize(with_revisits(pages).mapInArrow(write, "path string, records long, bytes long"))


def _id(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the files in column `path`. A task reads one file at a time and holds one record of it.

    Columns: path, offset, length, reason (gaps only), page_id, record_type, payload_bytes, payload_digest, refers_to, and html
    unless payloads is False. Sizes and digests are those of the payload read; a revisit has them in its header.
    """

    longs = ("offset", "length", "page_id", "payload_bytes", "refers_to")
    names = ["path", "offset", "length", "reason", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "html"][: 9 + payloads]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array([r[k] for r in held], pa.int64() if c in longs else pa.string()) for k, c in enumerate(names)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with reading(path) as stream:
                    for f in salvage(stream):
                        if f.headers is None:
                            held.append((path, f.offset, f.length, f.reason, None, None, None, None, None, None))
                            continue
                        h, p = f.headers, f.payload
                        n, digest = (len(p), hashlib.sha1(p).hexdigest()) if p is not None else (int(h.get("x-payload-length", 0)), h.get("warc-payload-digest", "").rpartition(":")[2])
                        held.append((path, f.offset, f.length, None, _id(h.get("warc-record-id")), h.get("warc-type"), n, digest, _id(h.get("warc-refers-to")), p.decode("utf-8", "replace") if payloads and p is not None else None))
                        size += f.length
                        if len(held) >= 1000 or size >= 8 << 20:
                            yield out()
                            size = 0
        yield out()

    schema = ", ".join(f"{c} {'long' if c in longs else 'string'}" for c in names)
    return files.select("path").repartition(max(1, files.count())).mapInArrow(read, schema)


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), shared_dir(spark))
    found = read_archives(archives, payloads=False)
    # these archives are fresh: a gap is an error, not something to leave out
    sound = F.when(F.col("reason").isNotNull(), F.raise_error(F.concat_ws(" ", F.lit("a gap in"), "path", F.lit("at"), "offset", "reason"))).otherwise(F.col("record_type"))
    return found.select("page_id", "payload_bytes", "payload_digest", sound.alias("record_type"), "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest AS d, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN g ON payload_digest = d AND payload_bytes >= 1000
"""
