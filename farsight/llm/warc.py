"""Operator 9 -- WARC writing, and a reader that salvages damaged archives.

Writing is a Spark text sink with CRLF as the line separator, so each row's
string is one record and files go wherever Spark can write.  Equal payloads
are stored once: the record of the smallest page_id is a response, the others
are revisit records that refer to it.

Reading takes whole files through ``binaryFile`` and walks their members and
records.  When a check fails (gzip member, version line, length, terminator,
payload digest), the walker searches for the next place that holds a valid
member or record, goes on from there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.util import checked_broadcast, table, trimmed
from farsight.session import saved, scratch_path

DATE = "2024-01-01T00:00:00Z"
#: Records of a file at most, which bounds what a reading task holds.
FILE_RECORDS = 1500
_CRLF = "\r\n"


def base32_sha1(hex_digest: Column) -> Column:
    """RFC 4648 base 32 of 40 hex digits: 8 digits for each 10."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, compression: str = "none") -> None:
    """Write one WARC/1.1 record per row of ``pages`` (page_id, url, html).

    A null html is an empty payload; a null url leaves out WARC-Target-URI; a
    null page_id sorts last.  Payloads under ``least_bytes`` are always
    responses.  Rows that repeat the smallest page_id of a payload are all
    responses.  An empty table writes no record.  With gzip a file is one
    member of up to FILE_RECORDS records.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.encode("html", "utf-8"))).withColumn("n", F.octet_length("html"))
    seen = saved(rows.where(F.col("n") >= least_bytes).select("page_id", "sha", "n"), "digests")
    first = (seen.groupBy("sha", "n").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1 and refers_to is not null").drop("copies"))
    again = (seen.join(first, ["sha", "n"]).where("page_id is null or page_id > refers_to")
             .select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "refers_to").distinct())
    again = checked_broadcast(again, 96)
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha")), "left")

    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"),
                    line("Content-Length", F.col("n").cast("string")), F.lit(_CRLF))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    record = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("sha")))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", urn(F.col("refers_to"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        line("Content-Length", size.cast("string")),
        F.lit(_CRLF), http, F.when(revisit, "").otherwise(F.col("html")), F.lit(_CRLF))
    (rows.select(record.alias("value")).write.option("lineSep", _CRLF)
     .option("maxRecordsPerFile", FILE_RECORDS).option("compression", compression).text(path))


_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
_MAGIC = b"\x1f\x8b\x08"


class _Bad(Exception):
    """A check failed; ``end`` is where the record ends, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


def _headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for item in raw.decode("utf-8", "replace").splitlines()[1:]:
        name, colon, value = item.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and where it ends.  Raises _Bad if a check fails."""
    if not _VERSION.match(data, at):
        raise _Bad("version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise _Bad("header end")
    h = _headers(data[at:end])
    if not h.get("content-length", "").isdigit():
        raise _Bad("content length")
    body = end + 4
    stop = body + int(h["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise _Bad("record end")
    block = data[body:stop]
    payload, declared = block, len(block)
    if h.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        declared = int(_headers(head).get("content-length") or len(payload))
    kind, digest = h.get("warc-type", ""), h.get("warc-payload-digest", "")
    if kind != "revisit":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest.lower().startswith("sha1:") and digest[5:].upper() != own:
            raise _Bad("payload digest", stop + 4)
        declared, digest = len(payload), own
    return {"type": kind, "record_id": h.get("warc-record-id"), "uri": h.get("warc-target-uri"),
            "date": h.get("warc-date"), "refers_to": h.get("warc-refers-to"), "payload": payload,
            "payload_bytes": declared, "payload_digest": digest.removeprefix("sha1:")}, stop + 4


def _valid(data: bytes, at: int) -> bool:
    try:
        _record(data, at)
    except _Bad as e:
        return e.end is not None
    return True


def walk(data: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """(offset, length, reason of a gap or None, record or None) over plain records."""
    at = 0
    while at < len(data):
        try:
            record, end = _record(data, at)
            yield at, end - at, None, record
        except _Bad as e:
            end = e.end
            if end is None:
                end = next((m.start() for m in _VERSION.finditer(data, at + 1) if _valid(data, m.start())), len(data))
            yield at, end - at, e.reason, None
        at = end


_INPUT = 1 << 16


def _member(data: bytes, at: int) -> tuple[bytes, int | None, str | None]:
    """(content, where the member ends, None), or, of a damaged or cut off
    member, (what comes out before the damage, None, the check that failed)."""
    d, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not d.eof and at < len(data):
        before, part = d.copy(), view[at:at + _INPUT]
        try:
            out.append(d.decompress(part))
        except zlib.error as e:
            for i in range(len(part)):  # the same input again, up to the byte that fails
                try:
                    out.append(before.decompress(part[i:i + 1]))
                except zlib.error:
                    break
            return b"".join(out), None, f"gzip member: {e}"
        at += len(part)
    if not d.eof:
        return b"".join(out), None, "gzip member: cut off"
    return b"".join(out), at - len(d.unused_data), None


def _opens(data: bytes, at: int) -> bool:
    """Whether a member with a record begins at ``at``."""
    try:
        return bool(_VERSION.match(zlib.decompressobj(31).decompress(data[at:at + 65536], 64)))
    except zlib.error:
        return False


def walk_members(data: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """As walk(), over gzip members; offsets are those of the compressed
    member, lengths inside a member those of its content.  Of a damaged member
    the records before the damage are returned, and the member as a gap."""
    at = 0
    while at < len(data):
        content, end, reason = _member(data, at)
        if reason is None:
            for offset, size, gap, record in walk(content):
                if offset == 0 and size == len(content):
                    size = end - at
                yield at, size, gap, record
        else:
            # whole records before the damage count; what it cuts is in the member's gap
            for offset, size, gap, record in walk(content):
                if record is not None or offset + size < len(content):
                    yield at, size, gap, record
            end = data.find(_MAGIC, at + 1)
            while end >= 0 and not _opens(data, end):
                end = data.find(_MAGIC, end + 1)
            end = len(data) if end < 0 else end
            yield at, end - at, reason, None
        at = end


READ_SCHEMA = ("path string, offset long, length long, gap string, type string, record_id string, uri string, "
               "date string, refers_to string, payload binary, payload_bytes long, payload_digest string")


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record or quarantined gap of the files under ``path``.

    ``gap`` is null for records, else the check that failed; offset and
    length locate the bytes.  Every byte of a file belongs to a record or a
    gap.  An empty file gives no rows.  With ``payload`` false the payload
    column is null.  A file that holds a gzip magic at its start is read as
    members, any other as plain records.
    """
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
                            for n, t in (c.split() for c in READ_SCHEMA.split(", "))])
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_py()
                rows, held = [], 0
                for offset, size, gap, record in (walk_members if data[:3] == _MAGIC else walk)(data):
                    row = dict.fromkeys(names) | {"path": name, "offset": offset, "length": size, "gap": gap} | (record or {})
                    if payload:
                        held += len(row["payload"] or b"")
                    else:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(trimmed(parse), READ_SCHEMA)


def gaps(read: DataFrame) -> DataFrame:
    """The log of quarantined byte ranges."""
    return read.where("gap is not null").select("path", "offset", "length", "gap")


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    read = read_warc(spark, path, payload=False).where("gap is null")
    return read.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))


OP9_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS sha, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
f AS (SELECT sha, n, min(page_id) AS f, count(*) AS copies FROM p GROUP BY sha, n),
r AS (SELECT p.*, CASE WHEN copies > 1 AND f IS NOT NULL AND (page_id IS NULL OR page_id > f) THEN f END AS refers_to FROM p JOIN f USING (sha, n))
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((CAST('0x' || substr(sha, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""
