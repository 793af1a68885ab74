"""WARC archives of pages: a writer, and a reader that salvages damaged ones.

Writing: each page is a record in a gzip member of its own. Of pages with
equal payloads the one with the smallest id is a response, the others are
revisits of it, without the payload. Tasks fill archives of about
``ARCHIVE_MB``; each is one row and becomes one file through Spark's text
writer, whose commit protocol keeps a task that runs twice from leaving two
copies. An archive's last record is small, so the last byte of its gzip
trailer (the top byte of a length) is zero; the row goes without that byte,
and the writer's line end, set to a zero byte, puts it back.

Reading: Spark reads the files whole (their size is bounded) and a task walks
through each. A gzip member must inflate with the right checksum, a record
must have a version line, headers, a block of the stated length, the end
mark, and the stated digests; a page's record has to state a digest of its
header lines, too, so that a damaged id is noticed. After a failed check the
reader looks for the next place at which a member or a version line begins
that passes all checks, goes on there, and reports the bytes between as a gap.
Of a member that breaks off or fails its checksum, what did inflate is
searched in the same way, and so is a sound member with a damaged record; from
a member that isn't sound only records with a digest of their block count.
Gaps inside a member have ``member_offset``, counted in inflated bytes (as is
their length); ``offset`` is the member's.

Defined results: null html is an empty payload; a null url gives a record
without a target; pages with a null id are responses without an id; rows with
the same id and payload are two responses; an empty table gives no archive;
further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlab.llm.common import column, slices

ARCHIVE_MB = 16
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_DIGEST_LINE = b"X-Header-Digest: sha1:"
_LAST = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:archive:end>\r\nWARC-Date: " + _DATE.encode() + b"\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
RECORD = ("path string, offset bigint, length bigint, member_offset bigint, gap string, record_type string, record_id string, target_uri string, "
          "refers_to string, payload_digest string, payload_bytes bigint, payload binary")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page: str, url: str | None, refers: str | None, digest: str, payload: bytes | None, size: int) -> bytes:
    """One record. The digest and size are those of the full payload, also in a revisit."""
    block = _HTTP % size + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {_DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
            f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines = "\r\n".join(head).encode() + b"\r\n"
    return lines + _DIGEST_LINE + sha1_base32(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(df: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", level: int = 6) -> None:
    """Writes the archives of all rows to the folder ``path``."""
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(payload_col, F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("size", F.octet_length("payload").cast("bigint")).withColumn("sha1", F.sha1("payload"))
    first = pages.where(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    later = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    typed = pages.join(first, ["sha1", "size"], "left").withColumn("refers", later).select(
        F.col("page_id").cast("string").alias("page"), "url", F.col("refers").cast("string").alias("refers"), "sha1", "size",
        F.when(F.col("refers").isNull(), F.col("payload")).alias("payload"))

    def fill(batches):
        held, size = [], 0

        def archive():
            return pa.RecordBatch.from_pydict({"value": pa.array([b"".join([*held, gzip.compress(_LAST, 9, mtime=0)])[:-1]], pa.binary())})

        for part in slices(batches, "payload", 1 << 20):
            for page, url, refers, sha1, n, payload in zip(*(c.to_pylist() for c in part.columns)):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                held.append(gzip.compress(record("response" if refers is None else "revisit", page or "", url, refers, digest, payload, n), level, mtime=0))
                size += len(held[-1])
                if size >= ARCHIVE_MB << 20:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    typed.mapInArrow(fill, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", 1).text(path)


class Damaged(ValueError):
    pass


def parse_record(data, at: int, digest_needed: bool = False) -> tuple[dict, bytes, int]:
    """Headers (names in lower case), block and end of the record at ``at``."""
    if not _VERSION.match(data, at):
        raise Damaged("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damaged("headers without an end")
    head, lines = {}, data[at:head_end].split(b"\r\n")
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit() or not all(head.get(k) for k in ("warc-type", "warc-record-id", "warc-date")):
        raise Damaged("no length, type, id or date")
    if "x-header-digest" in head or "x-payload-length" in head or head["warc-record-id"].startswith("<urn:page:"):
        upto = head_end - len(lines[-1])
        if lines[-1] != _DIGEST_LINE + sha1_base32(data[at:upto]).encode():
            raise Damaged("another header digest")
    start = head_end + 4
    end = start + int(head["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("the block has another length")
    block = data[start:end]
    stated = head.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise Damaged("another block digest")
    if digest_needed and not stated.startswith("sha1:"):
        raise Damaged("no block digest, in a member that isn't sound")
    payload = block.partition(b"\r\n\r\n")[2]
    stated = head.get("warc-payload-digest", "")
    if head["warc-type"] == "response" and stated.startswith("sha1:") and stated[5:] != sha1_base32(payload):
        raise Damaged("another payload digest")
    return head, payload, end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The member at ``at`` and its end."""
    inner, end, fault = inflated(data, at)
    if fault:
        raise Damaged(fault)
    return inner, end


def inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What of the member at ``at`` inflates, where it ends or breaks off, and the fault, if any."""
    z, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not z.eof:
        piece = view[at:at + (1 << 16)]
        if not piece:
            return b"".join(out), at, "a member without an end"
        before = z.copy()
        try:
            out.append(z.decompress(piece))
        except zlib.error as e:
            k = 0       # the output of this piece is lost with the error: byte by byte up to it
            try:
                while True:
                    out.append(before.decompress(piece[k:k + 1]))
                    k += 1
            except zlib.error:
                return b"".join(out), at + k, f"a member that doesn't inflate: {e}"
        at += len(piece) - len(z.unused_data)
    return b"".join(out), at, None


def unit(data: bytes, at: int, digest_needed: bool = False) -> tuple[list, int | None, str | None]:
    """Records (headers, payload) of the member or plain record at ``at``, its
    end, and the fault, if any; with a fault, the records are those recovered
    from it and the end is unknown. A gap inside a member is an entry (None,
    (offset, length, reason)) among the records."""
    try:
        if data[at:at + 2] != b"\x1f\x8b":
            head, payload, end = parse_record(data, at, digest_needed)
            return [(head, payload)], end, None
    except Damaged as e:
        return [], None, str(e)
    inner, end, fault = inflated(data, at)
    found, good = [], False
    for k, n, records, gap in salvage(inner, _VERSION, fault is not None):
        found += [(None, (k, n, gap))] if gap else records
        good = good or not gap
    if not good and (fault or inner):
        return [], None, fault or found[0][1][2]
    if fault:
        found.append((None, (len(inner), 0, fault)))
    return found, None if fault else end, fault


def salvage(data: bytes, starts: re.Pattern = _START, digest_needed: bool = False):
    """(offset, length, records, None) for what passes its checks or was
    recovered from a damaged member, and (offset, length, [], reason) for each
    gap between. ``starts``: what a record or member may begin with."""
    at, ahead = 0, None
    while at < len(data):
        records, end, fault = ahead or unit(data, at, digest_needed)
        ahead = None
        if fault is None:
            yield at, end - at, records, None
            at = end
            continue
        stop = len(data)
        for m in starts.finditer(data, at + 1):
            ahead = unit(data, m.start(), digest_needed)
            if ahead[0]:
                stop = m.start()
                break
            ahead = None
        yield at, stop - at, records, None if records else fault
        at = stop


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, glob: str = "part-*") -> DataFrame:
    """A row for each record, and for each gap (``gap``: the failed check, else null)."""
    bare = re.compile("<urn:page:(.*)>")
    names = [x.split()[0] for x in RECORD.split(", ")]

    def work(batches):
        for batch in batches:
            for name, data in zip(column(batch, "path").to_pylist(), column(batch, "content")):
                rows, size = [], 0
                for at, n, records, gap in salvage(data.as_py()):
                    if gap:
                        rows.append((name, at, n, None, gap, *[None] * 7))
                    for head, payload in records:
                        if head is None:        # a gap inside a member
                            rows.append((name, at, payload[1], payload[0], payload[2], *[None] * 7))
                            continue
                        own = lambda key: (m[1] or None) if (m := bare.fullmatch(head.get(key, ""))) else None
                        kind = head["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        full = len(payload) if kind == "response" else int(head.get("x-payload-length", "0"))
                        rows.append((name, at, n, None, None, kind, own("warc-record-id"), head.get("warc-target-uri"), own("warc-refers-to"),
                                     head.get("warc-payload-digest", "").removeprefix("sha1:"), full, payload if with_payload else None))
                        size += len(payload) * with_payload
                    if len(rows) >= 5000 or size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    kinds = {"offset": pa.int64(), "length": pa.int64(), "member_offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(k, pa.string())) for k, c in zip(names, zip(*rows))], names)

    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content").mapInArrow(work, RECORD)
