"""WARC archives: written as files of WARC/1.1 records, read by a salvage reader.

Writing: one record a page. Of pages with equal payloads of at least
``least`` bytes, the one with the largest page_id is the response, the others
revisit it. The text sink writes the records; its line separator is the end of a
record. A file has at most ``records`` records, and fewer of larger pages (64 MB
or one record), so a reader's task holds a bounded archive.

Reading: plain records and gzip members (one record each). A record whose
version line, headers, length, end or digest fails is given up; the reader
searches for the next member or version line from which a record passes all
checks, goes on there, and logs the bytes between as a quarantined gap.

Defined results: null html is an empty payload; pages that share the largest
page_id of a payload are all responses; a null page_id reads back as null and
revisits a known one; a null url is left out, characters that a header cannot
hold are percent-encoded; a very long page has a file of its own; other columns
are ignored, also those named like the result's; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.llm.work import keep, ship_code, work_dir

DATE = "2024-01-01T00:00:00Z"  # of all records, so that reruns write the same bytes
RECORDS = 2_000
#: Payload bytes below which a file has so many records: files of 64 MB at most, or of one record.
FILE_CLASSES = [(32 << 10, RECORDS), (1 << 20, 64), (None, 1)]
MEMBER_STEP = 1 << 16  # compressed bytes taken at once
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEXT = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a SHA-1: five hex digits are four base-32 digits."""
    hex_ = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hex_, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, refers_to)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html")).withColumns({
        "payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": base32_sha1(payload.cast("binary"))})
    groups = keep(rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(
        F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1").select("payload_digest", "last"), "payloads")
    first = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return rows.join(groups, "payload_digest", "left").withColumn("refers_to", first).drop("last")


def record(rows: DataFrame) -> Column:
    """The record of a row of ``with_revisits``, without its end."""
    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    empty = F.lit("")
    return F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", url), empty),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE)),
                                 line("X-Payload-Length", F.col("payload_bytes").cast("string")))).otherwise(empty),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, least: int = 0, records: int = RECORDS) -> None:
    """Archive files under ``path``, a folder for each class of payload sizes, so
    that a file is bounded in bytes, whatever its records' sizes."""
    rows = with_revisits(pages, least)
    size = F.octet_length(F.coalesce("html", F.lit("")))
    sizes = F.lit(0)
    for below, _ in FILE_CLASSES[:-1]:
        sizes = sizes + (size >= below).cast("int")
    there = {r[0] for r in pages.select(sizes.alias("class")).distinct().collect()}  # three numbers at most
    for k in sorted(there) or [0]:
        (rows.where(sizes == k).select(record(rows).alias("value")).write.option("lineSep", END)
         .option("maxRecordsPerFile", min(records, FILE_CLASSES[k][1])).text(f"{path}/size={k}"))


def _plain_record(data: bytes, at: int) -> tuple[dict, int]:
    """Headers (with block and payload) of the record at ``at``, and its end. ValueError if any check fails."""
    head = data.find(b"\r\n\r\n", at)
    if not re.match(rb"WARC/1\.[01]\r\n", data[at:at + 10]) or head < 0:
        raise ValueError("no version line and headers")
    fields = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header without colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit():
        raise ValueError("no length")
    begin = head + 4
    end = begin + int(size)
    block = data[begin:end]
    if len(block) < int(size) or data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("the block does not end where its length says")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        http = block.find(b"\r\n\r\n")
        if http < 0:
            raise ValueError("no HTTP headers")
        payload = block[http + 4:]
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") != "revisit" and digest.startswith("sha1:"):
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest[5:]:
            raise ValueError("the payload's digest differs")
    return fields | {"payload": payload}, end + 4


def _record_at(data: bytes, at: int) -> tuple[dict, int]:
    if data[at:at + 2] == b"\x1f\x8b":
        member, parts, to = zlib.decompressobj(31), [], at
        try:
            while not member.eof and to < len(data):
                piece = data[to:to + MEMBER_STEP]
                parts.append(member.decompress(piece))
                to += len(piece)
        except zlib.error as e:
            raise ValueError(f"broken member: {e}") from None
        if not member.eof:
            raise ValueError("a member without end")
        inner = b"".join(parts)
        fields, end = _plain_record(inner, 0)
        if end != len(inner):
            raise ValueError("a member with more than its record")
        return fields, to - len(member.unused_data)
    return _plain_record(data, at)


def salvage(data: bytes):
    """("record", start, end, fields) and ("gap", start, end, reason), in order, without a byte left out."""
    at, n = 0, len(data)
    while at < n:
        try:
            fields, end = _record_at(data, at)
            yield "record", at, end, fields
            at = end
        except ValueError as e:
            begin, reason = at, str(e)
            while True:
                found = _NEXT.search(data, at + 1)
                at = found.start() if found else n
                if at >= n:
                    break
                try:
                    _record_at(data, at)
                    break
                except ValueError:
                    continue
            yield "gap", begin, at, {"reason": reason}


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


READ_SCHEMA = ("path string, start long, stop long, kind string, page_id long, url string, record_type string, "
               "payload_digest string, payload_bytes long, refers_to long, payload binary, reason string")


def _read(payloads: bool):
    def run(batches):
        names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(),
                 pa.int64(), pa.int64(), pa.binary(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 12, kinds)], names)

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows, held = [], 0
                for kind, start, stop, f in salvage(content.as_py()):
                    if kind == "gap":
                        rows.append((path, start, stop, kind, *[None] * 7, f["reason"]))
                        continue
                    revisit = f.get("warc-type") == "revisit"
                    size = int(f.get("x-payload-length", "0")) if revisit else len(f["payload"])
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((path, start, stop, kind, _page(f.get("warc-record-id")), f.get("warc-target-uri"),
                                 f.get("warc-type"), digest, size, _page(f.get("warc-refers-to")),
                                 f["payload"] if payloads else None, None))
                    held += len(f["payload"]) if payloads else 0
                    if len(rows) >= 5_000 or held > 8_000_000:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)
    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archive files under ``path``."""
    ship_code(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(_read(payloads), READ_SCHEMA)


def gaps(archives: DataFrame) -> DataFrame:
    """The log of quarantined bytes of ``read_archives``: (path, start, stop, reason)."""
    return archives.where("kind = 'gap'").select("path", "start", "stop", "reason")


def archived_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back. A
    byte gap in them is an error: nothing of one's own archives may be left out."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(pages, path, least)
    gap = F.raise_error(F.concat_ws(" ", F.lit("gap in"), "path", F.col("start"), F.col("stop"), "reason")).cast("boolean")
    return read_archives(spark, path, payloads=False).where(F.when(F.col("kind") == "gap", gap).otherwise(True)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
