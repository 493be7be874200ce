"""WARC archives: deduplicated writing and a salvage reader.

Records are written through Spark's text sink as one gzip member each, so a
lost task is written again and only committed files are seen. The sink puts a
line separator after each value; here it is an empty gzip member, so a file is
nothing but valid members. Of equal payloads of at least ``SMALL`` bytes one is
stored; the others become revisit records that refer to it.

The reader takes files as bytes and walks them. A gzip member should inflate and
pass its checksum; of one that does not, records whose digests agree are taken.
Digests may be in hex or base32. A record needs a version line, a ``Content-Length`` that
fits, and block and payload digests that agree. After a failed check it searches
for the next member or version line that passes, goes on from there, and reports
the bytes between as a gap. Files should be of a size that a task can hold;
``write`` fills values of ``VALUE_BYTES`` with records and starts a new file after
``FILE_BYTES``, so that a file is larger only by its last records.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SMALL = 1000
VALUE_BYTES, FILE_BYTES = 4 << 20, 128 << 20
VERSION = b"WARC/1.1\r\n"
MEMBER = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
VERSION_LINE = re.compile(rb"WARC/[0-9]\.[0-9]\r?\n")
FOLD = re.compile(rb"\r\n[ \t]+")
LONGEST_HEAD = 1 << 20
GAP = "gap"
CUT_OFF = "member cut off"


def with_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", small: int = SMALL) -> DataFrame:
    """``(page_id, url, html, digest, size, refers_to)``; a null ``refers_to`` makes a response.

    Of equal payloads the one with the largest id is stored. Rows that share
    that id are all stored. A null html is empty; a null id is smaller than any other.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("html"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    copies = rows.filter(F.col("size") >= small).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("least"), F.count("page_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    # Only payloads with several ids have revisits; this keeps the joined side small.
    copies = copies.filter((F.col("least") < F.col("kept")) | ((F.col("n") < F.col("rows")) & F.col("kept").isNotNull()))
    # Small payloads match nothing; keys of their own spread them, as many are equal.
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url", "digest").cast("string"))
    keyed = rows.withColumn("key", F.when(F.col("size") >= small, F.col("digest")).otherwise(alone))
    copies = copies.select(F.col("digest").alias("key"), F.col("size").alias("copy_size"), "kept")
    joined = keyed.join(copies, (keyed["key"] == copies["key"]) & (F.col("size") == F.col("copy_size")), "left")
    other = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", "html", "digest", "size", F.when(other, F.col("kept")).alias("refers_to"))


def name(page_id: int | None) -> bytes:
    return b"<urn:page:%b>" % (b"" if page_id is None else str(page_id).encode())


def record(page_id: int | None, url: bytes | None, payload: bytes, digest: str, refers_to: int | None, date: bytes) -> bytes:
    """The bytes of one record, with the empty lines after it."""
    head = [b"WARC-Record-ID: " + name(page_id), b"WARC-Date: " + date]
    if url:
        head.append(b"WARC-Target-URI: " + b"".join(url.split()))
    if refers_to is None:
        block, kind = HTTP + payload, b"response"
        head.append(b"WARC-Block-Digest: sha1:" + hashlib.sha1(block).hexdigest().encode())
    else:
        block, kind = HTTP, b"revisit"
        head.append(b"WARC-Refers-To: " + name(refers_to))
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"WARC-Block-Digest: sha1:" + hashlib.sha1(block).hexdigest().encode())
    head.append(b"WARC-Payload-Digest: sha1:" + digest.encode())
    head.append(b"X-Payload-Length: %d" % len(payload))
    head.append(b"Content-Type: application/http; msgtype=response")
    head.append(b"Content-Length: %d" % len(block))
    return b"%bWARC-Type: %b\r\n%b\r\n\r\n%b\r\n\r\n" % (VERSION, kind, b"\r\n".join(head), block)


def member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(typed: DataFrame, path: str, date: str | None = None, compressed: bool = True) -> None:
    """The records of ``with_types`` as archives below ``path``; plain records where ``compressed`` is false."""
    told = (date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")).encode()

    def value(held: list[bytes]) -> pa.RecordBatch:
        # What the sink puts after a value is what a plain record ends with.
        data = b"".join(map(member, held)) if compressed else b"".join(held)[:-2]
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in parts:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                columns = [part.column(0), part.column(1).cast(pa.binary()), part.column(2).cast(pa.binary()), part.column(3), part.column(4)]
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in columns)):
                    held.append(record(page_id, url, payload, digest, refers_to, told))
                    size += len(held[-1])
                    if size >= VALUE_BYTES:
                        yield value(held)
                        held, size = [], 0
        if held:
            yield value(held)

    rows = typed.select(F.col("page_id").cast("long"), "url", "html", "digest", F.col("refers_to").cast("long"))
    # The text sink writes a string's bytes as they are.
    values = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    separator = EMPTY_MEMBER.decode("latin-1") if compressed else "\r\n"
    sink = values.write.option("encoding", "ISO-8859-1").option("lineSep", separator)
    sink.option("maxRecordsPerFile", FILE_BYTES // VALUE_BYTES).option("compression", "none").text(path)


class Broken(Exception):
    """A check failed."""


def sha1_bytes(told: str) -> bytes | None:
    """The digest that a header tells in hex or base32; null for another algorithm or spelling."""
    name, _, value = told.partition(":")
    if name.strip().lower() != "sha1":
        return None
    value = value.strip()
    try:
        return bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value, casefold=True) if len(value) == 32 else None
    except (ValueError, binascii.Error):
        return None


def differs(told: str, data: bytes) -> bool:
    """Whether a told sha1 digest is not that of the data; other algorithms are not checked."""
    return told.strip().lower().startswith("sha1:") and sha1_bytes(told) != hashlib.sha1(data).digest()


def spelled(digest: str) -> str | None:
    """A digest in hex where it is sha1, otherwise as told."""
    own = sha1_bytes(digest)
    return own.hex() if own else digest.removeprefix("sha1:").lower() or None


def parsed(data, start: int) -> tuple[dict, int]:
    """The record that begins at ``start`` and where it ends; ``Broken`` if a check fails."""
    line = VERSION_LINE.match(data, start)
    if not line:
        raise Broken("no version line")
    end = data.find(b"\r\n\r\n", line.end() - 2, line.end() + LONGEST_HEAD)
    if end < 0:
        raise Broken("header without end")
    fields: dict[str, str] = {}
    for row in FOLD.sub(b" ", bytes(data[line.end() : end])).split(b"\r\n"):
        key, colon, value = row.partition(b":")
        if not colon:
            raise Broken("header line without a colon")
        fields.setdefault(key.decode("latin-1").strip().lower(), value.decode("utf-8", "replace").strip())
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Broken("no length")
    begin = end + 4
    stop = begin + int(length)
    if stop > len(data):
        raise Broken("block cut off")
    block = bytes(data[begin:stop])
    if differs(fields.get("warc-block-digest", ""), block):
        raise Broken("block digest")
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    kind = fields.get("warc-type", "")
    digest = fields.get("warc-payload-digest", "")
    if kind == "response":
        if differs(digest, payload):
            raise Broken("payload digest")
        digest = hashlib.sha1(payload).hexdigest()
    if data[stop : stop + 4] == b"\r\n\r\n":
        stop += 4
    elif stop != len(data):
        raise Broken("no empty lines after the block")
    return {
        "kind": kind,
        "record_id": fields.get("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "digest": spelled(digest),
        "size": len(payload) if kind == "response" else int(fields.get("x-payload-length") or 0),
        "payload": payload,
        "checked": any(told.strip().lower().startswith("sha1:") for told in (fields.get("warc-block-digest", ""), kind == "response" and fields.get("warc-payload-digest", "") or "")),
    }, stop


def inflated(data: bytes, start: int) -> tuple[bytes, int | None, str]:
    """What inflates of the member at ``start``, where it ends, and an empty reason; zlib checks its sum and length.

    Of a member that fails, what inflated before that, no end, and the reason.
    """
    engine, out, at, step = zlib.decompressobj(31), [], start, 1 << 13
    before = engine.copy()
    try:
        while not engine.eof and at < len(data):
            before = engine.copy()
            out.append(engine.decompress(data[at : at + step]))
            at, step = at + step, min(2 * step, 1 << 20)
    except zlib.error as error:
        try:  # the last piece byte by byte, for what it gives up to the fault
            for k in range(at, min(at + step, len(data))):
                out.append(before.decompress(data[k : k + 1]))
        except zlib.error:
            pass
        return b"".join(out), None, "member: " + str(error)[:80]
    if not engine.eof:
        return b"".join(out), None, CUT_OFF
    return b"".join(out), min(at, len(data)) - len(engine.unused_data), ""


def records_inside(inner: bytes, sound: bool) -> tuple[list[dict], list[str]]:
    """The records of an inflated member, and what was passed over with its reason.

    Where the member is not sound, a record needs a digest that agrees.
    """
    records, passed, at = [], [], 0
    while at < len(inner):
        low, reason = at, ""
        while at >= 0:
            try:
                one, end = parsed(inner, at)
                if not (sound or one["checked"]):
                    raise Broken("no digest in a damaged member")
                break
            except Broken as error:
                reason = reason or str(error)
                at = inner.find(b"WARC/", at + 1)
        if reason:
            passed.append(f"inflated bytes {low} to {len(inner) if at < 0 else at}: {reason}")
        if at < 0:
            break
        records.append(one)
        at = end
    return records, passed


def unit_at(data: bytes, start: int) -> tuple[list[dict], int | None, list[str]]:
    """The records of the member or the plain record at ``start``, where it ends, and reasons of gaps in it.

    A member that breaks off has no end; ``Broken`` if nothing in it is sound.
    """
    if data.startswith(MEMBER, start):
        inner, end, reason = inflated(data, start)
        records, passed = records_inside(inner, end is not None or reason == CUT_OFF)
        reasons = [reason] * bool(reason) + passed
        if reasons and not records:
            raise Broken(reasons[0])
        return records, end, reasons
    one, end = parsed(data, start)
    return [one], end, []


def starts_after(data: bytes, start: int) -> Iterator[int]:
    """Places after ``start`` where a member or a version line may begin, in order."""
    gz, line = data.find(MEMBER, start), data.find(b"WARC/", start)
    while gz >= 0 or line >= 0:
        at = min(x for x in (gz, line) if x >= 0)
        yield at
        gz = data.find(MEMBER, at + 1) if gz == at else gz
        line = data.find(b"WARC/", at + 1) if line == at else line


def next_unit(data: bytes, places: Iterator[int]) -> tuple[int, list[dict], int | None, list[str], str]:
    """The first of ``places`` that holds a unit, the unit, and why the first place held none; the data's end if none does."""
    why = ""
    for at in places:
        try:
            return at, *unit_at(data, at), why
        except Broken as error:
            why = why or str(error)
    return len(data), [], len(data), [], why


def salvaged(data: bytes) -> Iterator[dict]:
    """All records of an archive, and a gap for each stretch that is not covered by sound units.

    A member with faults gives its sound records and a gap of its own for each fault.
    """
    low, unit = 0, None
    while low < len(data):
        at, records, end, reasons, why = unit or next_unit(data, chain([low], starts_after(data, low + 1)))
        unit = None
        if at > low:
            yield {"kind": GAP, "start": low, "end": at, "reason": why}
        if end is None:
            unit = next_unit(data, starts_after(data, at + 1))
            end = unit[0]
        for one in records:
            yield one | {"start": at, "end": end}
        for reason in reasons:
            yield {"kind": GAP, "start": at, "end": end, "reason": reason}
        low = end


FIELDS = ("kind", "record_id", "url", "refers_to", "digest", "size", "payload", "start", "end", "reason")
SCHEMA = (
    "file string, kind string, record_id string, url string, refers_to string, digest string,"
    " size long, payload binary, start long, end long, reason string"
)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives below ``path``; ``payload`` is null if not wanted.

    ``size`` and ``digest`` are those of the full payload, of a revisit as its header
    tells them. Gaps have ``kind`` 'gap', byte range and reason. Empty files give nothing.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[tuple] = []
                held = 0
                for one in salvaged(data.as_py() or b""):
                    if not payloads:
                        one["payload"] = None
                    rows.append((file, *(one.get(field) for field in FIELDS)))
                    held += len(one.get("payload") or b"")
                    if len(rows) == 5000 or held > 8 << 20:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], ["file", *FIELDS])

    return files.mapInArrow(run, SCHEMA)


def records(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind") != GAP).drop("reason")


def gaps(rows: DataFrame) -> DataFrame:
    """The log of quarantined byte ranges: ``(file, start, end, reason)``."""
    return rows.filter(F.col("kind") == GAP).select("file", "start", "end", "reason")


def page_number(record_id: Column) -> Column:
    """The page id of a record's name; null for the empty one."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
