"""WARC archives: writing segmented records, and reassembly on reading.

Writing: one ``response`` record a page, its payload in chunked transfer
framing; of records with equal payloads of at least ``revisit_from`` bytes all
but the one with the smallest id are ``revisit`` records that name it. A record
longer than ``segment_bytes`` is cut into a first segment and ``continuation``
records. Files are written by Spark's text writer with the blank lines that end
a record as its separator, at most ``records_per_file`` segments each, so any
file system Spark can write to will do and a file's size is bounded. Files are
gzipped.

Reading: each file is walked by the records' content lengths. Unsegmented
records are decoded on the spot; segments are shuffled by the identifier of
their origin, ordered by segment number, checked for gaps and against the total
length, then decoded. Incomplete records are returned with ``complete`` false
and no payload figures, and so is what cannot be read as a record: a head cut
short, another length than stated, a damaged gzip member. The walk goes on at the next
line that begins a record. Records of other kinds (``warcinfo``, ``request``) are no rows.

Defined results: a null payload is empty; a null id is written without an id
field and read back as null; a null url is written as an empty target; rows
with equal id and payload are written and read once each; an empty table
gives an archive without files.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import as_text

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
FIELDS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, complete boolean"


# ---- writing


def with_revisits(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Adds ``_digest`` and ``_first`` (the id a revisit refers to, else null)."""
    pages = pages.withColumn("_digest", F.sha2("_payload", 256))
    first = (
        pages.where(F.octet_length("_payload") >= revisit_from)
        .groupBy(F.col("_digest").alias("_same")).agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _least IS NOT NULL").select("_same", "_least")
    )
    joined = pages.join(first, F.col("_digest") == F.col("_same"), "left")
    return joined.withColumn("_first", F.when(~F.col("_id").eqNullSafe(F.col("_least")), F.col("_least"))).drop("_same", "_least")


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{digest}')}>"


def _headed(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def _chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def page_records(
    page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, segment_bytes: int, chunk_bytes: int
) -> list[bytes]:
    """The records (segments) of one page, without the blank lines that end them."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    fields = [("WARC-Record-ID", _record_id(page, digest)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _record_id(first, digest)), ("X-Refers-To-Page-ID", str(first))]
        return [_headed([("WARC-Type", "revisit"), *fields], http + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_headed([("WARC-Type", "response"), *fields], block)]
    out = [_headed([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", "1")], block[:segment_bytes])]
    starts = range(segment_bytes, len(block), segment_bytes)
    for k, at in enumerate(starts, 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{digest}/{k}')}>"),
                ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", _record_id(page, digest)), ("WARC-Segment-Number", str(k))]
        if at + segment_bytes >= len(block):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_headed(more, block[at : at + segment_bytes]))
    return out


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_from: int = 100, segment_bytes: int = 1 << 16, chunk_bytes: int = 1 << 13, records_per_file: int = 1000,
) -> None:
    """Write ``pages`` as WARC files under ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    p = with_revisits(pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload")), revisit_from)

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def number(x):
            return None if pd.isna(x) else int(x)

        for pdf in batches:
            rows: list[bytes] = []
            for page, url, payload, digest, first in zip(pdf["_id"], pdf["_url"], pdf["_payload"], pdf["_digest"], pdf["_first"]):
                rows += page_records(number(page), url, bytes(payload), digest, number(first), segment_bytes, chunk_bytes)
            yield pd.DataFrame({"record": pd.Series(rows, dtype=object)})

    # the cast keeps the bytes as they are
    p.select(as_text("_id").alias("_id"), "_url", "_payload", "_digest", as_text("_first").alias("_first")).mapInPandas(records, "record binary").select(
        F.col("record").cast("string").alias("value")
    ).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


# ---- reading


_MARK = b"WARC/1."
#: record types that become rows; others (warcinfo, request, metadata, conversion, resource) are passed over
PAGE_TYPES = ("response", "revisit", "continuation")


def inflated(data: bytes) -> bytes:
    """All gzip members of ``data``, as far as they can be read; other data as they are."""
    if data[:2] != b"\x1f\x8b":
        return bytes(data)
    out, rest = [], bytes(data)
    while rest[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        try:
            out.append(member.decompress(rest))
        except zlib.error:
            # what the member held before the damage, in small steps
            member, at = zlib.decompressobj(zlib.MAX_WBITS | 16), 0
            try:
                while at < len(rest):
                    out.append(member.decompress(rest[at : at + 512]))
                    at += 512
            except zlib.error:
                pass
            break
        rest = member.unused_data
    return b"".join(out)


def walk(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive file, by content length. What cannot be read as a
    record comes with the field ``broken``: up to the next line that begins one, which is read again."""
    data, at, end = inflated(data), 0, END.encode()
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        lines = data[at:head].split(b"\r\n") if head >= 0 else []
        # other writers' names and values may hold any bytes
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        if not lines or not lines[0].startswith(_MARK) or not length.isdecimal():
            following = data.find(b"\n" + _MARK, at)
            upto = len(data) if following < 0 else following + 1
            if data[at:upto].strip():
                yield {**fields, "broken": "head"}, data[at:upto]
            at = upto
            continue
        block = data[head + 4 : head + 4 + int(length)]
        after = head + 4 + int(length)
        if len(block) < int(length) or data[after : after + 4] not in (end, end[: len(data) - after]):
            # cut short, or of another length than it says
            following = data.find(b"\n" + _MARK, head)
            yield {**fields, "broken": "length"}, block
            at = len(data) if following < 0 else following + 1
            continue
        yield fields, block
        at = after + len(END)


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        out.append(body[at : at + n])
        at += n + 2


def decoded(fields: dict[str, str], block: bytes) -> tuple:
    """A row of FIELDS for a whole record; ``complete`` is false for what could not be read."""
    kind, page = fields.get("warc-type"), _whole_number(fields.get("x-page-id"))
    nothing = (page, None, None, kind, None, False)
    if "broken" in fields:
        return nothing
    head, _, body = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in head.split(b"\r\n")[1:])}
    stated = fields.get("warc-payload-digest", "")
    if kind == "revisit":
        first = _whole_number(fields.get("x-refers-to-page-id"))
        size = _whole_number(http.get("content-length"))
        own = first is not None and size is not None and stated.startswith("sha256:")
        return (page, int(size), stated.partition(":")[2], kind, first, True) if own else nothing
    try:
        payload = unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    except ValueError:
        return nothing
    digest = hashlib.sha256(payload).hexdigest()
    # digests of other algorithms, as other writers state them, are not checked
    return page, len(payload), digest, kind, None, not stated.startswith("sha256:") or len(stated) != 71 or stated == f"sha256:{digest}"


def _whole_number(text: str | None) -> str | None:
    return text if text is not None and re.fullmatch("-?[0-9]{1,19}", text) and -(1 << 63) <= int(text) < 1 << 63 else None


def _is_segment(fields: dict[str, str]) -> bool:
    return "broken" not in fields and (fields.get("warc-segment-number") or "x").isdecimal()


def _is_page(fields: dict[str, str]) -> bool:
    return "broken" in fields or fields.get("warc-type") in PAGE_TYPES


def _rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"])
    return out.astype({"payload_bytes": "Int64"})


def read_archive(spark: SparkSession, path: str, files_like: str = "part-*") -> DataFrame:
    """FIELDS of every page record of the WARC files under ``path`` whose names are ``files_like``
    (``*`` for other writers' archives). A file is read as one value, so it must be under 2 GB."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", files_like).load(path).select("content")

    def unsegmented(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["content"]:
                yield _rows([decoded(f, b) for f, b in walk(data) if _is_page(f) and not _is_segment(f)])

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["content"]:
                rows = [
                    (f.get("warc-segment-origin-id", f.get("warc-record-id", "")), int(f["warc-segment-number"]),
                     int(_whole_number(f.get("warc-segment-total-length")) or -1), "\n".join(f"{k}:{v}" for k, v in f.items()), b)
                    for f, b in walk(data) if _is_page(f) and _is_segment(f)
                ]
                yield pd.DataFrame(rows, columns=["origin", "number", "total", "fields", "block"])

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come ordered by origin and number; one origin's segments are held at a time."""
        origin, held = None, []
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.origin != origin and held:
                    out += reassembled(held)
                    held = []
                origin = row.origin
                held.append(row)
            yield _rows(out)
        if held:
            yield _rows(reassembled(held))

    # as many partitions as the session sets: Spark may not merge or move what is sorted for `joined`
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = (
        files.mapInPandas(segments, "origin string, number int, total long, fields string, block binary")
        .repartition(parts, "origin").sortWithinPartitions("origin", "number").mapInPandas(joined, FIELDS)
    )
    read = files.mapInPandas(unsegmented, FIELDS).unionByName(whole)
    return read.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def reassembled(segments: list) -> list[tuple]:
    """Rows of FIELDS for the segments of one origin, ordered by number. Equal
    records written twice give every number twice."""
    copies = max(1, sum(s.number == 1 for s in segments))
    own = segments[::copies]
    block = b"".join(bytes(s.block) for s in own)
    whole = (
        [s.number for s in segments] == [k for k in range(1, len(own) + 1) for _ in range(copies)]
        and own[-1].total == len(block)
    )
    fields = dict(x.partition(":")[::2] for x in own[0].fields.split("\n"))
    if not whole:
        return [(_whole_number(fields.get("x-page-id")), None, None, fields.get("warc-type"), None, False)]
    return [decoded(fields, block)] * copies
