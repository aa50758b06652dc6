"""WARC archives: segmented records written and read as Spark jobs.

Writing: pages become WARC/1.1 records (response, or revisit of the first page
with the same payload) with chunked transfer framing; a record block longer
than a segment is split into a first record and continuation records. Records
leave through Spark's text writer whose line separator is the blank line that
ends every WARC record, so archives go wherever Spark can write.

Reading: archives come in as binary files, are parsed record by record, and
continuation records are grouped by their origin, ordered by segment number,
checked against the total length and decoded.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm.common import in_pandas

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_ARCHIVE = 4_000
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"

RECORD_SCHEMA = (
    "warc_type string, record_id string, target_uri string, page_id long, refers_to string, payload_digest string, "
    "segment_number long, origin_id string, total_length long, block binary"
)
PAGE_SCHEMA = (
    "record_id string, warc_type string, target_uri string, page_id long, refers_to string, payload_digest string, "
    "payload binary, payload_bytes long, error string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def header_value(value: str) -> str:
    """A header line cannot hold line breaks or other control characters; they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    out = [
        b"%x\r\n%s\r\n" % (len(part), part)
        for part in (payload[i : i + chunk_bytes] for i in range(0, len(payload), chunk_bytes))
    ]
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The content of a chunked body. ValueError if its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:end].split(b";")[0].strip() or b"x", 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + CRLF + block


def page_records(row, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The WARC records of a page, each without the blank line that ends it."""
    page_id = None if pd.isna(row.page_id) else int(row.page_id)
    payload = (row.html or "").encode()
    digest = payload_digest(payload)
    # of a shared payload there is one response, which revisits can name without knowing its row
    own = record_urn("response", page_id, digest) if row.shared and not row.revisit else record_urn(page_id, digest, row.row)
    fields = [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if row.url is not None:
        fields.append(("WARC-Target-URI", header_value(row.url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if row.revisit:
        target = None if pd.isna(row.first_id) else int(row.first_id)
        extra = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_urn("response", target, digest)),
        ]
        yield record_bytes([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *fields, *extra], http)
        return
    block = http + chunked(payload, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    for n, part in enumerate(parts, 1):
        segment = [("WARC-Segment-Number", str(n))] if len(parts) > 1 else []
        if n == 1:
            yield record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", own), *fields, *segment], part)
            continue
        segment.append(("WARC-Segment-Origin-ID", own))
        if n == len(parts):
            segment.append(("WARC-Segment-Total-Length", str(len(block))))
        kind = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_urn(own, n)), ("WARC-Date", DATE)]
        yield record_bytes([*kind, *segment], part)


def with_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages with row, shared, revisit and first_id: of equal payloads the smallest page_id is the response.

    A null page_id comes last; ties go by url, then by the row's place in the
    input. That place is computed on both sides of the join, so the input has
    to be a table or another frame that reads back in the same order.
    """
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "row")
    groups = (
        keyed.where(F.octet_length("html") >= min_payload)
        .groupBy("digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("d"), F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    joined = keyed.join(groups, F.col("digest") == F.col("d"), "left")
    return joined.select(
        "page_id",
        "url",
        "html",
        "row",
        "first_id",
        F.col("first_row").isNotNull().alias("shared"),
        F.coalesce(F.col("row") != F.col("first_row"), F.lit(False)).alias("revisit"),
    )


def write_warc(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    min_payload: int = 0,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
) -> None:
    """Write pages (page_id, url, html; other columns are ignored) as gzipped archives into a folder.

    A null html is an empty payload, a null url no target, a null page_id no
    id header. An empty table leaves an empty folder. Records are at most
    ``segment_bytes`` plus headers and archives ``records_per_archive`` records,
    so one archive fits in a task whatever the pages' lengths.
    """

    def records(batches):
        for batch in batches:
            made, size = [], 0
            for row in batch.itertuples(index=False):
                for record in page_records(row, segment_bytes, chunk_bytes):
                    made.append(record)
                    size += len(record)
                    if size > 8 << 20:
                        yield pd.DataFrame({"record": made})
                        made, size = [], 0
            yield pd.DataFrame({"record": made})

    (
        in_pandas(with_revisits(pages, min_payload), records, "record binary")
        .select(F.col("record").cast("string"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_archive)
        .text(path)
    )


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of an (uncompressed) archive. Garbage between records is skipped up to the next record."""
    at = data.find(b"WARC/")
    while at >= 0:
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0:
            return
        fields = {}
        for line in data[at:head_end].split(CRLF)[1:]:
            key, _, value = line.partition(b":")
            fields[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        start = head_end + 4
        length = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else 0
        yield {**fields, "block": data[start : start + length]}
        at = data.find(b"WARC/", start + length)


def unzipped(content: bytes) -> bytes:
    """An archive's bytes, of one gzip member or many, or as they are."""
    out = io.BytesIO()
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.write(member.decompress(content))
        content = member.unused_data
    out.write(content)
    return out.getvalue()


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and value.isdigit() else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every archive under a folder, as stored (segments apart)."""

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                made, size = [], 0
                for r in parse_records(unzipped(bytes(content))):
                    digest = r.get("warc-payload-digest")
                    made.append(
                        (
                            r.get("warc-type"),
                            r.get("warc-record-id"),
                            r.get("warc-target-uri"),
                            _number(r.get("x-page-id", "").lstrip("-")) if "x-page-id" in r else None,
                            r.get("warc-refers-to"),
                            digest and digest.removeprefix("sha1:"),
                            _number(r.get("warc-segment-number")),
                            r.get("warc-segment-origin-id"),
                            _number(r.get("warc-segment-total-length")),
                            r["block"],
                        )
                    )
                    if r.get("x-page-id", "").startswith("-") and made[-1][3] is not None:
                        made[-1] = (*made[-1][:3], -made[-1][3], *made[-1][4:])
                    size += len(r["block"])
                    if size > 8 << 20:
                        yield records_frame(made)
                        made, size = [], 0
                yield records_frame(made)

    columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    numbers = ["page_id", "segment_number", "total_length"]

    def records_frame(made):
        return pd.DataFrame(made, columns=columns).astype({c: "Int64" for c in numbers})

    # nothing is listed under a folder without archives; the schema then stands for the empty result
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return in_pandas(files, parse, RECORD_SCHEMA)


def decoded(batches):
    """Pages out of records with their segments in order; what is wrong goes to ``error``."""
    for batch in batches:
        made = []
        for r in batch.itertuples(index=False):
            block, error, payload = b"".join(bytes(b) for b in r.blocks), None, None
            numbers = [int(n) for n in r.numbers]
            total = None if pd.isna(r.total_length) else int(r.total_length)
            if r.record_id is None:
                error = "segments without their first record"
            elif numbers and numbers != list(range(1, len(numbers) + 1)):
                error = "segments are missing or repeated"
            elif numbers and total is None:
                error = "the last segment is missing"
            elif total is not None and total != len(block):
                error = "the segments have another total length"
            elif r.warc_type == "response":
                head, sep, body = block.partition(b"\r\n\r\n")
                try:
                    if not sep:
                        raise ValueError("HTTP headers do not end")
                    framed = re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head)
                    payload = dechunked(body) if framed else body
                    if r.payload_digest and payload_digest(payload) != r.payload_digest:
                        error = "the payload has another digest"
                except ValueError as bad:
                    error = str(bad)
            made.append(
                (r.record_id, r.warc_type, r.target_uri, r.page_id, r.refers_to, r.payload_digest, payload,
                 None if payload is None else len(payload), error)
            )
        columns = [c.split()[0] for c in PAGE_SCHEMA.split(", ")]
        yield pd.DataFrame(made, columns=columns).astype({"page_id": "Int64", "payload_bytes": "Int64"})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the archives: payloads reassembled, framing undone, revisits as stored.

    Only segmented records are shuffled. A record whose segments are missing,
    repeated, or of another total length, or whose framing or digest is broken,
    keeps its row with a null payload (or the payload that disagrees) and an
    ``error``; continuation records without their first record make one row too.
    """
    records = read_records(spark, path)
    head = ["record_id", "warc_type", "target_uri", "page_id", "refers_to", "payload_digest"]
    alone = F.col("origin_id").isNull() & F.col("segment_number").isNull()
    whole = records.where(alone).select(
        *head, "total_length", F.array("block").alias("blocks"), F.expr("cast(array() as array<bigint>)").alias("numbers")
    )
    first = F.col("origin_id").isNull()
    segments = (
        records.where(~alone)
        .groupBy(F.coalesce("origin_id", "record_id").alias("origin"))
        .agg(
            *[F.max(F.when(first, F.col(c))).alias(c) for c in head],
            F.max("total_length").alias("total_length"),
            F.array_sort(F.collect_list(F.struct("segment_number", "block"))).alias("s"),
        )
        .select(*head, "total_length", F.col("s.block").alias("blocks"), F.col("s.segment_number").alias("numbers"))
    )
    return in_pandas(whole.unionByName(segments), decoded, PAGE_SCHEMA)


def resolve_revisits(pages: DataFrame) -> DataFrame:
    """Revisit rows with the payload length of the response they refer to, and its page_id as ``refers_to_page``."""
    responses = pages.where("warc_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to_page"), F.col("payload_bytes").alias("target_bytes")
    )
    joined = pages.join(responses, F.col("refers_to") == F.col("target"), "left")
    lost = (F.col("warc_type") == "revisit") & F.col("target").isNull()
    return joined.withColumns(
        {
            "payload_bytes": F.coalesce("payload_bytes", "target_bytes"),
            "error": F.when(lost, F.lit("the revisited response is missing")).otherwise(F.col("error")),
        }
    ).drop("target", "target_bytes")
