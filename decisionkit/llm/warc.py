"""WARC revisit resolution: digests are shuffled, not payloads; archives are written without repeated payloads and read back.

Headers (digests and lengths) of payloads of at least ``least`` bytes are grouped; of equal payloads the record with the largest page id is the response, the
others become revisit records that refer to it. SHA-1, which the records carry, is joined by SHA-256 and the length when payloads are
compared. Every record gets fresh headers. Spark's text writer puts the records down: its line separator is the blank lines
that end a WARC record, so each part file is a WARC file (compressed by gzip). Reading back follows the records' own
lengths, checks each payload's digest, and resolves revisits by joining them to their responses.

Nulls and odd rows: null html is the empty payload; a null page id is smaller than any other and reads back as null; rows repeated with the largest
page id are all responses; line breaks in a url are written as %0D and %0A; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filled, scratch_path, staged

LEAST_BYTES, RECORDS_PER_FILE = 1000, 20_000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def resolved(pages: DataFrame, least: int = LEAST_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, html, size, digest, original (the response's page id for revisits)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), filled(F.col(html_col)).alias("html"))
    body = F.encode("html", "UTF-8")
    rows = rows.select("*", F.octet_length("html").cast("long").alias("size"), F.sha1(body).alias("digest"), F.sha2(body, 256).alias("check"))
    same = rows.where(F.col("size") >= least).groupBy("digest", "check", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("records"))
    same = staged(same.where("records > 1 and original is not null").select(F.col("digest").alias("d"), F.col("check").alias("c"), F.col("size").alias("s"), "original"), "originals")
    joined = rows.join(same, (rows["digest"] == same["d"]) & (rows["check"] == same["c"]) & (rows["size"] == same["s"]), "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select("page_id", "url", "html", "size", "digest", F.when(revisit, F.col("original")).alias("original"))


def records(rows: DataFrame, date: str = DATE) -> DataFrame:
    """One WARC record per row, without its closing blank lines."""
    lines = lambda *cs: F.concat_ws("\r\n", *cs)
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    again = F.col("original").isNotNull()
    http = F.concat(lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), field("Content-Length", F.col("size").cast("string"))), F.lit(END))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    length = (F.octet_length(http) + F.when(again, F.lit(0).cast("long")).otherwise(F.col("size"))).cast("string")
    head = lines(
        F.lit("WARC/1.1"),
        field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _record_id(F.col("page_id"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, lines(field("WARC-Refers-To", _record_id(F.col("original"))), F.lit(f"WARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        field("Content-Length", length),
    )
    return rows.select(F.concat(head, F.lit(END), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, **names: str) -> None:
    writer = records(resolved(pages, least, **names)).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _chunks(body: bytes) -> Iterator[bytes]:
    """The plain bytes of an archive, a megabyte at a time."""
    if body[:2] != b"\x1f\x8b":
        yield body
        return
    while body:
        member = zlib.decompressobj(31)
        while not member.eof and body:
            yield member.decompress(body, 1 << 20)
            body = member.unconsumed_tail
            if not body and not member.eof:
                yield member.flush()
        body = member.unused_data


def parsed(body: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive; lengths, not separators, tell where a record ends."""
    held, source = bytearray(), _chunks(body)

    def more() -> bool:
        part = next(source, None)
        if part is not None:
            held.extend(part)
        return part is not None

    while True:
        while (cut := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends inside a header")
                return
        lines = held[:cut].decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        size = int(headers["Content-Length"])
        while len(held) < cut + 8 + size:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield headers, bytes(held[cut + 4 : cut + 4 + size])
        del held[: cut + 8 + size]


def _page(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "size", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for headers, block in parsed(content.as_py()):
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                kind = headers["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not have its digest")
                rows.append((_page(headers["WARC-Record-ID"]), len(payload) if kind == "response" else None, digest, kind, _page(headers.get("WARC-Refers-To"))))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_archives(spark, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; revisits have their response's length."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = staged(files.mapInArrow(_read, "page_id long, size long, payload_digest string, record_type string, refers_to long"), "records")
    full = found.where("record_type = 'response'").select(F.col("page_id").alias("__of"), F.col("payload_digest").alias("__digest"), F.col("size").alias("__size")).distinct()
    to = (found["refers_to"] == full["__of"]) & (found["payload_digest"] == full["__digest"])
    return found.join(full, to, "left").select("page_id", F.coalesce("size", "__size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def archived(pages: DataFrame, least: int = LEAST_BYTES, **names: str) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, least, **names)
    return read_archives(pages.sparkSession, path)
