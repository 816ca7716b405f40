"""WARC archives with revisit records, and their resolution when read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_per_key

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"
_HEADERS = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, target_uri string"


@F.pandas_udf(T.StringType())
def _base32(digest: pd.Series) -> pd.Series:
    return digest.map(lambda d: base64.b32encode(bytes(d)).decode())


def _payload() -> Column:
    return F.coalesce("html", F.lit(""))


def plan_records(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """row, digest, record_type, refers_to for ``rows(row, page_id, digest, size)`` with distinct ``row``.

    Of the rows of one payload of at least ``min_bytes`` bytes, that with the largest page_id is the response (one of
    them, where a page is repeated; a null page_id is the least), the others revisit it; smaller payloads are all
    responses. Only headers are shuffled, and those of a frequent payload stay where they are.
    """
    originals = rows.groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("original"), F.count("*").alias("n"))
    revisit = (F.col("size") >= min_bytes) & (F.col("row") != F.col("original.row"))
    return join_per_key(rows, originals, "digest").select(
        "row", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("original.page_id")).alias("refers_to")
    )


def write_archives(pages: DataFrame, path: str, file_bytes: int = 128 << 20, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", scratch: Scratch | None = None) -> None:
    """Writes ``pages(page_id, url, html)`` as gzipped WARC 1.1 files: payloads once, revisits with fresh headers.

    A null html is an empty payload; a null url becomes a URI made of the page_id. Records are written by classes of
    size, with as many in a file as ``file_bytes`` hold of the largest of the class, so that a file has at most that
    many bytes or one record. A file is one gzip stream.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", _payload().alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    rows = scratch.save(rows, "rows", "zstd")
    plan = scratch.save(plan_records(rows.select("row", "page_id", "digest", "size"), min_bytes), "plan")
    uri = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.concat(F.lit(_ID), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    size = F.col("size").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    block = F.when(F.col("record_type") == "response", F.concat(http, "html")).otherwise(http)
    target = F.concat(F.lit(f"WARC-Refers-To: <{_ID}"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(">\r\n"))
    revisit = F.when(F.col("record_type") == "revisit", F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\n"), target)).otherwise("")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type", F.lit(f"\r\nWARC-Record-ID: <{_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("#"), F.col("row").cast("string"),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), _base32(F.unhex("digest")), F.lit("\r\n"), revisit,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), "block",
    )
    least = -1
    for most in (*(c for c in (64 << 10, 4 << 20) if c < file_bytes), file_bytes, None):
        part = rows.where(F.col("size") > least) if most is None else rows.where(F.col("size").between(least + 1, most))
        records = part.drop("digest").join(plan.hint("merge"), "row").withColumn("block", block).select(record.alias("value"))
        if least < 0 or part.limit(1).count():
            # A record ends with the separator, so that Spark's text writer makes whole WARC files.
            out = records.write.mode("overwrite" if least < 0 else "append").option("lineSep", "\r\n\r\n").option("compression", "gzip")
            out.option("maxRecordsPerFile", max(1, file_bytes // most) if most else 1).text(path)
        least = most
    scratch.drop("rows", "plan")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, by Content-Length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _HEADERS.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())

    def number(value: str | None) -> int | None:
        digits = (value or "").strip("<>").removeprefix(_ID).partition("#")[0]
        return int(digits) if digits else None

    for batch in batches:
        for content in batch.column(0):
            rows = []
            for h, block in parse(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))):
                payload = block.partition(b"\r\n\r\n")[2]
                response = h["warc-type"] == "response"
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else h["warc-payload-digest"].removeprefix("sha1:")
                rows.append((number(h["warc-record-id"]), h["warc-type"], len(payload) if response else None, digest, number(h.get("warc-refers-to")), h.get("warc-target-uri")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, path: str, scratch: Scratch | None = None) -> DataFrame:
    """One row per record, revisits resolved: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri.

    Bytes and digest of a response are those of the payload read; a revisit has those of the response of the page
    that it refers to with its digest, null where the archives lack it.
    """
    scratch = scratch or Scratch(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    headers = scratch.save(files.mapInArrow(_read, _HEADERS), "headers")
    # A response is found by digest and page; a page that is null is a value like others here.
    key = lambda page: F.concat_ws(" ", "payload_digest", page)
    responses = headers.where("record_type = 'response'").groupBy(key("page_id").alias("key")).agg(F.max("payload_bytes").alias("resolved"))
    revisits = headers.where("record_type = 'revisit'").withColumn("key", key("refers_to"))
    counts = revisits.groupBy("key").agg(F.count("*").alias("n")).join(responses, "key", "left")
    known = join_per_key(revisits, scratch.save(counts, "responses"), "key")
    known = known.select("page_id", F.col("resolved").alias("payload_bytes"), F.when(F.col("resolved").isNotNull(), F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to", "target_uri")
    return headers.where("record_type = 'response'").select(known.columns).unionByName(known)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and resolves their revisits.

    One row per row of ``pages``, without page_id too; see ``plan_records``. Other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    write_archives(pages, scratch.path("archives"), min_bytes=min_bytes, scratch=scratch)
    out = read_archives(pages.sparkSession, scratch.path("archives"), scratch).drop("target_uri")
    scratch.drop("archives")
    return out
