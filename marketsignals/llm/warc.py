"""WARC archives: writing, reading back, and assembling transactions.

Writing makes three records per page: request, response (or revisit) and
metadata, tied by WARC-Concurrent-To.  Spark's text writer stores them, one
row a record, gzipped, under its commit protocol, on any file system that Spark
reaches; CRLF, which ends a record anyway, is the line separator.  Pages are
written by classes of payload size, each into files of so many records that even
the largest payloads of the class stay within ``FILE_BYTES`` of text; a page above
that has a file of its own.  So no file grows with its neighbours, and nothing is
shuffled or sorted for it.

Reading parses the files as WARC: headers up to the empty line, then exactly
Content-Length bytes, record by record from the gzip stream.  Transactions are assembled from the records alone: request
and metadata records join the response or revisit they are concurrent to, and a
revisit joins the response with its payload digest.

Defined results: a null html is an empty payload; null urls and ids are left out
of the records and come back null; pages with the smallest page_id of a group of
equal payloads are responses, all of them if that id repeats; in a group without
any page_id every page is a response; rows that repeat are captures of their own;
other columns are ignored; an empty table makes an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .shared import materialize

LEAST_REVISIT = 100          # bytes; smaller payloads are always stored
FILE_BYTES = 32 << 20        # text of an archive file with more than one page
PAGE_CLASSES = [4 << 10, 128 << 10, 4 << 20, 1 << 62]     # upper payload sizes of the classes
RECORD_BYTES = 1200          # headers of a page's three records, without urls
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(kind: str, row: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(kind), row.cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record; headers with a null value are left out.  The writer adds the second CRLF at its end."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block, F.lit(CRLF))


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               least: int = LEAST_REVISIT) -> None:
    """Write every row of ``pages`` as request, response or revisit, and metadata record below ``path``."""
    payload = F.coalesce(F.col(html), F.lit(""))
    clean_url = F.regexp_replace(F.col(url), r"[\r\n]", "")
    # The url stands in three headers and the request line.
    held = F.octet_length(payload) + 4 * F.coalesce(F.octet_length(clean_url), F.lit(0)) + F.lit(RECORD_BYTES).cast("long")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), clean_url.alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"), held.alias("held"))
    facts = materialize(rows.select("id", "digest", "held", F.octet_length("payload").alias("size")), "digests")
    copies = facts.where(F.col("size") >= least).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    copies = materialize(copies.select("digest", "first"), "copies")
    upper = F.array_min(F.filter(F.array(*[F.lit(c) for c in PAGE_CLASSES]), lambda c: F.col("held") <= c))
    classes = facts.groupBy(upper.alias("upper")).agg(F.max("held").alias("most")).collect()    # one row a class
    for i, (top, most) in enumerate(sorted(map(tuple, classes)) or [(PAGE_CLASSES[-1], 1)]):
        below = max([0, *(c for c in PAGE_CLASSES if c < top)])
        part = rows.where((F.col("held") > below) & (F.col("held") <= top)).join(copies, "digest", "left")
        _write_records(part, f"{path}/class={i}", i, max(1, FILE_BYTES // most))


def _write_records(rows: DataFrame, path: str, part: int, pages_per_file: int) -> None:
    """Rows (id, url, payload, digest, first) of one class of pages as archive files."""
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("row", F.concat_ws("/", F.lit(part), F.monotonically_increasing_id()))

    uri = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    me, http = _uuid("response", F.col("row")), F.lit("application/http; msgtype=response")
    head = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF)
    response = _record("response", [("WARC-Record-ID", me), uri, digest, ("Content-Type", http)],
                       F.concat(head, F.col("payload")))
    revisit = _record("revisit", [("WARC-Record-ID", me), uri, digest, ("WARC-Profile", F.lit(PROFILE)),
                                  ("Content-Type", http)], head)
    request = _record("request", [("WARC-Record-ID", _uuid("request", F.col("row"))), ("WARC-Concurrent-To", me), uri,
                                  ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")),
                               F.lit(" HTTP/1.1" + CRLF + CRLF)))
    meta = _record("metadata", [("WARC-Record-ID", _uuid("metadata", F.col("row"))), ("WARC-Concurrent-To", me), uri,
                                ("Content-Type", F.lit("application/warc-fields"))],
                   F.concat(F.lit("pageId: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(CRLF)))
    records = rows.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), meta)).alias("value"))
    (records.write.option("lineSep", CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * pages_per_file).text(path))


def parse(raw: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record, of which one at a time is held."""
    while first := raw.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record before byte {raw.tell()}")
        lines = []
        while (line := raw.readline()) not in (CRLF.encode(), b""):
            lines.append(line.decode())
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        block = raw.read(size)
        if len(block) < size:
            raise ValueError("a WARC record ends before its length")
        yield headers, block
        raw.read(4)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: record_id, type, concurrent_to, uri, date, stated_digest, block, and for responses the payload
    with its size and digest as found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for h, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    kind = h["warc-type"]
                    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    stated = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    rows.append((h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-target-uri"),
                                 h.get("warc-date"), stated, None if kind == "response" else block, body,
                                 None if body is None else len(body),
                                 None if body is None else hashlib.sha256(body).hexdigest()))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["record_id", "type", "concurrent_to", "uri", "date", "stated_digest", "block", "payload", "payload_bytes",
             "payload_digest"]
    types = [pa.string()] * 6 + [pa.binary()] * 2 + [pa.int64(), pa.string()]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "record_id string, type string, concurrent_to string, uri string, date string, "
                                 "stated_digest string, block binary, payload binary, payload_bytes long, "
                                 "payload_digest string")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: uri, date, record_type, refers_to, payload facts, and the structs request, response,
    metadata.  ``records`` should be a written table; it is read once per record type."""
    main = records.where(F.col("type").isin("response", "revisit"))
    side = records.where(F.col("type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    # More than one request or metadata record: the one with the smallest id.
    parts = side.groupBy(F.col("concurrent_to").alias("its_record")).agg(*[F.min(F.when(F.col("type") == t, F.struct(
        "record_id", "block"))).alias(t) for t in ("request", "metadata")])
    joined = main.join(parts, F.col("record_id") == F.col("its_record"), "left")
    page = F.regexp_extract(F.col("metadata.block").cast("string"), r"pageId: ([^\r\n]+)", 1)
    joined = joined.withColumn("page_id", F.when(page != "", page).cast("long"))
    # What revisits point to: the response of each digest, which for stored copies is one.
    named = (main.where("type = 'revisit'").select(F.col("stated_digest").alias("payload_digest")).distinct())
    target = (joined.where("type = 'response'").join(named, "payload_digest", "left_semi").groupBy("payload_digest")
              .agg(F.min("page_id").alias("first"), F.min("record_id").alias("first_record"),
                   F.max("payload_bytes").alias("first_bytes")).withColumnRenamed("payload_digest", "its_digest"))
    revisit = F.col("type") == "revisit"
    out = joined.join(target, revisit & (F.col("stated_digest") == F.col("its_digest")), "left")
    return out.select(
        "page_id", "uri", "date", F.col("type").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(revisit, F.col("first_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.struct("record_id", "payload", "stated_digest").alias("response"), "request", "metadata")


def round_trip(pages: DataFrame) -> DataFrame:
    """The captures of ``pages`` after writing them as archives in the shared folder and reading those."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    return captures(materialize(read_records(spark, path), "records"))


def op6(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, payload_bytes, d AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
