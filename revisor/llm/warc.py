"""WARC archives: writing, reading and transaction assembly (operator 7).

``write_archive`` turns each page into a transaction of three records (request,
response or revisit, metadata), tied by WARC-Concurrent-To, and writes them
with Spark's own text sink: a record is text, its closing CRLF CRLF is the
line separator, so files are committed like any Spark output, on any file
system.  ``maxRecordsPerFile`` bounds a file.

``read_records`` parses archives as a stream (``Content-Length`` decides, never
the payload's content), and ``assemble`` joins the records of a transaction
through the concurrent-to identifier and emits one nested row per capture; the
join is an aggregation on that identifier, so a capture whose request or
metadata is missing still gives a row.

Equal payloads of at least ``MIN_REVISIT`` bytes share one response, that with
the smallest page id; the others revisit it.  The digests that occur more than
once are found by an aggregation that combines on the map side; payloads too
short to be revisited get keys of their own, and AQE splits the rest of a hot
digest.

Defined cases: a null page is an empty payload; a null id sorts after all
others and stays null; of repeated rows the first read is the response; a null
url has no target; an empty table gives an archive without records; columns
beyond id, url and page are not read.  The input must give the same rows in the
same order when read twice (a table or a checkpoint does).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisor.llm.common import rename_free, staged
from revisor.session import stage_dir

MIN_REVISIT = 100
RECORDS_PER_FILE = 3 * 4096
CRAWL_DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format: version line, record ends, the revisit profile.
VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
                 "date string, content_type string, declared_digest string, block binary, payload binary, "
                 "payload_bytes long, payload_digest string")


def _record_id(kind: str, capture: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind + ":"), capture.cast("string")))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    length = F.octet_length(block).cast("string")
    return F.concat(F.lit(VERSION + CRLF), *[_header(n, v) for n, v in headers],
                    _header("Content-Length", length), F.lit(CRLF), block)


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  path: str | None = None, date: str = CRAWL_DATE, compression: str = "gzip") -> str:
    """Write the transactions of all pages; returns the archive folder."""
    path = path or stage_dir(pages.sparkSession, "warc")
    base = rename_free(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("payload"),
        F.monotonically_increasing_id().alias("capture"))
    base = base.withColumn("size", F.octet_length("payload")) \
               .withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), F.col("page_id"), F.col("capture"))
    # staged first: where the repeated digests are few, Spark sees it and broadcasts them, and no payload is shuffled
    shared, _ = staged(base.filter(F.col("size") >= MIN_REVISIT).groupBy("digest")
                       .agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
                       .select("digest", F.col("first.capture").alias("first")), "warc-shared")
    # a payload too short to be revisited joins nothing: its key is its own
    key = F.when(F.col("size") >= MIN_REVISIT, F.col("digest")).otherwise(F.col("capture").cast("string"))
    rows = base.withColumn("key", key).join(shared.withColumnRenamed("digest", "key"), "key", "left")
    revisit = F.coalesce(F.col("first") != F.col("capture"), F.lit(False))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    response_id, digest = _record_id("response", F.col("capture")), F.concat(F.lit("sha256:"), F.col("digest"))
    host = F.regexp_extract(target, r"://([^/?#]*)", 1)
    when = F.lit(date)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id("request", F.col("capture"))),
                       ("WARC-Concurrent-To", response_id), ("WARC-Target-URI", target), ("WARC-Date", when),
                       ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                               F.coalesce(host, F.lit("")), F.lit("\r\n\r\n")))
    capture = F.when(revisit, _record(
        [("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", response_id), ("WARC-Target-URI", target),
         ("WARC-Date", when), ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit(REVISIT_PROFILE)),
         ("WARC-Refers-To", _record_id("response", F.col("first"))),
         ("Content-Type", F.lit("application/http; msgtype=response"))], http)).otherwise(_record(
            [("WARC-Type", F.lit("response")), ("WARC-Record-ID", response_id), ("WARC-Target-URI", target),
             ("WARC-Date", when), ("WARC-Payload-Digest", digest),
             ("Content-Type", F.lit("application/http; msgtype=response"))], F.concat(http, F.col("payload"))))
    fields = F.concat(_header("page-id", F.col("page_id").cast("string")),
                      _header("payload-bytes", F.col("size").cast("string")), _header("payload-digest", digest))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id("metadata", F.col("capture"))),
                        ("WARC-Concurrent-To", response_id), ("WARC-Target-URI", target), ("WARC-Date", when),
                        ("Content-Type", F.lit("application/warc-fields"))], fields)
    (rows.select(F.explode(F.array(request, capture, metadata)).alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", compression)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    return path


class _Stream:
    """Bytes of one archive file, inflated as they are needed."""

    def __init__(self, content: memoryview):
        self.content, self.at, self.buffer = content, 0, bytearray()
        self.inflate = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.content):
            return False
        chunk = bytes(self.content[self.at:self.at + (1 << 20)])
        self.at += len(chunk)
        if self.inflate is None:
            self.buffer += chunk
            return True
        while chunk:
            self.buffer += self.inflate.decompress(chunk)
            chunk = self.inflate.unused_data
            if self.inflate.eof:  # the next member of a file with one member per record
                self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (end := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.buffer[:end])
        del self.buffer[:end + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("a WARC file ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(content: memoryview) -> Iterator[tuple]:
    """Records of one file, as rows of ``RECORD_SCHEMA``."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        h = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        block = stream.take(int(h["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is longer than its Content-Length")
        payload = None
        if h["warc-type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4:]
            block = block[:len(block) - len(payload)]
        yield (h["warc-type"], h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"),
               h.get("warc-target-uri"), h.get("warc-date"), h.get("content-type"), h.get("warc-payload-digest"), block,
               payload, None if payload is None else len(payload),
               None if payload is None else hashlib.sha256(payload).hexdigest())


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archive files under ``path`` (gzip, by file or by record, or plain).

    Sizes and digests always come from the whole payloads; with ``payloads``
    off, the payloads themselves stay behind (null).
    """
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in RECORD_SCHEMA.split(", "))]

    def run(batches):
        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, (_, k) in zip(zip(*rows), fields)],
                                              names=[n for n, _ in fields])

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse(memoryview(content.as_buffer())):
                    rows.append(row if payloads else (*row[:9], None, *row[10:]))
                    size += 200 + len(row[8]) + (payloads and row[10] or 0)
                    if size > 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
                if rows:
                    yield flush(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``request``, ``response`` and ``metadata`` structs."""
    kind = F.col("type")

    def one(column: str, *types: str) -> Column:
        return F.max(F.when(kind.isin(*types), F.col(column))).alias(f"{types[0]}_{column}")

    grouped = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        *[one(c, "response", "revisit") for c in ("type", "target_uri", "date", "refers_to", "declared_digest", "block",
                                                  "payload", "payload_bytes", "payload_digest")],
        *[one(c, "request") for c in ("record_id", "block")], *[one(c, "metadata") for c in ("record_id", "block")])
    text = F.col("metadata_block").cast("string")

    def field(name: str) -> Column:
        found = F.regexp_extract(text, f"(?m)^{name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    return grouped.select(
        "capture_id",
        F.struct(F.col("request_record_id").alias("record_id"), F.col("request_block").cast("string").alias("http")).alias("request"),
        F.struct(F.col("response_type").alias("type"), F.col("response_target_uri").alias("target_uri"),
                 F.col("response_date").alias("date"), F.col("response_refers_to").alias("refers_to"),
                 F.col("response_declared_digest").alias("declared_digest"),
                 F.col("response_block").cast("string").alias("http"), F.col("response_payload").alias("payload"),
                 F.col("response_payload_bytes").alias("payload_bytes"),
                 F.col("response_payload_digest").alias("payload_digest")).alias("response"),
        F.struct(F.col("metadata_record_id").alias("record_id"), field("page-id").alias("page_id"),
                 field("payload-bytes").cast("long").alias("payload_bytes"),
                 F.regexp_replace(field("payload-digest"), "^sha256:", "").alias("payload_digest")).alias("metadata"))


def page_captures(captures: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Digest of the captures: one row per page, revisits resolved to the page they refer to.

    Sizes and digests are those of the payloads in the captures, a revisit's those
    of the response it refers to; where that is not in the archive, the metadata
    record's.  A metadata record that disagrees with the payload is an error.
    """
    payload = F.col("response.payload")
    narrow, _ = staged(captures.select(
        "capture_id", F.col("metadata.page_id").cast(id_type).alias("page_id"), F.octet_length(payload).cast("long").alias("own_bytes"),
        F.sha2(payload, 256).alias("own_digest"), F.col("metadata.payload_bytes").alias("said_bytes"),
        F.col("metadata.payload_digest").alias("said_digest"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("target")), "warc-captures")
    wanted = narrow.filter(F.col("target").isNotNull()).select(F.col("target").alias("capture_id")).distinct()
    targets = wanted.join(narrow.select("capture_id", F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("their_bytes"),
                                        F.col("own_digest").alias("their_digest")), "capture_id")
    found = narrow.join(targets.withColumnRenamed("capture_id", "target"), "target", "left")
    size, digest = F.coalesce("own_bytes", "their_bytes"), F.coalesce("own_digest", "their_digest")
    differs = F.coalesce((size != F.col("said_bytes")) | (digest != F.col("said_digest")), F.lit(False))
    checked = F.when(differs, F.raise_error(F.concat(F.lit("the metadata of "), F.col("capture_id"), F.lit(" disagree with its payload"))))
    return found.select("page_id", F.coalesce(size, "said_bytes").alias("payload_bytes"),
                        F.coalesce(checked, digest, "said_digest").alias("payload_digest"), "record_type", "refers_to")
