"""A content-addressed web archive: every payload once, every record's exact header, joined back by digest.

Records are written as WARC/1.1 text files (gzip) by Spark's own writer, so any file system that Spark knows will do.
A payload is stored with one record only, the ``response``; the other records of the same payload are ``revisit``
records that name it. Equality of payloads is decided by SHA-1, SHA-256 and length together. Reading recomputes both
digests from the stored bytes and refuses a file whose digests differ.

* A null payload is an empty payload; all empty payloads of at least ``min_bytes`` share one response too.
* The response of a payload is the record with the smallest id; rows that repeat that very id and payload are all
  responses. A null id is never the smallest; where a payload has null ids only, each is a response.
* A null url gives a record without target; control characters in a url are percent-encoded.
* An empty table gives an archive without records. Other columns of the pages do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

LINE = "\r\n"
ID_PREFIX = "urn:x-page:"
HTTP_HEAD = f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}{LINE}"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "1970-01-01T00:00:00Z"
#: Records of one file; a reader holds one compressed file and one record at a time.
RECORDS_PER_FILE = 20_000


def base32(sha1_hex: Column) -> Column:
    """A SHA-1 in hexadecimal as base32: ten digits are forty bits, which are eight characters."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_digests(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit(""))
    return pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("bigint").alias("n_bytes"),
        F.sha1(F.col("payload").cast("binary")).alias("sha1"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("sha256"),
    )


def decided(records: DataFrame, min_bytes: int) -> DataFrame:
    """Records with ``keeper``, the id of the response that a revisit names (null for responses)."""
    key = ["sha256", "sha1", "n_bytes"]
    keepers = (
        records.where(F.col("n_bytes") >= min_bytes)
        .groupBy(key)
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("members"))
        .where("members > 1 AND first_id IS NOT NULL")
        .drop("members")
    )
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return records.join(keepers, key, "left").withColumn("keeper", keeper).drop("first_id")


def record_text() -> Column:
    """The whole record but its last line end, which the text writer puts there."""
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    name = F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("keeper").isNotNull()

    def line(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"{key}: "), value, F.lit(LINE))

    length = F.lit(len(HTTP_HEAD)) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    named = F.concat(F.lit(f"<{ID_PREFIX}"), F.col("keeper").cast("string"), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{LINE}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name),
        line("WARC-Date", F.lit(WRITTEN)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", url)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        line("X-Payload-SHA256", F.col("sha256")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", named))).otherwise(
            ""
        ),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(LINE),
    )
    return F.concat(header, F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("payload")), F.lit(LINE))


def write_archive(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
) -> None:
    """Write one record per row. Payloads shorter than ``min_bytes`` are never replaced by a revisit."""
    records = decided(with_digests(pages, id_column, url_column, payload_column), min_bytes)
    (
        records.select(record_text().alias("value"))
        .write.option("lineSep", LINE)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "gzip")
        .text(path)
    )


FIELDS = StructType(
    [
        StructField("record_id", LongType()),
        StructField("record_type", StringType()),
        StructField("refers_to", LongType()),
        StructField("target_uri", StringType()),
        StructField("payload_digest", StringType()),
        StructField("sha256", StringType()),
        StructField("header", BinaryType()),
        StructField("payload_bytes", LongType()),
        StructField("payload", BinaryType()),
    ]
)


def _number(value: str | None) -> int | None:
    digits = (value or "").strip("<>").removeprefix(ID_PREFIX)
    return None if digits in ("", "none") else int(digits)


def parse_records(stream: io.BufferedIOBase, keep_payload: bool) -> Iterator[tuple]:
    """Records of one file, one in memory at a time; payload fields are null for a revisit."""
    while first := stream.readline():
        if first.strip() != b"WARC/1.1":
            raise ValueError(f"a record begins with {first[:40]!r}")
        lines = [first]
        while (line := stream.readline()) not in (b"\r\n", b""):
            lines.append(line)
        named = dict(x.decode().rstrip("\r\n").split(": ", 1) for x in lines[1:])
        block = stream.read(int(named["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {named['WARC-Record-ID']} has no end")
        at = block.index(b"\r\n\r\n") + 4
        digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = None
        if named["WARC-Type"] == "response":
            payload = memoryview(block)[at:]
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode(), hashlib.sha256(payload).hexdigest()
            if found != (digest, named["X-Payload-SHA256"]):
                raise ValueError(f"record {named['WARC-Record-ID']} does not have the digest it names")
        yield (
            _number(named["WARC-Record-ID"]),
            named["WARC-Type"],
            _number(named.get("WARC-Refers-To")),
            named.get("WARC-Target-URI"),
            digest,
            named["X-Payload-SHA256"],
            b"".join(lines) + b"\r\n" + block[:at],
            None if payload is None else len(payload),
            bytes(payload) if keep_payload and payload is not None else None,
        )


def read_archive(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per stored record, with its exact header. Files are dealt over the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(FIELDS)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, total = [], 0
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for row in parse_records(io.BufferedReader(stream, 1 << 20), keep_payload):
                        rows.append(row)
                        total += len(row[6]) + len(row[8] or b"")
                        if total > 16_000_000:
                            yield as_batch(rows)
                            rows, total = [], 0
                yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, FIELDS)


def headers(archive: DataFrame) -> DataFrame:
    """The exact header of every record, apart from its payload."""
    return archive.select("record_id", "record_type", "refers_to", "target_uri", "payload_digest", "sha256", "header")


def payloads(archive: DataFrame) -> DataFrame:
    """Each stored payload once, by its digest."""
    stored = archive.where("record_type = 'response'")
    columns = [c for c in ("payload_bytes", "payload") if c in archive.columns]
    return stored.groupBy("payload_digest", "sha256").agg(*[F.first(c).alias(c) for c in columns])


def reconstruct(archive: DataFrame) -> DataFrame:
    """Every original record: its header joined to the payload that its digest names."""
    return headers(archive).join(payloads(archive), ["payload_digest", "sha256"], "left")
