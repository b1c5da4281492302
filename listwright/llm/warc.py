"""A content-addressed WARC archive: payloads stored once by digest, record headers apart.

``write_archive`` makes two tables below a path. ``payloads`` holds each distinct payload once, under
its SHA-256, which is checked against the bytes when they are read. ``headers`` holds, for every
record, its exact header block and the digest of its payload. A record is rebuilt by joining the two:
header block, empty line, payload, two line ends, as in a WARC/1.1 file.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest key is a
response, the others are revisits that name it. Smaller payloads are all responses.

A null payload is an empty one. Rows with the same key are records of their own: among equal
payloads the smallest key is a response in each of its rows. A null key is larger than all others,
and its record id is that of the word null.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hexed: Column) -> Column:
    """Base 32 of 20 bytes in hex: each five bytes are eight digits of the number they make."""
    digits = [F.substring(hexed, 1 + 10 * i, 10) for i in range(4)]
    words = [
        F.translate(
            F.lpad(F.conv(d, 16, 32), 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32
        )
        for d in digits
    ]
    return F.concat(*words)


def _record_id(key: Column) -> Column:
    """A stable record id: a UUID made of the digest of the key."""
    h = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *(F.substring(h, at, n) for at, n in cuts))


def _header(key: Column, uri: Column, bytes_: Column, sha1: Column, refers: Column) -> Column:
    """The header block of a record, without the empty line that ends it."""
    revisit = refers.isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    # A line end inside a field would end the field.
    target = F.translate(F.coalesce(uri, F.lit("")), "\r\n", "")
    return F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _record_id(key), F.lit(">"))),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, line("WARC-Refers-To", F.concat(
            F.lit("<urn:uuid:"), _record_id(refers), F.lit(">")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", bytes_.cast("string")),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> None:
    """Write the two tables of an archive of one record per row of ``pages``.

    Digests are worked out where the rows are read. Only digests and keys are shuffled to find the
    response among equal payloads; each payload is written by the task that reads its response.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(key).alias("key"), F.col(uri).alias("uri"), body.alias("payload")
    ).select(
        "key", "uri", "payload",
        F.unhex(F.sha2("payload", 256)).alias("digest"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    narrow = records.drop("payload")
    firsts = narrow.groupBy("digest").agg(
        F.min("key").alias("first"), F.count("*").alias("copies")
    )
    repeated = firsts.filter("copies > 1").select("digest", "first")
    found = narrow.join(repeated, "digest", "left")
    revisits = (F.col("bytes") >= least_bytes) & ~F.col("key").eqNullSafe(F.col("first"))
    refers = F.when(revisits, F.col("first"))
    sha1 = _base32(F.col("sha1"))
    headers = found.select(
        "key", "digest",
        refers.alias("refers_to"),
        _header(F.col("key"), F.col("uri"), F.col("bytes"), sha1, refers)
        .cast("binary").alias("header"),
    )
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    # Equal payloads of one task go on once; what is left is one row per task and digest.
    stored = records.select("digest", "payload").dropDuplicates(["digest"])
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(key, refers_to, record)``: every record of an archive, rebuilt byte for byte."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    held = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = payloads.filter(F.when(held, F.lit(True)).otherwise(
        F.raise_error(F.lit("a payload does not match its digest"))
    ))
    end = F.lit(b"\r\n\r\n")
    record = F.concat(F.col("header"), end, F.col("payload"), end)
    return headers.join(checked, "digest").select("key", "refers_to", record.alias("record"))


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields, with ``version`` for the first line, and the payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {"version": lines[0]} | dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, rest[:size]


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """Per record, as parsed from its rebuilt bytes: ``key``, ``payload_bytes``, ``payload_digest``
    (checked against the payload), ``record_type``, ``refers_to``."""
    records = read_records(spark, path)

    def run(batches):
        for batch in batches:
            sizes, digests, kinds = [], [], []
            for record in batch.column(2).to_pylist():
                fields, payload = parse_record(record)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
                    raise ValueError("a payload does not match its record")
                sizes.append(len(payload))
                digests.append(digest)
                kinds.append(fields["WARC-Type"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(kinds, pa.string()), batch.column(1)],
                ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    kind = records.schema["key"].dataType.simpleString()
    return records.mapInArrow(
        run,
        f"key {kind}, payload_bytes bigint, payload_digest string, record_type string, "
        f"refers_to {kind}",
    )
