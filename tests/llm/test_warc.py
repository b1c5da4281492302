import base64
import hashlib

import pytest
from pyspark.errors import PySparkException

from listwright.llm import warc
from listwright.storage import fresh_path

from .odd import rows_of

ROWS = [
    (3, "http://a/", "<p>same</p>"), (1, "http://b/", "<p>same</p>"), (2, None, None), (9, "u", ""),
    (4, "x\r\ny", "naïve \r\n\r\n 漢"), (5, "http://c/", "x" * 200_000), (6, "", "x" * 200_000),
    (1, "http://b/", "<p>same</p>"), (None, "n", "<p>same</p>"), (None, "n", "alone"), (7, "z", "q"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(
        [(k, u, h, "k", b"d") for k, u, h in rows],
        "page_id bigint, url string, html string, key string, digest binary",
    )


@pytest.mark.parametrize("least", [0, 5])
def test_archive(spark, least):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark), path, least_bytes=least)
    want = []
    for key, _, html in ROWS:
        payload = (html or "").encode()
        equal = [k for k, _, h in ROWS if (h or "").encode() == payload and k is not None]
        first = min(equal, default=None)
        revisit = len(payload) >= least and key != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if revisit and first is not None else "response"
        want.append((key, len(payload), digest, kind, first if revisit else None))
    assert rows_of(warc.record_index(spark, path)) == sorted(want, key=repr)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert sorted(r.payload for r in stored) == sorted({(h or "").encode() for _, _, h in ROWS})


def test_records_are_whole(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark), path)
    for row in warc.read_records(spark, path).collect():
        fields, payload = warc.parse_record(bytes(row.record))
        assert fields["version"] == warc.VERSION
        assert int(fields["Content-Length"]) == len(payload)
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")
        url = {k: u for k, u, _ in ROWS}[row.key]
        assert fields["WARC-Target-URI"] == (url or "").replace("\r\n", "")


def test_damage_is_found(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark), path)
    payloads = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "x'00' AS payload")
    rows = payloads.collect()
    spark.createDataFrame(rows, payloads.schema).write.mode("overwrite").parquet(
        f"{path}/payloads"
    )
    with pytest.raises(PySparkException, match="does not match its digest"):
        warc.read_records(spark, path).collect()


def test_empty(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark, []), path)
    assert warc.record_index(spark, path).count() == 0
