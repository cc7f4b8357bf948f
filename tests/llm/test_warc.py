import hashlib

import pytest

from codetide.llm import sql, warc
from codetide.session import scratch_path
from conftest import SF_DIR
from oracle_check import difference

LONG = "é" * 600


def test_equals_sql(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert difference(warc.archive_query(pages), sql.OP10, SF_DIR) is None


def test_cases(make_pages):
    pages = make_pages((1, "u", LONG), (2, "u", LONG), (3, None, LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (6, "u", ""), (7, "a\r\nWARC-Type: x", "y"), (3, "z", LONG), (None, "u", LONG))
    rows = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_query(pages).collect())
    assert rows == [(0, 1200, "revisit", 3), (1, 1200, "revisit", 3), (2, 1200, "revisit", 3), (3, 1200, "response", None), (3, 1200, "response", None),
                    (4, 5, "response", None), (5, 5, "response", None), (6, 0, "response", None), (6, 0, "response", None), (7, 1, "response", None)]
    assert warc.archive_query(pages.limit(0)).count() == 0


def test_records_are_rebuilt_from_payloads_stored_once(spark, make_pages):
    path = scratch_path(spark, "archive")
    warc.write_archive(make_pages((1, "u", LONG), (2, "v", LONG), (2, "w", LONG), (3, "x", "tiny"), (4, "x", "tiny")), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 2
    for r in warc.read_archive(spark, path).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block[int(lines["Content-Length"]) :] == b"\r\n\r\n"
        assert lines["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(bytes(r.payload)).hexdigest()
        assert int(lines["X-Payload-Length"]) == len(r.payload)
        if lines["WARC-Type"] == "response":
            assert block[:-4] == bytes(r.payload)


def test_damage_is_found(spark, make_pages):
    path = scratch_path(spark, "archive")
    warc.write_archive(make_pages((1, "u", LONG)), path)
    held = spark.read.parquet(f"{path}/payloads")
    held.selectExpr("sha256", "cast('other' as binary) as payload").write.parquet(f"{path}-2/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-2/headers")
    with pytest.raises(Exception, match="payload unlike its digest"):
        warc.read_archive(spark, f"{path}-2").collect()


def test_a_missing_payload_is_found(spark, make_pages):
    path = scratch_path(spark, "archive")
    warc.write_archive(make_pages((1, "u", LONG), (2, "u", "other")), path)
    spark.read.parquet(f"{path}/payloads").where("octet_length(payload) > 10").write.parquet(f"{path}-3/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-3/headers")
    with pytest.raises(Exception, match="no payload for"):
        warc.read_archive(spark, f"{path}-3").collect()


def test_very_long_payloads(spark, make_pages):
    long = "é\n" * 1_000_000
    path = scratch_path(spark, "archive")
    warc.write_archive(make_pages((1, "u", long), (2, "v", long), (3, "w", long + "x")), path)
    rows = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert [bytes(rows[i].payload).decode() for i in (1, 2, 3)] == [long, long, long + "x"]
