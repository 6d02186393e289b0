import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from spectrine.llm import warc as W

T0 = dt.datetime(2024, 1, 1)


def record(i, kind, url, hours, headers=None, body=None, status=200):
    return (i, kind, url, None if hours is None else T0 + dt.timedelta(hours=hours), status, headers, body)


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        record("r1", "response", "http://www.a.org/x?utm_a=1", 0, {"ETag": '"1"', "Age": "1", "Server": "s"}, b"one"),
        record("r2", "response", "https://a.org/x/", 50, {"ETag": '"2"'}, b"two"),
        record("r3", "response", "https://a.org/x#f", 60, {"ETag": '"2"'}, b"error", 500),
        record("v1", "revisit", "http://a.org/x", 10, {"etag": 'W/"1"', "AGE": "9", "Content-Length": "0"}),
        record("v2", "revisit", "http://a.org/x", 70, {"ETag": '"1"'}),
        record("v3", "revisit", "http://a.org:80/x", 80, {}),
        record("v4", "revisit", "http://a.org/x", 0, {"ETag": '"1"'}),
        record("v5", "revisit", "http://b.org/x", 9, {"ETag": '"1"'}),
        record("v6", "revisit", None, 9, None), record("v7", "revisit", "http://a.org/x", None, None), record(None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, W.SCHEMA)


@pytest.mark.parametrize("seconds", [60, 86_400, 10**9])
def test_resolution(records, seconds):
    got = {r.record_id: r for r in W.resolve_revisits(records, slice_seconds=seconds).collect()}
    assert len(got) == 11
    assert {k: (r.outcome, r.refers_to) for k, r in got.items() if k and k[0] == "v"} == {
        "v1": ("resolved", "r1"), "v2": ("mismatch", None), "v3": ("unvalidated", "r2"), "v4": ("unresolved", None),
        "v5": ("unresolved", None), "v6": ("unresolved", None), "v7": ("unresolved", None),
    }
    assert bytes(got["v1"].merged_body) == b"one"
    assert got["v1"].merged_headers == {"etag": 'W/"1"', "age": "9", "server": "s"}
    assert got["r1"].outcome == "response" and bytes(got["r1"].merged_body) == b"one" and got[None].outcome == "other"


def test_edges(records):
    assert W.resolve_revisits(records.limit(0)).count() == 0
    twice = records.unionByName(records).withColumn("outcome", F.lit("clash")).withColumn("extra", F.lit(1))
    got = W.resolve_revisits(twice)
    assert got.count() == 22 and "extra" in got.columns and got.where("record_id = 'v1' and outcome = 'resolved'").count() == 2


def test_canonical(spark):
    urls = ["HTTP://WWW.A.org:443/p/index.html?b=2&a=1&utm_x=3#z", "https://a.org/p?a=1&b=2", "ftp://x", "", None, "http://u:p@a.org/p/?b=2&a=1&ref"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(W.canonical_url(F.col("u"))).collect()]
    assert got[0] == got[1] == got[5] == "http://a.org/p?a=1&b=2" and got[2:5] == [None, None, None]


def test_files_round_trip(spark, records, tmp_path):
    good = records.where("record_id is not null")
    data = b"".join(bytes(r.member) for r in W.to_members(good).orderBy("record_id").collect())
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "b.warc").write_bytes(gzip.decompress(data))
    (tmp_path / "c.warc.gz").write_bytes(data[:-20])
    rows = W.read_warc(spark, str(tmp_path / "a.warc.gz")).collect()
    assert sorted(r.record_id for r in rows) == sorted(r.record_id for r in good.collect())
    by = {r.record_id: r for r in rows}
    assert bytes(by["r1"].body) == b"one" and by["r1"].headers["etag"] == '"1"' and by["r1"].warc_date == T0 and by["v1"].status == 304
    assert by["v1"].body is None
    assert W.read_warc(spark, str(tmp_path / "b.warc")).count() == len(rows)
    assert W.read_warc(spark, str(tmp_path / "c.warc.gz")).count() in (len(rows) - 1, len(rows))


def test_records_of_unknown_length_are_passed_over():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for bad in (b"-1", b"x", b"", b"9" * 40):
        odd = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: " + bad + b"\r\n\r\nlost\r\n\r\n"
        assert [r["body"] for r in W.parse(odd + good)] == [b"hello"]
