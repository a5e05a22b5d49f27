import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from basketry.llm import op08_warc as warc
from basketry.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, record string"
BIG = "<p>" + "x" * 1500 + "</p>"
ROWS = [(1, "http://a/1", BIG), (7, "http://a/7", BIG), (3, None, BIG), (2, "http://a/2", "short"),
        (4, "http://a/4", "short"), (5, "http://a/\r\nX: y", None), (6, "u", ""), (None, "u", "no id"),
        (8, "u", "line\r\n\r\nbreaks\r\n\r\n" * 300), (9, "u", "ü€😀\r\n" * 40000), (10, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\nx")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunked_framing_round_trip(size):
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 9, bytes(range(256)) * 40):
        assert warc.dechunked(warc.chunked(payload, size)) == payload
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc")


@pytest.mark.parametrize("segment", [50, 1 << 14])
def test_pages_survive_the_archives(spark, segment):
    path = scratch_path(spark, f"warc-test-{segment}")
    records = [r for page, url, html in ROWS for r in warc.page_records(
        page, url, (html or "").encode(), 7 if page in (1, 3) else None, f"t-{page}", segment)]
    df = spark.createDataFrame([(bytearray(r),) for r in records], "record binary").repartition(3)
    df.select(F.col("record").cast("string")).write.mode("overwrite").option("lineSep", "\r\n\r\n").text(
        path, compression="gzip")
    got = {r.page_id: r for r in warc.read_pages(spark, path).collect()}
    for page, _, html in ROWS:
        r = got[page]
        assert r.problem is None
        if page in (1, 3):
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", 7, None)
        else:
            assert (r.record_type, bytes(r.payload)) == ("response", (html or "").encode())


def write(spark, records, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(bytearray(r),) for r in records], "record binary").select(
        F.col("record").cast("string")).coalesce(1).write.mode("overwrite").option("lineSep", "\r\n\r\n").text(path)
    return path


def test_damaged_segments_are_reported(spark):
    parts = warc.page_records(1, "u", b"p" * 500, None, "a", 100)
    assert len(parts) > 3
    lost = write(spark, parts[:2] + parts[3:], "warc-lost")
    assert [r.problem for r in warc.read_pages(spark, lost).collect()] == ["segments are missing"]
    total = [p.replace(b"Segment-Total-Length: ", b"Segment-Total-Length: 1") for p in parts]
    assert [r.problem for r in warc.read_pages(spark, write(spark, total, "warc-total")).collect()] == [
        "wrong total length"]
    digest = base64.b32encode(hashlib.sha1(b"p" * 500).digest())
    wrong = [p.replace(digest, b"A" * 32) for p in parts]
    assert [r.problem for r in warc.read_pages(spark, write(spark, wrong, "warc-digest")).collect()] == [
        "wrong payload digest"]
    shuffled = write(spark, parts[::-1], "warc-order")
    assert [bytes(r.payload) for r in warc.read_pages(spark, shuffled).collect()] == [b"p" * 500]


def run(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "pages.parquet"))
    return warc.op8_warc(spark, str(tmp_path))


def test_query_over_odd_rows(spark, tmp_path):
    got = {r.page_id: r for r in run(spark, ROWS, tmp_path).collect()}
    assert len(got) == len(ROWS)
    for page, _, html in ROWS:
        data, r = (html or "").encode(), got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 7) if page in (1, 3) else ("response", None))


def test_query_over_repeated_and_no_rows(spark, tmp_path):
    got = run(spark, [(7, "u", BIG), (7, "u", BIG), (1, "u", BIG)], tmp_path / "a").collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "revisit"), (7, "response"), (7, "response")]
    assert run(spark, [], tmp_path / "b").count() == 0
