"""Operator 6: WARC."""

import glob
import gzip
import io

import pytest

from marketsignals.llm import warc
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF, passage, same

OP6 = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
LONG = "<p>" + passage(1, 60) + "</p>"
PAGES = [(1, "http://a/", LONG), (2, "http://b/", LONG), (0, "http://c/", LONG), (3, None, LONG), (4, "u", "short"), (5, "u", "short"),
         (6, "u", None), (7, "u", ""), (8, "u\r\nEvil: 1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9), (9, "é", "日本" * 50),
         (None, "n", LONG), (None, "n", "x" * 200), (None, "n", "x" * 200), (9, "é", "日本" * 50), (10, "u", "\n\r\n" * 60),
         (11, "u", "a" * 99), (12, "u", "a" * 99), (13, "u", "a" * 100), (14, "u", "a" * 100), (15, "z", "日本" * 50)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, type string, record_id int")


def test_edges(spark):
    same(warc.round_trip(pages(spark)), brute.warc([(p, h) for p, _, h in PAGES]), *OP6)


def test_captures_hold_what_was_written(spark):
    for r in warc.round_trip(pages(spark)).collect():
        if r.record_type == "response" and r.page_id is not None:
            assert r.response.payload.decode() in {h or "" for p, _, h in PAGES if p == r.page_id}
            assert r.response.stated_digest == r.payload_digest
        assert r.request.block.startswith(b"GET ") and r.metadata.block.startswith(b"pageId: ")
    assert warc.round_trip(pages(spark)).where("page_id = 8").first().uri == "uEvil: 1"


def test_many_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1)
    same(warc.round_trip(pages(spark)), brute.warc([(p, h) for p, _, h in PAGES]), *OP6)


def test_a_stretch_of_large_pages_among_small_ones(spark, tmp_path, monkeypatch):
    """Files stay bounded by bytes, whatever the mean page is."""
    monkeypatch.setattr(warc, "FILE_BYTES", 3 << 20)
    rows = [(i, f"u{i}", ("%07d" % i) * (150_000 if 700 <= i < 710 else 20)) for i in range(2000)]
    table = pages(spark, rows).coalesce(1)
    warc.write_warc(table, str(tmp_path / "w"))
    sizes = [len(gzip.open(f).read()) for f in glob.glob(str(tmp_path / "w/*/*.gz"))]
    assert max(sizes) <= 3 << 20 and len(sizes) <= 8
    same(warc.captures(warc.read_records(spark, str(tmp_path / "w"))), brute.warc([(p, h) for p, _, h in rows]), *OP6)


def test_a_long_url_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    warc.write_warc(pages(spark, [(i, "u" * 100_000, "x") for i in range(20)]).coalesce(1), str(tmp_path / "w"))
    assert max(len(gzip.open(f).read()) for f in glob.glob(str(tmp_path / "w/*/*.gz"))) <= 1 << 20


def test_parse_takes_a_record_at_a_time():
    good = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\na\r\n\r\n\r\n"
    raw = io.BytesIO(good * 2)
    records = warc.parse(raw)
    assert next(records) == ({"warc-type": "x", "content-length": "3"}, b"a\r\n") and raw.tell() < len(good)
    assert len(list(records)) == 1
    for bad in (good[:-6], b"x" + good):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(bad)))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    same(QUERIES["op6_warc"](spark, SF), brute.warc(rows), *OP6)


def test_empty(spark, empty_dir):
    assert QUERIES["op6_warc"](spark, empty_dir).count() == 0
