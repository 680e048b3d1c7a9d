import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from propmart.llm import warc
from propmart.llm.common import open_folder, scratch

PAGES = "page_id long, url string, html string"


def expected(rows):
    largest = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            largest[data] = max(page, largest.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        kept = largest.get(data)
        revisit = kept is not None and page != kept
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=str)


def read(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


BIG = "é<p>" * 300
ROWS = [
    (1, "http://www.Example.com:8080/a?b=c", BIG),
    (2, "https://example.com/", BIG),
    (3, "http://example.com/small", "x" * 999),
    (4, "http://example.com/small", "x" * 999),
    (5, None, None),
    (6, "no url\r\nInjected: yes", ""),
    (7, "http://user@host.org/p q\n", "\r\n\r\nWARC/1.1\r\n" * 100),
    (8, "http://host.org/long", "y" * 2_000_000),
    (None, "http://host.org/null", BIG),
    (9, "http://example.com/small", BIG),
    (9, "http://example.com/small", BIG),
]


def test_round_trip_and_revisits(spark):
    got = read(warc.archive_and_read(spark.createDataFrame(ROWS, PAGES).withColumn("digest", F.lit("clash")).repartition(4)))
    assert got == expected(ROWS)


def test_empty_table(spark):
    df = warc.archive_and_read(spark.createDataFrame([], PAGES))
    assert df.collect() == [] and df.columns[:2] == ["page_id", "url"]


def test_large_id_group_without_ids_is_all_response(spark):
    rows = [(None, "http://a/1", BIG), (None, "http://a/2", BIG)]
    assert read(warc.archive_and_read(spark.createDataFrame(rows, PAGES))) == expected(rows)


def test_url_key(spark):
    urls = ["http://a.b.example.net/x?y", "HTTPS://Example.NET:81/", "//h/p", "plain", None, "http://u@h.c/a b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url")).alias("k"))
    assert [r.k for r in df.collect()] == ["net,example,b,a)/x?y", "net,example):81/", "h)/p", ")plain", ")", "c,h)/a%20b"]


def test_index_finds_keys_over_block_ends(spark, monkeypatch):
    folder = scratch(spark, "warc-test")
    rows = [(f"k{i // 7:03d}", str(i // 7), "f", i, 1, "d") for i in range(700)]
    index = warc.build_index(spark.createDataFrame(rows, warc.CAPTURES), folder, block_lines=5)
    wanted = spark.createDataFrame([("k000", "0"), ("k050", "50"), ("k099", "99"), ("k100", "100"), ("a", "0"), ("k050", "0")], "url_key string, capture string")
    got = sorted((r.url_key, r.offset) for r in warc.lookup(wanted, index, folder).collect())
    assert got == [(f"k{k:03d}", 7 * k + i) for k in (0, 50, 99) for i in range(7)]


def test_members_are_ordinary_gzip(spark):
    folder = scratch(spark, "warc-test")
    captures = warc.write_archives(warc.classify(spark.createDataFrame(ROWS[:4], PAGES).coalesce(1)), folder)
    name = captures.first().file
    filesystem, path = open_folder(folder)
    data = gzip.decompress(filesystem.open_input_file(f"{path}/{name}").read())
    assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC-Type: response") == 3


def test_damaged_payload_is_refused():
    record = warc._record("1", "http://a/", hashlib.sha1(b"abc").hexdigest(), 3, None, b"abd")
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record)
