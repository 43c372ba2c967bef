"""Archives and their index: exact round trip of every odd page, range reads, and hot keys."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from peoplelake.llm import warc

BIG = "<p>" + "x" * 200
PAGES = [
    (5, "http://www.Example.org/a?b=1", BIG), (3, "http://example.org:80/", BIG), (4, None, BIG), (9, "http://e.org/x", None), (10, "http://e.org/x", ""),
    (1, "ftp://user@h.example/é\r\nX: y", "é" * 60), (2, "no url", "é" * 60), (6, "http://e.org/x", "small"), (7, "http://e.org/y", "small"),
    (8, "http://e.org/%0A", "\r\n\r\nWARC/1.1\r\n" * 20), (None, "http://e.org/z", BIG), (11, "http://e.org/z", "z" * 300_000), (3, "http://e.org/q", BIG),
]
SCHEMA = "page_id bigint, url string, html string, key string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)


def test_every_page_comes_back(spark):
    got = warc.archive(frame(spark, PAGES)).collect()
    least = defaultdict(list)
    for i, _, html in PAGES:
        least[html or ""].append(i)
    want = Counter()
    for i, url, html in PAGES:
        data = (html or "").encode()
        first = min(x for x in least[html or ""] if x is not None)
        response = len(data) < 100 or i == first
        want[i, url, "response" if response else "revisit", len(data), hashlib.sha256(data).hexdigest(),
             None if response else first, data if response else None] += 1
    keys = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    assert Counter((*(r[k] for k in keys), None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    assert warc.archive(frame(spark, [])).count() == 0


def test_lookup_reads_only_its_blocks(spark, tmp_path):
    rows = [(i, f"http://h{i % 40}.example/{i % 90}", f"page {i}") for i in range(600)] + [
        (1000 + i, "http://hot.example/", f"hot {i}") for i in range(300)]
    captures = warc.write_archives(frame(spark, rows), str(tmp_path / "archive"))
    directory = warc.write_index(captures.repartition(4), str(tmp_path / "index"), block_lines=16)
    blocks = directory.collect()
    assert len(blocks) >= 900 / 16 and all(b["first"] <= b["last"] for b in blocks)
    for b in blocks:  # a block can be read alone
        with open(tmp_path / "index" / b["file"], "rb") as file:
            file.seek(b["offset"])
            assert zlib.decompress(file.read(b["length"]), 31).count(b"\n") <= 16
    asked = ["http://h3.example/3", "http://hot.example/", "http://h3.example/nothing", "http://zzz.example/", ""]
    keys = spark.createDataFrame([(u,) for u in [*asked, asked[0]]], "url string").select(warc.url_key("url").alias("key"))
    found = warc.look_up(keys, directory, str(tmp_path / "index"))
    records = warc.read_records(found, str(tmp_path / "archive")).collect()
    want = Counter(str(i) for i, u, _ in rows if u in asked)
    assert Counter(r["page_id"] for r in records) == want and sum(want.values()) > 300


def test_keys_sort_by_reversed_host(spark):
    urls = ["http://a.b.Example.org/x?y#z", "https://u:p@example.org:8080", "no url", None]
    keys = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key("url")).collect()]
    assert keys == ["org,example,b,a)/x?y#z", "org:8080,example)", ")no url", ")"]


def test_records_parse_and_refuse():
    data = warc.record("7", "http://x/\n", "response", "ab", 4, None, b"\r\n\r\n")
    got = warc.parse(data)
    assert (got["page_id"], got["url"], got["payload"], got["payload_bytes"]) == ("7", "http://x/\n", b"\r\n\r\n", 4)
    assert zlib.decompress(warc.member(data), 31) == data
    with pytest.raises(ValueError):
        warc.parse(b"GET / HTTP/1.1\r\n\r\n")


def test_a_lost_attempt_leaves_no_capture(spark, tmp_path):
    """A file that no task committed is there but not found."""
    captures = warc.write_archives(frame(spark, PAGES), str(tmp_path / "archive"))
    (tmp_path / "archive" / "orphan.warc.gz").write_bytes(b"broken")
    named = {r["file"] for r in captures.select("file").distinct().collect()}
    assert "orphan.warc.gz" not in named and warc.read_records(captures, str(tmp_path / "archive")).count() == len(PAGES)
    assert captures.select(F.max("length")).first()[0] < 10_000
