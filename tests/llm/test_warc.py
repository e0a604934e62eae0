import base64
import hashlib

import pytest
from shoalmark.llm import warc
from shoalmark.session import scratch_path

PAGES = [
    (1, "https://a.example.org/x?y=1", "<p>one</p>"), (2, "http://b.example.org:8080/", "<p>one</p>"),
    (3, None, None), (4, "https://a.example.org/x?y=1", ""), (5, "no url at all", "é😀\r\n\r\nWARC/1.1\r\n"),
    (6, "http://[bad", "x" * 300_000), (7, "http://h/\n: é", "\x1f\x8b"), (None, "http://h/", "<p>one</p>"),
    (None, None, None), (0, "http://z/", "<p>one</p>"), (9, "http://z/", "dup"), (9, "http://z/", "dup"),
] + [(100 + i, "http://hot.example/", f"body {i % 20}") for i in range(120)]
SCHEMA = "page_id long, url string, html string"


def brute(pages, least=0):
    out = []
    for page_id, url, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        first = min(same, default=None) if len(body) >= least else None
        revisit = first is not None and page_id != first
        out.append((page_id, url, "revisit" if revisit else "response", len(body),
                    base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    first if revisit else None, None if revisit else body))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least,block_rows", [(0, 3000), (6, 3)])
def test_round_trip(frame, least, block_rows):
    assert plain(warc.round_trip(frame(PAGES, SCHEMA), least, block_rows)) == brute(PAGES, least)


def test_without_broadcast(frame, no_broadcast):
    assert plain(warc.round_trip(frame(PAGES, SCHEMA))) == brute(PAGES)


def test_empty(frame):
    assert warc.round_trip(frame([], SCHEMA)).collect() == []


def test_lookup_of_some_captures(spark, frame):
    pages = frame(PAGES, SCHEMA)
    archives = scratch_path(spark, "warc")
    warc.write_archives(warc.records(pages), archives, records_per_file=10)
    index = warc.build_index(warc.captures(spark, archives), scratch_path(spark, "captures"), 4)
    wanted = warc.page_names(pages.where("page_id in (6, 9, 137)"))
    missing = spark.createDataFrame([("org,nowhere)/", "urn:page:1")], "url_key string, record_id string")
    ranges = warc.lookup(index, wanted.unionByName(missing))
    found = warc.read_ranges(spark, archives, ranges)
    assert sorted(r.page_id for r in found.collect()) == [6, 9, 9, 137]


def test_files_are_gzip_chains(spark, frame):
    import glob
    import gzip

    archives = scratch_path(spark, "warc")
    warc.write_archives(warc.records(frame(PAGES, SCHEMA)), archives)
    local = archives.removeprefix("file:")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{local}/part-*"))
    assert data.count(b"WARC-Record-ID") == len(PAGES)


def test_keys_sort_by_host():
    keys = [warc.url_key(u) for u in ("http://b.example.org/1", "http://a.example.org/z",
                                      "http://example.org/", "http://example.com/q")]
    assert sorted(keys) == ["com,example)/q", "org,example)/", "org,example,a)/z", "org,example,b)/1"]
