import base64
import hashlib
import random

import duckdb
import pytest

from starloom.llm import queries, url_filters, warc

SMALL = "/root/testdata/sf0.001"


def test_filters_match_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{SMALL}/pages.parquet'")
    got = queries.QUERIES["op6_url_filters"](spark, SMALL)
    names = sorted(got.columns)
    want = db.execute(f"select {', '.join(names)} from ({queries.SQL['op6_url_filters']})").fetchall()
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)


def test_filter_cases(spark):
    entries = spark.createDataFrame([
        ("l", "host", "a.com", "block", 10), ("l", "host", "a.com", "remove", 20), ("l", "host", "a.com", "block", 30),
        ("l", "host", "a.com", "block", 30), ("t", "domain", "good.org", "allow", 5), ("l", "domain", "org", "block", 0),
        ("p", "path", "b.com/x/y", "block", 0), ("l", "host", "c.com", "remove", 7), ("l", "host", "c.com", "block", 7),
        (None, "host", "d.com", "block", 0), ("l", "host", "d.com", "nonsense", 0),
    ], "list string, kind string, pattern string, action string, dated_at long")
    cases = [
        ("http://a.com/", 9, "none"), ("http://a.com/", 10, "block"), ("HTTP://u:p@A.com.:80/q", 19, "block"), ("http://a.com/", 20, "none"), ("http://a.com/", 31, "block"),
        ("http://x.good.org/", 6, "allow"), ("http://x.good.org/", 4, "block"), ("http://b.com/x/y/z?q", 1, "block"), ("http://b.com/x/yz", 1, "none"),
        ("http://c.com", 8, "block"), ("http://d.com", 8, "none"), (None, 1, "none"), ("", 1, "none"), ("nonsense", 1, "none"), ("http://a.com/", None, "none"), ("http://a.com/", 31, "block"),
        ("http://a.com/" + "s/" * 2000, 31, "block"),
    ]
    captures = spark.createDataFrame([(u, t, w, 1) for u, t, w in cases], "url string, fetched_at long, want string, u int")
    rows = url_filters.filter_urls(captures, entries).collect()
    assert len(rows) == len(cases) and [r for r in rows if r.verdict != r.want] == []
    assert url_filters.filter_urls(captures.where("false"), entries).count() == 0
    assert {r.verdict for r in url_filters.filter_urls(captures, entries.where("false")).collect()} == {"none"}


@pytest.mark.parametrize("hot", [url_filters.HOT, 2])
def test_shared_patterns_are_spread(spark, monkeypatch, hot):
    """Half of the captures meet under one domain; the answer is that of a plain join."""
    monkeypatch.setattr(url_filters, "HOT", hot)
    entries = spark.createDataFrame([("l", "domain", "com", "block", 100), ("l", "domain", "com", "remove", 900), ("l", "host", "h1.com", "allow", 300), ("l", "domain", "x.org", "block", 0)], "list string, kind string, pattern string, action string, dated_at long")
    urls = [(f"http://h{i % 9}.com/{i}" if i % 2 else f"http://a.x.org/{i}" if i % 4 else f"http://other{i}.net/", i) for i in range(1000)]
    got = {r.fetched_at: r.verdict for r in url_filters.filter_urls(spark.createDataFrame(urls, "url string, fetched_at long"), entries).collect()}
    want = {i: ("allow" if "h1.com" in u and i >= 300 else "block" if ".com" in u and 100 <= i < 900 or "x.org" in u else "none") for u, i in urls}
    assert got == want


def test_large_page_ids(spark):
    pages = spark.createDataFrame([(2**62, "http://a.com"), (-5, "http://b.com"), (None, None)], "page_id long, url string")
    assert queries._captures(pages).count() == 3 and len(queries._captures(pages).collect()) == 3


URLS = ["http://A.b.com/x y", "https://b.com:80/é?q=1#f", None, "not a url", "http://u:p@c.com.", "http://a-b.com/z", "http://a.com/0", "http://a.com/\n1", "http://a.com/\n", "http://a.com/ 2"]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture()
def pages(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(URLS), rng.choice([None, "", "x", "é\n", str(i % 3) * 1000, "y" * 300_000 if i == 7 else "z"])) for i in range(60)]
    rows += [(None, None, "solo"), (None, "http://q.com/", "x"), (5, "http://z.com", "x"), (5, "http://z.com", "x")]
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, size int").repartition(3)


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(pages, monkeypatch, least):
    monkeypatch.setattr(warc, "BLOCK_RECORDS", 3)
    rows = [(r.page_id, r.html) for r in pages.collect()]
    best = {}
    for page, html in rows:
        best[sha1(html)] = max(best.get(sha1(html), -1), -1 if page is None else page)
    want = []
    for page, html in rows:
        first = best[sha1(html)]
        response = len((html or "").encode()) < least or (-1 if page is None else page) == first
        want.append((page, len((html or "").encode()), sha1(html), "response" if response else "revisit", None if response else first))
    assert sorted(map(tuple, warc.round_trip(pages, min_revisit=least).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("heavy", [warc.HEAVY, 4, 1])
def test_frequent_payloads_and_large_ids(spark, monkeypatch, heavy):
    """All, some or no digests are answered by a broadcast; ids beyond 2^53 stay exact."""
    monkeypatch.setattr(warc, "HEAVY", heavy)
    monkeypatch.setattr(warc, "CHUNK", 200)
    big = 2**60 + 1
    rows = [(big + i, f"http://h{i % 3}.com/{i}", "" if i % 3 else f"page {i % 7}") for i in range(60)] + [(None, None, "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    best = {}
    for page, _, html in rows:
        best[html] = max(best.get(html, -1), -1 if page is None else page)
    want = {(p, len(h), sha1(h), "response" if p == best[h] else "revisit", None if p == best[h] else best[h]) for p, _, h in rows}
    got = [tuple(r) for r in warc.round_trip(frame).collect()]
    assert len(got) == len(rows) and set(got) == want


def test_lookup(pages, monkeypatch, tmp_dir):
    monkeypatch.setattr(warc, "BLOCK_RECORDS", 2)
    directory = [tuple(r) for r in warc.write(pages.where("page_id < 60 and page_id != 5"), f"{tmp_dir}/w").collect()]
    reader = warc.Reader(directory)
    for r in pages.where("page_id < 60 and page_id != 5").collect():
        fields, _ = reader.lookup(warc.index_key(warc._uri_key(r.url), r.page_id))
        assert fields["X-Page-Id"] == str(r.page_id)
    assert reader.lookup(warc.index_key("com,nowhere)/", 1)) is None
    assert warc.Reader([]).lookup("x") is None


def test_no_pages(pages):
    assert warc.round_trip(pages.where("false")).count() == 0
