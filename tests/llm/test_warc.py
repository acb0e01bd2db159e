import gzip
import hashlib

import pytest

from onsetlake.llm import common, registry, warc

SF = "/root/testdata/sf0.001"


def brute(rows):
    first = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        origin = first.get(html) if len(raw) >= 100 else None
        again = origin is not None and origin != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", origin if again else None))
    return sorted(out, key=str)


def test_keys():
    assert warc.url_key("https://Blog.Site.example.com:443/a/b?x=1#top") == "com,example,site,blog)/a/b?x=1"
    assert warc.url_key("http://h.example:8080") == "example,h:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") and " " not in warc.url_key("http://a/b c\n")


def test_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = registry.op10_warc_capture_index(spark, SF).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows)


LONG = "<p>" + "é" * 60


@pytest.mark.parametrize("rows", [[], [
    (None, None, None), (4, "http://a.b/x", LONG), (2, "http://c.b/x y\n", LONG), (2, "http://c.b/x y\n", LONG),
    (9, "no url", "short"), (8, "no url", "short"), (7, "http://[bad", "a\r\n\r\nb" * 40), (None, "http://a.b/x", LONG),
    (11, "http://a.b/x", "z" * 400_000), *[(k, "http://hot.example/", f"text {k}" * 30) for k in range(20, 60)]]])
def test_odd_rows(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, size int")
    out = str(tmp_path)
    got = warc.round_trip(df, out, lines=3).collect()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == brute(rows)
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    assert all(bytes(r.payload) == texts[r.payload_digest] for r in got if r.record_type == "response")
    for name in tmp_path.glob("archives/*.gz"):
        assert gzip.decompress(name.read_bytes()).count(b"WARC/1.1\r\nWARC-Type: ") > 0


def test_lookup_of_some_and_unknown_keys(spark, tmp_path):
    rows = [(k, f"http://s{k % 7}.example.org/p{k}", f"page {k}") for k in range(200)]
    captures = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path))
    directory = warc.write_index(captures, str(tmp_path), lines=5)
    asked = [warc.url_key(rows[k][1]) for k in (0, 3, 150)] + ["zz", "", "org,example,s3)/p", None]
    found = warc.lookup(spark.createDataFrame([(a,) for a in asked], "key string"), directory, str(tmp_path))
    assert sorted(r.page_id for r in found.collect()) == [0, 3, 150]
    assert sorted(bytes(r.payload) for r in warc.read_records(found, str(tmp_path)).collect()) == [b"page 0", b"page 150", b"page 3"]


def test_lookup_is_linear_in_captures(spark, tmp_path):
    """Rows that pass through the lookup's Python tasks: a directory row and a key each, whatever the shards hold."""
    import time

    def seconds(n):
        out = str(tmp_path / str(n))
        rows = spark.range(n).selectExpr("id AS page_id", "concat('http://s', id % 7, '.example.org/p', id) AS url", "cast(id AS string) AS html")
        captures = common.stored(warc.write_archives(rows, out), "captures")
        directory = warc.write_index(captures, out, lines=10)
        start = time.perf_counter()
        assert warc.lookup(captures.select("key"), directory, out).count() == n
        return time.perf_counter() - start

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        seconds(500)
        few, many = seconds(2000), seconds(16000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert many <= 10 * max(few, 1)
