from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from pulsegrain.llm import warc
from pulsegrain.llm.queries import ORACLE, op8_warc
from tests.compare import connect, differences
from tests.conftest import SMALL

LONG = "<p>same page</p>" * 100


def pages(spark):
    rows = [(i, f"http://host{i % 3}.example.org/a/{i % 50}?q={i}", f"<p>{i}</p>" * (i % 400)) for i in range(700)]
    rows += [(1000 + i, "https://Copy.example.org:80/x#f", LONG) for i in range(600)]
    rows += [(2000, None, None), (None, "http://a.b/", LONG), (2001, "not a url\r\n", "é" * 600), (5, rows[5][1], rows[5][2]),
             (1003, "https://copy.example.org/x", LONG), (2002, "http://z.example/", "short"), (2003, "http://z.example/", "short")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {n: F.lit("clash") for n in ("key", "payload", "digest", "original", "n", "refers_to")}).repartition(4)


def expected(rows):
    best: dict[str, int] = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = best.get(html) if page is not None and len(data) >= 1000 else None
        revisit = original is not None and original != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    original if revisit else None))
    return sorted(out, key=str)


def test_everything_comes_back(spark):
    rows, df = pages(spark)
    archives = warc.write_archives(df)
    found = warc.captures(archives, df.select(warc.url_key("url").alias("key")))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in found.collect()], key=str) == expected(rows)


def test_lookup_of_some_urls(spark):
    rows, df = pages(spark)
    archives = warc.write_archives(df)
    asked = spark.createDataFrame([("http://copy.example.org/x",), ("http://host1.example.org/a/1?q=1",),
                                   ("http://nowhere.example/",), (None,)], "url string")
    keys = asked.where("url IS NOT NULL").select(warc.url_key("url").alias("key"))
    found = warc.captures(archives, keys, payloads=True).collect()
    assert len(found) == 602
    assert {r.page_id for r in found if r.payload} == {1, 1599}
    assert next(bytes(r.payload) for r in found if r.page_id == 1599) == LONG.encode()


def test_keys_and_empty_table(spark):
    urls = spark.createDataFrame([("http://User@WWW.Example.com:8080/p?q#f",), ("x",), (None,)], "url string")
    assert [r[0] for r in urls.select(warc.url_key("url")).collect()] == ["com,example,www)/p?q", "x", ""]
    _, df = pages(spark)
    archives = warc.write_archives(df.where("false"))
    assert warc.captures(archives, df.select(warc.url_key("url").alias("key"))).count() == 0


def test_against_sql(spark):
    assert differences(op8_warc(spark, SMALL), connect(SMALL), ORACLE["op8_warc"]) is None
