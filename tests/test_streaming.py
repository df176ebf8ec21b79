from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from webloom import streaming
from webloom.plans.extract_clause import crawl_into, parse_crawl, parse_extract, select_extract
from webloom.plans.statement import StatementError
from webloom.sources.fetch import StoredFetcher

from .test_web import A, SITE


@pytest.fixture
def stream(spark, tmp_path):
    def make(rows, schema, parts=1):
        path = str(tmp_path / f"in{len(list(tmp_path.iterdir()))}")
        df = spark.createDataFrame(rows, schema)
        df.repartition(parts).write.parquet(path)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)

    return make


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


EVENTS = [(i, datetime(2024, 1, 1) + timedelta(minutes=7 * i), i % 3, float(i)) for i in range(60)] + [(99, datetime(2024, 1, 3), 0, 1.0)]


def test_windows_stream_like_batches(spark, stream):
    schema = "event_id long, ts timestamp, user_id long, value double"
    src = stream(EVENTS, schema)
    batch = spark.createDataFrame(EVENTS, schema)
    got = drain(streaming.tumbling(src), "tumble")
    want = streaming.tumbling(batch).where("window_start < '2024-01-02'")
    assert sorted(got.collect()) == sorted(want.collect())
    assert drain(streaming.sessions(src), "sess").count() > 0
    assert drain(streaming.sliding(src), "slide").count() > 0
    assert drain(streaming.distinct_events(src.union(src), ["event_id"]), "dedup").count() == len(EVENTS)


def test_state_and_upserts(spark, stream, tmp_path):
    src = stream([("d", 100.0)] * 3 + [("d", 1000.0), ("e", 5.0)], "domain string, response_ms double")
    got = {r.domain: r.n for r in drain(streaming.domain_delays(src), "delays", "update").collect()}
    assert got == {"d": 4, "e": 1}
    spark.sql("DROP TABLE IF EXISTS up")
    rows = stream([("a", 1, 1), ("a", 2, 2), ("b", 3, 3)], "k string, v int, o int")
    streaming.merge_stream(rows, "up", "k", str(tmp_path / "cp"), "o").awaitTermination(120)
    assert sorted((r.k, r.v) for r in spark.table("up").collect()) == [("a", 2), ("b", 3)]
    spark.sql("DROP TABLE up")
    spark.sql("DROP TABLE IF EXISTS seen_urls")
    urls = stream([("u1",), ("u2",), ("u1",)], "url string", 3)
    streaming.crawl_frontier(urls, lambda df: df.withColumn("status", F.lit(200)), "seen_urls", str(tmp_path / "cp2")).awaitTermination(120)
    assert spark.table("seen_urls").count() == 2
    spark.sql("DROP TABLE seen_urls")


def test_extract_clause(spark):
    html = """<meta property="og:title" content="O"><h1 id=q> Hi </h1><b class=price>€ 1.299,50</b><i>Yes</i><script type="application/ld+json">{"@type":"Product","name":"Lamp","offers":[{"price":"3"}]}</script>"""
    df = spark.createDataFrame([(1, html)], "k int, html string")
    r = select_extract(df, "html", "EXTRACT (jsonld.Product.name, COALESCE(meta.x, og.title) AS t, jsonld.Product.offers[0].price AS p, css 'h1::attr(id)' AS i, price DECIMAL(10,2) FROM css 'b.price::text' | parse_price, ok BOOLEAN FROM css 'i::text', css 'i' AS outer, regex '<b class=(\\w+)>' AS cls)", "k").first()
    assert (r.k, r.name, r.t, r.p, r.i, float(r.price), r.ok, r.outer, r.cls) == (1, "Lamp", "O", "3", "q", 1299.5, True, "<i>Yes</i>", "price")
    for bad in ("EXTRACT (nope.x)", "EXTRACT (a FROM css 'x' | explode)"):
        with pytest.raises(StatementError):
            parse_extract(bad)


def test_crawl_into(spark):
    spark.sql("DROP TABLE IF EXISTS ci")
    for _ in range(2):
        n = crawl_into(spark, [f"{A}/", f"{A}/p1"], "ci", "EXTRACT (title FROM css 'title::text')", fetcher=StoredFetcher(SITE), delay=0).first().rows_inserted
    assert n == 2 and spark.table("ci").count() == 4 and {r.title for r in spark.table("ci").collect()} == {"Home", None}
    assert spark.table("ci").columns[:18] == ["url", "surt_key", "status_code", "body", "content_type", "crawled_at", "elapsed_ms", "error", "error_type", "final_url", "redirect_count", "etag", "last_modified", "content_hash", "jsonld", "opengraph", "meta", "js"]
    spark.sql("DROP TABLE ci")


def test_crawl_statement(spark):
    s = parse_crawl("""CRAWL (SELECT u FROM x WHERE a IN ('LIMIT 3', 'INTO y')) INTO db.t EXTRACT (jsonld.Product.name AS name, price DECIMAL FROM css '.p::text') WHERE url LIKE '%WITH (%' WITH (user_agent 'B/1 (+x)', follow_links true, max_crawl_depth 3, default_crawl_delay 0.5, accept_content_types 'text/html, application/pdf') LIMIT 9;""")
    assert (s.query, s.table, s.sites, s.where, s.limit) == ("SELECT u FROM x WHERE a IN ('LIMIT 3', 'INTO y')", "db.t", False, "url LIKE '%WITH (%'", 9)
    assert s.settings() == {"user_agent": "B/1 (+x)", "max_depth": 3, "delay": 500, "accept": ["text/html", "application/pdf"], "follow": "a[href]", "same_site": True, "respect_nofollow": True}
    assert parse_crawl("crawl sites (select 'a') into t").sites
    for bad in ("CRAWL (SELECT 1)", "CRAWL (SELECT 1) INTO t WITH (nope 1)", "CRAWL (SELECT 1) INTO t LIMIT x", "CRAWL (SELECT 1) INTO t what", "CRAWL (SELECT 1) INTO t WITH (timeout_seconds soon)"):
        with pytest.raises(StatementError):
            parse_crawl(bad).settings()


def test_extract_proposals(spark):
    html = """<html><body><h1 class="t big">Tea <b>x</b></h1><ul id=c><li>a</li><li> b </li></ul><p data-p="7">2,5 kg</p><i class=p>12,99 kr</i></body></html>"""
    df = spark.createDataFrame([(1, html), (2, "<p>other")], "k int, html string")
    clause = """EXTRACT (name TEXT FROM jsonld 'Product.name' OR xpath '//h1[contains(@class, "t")]/text()' REQUIRED, items TEXT[] FROM css 'li::text', line TEXT FROM css 'li::text' TRANSFORM join_array SEPARATOR ' / ',
      p INTEGER FROM attr 'p' 'data-p', grams DECIMAL(9,2) FROM css 'p::text' TRANSFORM normalize_quantity, cur TEXT FROM meta 'currency' DEFAULT 'EUR', second TEXT FROM xpath '/html/body/ul[@id="c"]/li[2]/text()', price DECIMAL(9,2) FROM css '.p::text' | parse_price DEFAULT 0, brand TEXT FROM jsonld 'X.y' OR css 'h1 b::text' WARN_FALLBACK)"""
    rows = select_extract(df, "html", clause, "k").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.name, r["items"], r.line, r.p, float(r.grams), r.cur, r.second, float(r.price), r.brand) == ("Tea", ["a", "b"], "a / b", 7, 2500.0, "EUR", "b", 12.99, "x")
    import json

    note = json.loads(r._extraction_meta)
    assert note["brand"] == {"source": "css", "success": True, "fallback": True} and note["items"]["fallback"] is False and note["cur"]["success"] is False
    for bad in ("EXTRACT (a TEXT FROM css 'x' TRANSFORM nope)", "EXTRACT (a TEXT FROM css 'x' DEFAULT)", "EXTRACT (a TEXT FROM xpath 'x[')"):
        with pytest.raises(StatementError):
            parse_extract(bad)


def test_xpath():
    from webloom.functions.dom import parse
    from webloom.functions.xpath import XPathError, select

    root = parse('<div><p id="a">x<b>1</b></p><p id="b" class="k">y</p></div><div><p>z</p><a href="/1">l</a></div>')
    texts = lambda p: [v if isinstance(v, str) else v.text() for v in select(root, p)]
    assert texts("//p") == ["x1", "y", "z"] and texts("//p[1]") == ["x1", "z"] and texts("//div/p[last()]/text()") == ["y", "z"] and texts("//p[@id and @class='k']") == ["y"]
    assert texts("//a/@href") == ["/1"] and texts("//p[text()='x']/b") == ["1"] and texts("//b/../@id") == ["a"] and texts("//*[contains(text(), 'y')]/@class") == ["k"] and texts("//q") == []
    for bad in ("", "p", "//p[", "//text()/p", "//p[foo()]"):
        with pytest.raises(XPathError):
            select(root, bad)
