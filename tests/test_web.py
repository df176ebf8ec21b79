import gzip

import pytest
from pyspark.sql import functions as F

from webloom.functions import http, names, robots, urls, values
from webloom.sources import crawl as C
from webloom.sources.fetch import HttpFetcher, Options, StoredFetcher, Visitor, gunzip, response
from webloom.sources.read_html import column_names, html_relation, read_html
from webloom.sources.sitemap import parse_sitemap, sitemap, stale

A = "https://a.com"
ROBOTS = "User-agent: *\nDisallow: /private\nAllow: /private/ok\nCrawl-delay: 2\n\nUser-agent: slowbot\nuser-agent: other\nDisallow: /\nSitemap: https://a.com/sm.xml\n"
SITE = {
    f"{A}/robots.txt": (200, "text/plain", ROBOTS),
    f"{A}/": (200, "text/html", '<title>Home</title><a class=n href="/p1">1</a><a class=n href="/p2#x">2</a><a class=n href="/private/z">3</a><a class=n href="https://b.org/">b</a>'),
    f"{A}/p1": (200, "text/html", '<a class=n href="/">home</a><a class=n href="/p3">3</a><table><tr><th>n</th><th>x y</th></tr><tr><td>1</td><td>2.5</td></tr><tr><td>2</td><td></td></tr></table><script>var t = [{b: 1.25, a: "q"}, {a: null}]</script>'),
    f"{A}/p2#x": (200, "text/html; charset=utf-8", "<p>two"),
    f"{A}/p3": (200, "application/pdf", "%PDF"),
    "https://b.org/": (500, "text/html", "oops"),
    f"{A}/sm.xml": (200, "text/xml", f"<sitemapindex><sitemap><loc>{A}/s1.xml</loc></sitemap><sitemap><loc>{A}/s2.xml.gz</loc></sitemap><sitemap><loc>{A}/sm.xml</loc></sitemap></sitemapindex>"),
    f"{A}/s1.xml": (200, "text/xml", f"<urlset><url><loc> {A}/p1?a=1&amp;b=2 </loc><lastmod>2024-01-02</lastmod><changefreq>daily</changefreq><priority>0.8</priority></url><url><loc><![CDATA[{A}/p2]]></loc></url><url></url></urlset>"),
    f"{A}/s2.xml.gz": (200, "application/gzip", gzip.compress(f"<urlset><url><loc>{A}/p3</loc><priority>x</priority></url></urlset>".encode())),
}
STORE = StoredFetcher(SITE)
FAST = {"delay": 0}


def test_urls(spark):
    rows = ["https://www.Shop.example.co.uk:8080/a/b?x=1&y=2#f", "http://e.org", "nope", "", None, "ftp://x/y", "https://e.org?q", "http:///x", "https://e .org/"]
    df = spark.createDataFrame([(u,) for u in rows], "u string")
    got = df.select("u", urls.domain("u").alias("d"), urls.host("u").alias("h"), urls.path("u").alias("p"), urls.bare_path("u").alias("b"), urls.surt("u").alias("s"), urls.surt_domain("u").alias("sd"), urls.url_problem("u").alias("e"), urls.query_parameter("u", "y").alias("y")).collect()
    r = got[0]
    assert (r.d, r.h, r.p, r.b, r.s, r.sd, r.e, r.y) == ("www.Shop.example.co.uk", "www.shop.example.co.uk", "/a/b?x=1&y=2#f", "/a/b", "uk,co,example,shop)/a/b?x=1&y=2#f", "uk,co,example,shop)", None, "2")
    assert (got[1].p, got[1].s, got[1].y) == ("/", "org,e)/", None)
    assert got[2].s == "nope" and got[4].s is None and got[4].p is None and got[6].d == "e.org?q" and got[6].h == "e.org"
    assert [r.e for r in got] == [None, None, "scheme", "empty", "empty", "scheme", None, "host", "control_character"]
    pairs = spark.createDataFrame([("http://www.a.com/x", "https://a.com"), ("http://s.a.com", "http://a.com"), ("http://ba.com", "http://a.com")], "a string, b string")
    assert [tuple(r) for r in pairs.select(urls.same_domain("a", "b"), urls.same_domain("a", "b", True)).collect()] == [(True, True), (False, True), (False, False)]


def test_robots(spark):
    assert not robots.allowed(ROBOTS, "webloom/0.1", "/private/x") and robots.allowed(ROBOTS, "webloom", "/private/ok/1") and robots.allowed(ROBOTS, "webloom", "/robots.txt")
    assert not robots.allowed(ROBOTS, "SlowBot/2", "/a") and not robots.allowed(ROBOTS, "other", "/a") and robots.allowed("", "x", "/a")
    assert robots.allowed("User-agent: *\nDisallow: /a*b$", "x", "/ab/c") and not robots.allowed("User-agent: *\nDisallow: /a*b$", "x", "/a1b")
    assert robots.allowed("User-agent: *\nDisallow:", "x", "/a") and robots.allowed("User-agent: *\nDisallow: /\nAllow: /p", "x", "/p/1", prefix_only=True)
    alone = robots.parse_robots("User-agent: a\nUser-agent: b\nDisallow: /", False)
    assert [g.rules for g in alone.groups] == [[], [(False, "/")]]
    assert robots.crawl_delay(ROBOTS, "zzz") == 2.0 and robots.crawl_delay("User-agent: q\nCrawl-delay: 7", "zzz") == 7.0
    assert robots.effective_delay("User-agent: *\nCrawl-delay: 1\nRequest-rate: 1/5", "x") == 5.0
    df = spark.createDataFrame([(ROBOTS, "/private/x")], "t string, p string")
    r = df.select(robots.robots_allowed(F.col("t"), F.lit("w"), F.col("p")).alias("a"), robots.robots_delay(F.col("t"), F.lit("w")).alias("d"), robots.robots_sitemaps(F.col("t")).alias("s"), robots.sitemap_lines(F.col("t")).alias("s2")).first()
    assert (r.a, r.d, r.s, r.s2) == (False, 2.0, ["https://a.com/sm.xml"], ["https://a.com/sm.xml"])


def test_http_rules(spark):
    rows = [(429, None, 1, "5"), (503, None, 2, None), (404, None, 1, "x"), (0, "Connection timed out", 5, None), (0, "Could not resolve host", 1, None), (0, "certificate expired", 1, None), (0, "connection refused", 1, None), (0, None, 1, None), (200, None, 1, None)]
    df = spark.createDataFrame(rows, "s int, e string, n int, h string")
    got = df.select(http.error_class(F.col("s"), F.col("e")).alias("c"), http.fibonacci_backoff(F.col("n")).alias("b"), http.retry_after_ms(F.col("h")).alias("r"), http.next_action(F.col("s"), F.col("n"), F.col("h")).alias("x")).collect()
    assert [r.c for r in got] == ["rate_limited", "server_error", "client_error", "timeout", "dns_failure", "ssl_error", "connection_refused", "timeout", ""]
    assert [r.r for r in got[:3]] == [5000, 0, 0] and got[3].b == 24 and [got[i].b for i in (0, 1)] == [3, 6]
    assert [r.x.action for r in got] == ["block_domain", "retry", "done", "give_up", "retry", "retry", "retry", "retry", "done"] and got[0].x.wait_ms == 5000
    kinds = spark.createDataFrame([("Text/HTML; charset=x",), ("image/png",), (None,)], "k string")
    assert [r[0] for r in kinds.select(http.content_type_allowed(F.col("k"), ["text/*", "image/png"], ["image/png"])).collect()] == [True, False, False]
    d = spark.createDataFrame([("Wed, 21 Oct 2015 07:28:00 GMT",), ("x",)], "d string").select(http.server_date(F.col("d"), F.lit("2015-10-21 07:30:00").cast("timestamp")).alias("t"), http.server_date(F.col("d"), F.lit("2016-10-21 07:30:00").cast("timestamp")).alias("u")).collect()
    assert d[0].t is not None and d[0].u is None and d[1].t is None
    delays = http.adaptive_delays(spark.createDataFrame([("d", i, ms) for i, ms in enumerate([100, 100, 1000, 10])], "domain string, seq long, response_ms long")).orderBy("seq").collect()
    assert [round(r.delay, 3) for r in delays] == [1.0, 1.0, 1.5, 1.35]


def test_values(spark):
    df = spark.createDataFrame([("€ 1.299,99", '{"a":[{"b":"x"},{"b":2}]}'), ("12,99 kr", None), ("$1,299", '{"a":{"b":[1]}}'), ("7", "{")], "p string, j string")
    assert [r[0] for r in df.select(values.transform(F.col("p"), "trim", "parse_price")).collect()] == ["1299.99", "12.99", "1299", "7"]
    got = df.select(values.json_path(F.col("j"), "->'a'->[0]->>'b'").alias("t"), values.json_path(F.col("j"), "->'a'->[0]->'b'").alias("j"), values.json_path(F.col("j"), "->'a'->'b'").alias("n")).collect()
    assert (got[0].t, got[0].j) == ("x", '"x"') and got[1].t == "" and got[2].n == "[1]" and got[3].t == ""
    c = spark.createDataFrame([(" Yes ", "a1b2", "<p>a &amp; <b>b</b><script>x</script></p>"), ("maybe", "", "")], "b string, i string, h string")
    r = c.select(values.coerce(F.col("b"), "BOOLEAN").alias("b"), values.coerce(F.col("i"), "INTEGER").alias("i"), values.coerce(F.col("i"), "DECIMAL(10,2)").alias("d"), values.strip_html(F.col("h")).alias("h")).collect()
    assert (r[0].b, r[0].i, float(r[0].d), r[0].h) == (True, 12, 12.0, "a & b") and r[1].b is None and r[1].i is None


def test_crawl(spark):
    got = C.crawl(spark, [f"{A}/", None, f"{A}/private/z", f"{A}/none"], STORE, **FAST).orderBy("url").collect()
    assert got[0].__fields__ == list(C.CRAWL)
    by = {r.url: r for r in got}
    assert len(by) == 3 and by[f"{A}/"].html.document.startswith("<title>") and by[f"{A}/"].depth == 1
    assert by[f"{A}/private/z"].status == 0 and "robots" in by[f"{A}/private/z"].error and by[f"{A}/none"].status == 404


def test_follow(spark):
    got = C.crawl(spark, f"{A}/", STORE, follow="a.n", max_depth=3, **FAST).collect()
    assert {(r.url[14 if r.url.startswith(A) else 0 :], r.depth) for r in got} == {("", 1), ("p1", 2), ("p2#x", 2), ("private/z", 2), ("https://b.org/", 2), ("p3", 3)}
    assert len(C.crawl(spark, f"{A}/", STORE, follow="a.n", max_depth=3, max_results=2, **FAST).collect()) == 2
    inside = C.crawl(spark, f"{A}/", STORE, follow="a.n", max_depth=2, same_site=True, respect_robots=False, accept=["text/html"], **FAST).collect()
    assert len(inside) == 4 and all(r.url.startswith(A) for r in inside)


def test_state_and_cache(spark):
    for t in ("crawl_state", "crawl_cache"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    first = C.crawl(spark, [f"{A}/", f"{A}/p1"], STORE, state_table="crawl_state", cache="crawl_cache", **FAST)
    assert first.count() == 2 and spark.table("crawl_state").count() == 2 and spark.table("crawl_cache").count() == 2
    again = C.crawl(spark, [f"{A}/", f"{A}/p2#x"], STORE, state_table="crawl_state", **FAST)
    assert [r.url for r in again.collect()] == [f"{A}/p2#x"] and spark.table("crawl_state").count() == 3
    hit = C.crawl(spark, [f"{A}/"], StoredFetcher({}), cache="crawl_cache", **FAST).first()
    assert hit.status == 200 and hit.final_url == f"{A}/"
    for t in ("crawl_state", "crawl_cache"):
        spark.sql(f"DROP TABLE {t}")


def test_lateral_and_stream(spark):
    df = spark.createDataFrame([(1, f"{A}/p1"), (2, None), (3, ""), (4, f"{A}/p1")], "k int, url string")
    got = C.crawl_url(df, fetcher=STORE).orderBy("k").collect()
    assert [(r.k, r.status, r.error) for r in got] == [(1, 200, None), (2, 0, "NULL URL"), (4, 200, None)] and got[0].html.js
    assert C.crawl_url(df, fetcher=STORE, max_results=1).count() == 1
    df.createOrReplaceTempView("some_urls")
    s = C.crawl_stream(spark, "SELECT url FROM some_urls WHERE url <> ''", STORE, crawl_delay=0)
    assert s.columns == list(C.STREAM) and s.count() == 2
    assert C.crawl_stream(spark, [f"{A}/private/z", "https://b.org/"], STORE, crawl_delay=0).select("status_code", "jsonld").collect() == [(500, None)]
    C.register_crawl_url(spark, STORE)
    C.register_functions(spark)
    r = spark.sql("SELECT u.k, htmlpath(c.body, 'table td@text') AS v, jq(c.body, 'th').text AS t FROM some_urls u, LATERAL crawl_url(u.url) c WHERE c.status = 200 ORDER BY k").collect()
    assert [(x.k, x.v, x.t) for x in r] == [(1, '"1"', "n"), (4, '"1"', "n")]
    pages = spark.createDataFrame([(f"{A}/p1", 200, "text/html", "<p>x", f"{A}/p1", None)], "url string, status int, content_type string, body string, final_url string, error string")
    assert [(r.status, r.error) for r in C.stored_crawl(df.where("k in (1,3)"), pages).orderBy("url").collect()] == [(404, "not stored"), (200, None)]


def test_sitemap(spark):
    p = parse_sitemap(SITE[f"{A}/s1.xml"][2])
    assert p["urls"][0] == {"url": f"{A}/p1?a=1&b=2", "lastmod": "2024-01-02", "changefreq": "daily", "priority": 0.8} and p["urls"][1]["url"] == f"{A}/p2" and len(p["urls"]) == 2
    assert parse_sitemap("nothing") == {"urls": [], "children": []}
    got = sitemap(spark, A, STORE, discover=True)
    assert sorted(r.url for r in got.collect()) == [f"{A}/p1?a=1&b=2", f"{A}/p2", f"{A}/p3"]
    assert sitemap(spark, f"{A}/sm.xml", STORE, recursive=False).count() == 0
    assert sitemap(spark, f"{A}/s1.xml", STORE, like="%/p2").count() == 1 and sitemap(spark, "https://no.org", STORE, discover=True).count() == 0
    done = spark.createDataFrame([(f"{A}/p2", "2024-01-01 00:00:00"), (f"{A}/p3", "2024-01-08 12:00:00")], "url string, t string").select("url", F.col("t").cast("timestamp").alias("crawled_at"))
    assert sorted(r.url for r in stale(got, done, F.lit("2024-01-09 00:00:00").cast("timestamp")).collect()) == [f"{A}/p1?a=1&b=2", f"{A}/p2"]


def test_read_html(spark):
    df = read_html(spark, f"{A}/p1", fetcher=STORE)
    assert df.dtypes == [("n", "bigint"), ("x_y", "double")] and [tuple(r) for r in df.collect()] == [(1, 2.5), (2, None)]
    js = read_html(spark, f"{A}/p1", "js=t", fetcher=STORE)
    assert js.dtypes == [("a", "string"), ("b", "double")] and [tuple(r) for r in js.collect()] == [("q", 1.25), (None, None)]
    assert html_relation(spark, "<ul><li>1<li>2</ul>", "ul").dtypes == [("item", "bigint")]
    assert [tuple(r) for r in html_relation(spark, "<script>var o = {k: [1], z: null}</script>", "script@js=o").collect()] == [("k", "[1]"), ("z", None)]
    assert column_names(["A b", "", "a_B", "x/(y)"]) == ["A_b", "column2", "a_B_2", "x__y_"]
    for bad in (("ul", 1), ("table", 0), ("table", 2), ("js=none", 1), ("a[", 1)):
        with pytest.raises(ValueError):
            read_html(spark, f"{A}/p1", *bad, fetcher=STORE)
    with pytest.raises(ValueError):
        read_html(spark, f"{A}/missing", fetcher=STORE)


def test_options(spark):
    spark.conf.set("webloom.timeout_ms", "5")
    spark.conf.set("webloom.respect_robots", "false")
    o = Options.of(spark, user_agent="x", headers={A: {"Authorization": "Bearer 1"}})
    assert (o.timeout_ms, o.respect_robots, o.user_agent) == (5, False, "x") and o.headers_for(f"{A}/q") == {"Authorization": "Bearer 1"} and o.headers_for("http://z") == {}
    spark.conf.unset("webloom.timeout_ms")
    spark.conf.unset("webloom.respect_robots")
    assert STORE.fetch(f"{A}/p1", Options(max_response_bytes=5))["error"] == "content too large"


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(round(seconds, 6))
        self.now += seconds


class Scripted:
    """Answers from a list of statuses for each URL; the last one stays."""

    def __init__(self, clock, plan, robots=None, after=None):
        self.clock, self.plan, self.robots, self.after, self.log = clock, {u: list(v) for u, v in plan.items()}, robots or {}, after or {}, []

    def fetch(self, url, options):
        if url.endswith("/robots.txt"):
            return response(url, 200, "text/plain", self.robots.get(url, ""), url)
        left = self.plan[url]
        status = left.pop(0) if len(left) > 1 else left[0]
        self.log.append((round(self.clock.now, 6), url, status))
        return response(url, status, "text/html", "x", url, None if status else "timed out", 10) | {"retry_after": self.after.get(url)}


def visited(plan, urls, **how):
    clock = Clock()
    robots, after = how.pop("robots", None), how.pop("after", None)
    fetcher = Scripted(clock, plan, robots, after)
    got = Visitor(fetcher, Options(**how), robots is not None, True, clock, clock.sleep).visit(urls)
    return got, fetcher.log, clock


def test_delays_hold_for_a_host_whatever_the_scheme():
    a, b, c = "http://h.org/1", "https://h.org/2", "http://other.org/3"
    got, log, _ = visited({a: [200], b: [200], c: [200]}, [a, b, a, c], delay_ms=1000)
    assert [g["status"] for g in got] == [200] * 4
    assert log == [(0.0, a, 200), (0.0, c, 200), (1.0, b, 200), (2.0, a, 200)]
    # the site's own Crawl-delay, and rules that are read once
    got, log, _ = visited({a: [200], b: [200]}, [a, b, "http://h.org/no"], delay_ms=1000, robots={"http://h.org/robots.txt": "User-agent: *\nDisallow: /no\nCrawl-delay: 5"})
    assert [t for t, _, _ in log] == [0.0, 5.0] and got[2]["error_type"] == "robots_disallowed"


def test_failures_are_tried_again_and_a_429_blocks_the_site():
    a, b, c = "http://h.org/a", "http://h.org/b", "http://z.org/c"
    got, log, _ = visited({a: [503, 0, 200], b: [200], c: [404]}, [a, b, c], delay_ms=0, max_retries=3, retry_base_s=3.0)
    assert [g["status"] for g in got] == [200, 200, 404] and [(t, s) for t, u, s in log if u == a] == [(0.0, 503), (3.0, 0), (9.0, 200)]
    got, log, _ = visited({a: [429, 200], b: [200], c: [200]}, [a, b, c], delay_ms=0, max_retries=1, after={a: "60"})
    assert log == [(0.0, a, 429), (0.0, c, 200), (60.0, a, 200), (60.0, b, 200)] or log == [(0.0, a, 429), (0.0, c, 200), (60.0, b, 200), (60.0, a, 200)]
    got, log, _ = visited({a: [500]}, [a], delay_ms=0, max_retries=2)
    assert got[0]["status"] == 500 and len(log) == 3 and "retry_after" not in got[0]
    assert len(visited({a: [500]}, [a])[1]) == 1  # none without being asked for


def test_a_delay_that_adapts():
    a = "http://h.org/a"
    clock = Clock()

    class Slow:
        times = iter([100, 100, 1000, 10, 10])

        def fetch(self, url, options):
            return response(url, 200, "text/html", "", url, None, next(self.times))

    v = Visitor(Slow(), Options(delay_ms=1000, adaptive_delay=True), False, True, clock, clock.sleep)
    v.visit([a] * 5)
    assert clock.slept == [1.0, 1.0, 1.5, 1.35]


def test_many_urls_of_one_site_take_near_linear_time():
    import time

    urls = [f"http://h.org/{i}" for i in range(20000)]
    began = time.process_time()
    _, log, clock = visited({u: [200] for u in urls}, urls, delay_ms=10)
    assert time.process_time() - began < 10 and [u for _, u, _ in log] == urls and clock.now == pytest.approx(199.99)


def test_http_fetcher_answers_whatever_is_asked(monkeypatch):
    f, o = HttpFetcher(), Options(timeout_ms=200)
    for url in ("http://127.0.0.1:1/a b", "file:///etc/hostname", "ftp://x/y", "nope", "http://[bad/", "http://127.0.0.1:1/"):
        r = f.fetch(url, o)
        assert r["status"] == 0 and r["error"] and r["body"] is None, url

    import http.server
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append((self.path, self.headers.get("Authorization")))
            if self.path == "/away":
                self.send_response(302)
                self.send_header("Location", f"http://localhost:{port}/there")
                self.end_headers()
            elif self.path == "/file":
                self.send_response(302)
                self.send_header("Location", "file:///etc/hostname")
                self.end_headers()
            elif self.path == "/short":
                self.send_response(200)
                self.send_header("Content-Length", "100")
                self.end_headers()
                self.wfile.write(b"x")
            else:
                self.send_response(200)
                self.send_header("Content-Type", "text/html; charset=no-such-thing")
                self.end_headers()
                self.wfile.write(gzip.compress(b"a" * 20_000_000) if self.path == "/bomb" else "é".encode())

        def log_message(self, *_):
            pass

    seen = []
    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    port = server.server_port
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        home = f"http://127.0.0.1:{port}"
        o = Options(timeout_ms=2000, headers={home: "secret"})
        assert f.fetch(f"{home}/x", o)["body"] == "é"  # a charset that nobody knows
        away = f.fetch(f"{home}/away", o)
        assert away["status"] == 200 and away["final_url"] == f"http://localhost:{port}/there"
        assert seen == [("/x", "Bearer secret"), ("/away", "Bearer secret"), ("/there", None)]
        assert f.fetch(f"{home}/file", o)["status"] in (0, 302) and not f.fetch(f"{home}/file", o)["body"]
        assert f.fetch(f"{home}/short", o)["error"]
        assert f.fetch(f"{home}/bomb", o)["error"] == "content too large"
    finally:
        server.shutdown()


def test_headers_and_proxies_stay_within_their_prefix():
    o = Options(headers={"https://a.com": "t", "https://a.com/in": {"X": "1"}}, proxy="http://all", proxies={"https://a.com": "http://one", "https://a.com/in": "http://two"})
    assert o.headers_for("https://a.com/in/x") == {"Authorization": "Bearer t", "X": "1"} and o.headers_for("https://A.com") == {"Authorization": "Bearer t"}
    for url in ("https://a.com.evil.org/", "http://a.com/", "https://a.com:8443/", "https://x@a.com.evil.org"):
        assert o.headers_for(url) == {} and o.proxy_for(url) == "http://all"
    assert "X" not in o.headers_for("https://a.com/inside") and o.proxy_for("https://a.com/in?q") == "http://two" and o.proxy_for("https://a.com/q") == "http://one"


def test_inflating_is_bounded():
    data = gzip.compress(b"a" * 5_000_000) + gzip.compress(b"b" * 10)
    assert len(gunzip(data)) == 5_000_010 and len(gunzip(data, 100)) == 101 and gunzip(data[:50]) == b"" and gunzip(b"plain", 2) == b"plain"


def test_deep_crawls_of_a_table_keep_their_order(spark):
    site = {f"https://d.org/{i}": (200, "text/html", f'<a class="n" href="/{i + 1}">x</a><a class="n" href="/{i}?b">y</a>') for i in range(12)}
    urls = spark.createDataFrame([("https://d.org/0",), ("https://d.org/5",), ("http://bad host/x",), ("https://d.org/8",)], "url string").repartition(3)
    got = C.crawl(spark, urls, StoredFetcher(site), follow="a.n", max_depth=8, respect_robots=False, delay=0).collect()
    depth = {r.url: r.depth for r in got}
    assert depth["https://d.org/0"] == 1 and depth["https://d.org/4"] == 5 and depth["https://d.org/12"] == 5 and "http://bad host/x" in depth and len(depth) == len(got)


def test_cache_keeps_the_last_answer_and_compacts(spark):
    t = "crawl_cache_two"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    ask = lambda body, ttl: C.crawl(spark, ["https://c.org/1"], StoredFetcher({"https://c.org/1": (200, "text/html", body)}), cache=t, cache_ttl=ttl, respect_robots=False, delay=0).first().html.document
    assert [ask("<p>1", 24), ask("<p>2", 24), ask("<p>3", 0), ask("<p>4", 24)] == ["<p>1", "<p>1", "<p>3", "<p>3"]
    assert spark.table(t).count() == 2
    C.compact(spark, t)
    assert [r.body for r in spark.table(t).collect()] == ["<p>3"]
    spark.sql(f"DROP TABLE {t}")


def test_a_crawl_can_be_stopped(spark):
    import threading
    import time

    class Sleepy:
        def fetch(self, url, options):
            time.sleep(20)
            return response(url, 200, "text/html", "", url)

    failed = []

    def run():
        with C.interruptible(spark, "slow crawl"):
            try:
                C.crawl(spark, ["https://s.org/1"], Sleepy(), respect_robots=False, delay=0)
            except Exception as e:
                failed.append(str(e))

    from pyspark import InheritableThread

    t = InheritableThread(target=run)
    began = time.time()
    t.start()
    time.sleep(4)
    C.interrupt(spark, "slow crawl")
    t.join(15)
    assert failed and "ancel" in failed[0] and time.time() - began < 19


def test_names():
    assert names.quote_name("a.b") == "`a`.`b`" and names.quote_name('`x.y`."z`"') == "`x.y`.`z```" and names.quote_text("it's \\") == "'it\\'s \\\\'"
    for bad in ("", "a..b", "a;`", ".a", "`a"):
        with pytest.raises(ValueError):
            names.quote_name(bad)
    assert names.valid_name("_a.b1") and not names.valid_name("1a") and not names.valid_name("a" * 129) and not names.valid_name("a-b")


def test_a_giant_site_without_delay_is_spread(spark, monkeypatch):
    from webloom.sources import fetch

    class Two:
        """Answers with the task that asks; one site wants a delay."""

        def fetch(self, url, options):
            if url.endswith("/robots.txt"):
                return fetch.response(url, 200, "text/plain", "User-agent: *\nDisallow: /p9\n" + ("Crawl-delay: 0.001\n" if "slow" in url else ""), url)
            from pyspark import TaskContext

            return fetch.response(url, 200, "text/html", str(TaskContext.get().partitionId()), url)

    monkeypatch.setattr(fetch, "GIANT", 20)
    urls = [f"https://{s}.example/p{i}" for s in ("fast", "slow") for i in range(200)] + ["https://small.example/p1"]
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, seq bigint")
    got = fetch.fetch_all(df, Two(), fetch.Options(delay_ms=0), 8).collect()
    assert sorted(r.url for r in got) == sorted(urls) and {r.seq for r in got} == set(range(len(urls)))
    tasks = {s: {r.body for r in got if s in r.url and r.error_type is None} for s in ("fast", "slow", "small")}
    assert len(tasks["fast"]) > 2 and len(tasks["slow"]) == len(tasks["small"]) == 1, tasks
    assert {r.url for r in got if r.error_type} == {u for u in urls if "/p9" in u}
    again = fetch.fetch_all(df, Two(), fetch.Options(delay_ms=0, max_retries=1), 8).collect()
    assert len({r.body for r in again if "fast" in r.url and r.error_type is None}) == 1
