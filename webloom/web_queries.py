"""Queries of sources, sinks and structured data. Their pages are made by rule from the rows
of the tables, so that SQL can say what must come out of them."""

from __future__ import annotations

import gzip
import re
import uuid
from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import html as H
from .plans.extract_clause import crawl_into, extract_columns, parse_extract
from .plans.statement import sql
from .queries import _t, query
from .session import page_batches, written
from .sources import crawl as C
from .sources.fetch import Options, response
from .sources.read_html import read_html
from .sources.sitemap import sitemap, sitemap_entries, stale

# structured data: a page for each part

_PAGE = """<html><head><title>{p_name}</title><link rel="canonical" href="/part/{p_partkey}?size={p_size}">
<meta name="robots" content="{robots}"><meta name="description" content="{p_type}"><meta property="og:title" content="{p_name}"><meta property="og:image" content="a{p_size}.png"><meta property="og:image" content="b{p_size}.png"><meta name="twitter:card" content="{p_brand}">
<script type="application/ld+json">{"@context":"https://schema.org","@type":"Product","sku":"{p_partkey}","name":"{p_name}","brand":{"@type":"Brand","name":"{p_brand}"},"offers":[{"@type":"Offer","price":{p_size}},{"@type":"Offer","price":{p_partkey}}]}</script>
<script type="application/ld+json">{"@graph":[{"@type":["Thing","Place"],"name":"{p_type}"}]}</script><script type="application/ld+json">{broken {p_partkey}</script></head><body>
<div itemscope itemtype="https://schema.org/Offer"><span itemprop="price">{p_size}</span><meta itemprop="sku" content="{p_partkey}"><b itemprop="name"> {p_name} </b></div>
<div class="box" id="d{p_partkey}"><span class="price"> € 1.{cents},50 </span><i>{p_brand}</i></div>
<script>var size = {p_size}; const tags = ["{p_type}", {p_partkey}, {"k": [{p_size}]}]; /* var no = 1; */ window.__STATE__ = {"part": {p_partkey}};</script><script id="__NEXT_DATA__" type="application/json">{"props":{"id":{p_partkey}}}</script>
<table><thead><tr><th>Key</th><th>Unit price</th></tr></thead><tr><td>{p_partkey}</td><td>{p_size}<sup class="reference"><a href="#cite_note-1">[1]</a></sup></td></tr><tr><td>{p_name}</td><td>{p_brand}</td></tr></table>
<ul><li>{p_name}</li><li> {p_type} </li></ul><p><a href="/n/{p_partkey}" rel="nofollow">n</a><a href="../m/{p_size}#f">m</a><a href="mailto:x@e.org">x</a></p></body></html>"""


def made_pages(parts: DataFrame) -> DataFrame:
    """The parts' columns with url and html."""
    values: dict[str, Column] = {c: F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")}
    values |= {"robots": F.when(F.col("p_size") > 25, "noindex, nofollow").otherwise("index"), "cents": F.lpad((F.col("p_size") + 100).cast("string"), 3, "0")}
    pieces = re.split(r"\{(" + "|".join(values) + r")\}", _PAGE)
    html = F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)))
    return page_batches(parts.withColumns({"url": F.concat(F.lit("https://shop.example/a/b/"), F.col("p_partkey")), "html": html}))


def _parts(spark, d) -> DataFrame:
    return made_pages(_t(spark, d, "part"))


def _json(column: str, path: str) -> Column:
    return F.get_json_object(column, path)


@query("""SELECT p_partkey, p_name AS name, p_partkey::VARCHAR AS sku, p_brand AS brand, p_partkey::VARCHAR AS second_price, 1::BIGINT AS products, p_type AS thing, p_type AS place FROM part""")
def product_jsonld(spark, d):
    p = _parts(spark, d).select("p_partkey", H.jsonld("html").alias("m"))
    j = lambda path: F.get_json_object(F.col("m")["Product"], path)
    return p.select("p_partkey", j("$[0].name").alias("name"), j("$[0].sku").alias("sku"), j("$[0].brand.name").alias("brand"), j("$[0].offers[1].price").alias("second_price"), F.json_array_length(F.col("m")["Product"]).cast("long").alias("products"), F.get_json_object(F.col("m")["Thing"], "$[0].name").alias("thing"), F.coalesce(F.get_json_object(F.col("m")["Place"], "$[0].name"), F.get_json_object(F.col("m")["Thing"], "$[0].name")).alias("place"))


@query("""SELECT p_partkey, p_size::VARCHAR AS price, p_partkey::VARCHAR AS sku, p_name AS name, p_name AS schema_name, p_size::VARCHAR AS schema_price FROM part""")
def product_microdata(spark, d):
    p = _parts(spark, d).select("p_partkey", H.microdata("html")["Offer"].alias("o"), H.schema("html").alias("s"))
    return p.select("p_partkey", _json("o", "$[0].price").alias("price"), _json("o", "$[0].sku").alias("sku"), _json("o", "$[0].name").alias("name"), F.get_json_object(F.col("s")["Product"], "$[0].name").alias("schema_name"), F.get_json_object(F.col("s")["Offer"], "$[0].price").alias("schema_price"))


@query("""SELECT p_partkey, p_name AS og_title, 'b' || p_size || '.png' AS og_image, p_type AS description, p_size > 25 AS noindex, p_size > 25 AS nofollow, 'https://shop.example/part/' || p_partkey || '?size=' || p_size AS canonical,
  p_brand AS twitter, '/part/' || p_partkey || '?size=' || p_size AS link FROM part""")
def product_meta(spark, d):
    p = _parts(spark, d).select("p_partkey", H.opengraph("html").alias("og"), H.meta("html").alias("m"), H.meta_noindex("html").alias("noindex"), H.meta_nofollow("html").alias("nofollow"), H.canonical("html", "url").alias("canonical"), H.opengraph_twitter("html").alias("t"), H.meta("html", basic=True).alias("b"))
    return p.select("p_partkey", F.col("og")["title"].alias("og_title"), F.col("og")["image"].alias("og_image"), F.col("m")["description"].alias("description"), "noindex", "nofollow", "canonical", _json("t", "$.twitter.card").alias("twitter"), F.col("b")["canonical"].alias("link"))


@query("""SELECT p_partkey, p_size::VARCHAR AS size, p_partkey::VARCHAR AS tag, NULL::VARCHAR AS commented, p_partkey::VARCHAR AS state, p_partkey::VARCHAR AS hydrated, p_partkey::VARCHAR AS by_path, p_size::VARCHAR AS deep FROM part""")
def product_scripts(spark, d):
    p = _parts(spark, d).select("p_partkey", H.js_variables("html").alias("v"), H.js_variables("html", include_window=True).alias("w"), H.hydration("html").alias("h"), H.htmlpath("html", "@$tags[1]").alias("by_path"), H.htmlpath("html", "@$tags[2].k[0]").alias("deep"))
    return p.select("p_partkey", F.col("v")["size"].alias("size"), F.get_json_object(F.col("v")["tags"], "$[1]").alias("tag"), F.col("v")["no"].alias("commented"), F.get_json_object(F.col("w")["__STATE__"], "$.part").alias("state"), F.get_json_object(F.col("h")["__NEXT_DATA__"], "$.props.id").alias("hydrated"), "by_path", "deep")


@query("""
SELECT p_partkey, unnest([0, 1])::BIGINT AS pos, unnest([p_partkey::VARCHAR, p_name]) AS key, unnest([p_size::VARCHAR, p_brand]) AS price, unnest([p_size || '[1]', p_brand]) AS cited, 'Key,Unit price' AS headers FROM part""")
def product_tables(spark, d):
    p = _parts(spark, d).select("p_partkey", H.html_table("html", "table", 1, False).alias("t"), H.html_table("html", "table", 1, True).alias("c"))
    r = p.select("p_partkey", F.posexplode("t.rows").alias("pos", "r"), F.col("c.rows").alias("rows"), F.array_join("t.headers", ",").alias("headers"))
    return r.select("p_partkey", F.col("pos").cast("long").alias("pos"), F.col("r")[0].alias("key"), F.col("r")[1].alias("price"), F.get("rows", F.col("pos"))[1].alias("cited"), "headers")


@query("""SELECT p_partkey, p_name AS og, p_type AS description, p_size::VARCHAR AS js, p_name AS product, p_name AS title, '<html>' AS start FROM part""")
def product_html(spark, d):
    p = _parts(spark, d).select("p_partkey", H.html_struct("html", F.lit("text/html; charset=utf-8")).alias("h"))
    return p.select("p_partkey", _json("h.opengraph", "$.title").alias("og"), _json("h.meta", "$.description").alias("description"), _json("h.js", "$.size").alias("js"), F.get_json_object(F.col("h.schema")["Product"], "$[0].name").alias("product"), _json("h.readability", "$.title").alias("title"), F.left("h.document", F.lit(6)).alias("start"))


@query("""SELECT p_partkey, 'box' AS parent_class, 'd' || p_partkey AS parent_id, [p_partkey::VARCHAR, p_size || '[1]', p_name, p_brand] AS cells, [p_name, p_type] AS items, p_partkey::VARCHAR AS offer, p_brand AS brand FROM part""")
def product_selectors(spark, d):
    p = _parts(spark, d)
    path = 'script[type="application/ld+json"]@text'
    return p.select("p_partkey", H.css_select("html", ".price", "parent.attr:class").alias("parent_class"), H.css_select("html", ".price", "parent.attr:id").alias("parent_id"), H.css_texts("html", "td").alias("cells"), H.css_texts("html", "ul > li").alias("items"), H.htmlpath("html", f"{path}.offers[1].price").alias("offer"), H.css_select("html", "div.box", "children.1.text").alias("brand"))


@query("""
WITH l AS (SELECT p_partkey, unnest(['https://shop.example/n/' || p_partkey, 'https://shop.example/a/m/' || p_size]) AS link, unnest([true, false]) AS nofollow FROM part) SELECT * FROM l
""")
def product_links(spark, d):
    p = _parts(spark, d).select("p_partkey", F.explode(H.link_records("html", "url")).alias("l"))
    return p.select("p_partkey", F.col("l.url").alias("link"), "l.nofollow")


@query("""SELECT p_partkey, p_name AS name, (1000 + p_size + 100 + 0.5)::DECIMAL(12, 2) AS price, upper(p_type) = upper(p_type) AS ok, lower(p_brand) AS brand, p_size::INTEGER AS size, p_partkey::VARCHAR AS id, p_size > 25 AS hidden FROM part""")
def product_extract(spark, d):
    clause = """EXTRACT (COALESCE(microdata.Missing.name, jsonld.Product.name) AS name, price DECIMAL(12,2) FROM css '.price::text' | trim | parse_price, brand FROM css 'div.box i::text' | lowercase, size INTEGER FROM microdata.Offer.price, id FROM js.tags[1], og.title AS t, meta.robots AS r)"""
    p = _parts(spark, d).select("p_partkey", *extract_columns("html", parse_extract(clause)))
    return p.select("p_partkey", "name", F.col("price").cast("decimal(12,2)").alias("price"), (F.col("t") == F.col("name")).alias("ok"), "brand", "size", "id", F.contains("r", F.lit("noindex")).alias("hidden"))


# crawls


class Echo:
    """Answers every URL with a page that is titled with it."""

    def fetch(self, url: str, options: Options) -> dict:
        return response(url, 200, "text/html", f'<title>{escape(url)}</title><script type="application/ld+json">{{"@type":"Thing","name":"t"}}</script><p>x', url, None, 1)


class Tree:
    """Pages 1 to ``n``: k links to 10 k, ..., 10 k + 9. What ends in 7 is missing, what
    begins with 9 is forbidden."""

    def __init__(self, n: int):
        self.n = n

    def fetch(self, url: str, options: Options) -> dict:
        path = url.partition("//")[2].partition("/")[2]
        if path == "robots.txt":
            return response(url, 200, "text/plain", "User-agent: *\nDisallow: /9\n", url)
        k = int(path)
        if k % 10 == 7:
            return response(url, 404, "text/html", "<a href='/1'>home</a>", url)
        kids = "".join(f'<a class="kid" href="/{c}">{c}</a>' for c in range(10 * k, 10 * k + 10) if c <= self.n)
        return response(url, 200, "text/html", f"<title>Page {k}</title>{kids}<a href='/1'>home</a>", url)


_FAST = {"delay": 0}


@query("SELECT DISTINCT url, 200::INTEGER AS status, 'text/html' AS content_type, url AS title, url AS final_url, 1::INTEGER AS depth FROM pages")
def crawl_pages(spark, d):
    got = C.crawl(spark, _t(spark, d, "pages").select("url"), Echo(), respect_robots=False, extract=[{"alias": "t", "source": "css", "selector": "title", "accessor": "text"}], **_FAST)
    return got.select("url", "status", "content_type", _json("extract", "$.t").alias("title"), "final_url", "depth")


_TREE = """
WITH RECURSIVE t(k, depth) AS (
  SELECT i, 1 FROM range(1, 10) r(i) UNION ALL
  SELECT k * 10 + j, depth + 1 FROM t, range(0, 10) s(j) WHERE k * 10 + j <= (SELECT max(p_partkey) FROM part) AND k % 10 <> 7 AND NOT starts_with(k::VARCHAR, '9'))"""


@query(_TREE + """ SELECT 'https://tree.example/' || k AS url, depth::INTEGER AS depth, starts_with(k::VARCHAR, '9') AS forbidden,
  CASE WHEN starts_with(k::VARCHAR, '9') THEN 0 WHEN k % 10 = 7 THEN 404 ELSE 200 END::INTEGER AS status FROM t""")
def crawl_follow(spark, d):
    n = _t(spark, d, "part").agg(F.max("p_partkey")).first()[0] or 0
    got = C.crawl(spark, [f"https://tree.example/{k}" for k in range(1, 10)], Tree(n), follow="a.kid", max_depth=12, **_FAST)
    return got.select("url", "depth", F.coalesce(F.contains("error", F.lit("robots")), F.lit(False)).alias("forbidden"), "status")


@query("SELECT s_suppkey, s_name, 200::INTEGER AS status, 'https://s.example/' || s_suppkey AS final_url, 'https://s.example/' || s_suppkey AS title FROM supplier")
def crawl_lateral(spark, d):
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name", F.concat(F.lit("https://s.example/"), F.col("s_suppkey")).alias("u"))
    got = C.crawl_url(s, "u", Echo())
    return got.select("s_suppkey", "s_name", "status", "final_url", _json("html.readability", "$.title").alias("title"))


@query("SELECT s_suppkey, 200::INTEGER AS status, 'https://s.example/' || s_suppkey AS title FROM supplier")
def crawl_lateral_sql(spark, d):
    C.register_crawl_url(spark, Echo(), "webloom_crawl_url")
    C.register_functions(spark)
    _t(spark, d, "supplier").createOrReplaceTempView("webloom_supplier")
    return spark.sql("SELECT s.s_suppkey, c.status, jq(c.body, 'title').text AS title FROM webloom_supplier s, LATERAL webloom_crawl_url(concat('https://s.example/', s.s_suppkey)) c")


@query("SELECT url, 200::INTEGER AS status_code, '' AS error, 't' AS name FROM pages")
def crawl_streamed(spark, d):
    _t(spark, d, "pages").createOrReplaceTempView("webloom_pages")
    got = C.crawl_stream(spark, "SELECT url FROM webloom_pages", Echo(), crawl_delay=0, respect_robots_txt=False)
    return got.select("url", "status_code", "error", F.get_json_object("jsonld", "$.Thing").alias("j")).select("url", "status_code", "error", F.get_json_object("j", "$[0].name").alias("name"))


class Nothing:
    def fetch(self, url: str, options: Options) -> dict:
        return response(url, 404, "text/plain", "", url)


def _table(tag: str) -> str:
    return f"webloom_{tag}_{uuid.uuid4().hex[:12]}"


def _drop(spark, *tables: str) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


@query("""
SELECT 'first' AS run, 'https://s.example/' || s_suppkey AS url, 200::INTEGER AS status FROM supplier UNION ALL
SELECT 'resumed', 'https://n.example/' || n_nationkey, 200 FROM nation UNION ALL
SELECT 'cached', 'https://s.example/' || s_suppkey, 200 FROM supplier UNION ALL SELECT 'stale', 'https://s.example/' || s_suppkey, 404 FROM supplier UNION ALL
SELECT 'state', 'https://s.example/' || s_suppkey, 200 FROM supplier UNION ALL SELECT 'state', 'https://n.example/' || n_nationkey, 200 FROM nation""")
def crawl_resume_and_cache(spark, d):
    s = _t(spark, d, "supplier").select(F.concat(F.lit("https://s.example/"), F.col("s_suppkey")).alias("url"))
    n = _t(spark, d, "nation").select(F.concat(F.lit("https://n.example/"), F.col("n_nationkey")).alias("url"))
    state, cache = _table("state"), _table("cache")
    fast = {"respect_robots": False, **_FAST}
    try:
        runs = [("first", C.crawl(spark, s, Echo(), state_table=state, cache=cache, **fast)), ("resumed", C.crawl(spark, s.union(n), Echo(), state_table=state, **fast))]
        runs += [("cached", C.crawl(spark, s, Nothing(), cache=cache, **fast)), ("stale", C.crawl(spark, s, Nothing(), cache=cache, cache_ttl=0, **fast))]
        out = spark.table(state).select(F.lit("state").alias("run"), "url", F.col("http_status").alias("status"))
        for name, df in runs:
            out = out.union(df.select(F.lit(name), "url", "status"))
        return written(out, "resume")
    finally:
        _drop(spark, state, cache)


class Maps:
    """Site k has an index of one gzipped sitemap with k + 1 entries; odd sites name it in
    robots.txt, the others have it at the usual place."""

    def fetch(self, url: str, options: Options) -> dict:
        m = re.fullmatch(r"(https://n(\d+)\.example)/(.*)", url)
        home, k, path = m[1], int(m[2]), m[3]
        index = "maps/index.xml" if k % 2 else "sitemap.xml"
        if path == "robots.txt":
            return response(url, 200, "text/plain", f"Sitemap: {home}/{index}\n" if k % 2 else "User-agent: *\n", url)
        if path == index:
            return response(url, 200, "text/xml", f"<sitemapindex><sitemap><loc>{home}/s.xml.gz</loc></sitemap></sitemapindex>", url)
        if path == "s.xml.gz":
            freq = ("always", "hourly", "daily", "weekly", "monthly", "yearly", "never")
            rows = "".join(f"<url><loc>{home}/p/{j}?a=1&amp;b=2</loc><lastmod>2024-01-{j + 1:02d}</lastmod><changefreq>{freq[j % 7]}</changefreq><priority>0.{j % 10}</priority></url>" for j in range(k + 1))
            from .sources.fetch import gunzip

            return response(url, 200, "application/gzip", gunzip(gzip.compress(f"<urlset>{rows}</urlset>".encode()), options.max_response_bytes).decode(), url)
        return response(url, 404, "text/html", "", url)


_ENTRIES = """SELECT 'https://n' || n_nationkey || '.example/p/' || j || '?a=1&b=2' AS url, '2024-01-' || lpad((j + 1)::VARCHAR, 2, '0') AS lastmod,
  ['always', 'hourly', 'daily', 'weekly', 'monthly', 'yearly', 'never'][j % 7 + 1] AS changefreq, ('0.' || j % 10)::DOUBLE AS priority, j FROM nation, range(0, 100) r(j) WHERE j <= n_nationkey"""


def _entries(spark, d) -> DataFrame:
    # one site for each nation, as an argument is
    sites = [f"https://n{r.n_nationkey}.example" for r in _t(spark, d, "nation").select("n_nationkey").distinct().orderBy("n_nationkey").limit(1000).collect()]
    return written(sitemap(spark, sites, Maps(), discover=True), "entries")


@query(f"SELECT url, lastmod, changefreq, priority FROM ({_ENTRIES})")
def sitemap_discovery(spark, d):
    return _entries(spark, d)


@query(f"""SELECT url FROM ({_ENTRIES}) WHERE j % 3 = 0 OR lastmod::TIMESTAMP > TIMESTAMP '2024-01-08 12:00:00'
  OR epoch(TIMESTAMP '2024-01-09 12:30:00' - TIMESTAMP '2024-01-08 12:00:00') >= 3600 * CASE changefreq WHEN 'always' THEN 0 WHEN 'hourly' THEN 1 WHEN 'daily' THEN 24 WHEN 'weekly' THEN 168 WHEN 'monthly' THEN 720 WHEN 'yearly' THEN 8760 ELSE 87600 END""")
def sitemap_stale(spark, d):
    e = _entries(spark, d)
    j = F.regexp_extract("url", r"/p/(\d+)", 1).cast("int")
    # entries that have been crawled, all at one time; every third is new
    done = e.select("url", F.when(j % 3 != 0, F.lit("2024-01-08 12:00:00").cast("timestamp")).alias("crawled_at"))
    return stale(e, done, F.lit("2024-01-09 12:30:00").cast("timestamp")).select("url")


@query("SELECT p_partkey, 'https://e.org/' || p_partkey || '?a=1&b=2' AS url, '2024-02-03' AS lastmod, 0.5::DOUBLE AS priority, ['https://e.org/c' || p_size || '.xml'] AS children FROM part")
def sitemap_text(spark, d):
    xml = F.concat(F.lit("<urlset><url><loc> https://e.org/"), F.col("p_partkey"), F.lit("?a=1&amp;b=2 </loc><lastmod>2024-02-03</lastmod><priority>0.5</priority></url><url><lastmod>2024-02-03</lastmod></url></urlset><sitemap><loc><![CDATA[https://e.org/c"), F.col("p_size"), F.lit(".xml]]></loc></sitemap>"))
    p = page_batches(_t(spark, d, "part").select("p_partkey", xml.alias("x"))).select("p_partkey", sitemap_entries(F.col("x")).alias("s"))
    return p.select("p_partkey", F.col("s.urls")[0].alias("u"), F.col("s.children").alias("children")).select("p_partkey", "u.url", "u.lastmod", "u.priority", "children")


class Atlas:
    """One page with the given rows as a table, a list and a script variable."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.rows = rows

    def fetch(self, url: str, options: Options) -> dict:
        table = "".join(f"<tr><td>{k:,}</td><td>{name}</td><td>{k}.5</td></tr>" for k, name in self.rows)
        items = "".join(f"<li>{name}</li>" for _, name in self.rows)
        var = ",".join(f'{{"k":{k},"name":"{name}"}}' for k, name in self.rows)
        return response(url, 200, "text/html", f"<table><tr><th>Key</th><th>Full name</th><th>x/(y)</th></tr>{table}</table><ol>{items}</ol><script>var rows = [{var}];</script>", url)


@query("""
SELECT 'table' AS kind, n_nationkey AS k, n_name AS name, (n_nationkey + 0.5)::DOUBLE AS half FROM nation UNION ALL SELECT 'list', NULL, n_name, NULL FROM nation UNION ALL SELECT 'script', n_nationkey, n_name, NULL FROM nation""")
def read_html_page(spark, d):
    rows = [(r.n_nationkey, r.n_name) for r in _t(spark, d, "nation").orderBy("n_nationkey").limit(1000).collect()]  # a page, as an argument is
    atlas, url = Atlas(rows), "https://e.org/nations"
    t = read_html(spark, url, "table", fetcher=atlas)
    assert t.dtypes == [("Key", "bigint"), ("Full_name", "string"), ("x__y_", "double")], t.dtypes
    items, script = read_html(spark, url, "ol", fetcher=atlas), read_html(spark, url, "js=rows", fetcher=atlas)
    none = lambda kind: F.lit(None).cast(kind)
    out = t.select(F.lit("table").alias("kind"), F.col("Key").cast("int").alias("k"), F.col("Full_name").alias("name"), F.col("x__y_").alias("half"))
    out = out.union(items.select(F.lit("list"), none("int"), items.columns[0], none("double")))
    return out.union(script.select(F.lit("script"), F.col("k").cast("int"), "name", none("double")))


# sinks


@query("""SELECT o_orderkey AS k, o_orderstatus AS s, 2::BIGINT AS times FROM orders""")
def stream_into(spark, d):
    _t(spark, d, "orders").createOrReplaceTempView("webloom_orders")
    t = _table("stream")
    try:
        for _ in range(2):  # makes the table, then appends
            n = sql(spark, f"STREAM (SELECT o_orderkey AS k, o_orderstatus AS s FROM webloom_orders) INTO {t}").first().rows_inserted
            assert n == spark.table("webloom_orders").count(), n
        return written(spark.table(t).groupBy("k", "s").agg(F.count("*").alias("times")), "stream")
    finally:
        _drop(spark, t)


@query("""
SELECT 'created' AS step, count(*)::BIGINT AS rows_inserted, 0::BIGINT AS rows_updated, 0::BIGINT AS rows_deleted FROM supplier UNION ALL
SELECT 'limited', 7, 0, 0 UNION ALL SELECT 'merged', (SELECT count(*) FROM customer) - (SELECT count(*) FROM supplier s JOIN customer ON c_custkey = s_suppkey) - 7, (SELECT count(*) FROM supplier JOIN customer ON c_custkey = s_suppkey) + 7, (SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)) UNION ALL
SELECT 'left', (SELECT count(*) FROM customer), 0, 0""")
def crawling_merge(spark, d):
    _t(spark, d, "supplier").createOrReplaceTempView("webloom_supplier")
    _t(spark, d, "customer").createOrReplaceTempView("webloom_customer")
    t = _table("merge")
    try:
        steps = [("created", f"CRAWLING MERGE INTO {t} USING (SELECT s_suppkey AS k, s_name AS name FROM webloom_supplier) AS s ON ({t}.k = s.k) WHEN NOT MATCHED THEN INSERT BY NAME")]
        new = "SELECT c_custkey AS k, c_name AS name FROM webloom_customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM webloom_supplier)"
        steps.append(("limited", f"CRAWLING MERGE INTO {t} USING ({new}) AS s ON ({t}.k = s.k) WHEN NOT MATCHED THEN INSERT BY NAME LIMIT 7"))
        steps.append(("merged", f"CRAWLING MERGE INTO {t} USING (SELECT c_custkey AS k, c_name AS name FROM webloom_customer) AS s ON ({t}.k = s.k) WHEN MATCHED THEN UPDATE BY NAME WHEN NOT MATCHED THEN INSERT BY NAME WHEN NOT MATCHED BY SOURCE THEN DELETE"))
        out = None
        for name, text in steps:
            one = written(sql(spark, text).select(F.lit(name).alias("step"), "rows_inserted", "rows_updated", "rows_deleted"), "merge-step")
            out = one if out is None else out.union(one)
        zero = F.lit(0).cast("long")
        return written(out.union(spark.table(t).agg(F.lit("left"), F.count("*"), zero, zero)), "merge")
    finally:
        _drop(spark, t)


@query("""SELECT 'https://s.example/' || s_suppkey AS url, 'example,s)/' || s_suppkey AS surt_key, 200::INTEGER AS status_code, '' AS error_type, 0::INTEGER AS redirect_count, 't' AS thing, 'https://s.example/' || s_suppkey AS title FROM supplier""")
def crawl_into_table(spark, d):
    _t(spark, d, "supplier").createOrReplaceTempView("webloom_supplier")
    t = _table("into")
    try:
        sql(spark, f"CRAWL (SELECT concat('https://s.example/', s_suppkey) FROM webloom_supplier UNION ALL SELECT 'https://x.example/') INTO {t} EXTRACT (title FROM css 'title::text', jsonld.Thing.name AS thing) WHERE url NOT LIKE '%x.example%' WITH (user_agent 'q', default_crawl_delay 0, respect_robots_txt false)", Echo())
        return written(spark.table(t).select("url", "surt_key", "status_code", "error_type", "redirect_count", "thing", "title"), "into")
    finally:
        _drop(spark, t)


@query(f"""SELECT url, 200::INTEGER AS status_code, url AS title FROM ({_ENTRIES}) UNION ALL SELECT 'inserted ' || count(*), 0, NULL FROM ({_ENTRIES}) UNION ALL SELECT 'again 0 ' || (count(*) FILTER (changefreq = 'always')), 0, NULL FROM ({_ENTRIES})""")
def crawl_sites(spark, d):
    """All sites; then again for what is stale by then: what always changes."""
    _t(spark, d, "nation").createOrReplaceTempView("webloom_nation")

    class Both(Maps, Echo):
        def fetch(self, url: str, options: Options) -> dict:
            return Echo.fetch(self, url, options) if "/p/" in url else Maps.fetch(self, url, options)

    t = _table("sites")
    text = f"CRAWL SITES (SELECT concat('n', n_nationkey, '.example') FROM webloom_nation) INTO {t} EXTRACT (title FROM css 'title::text') WITH (default_crawl_delay 0, respect_robots_txt false, update_stale true)"
    try:
        first = sql(spark, text, Both()).first()
        again = sql(spark, text, Both()).first()
        notes = [(f"inserted {first.rows_inserted}", 0, None), (f"again {again.rows_inserted} {again.rows_updated}", 0, None)]
        return written(spark.table(t).select("url", "status_code", "title").union(spark.createDataFrame(notes, "url string, status_code int, title string")), "sites")
    finally:
        _drop(spark, t)


@query("SELECT n_nationkey::BIGINT AS k, 'https://n.example/' || n_nationkey AS url, 200::INTEGER AS status_code FROM nation")
def crawl_into_builder(spark, d):
    n = _t(spark, d, "nation").select(F.concat(F.lit("https://n.example/"), F.col("n_nationkey")).alias("url"))
    t = _table("builder")
    try:
        crawl_into(spark, n, t, fetcher=Echo(), delay=0, respect_robots=False)
        return written(spark.table(t).select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("k"), "url", "status_code"), "builder")
    finally:
        _drop(spark, t)


# relational parity


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)")
def semi_join(spark, d):
    big = _t(spark, d, "lineitem").where("l_quantity >= 50")
    return _t(spark, d, "part").join(big, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query("""SELECT e.event_id, p.event_id AS before FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def asof_join(spark, d):
    """The last purchase of the user at or before each event: one window over the events,
    no join of events with events."""
    from pyspark.sql import Window

    e = _t(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id"))).over(w)
    return e.select("event_id", last["event_id"].alias("before"))


@query("SELECT n_name, count(*) AS dearer FROM supplier JOIN nation ON s_nationkey > n_nationkey AND s_acctbal > 100 * n_nationkey GROUP BY 1")
def theta_join(spark, d):
    # 25 rows at any size
    n = F.broadcast(_t(spark, d, "nation"))
    j = _t(spark, d, "supplier").join(n, (F.col("s_nationkey") > F.col("n_nationkey")) & (F.col("s_acctbal") > 100 * F.col("n_nationkey")))
    return j.groupBy("n_name").agg(F.count("*").alias("dearer"))


@query("SELECT 'both' AS kind, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT s_suppkey FROM supplier) UNION ALL SELECT 'only', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier)")
def set_operations(spark, d):
    c, s = _t(spark, d, "customer").select(F.col("c_custkey").alias("k")), _t(spark, d, "supplier").select("s_suppkey")
    return c.intersect(s).select(F.lit("both").alias("kind"), "k").union(c.subtract(s).select(F.lit("only"), "k"))


@query("WITH w(kind, factor) AS (VALUES ('BUILDING', 2), ('MACHINERY', 3)), c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) SELECT kind, n * factor AS n FROM c JOIN w ON c_mktsegment = kind")
def cte_values(spark, d):
    _t(spark, d, "customer").createOrReplaceTempView("webloom_customer")
    return spark.sql("WITH w AS (SELECT * FROM VALUES ('BUILDING', 2L), ('MACHINERY', 3L) AS t(kind, factor)), c AS (SELECT c_mktsegment, count(*) AS n FROM webloom_customer GROUP BY 1) SELECT kind, n * factor AS n FROM c JOIN w ON c_mktsegment = kind")
