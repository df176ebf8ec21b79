"""The engine's own queries and their DuckDB counterparts, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import streaming
from .functions import html as H
from .functions import http, urls, values
from .functions.robots import robots_allowed, sitemap_lines
from .operators.merge import Merge, fresh_keys
from .plans.extract_clause import select_extract
from .session import page_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return page_batches(df) if name == "pages" else df


_HOST = r"lower(regexp_extract(url, '^[^/]*?://([^/:?#]*)', 1))"
_DECODE = "replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_TITLE = _DECODE.format("trim(regexp_extract(html, '<title>([^<]*)</title>', 1))")
_H1 = _DECODE.format("trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1))")
_HREFS = "regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten domains with the most links, with the number of their pages and a title."""
    p = _t(spark, sf_dir, "pages")
    read = p.select(urls.host("url").alias("host"), H.jq("html", "article h1").alias("h1"), F.size(H.links("html", "url")).alias("n"))
    out = read.groupBy("host").agg(F.count("*").alias("pages"), F.sum("n").cast("long").alias("links"), F.min("h1.text").alias("first_title"))
    return out.orderBy(F.desc("links"), "host").limit(10)


@query(f"""
SELECT {_HOST} AS host, count(*) AS pages, sum(len({_HREFS}))::BIGINT AS links, min({_H1}) AS first_title
FROM pages GROUP BY 1 ORDER BY links DESC, host LIMIT 10""")
def top_domains(spark, d):
    return flagship(spark, d)


# U: URL scalars


@query(f"""
SELECT page_id, regexp_extract(url, '^[^/]*?://([^/:]*)', 1) AS domain, {_HOST} AS host,
  coalesce(nullif(regexp_extract(url, '^[^/]*?://[^/]*(/.*)$', 1), ''), '/') AS path,
  coalesce(nullif(regexp_extract(url, '^[^/]*?://[^/?#]*(/[^?#]*)', 1), ''), '/') AS bare_path,
  nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
  sha256(html) AS content_hash
FROM pages""")
def url_parts(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", urls.domain("url").alias("domain"), urls.host("url").alias("host"), urls.path("url").alias("path"), urls.bare_path("url").alias("bare_path"), urls.query_parameter("url", "page").alias("page"), urls.content_hash("html").alias("content_hash"))


_RHOST = "array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(lower(url), '^[^/]*?://([^/:]*)', 1), '^www\\.', ''), '.')), ',')"


@query(f"""
SELECT page_id, {_RHOST} || ')' || coalesce(nullif(regexp_extract(url, '^[^/]*?://[^/]*(/.*)$', 1), ''), '/') AS surt, {_RHOST} || ')' AS surt_domain FROM pages""")
def surt_keys(spark, d):
    return _t(spark, d, "pages").select("page_id", urls.surt("url").alias("surt"), urls.surt_domain("url").alias("surt_domain"))


@query("""
WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN '' WHEN 2 THEN replace(url, 'http', 'ftp') WHEN 3 THEN 'http:///x' ELSE replace(url, '.', ' ') END AS url FROM pages)
SELECT page_id, CASE WHEN url IS NULL OR url = '' THEN 'empty' WHEN length(url) > 8192 THEN 'too_long' WHEN NOT regexp_matches(lower(url), '^https?://') THEN 'scheme'
  WHEN regexp_extract(url, '^[^/]*?://([^/?#]*)', 1) = '' THEN 'host' WHEN regexp_matches(regexp_extract(url, '^[^/]*?://([^/?#]*)', 1), '[\\x00-\\x20]') THEN 'control_character' END AS problem FROM u""")
def url_validation(spark, d):
    p = _t(spark, d, "pages")
    k = F.col("page_id") % 5
    u = F.when(k == 0, F.col("url")).when(k == 1, "").when(k == 2, F.replace("url", F.lit("http"), F.lit("ftp"))).when(k == 3, "http:///x").otherwise(F.replace("url", F.lit("."), F.lit(" ")))
    return p.select("page_id", urls.url_problem(u).alias("problem"))


@query(f"SELECT a.host AS host, count(*) AS n FROM (SELECT {_HOST} AS host FROM pages) a GROUP BY 1")
def pages_by_host(spark, d):
    return _t(spark, d, "pages").groupBy(urls.host("url").alias("host")).agg(F.count("*").alias("n"))


# X: extraction


@query(f"SELECT page_id, {_TITLE} AS title, {_H1} AS h1, '' AS missing, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def jq_text(spark, d):
    p = _t(spark, d, "pages")
    out = p.select("page_id", H.jq("html", "title").alias("t"), H.jq("html", "article h1").alias("h"), H.jq("html", "h1", "id").alias("missing"), H.jq("html", "html", "lang").alias("lang"))
    return out.select("page_id", F.col("t.text").alias("title"), F.col("h.text").alias("h1"), "missing", "lang")


@query(f"SELECT page_id, {_H1} AS text, 'utf-8' AS charset, regexp_extract(html, '<li>(<a .*?</a>)</li>', 1) AS first_link, '' AS missing FROM pages")
def css_select(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", H.css_select("html", "h1").alias("text"), H.css_select("html", "meta[charset]", "attr:charset").alias("charset"), H.css_select("html", "nav li", "children.0.html").alias("first_link"), H.css_select("html", "table td").alias("missing"))


@query(f"SELECT page_id, '\"' || {_HREFS}[1] || '\"' AS href, 'null' AS missing, '\"</p>\"' AS js FROM pages")
def htmlpath(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", H.htmlpath("html", "nav a@href").alias("href"), H.htmlpath("html", "table@class").alias("missing"), H.htmlpath("html", "@$t").alias("js"))


@query(f"SELECT page_id, len({_HREFS})::BIGINT AS links, 0::BIGINT AS tables, {_TITLE} AS title, '[{{\"name\":\"t\",\"type\":\"string\",\"size\":6}}]' AS js FROM pages")
def page_info(spark, d):
    p = _t(spark, d, "pages").select("page_id", H.page_info("html", "url").alias("i"))
    j = lambda path: F.get_json_object("i", path)
    return p.select("page_id", j("$.links").cast("long").alias("links"), j("$.tables").cast("long").alias("tables"), j("$.readability.title").alias("title"), j("$.js").alias("js"))


@query("SELECT page_id, '\"</p>\"' AS t FROM pages")
def js_variables(spark, d):
    return _t(spark, d, "pages").select("page_id", H.js_variables("html")["t"].alias("t"))


# Percent-encoding of what isn't printable ASCII.
_ENCODED = "array_to_string(list_transform(string_split({}, ''), lambda c: CASE WHEN regexp_full_match(c, '[!-~]') AND c NOT IN ('\"', '<', '>', '`') THEN c ELSE url_encode(c) END), '')"


@query(f"""
SELECT page_id, pos - 1 AS pos, regexp_extract(url, '^([^/]*//[^/?#]*)', 1) || {_ENCODED.format("hrefs[pos]")} AS link
FROM (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS pos FROM (SELECT page_id, url, {_HREFS} AS hrefs FROM pages))""")
def links(spark, d):
    out = _t(spark, d, "pages").select("page_id", F.posexplode(H.links("html", "url")).alias("pos", "link"))
    return out.select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query(f"""
SELECT DISTINCT page_id, regexp_extract(url, '^([^/]*//[^/?#]*)', 1) || unnest({_HREFS}) AS link, false AS nofollow FROM pages""")
def link_records(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", F.explode(H.link_records("html", "url")).alias("l")).select("page_id", F.col("l.url").alias("link"), "l.nofollow")


@query(f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages)
SELECT page_id, len(items)::BIGINT AS n, {_DECODE.format("regexp_replace(items[1], '<[^>]*>', '', 'g')")} AS first FROM l WHERE len(items) > 0""")
def list_items(spark, d):
    p = _t(spark, d, "pages").select("page_id", H.html_table("html", "ul").alias("t")).where("t is not null")
    return p.select("page_id", F.size("t.rows").cast("long").alias("n"), F.col("t.rows")[0][0].alias("first"))


@query(f"SELECT page_id, {_H1} AS title, lower({_TITLE}) AS shout, '0'::INTEGER AS tables FROM pages")
def extract_clause(spark, d):
    return select_extract(_t(spark, d, "pages"), "html", "EXTRACT (COALESCE(og.title, css 'h1::text') AS title, shout FROM css 'title::text' | trim | lowercase, tables INTEGER FROM css 'table::attr(n)')", "page_id").withColumn("tables", F.coalesce("tables", F.lit(0)))


@query("""SELECT page_id, false AS has_jsonld, 0::BIGINT AS n_schema, false AS noindex, NULL::VARCHAR AS canonical FROM pages""")
def structured_data(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", (F.size(H.jsonld("html")) > 0).alias("has_jsonld"), F.size(H.schema("html")).cast("long").alias("n_schema"), H.meta_noindex("html").alias("noindex"), H.canonical("html", "url").alias("canonical"))


@query()
def readability(spark, d):
    return _t(spark, d, "pages").select("page_id", H.readability("html").alias("r")).select("page_id", "r.title", "r.length", "r.excerpt")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, (json_extract_string(props, '$.k'))::INTEGER AS n, '' AS missing FROM events""")
def json_path(spark, d):
    e = _t(spark, d, "events")
    k = values.json_path(F.col("props"), "->>'k'")
    return e.select("event_id", k.alias("k"), values.coerce(k, "INTEGER").alias("n"), values.json_path(F.col("props"), "->>'no'").alias("missing"))


# C: crawl control


@query("""
WITH p AS (SELECT page_id, page_id % 7 AS k FROM pages), s AS (SELECT page_id, [200, 404, 429, 500, 503, 0, 301][k + 1]::INTEGER AS status, CASE k WHEN 5 THEN 'connection refused' END AS error, (page_id % 6)::INTEGER AS n FROM p)
SELECT page_id, CASE WHEN status = 429 THEN 'rate_limited' WHEN status >= 500 THEN 'server_error' WHEN status >= 400 THEN 'client_error' WHEN status <= 0 THEN 'connection_refused' ELSE '' END AS error_class,
  [3, 3, 6, 9, 15, 24][n + 1]::INTEGER AS backoff, status <= 0 OR status BETWEEN 500 AND 504 AS retryable FROM s""")
def response_rules(spark, d):
    k = (F.col("page_id") % 7).cast("int")
    s = _t(spark, d, "pages").select("page_id", F.get(F.array(*map(F.lit, (200, 404, 429, 500, 503, 0, 301))), k).alias("status"), F.when(k == 5, "connection refused").alias("error"), (F.col("page_id") % 6).cast("int").alias("n"))
    return s.select("page_id", http.error_class(F.col("status"), F.col("error")).alias("error_class"), http.fibonacci_backoff(F.col("n")).alias("backoff"), http.retryable(F.col("status")).alias("retryable"))


@query("""
WITH p AS (SELECT page_id, regexp_extract(url, '^[^/]*//[^/]*(/[^?#]*)', 1) AS path FROM pages)
SELECT page_id, NOT starts_with(path, '/en/1') OR starts_with(path, '/en/12') AS allowed, ['https://e.org/s.xml'] AS sitemaps FROM p""")
def robots(spark, d):
    text = F.lit("User-agent: *\nDisallow: /en/1\nAllow: /en/12\n\nSitemap: https://e.org/s.xml\n")
    p = _t(spark, d, "pages")
    return p.select("page_id", robots_allowed(text, F.lit("webloom"), urls.bare_path("url")).alias("allowed"), sitemap_lines(text).alias("sitemaps"))


@query("""
SELECT page_id, kind, (kind LIKE 'text/%' OR kind = 'application/pdf') AND kind <> 'text/css' AS allowed
FROM (SELECT page_id, ['text/html', 'text/css', 'image/png', 'application/pdf'][page_id % 4 + 1] AS kind FROM pages)""")
def content_types(spark, d):
    p = _t(spark, d, "pages").select("page_id", F.get(F.array(*map(F.lit, ("text/html", "text/css", "image/png", "application/pdf"))), (F.col("page_id") % 4).cast("int")).alias("kind"))
    return p.select("page_id", "kind", http.content_type_allowed(F.col("kind"), ["text/*", "application/pdf"], ["text/css"]).alias("allowed"))


# K/M: upsert. All orders are the target, and the source, with keys doubled so that either
# side has rows of its own.

_MERGE_CTE = """
WITH t AS (SELECT o_orderkey AS k, o_totalprice AS v, o_orderstatus AS s FROM orders),
s AS (SELECT o_orderkey * 2 AS k, o_totalprice + 1 AS v, 'N' AS s FROM orders),
j AS (SELECT coalesce(t.k, s.k) AS k, t.k AS tk, s.k AS sk, t.v AS tv, s.v AS sv, t.s AS ts, s.s AS ss FROM t FULL JOIN s ON t.k = s.k)"""


def _merge(spark, d):
    o = _t(spark, d, "orders")
    t = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    s = o.select((F.col("o_orderkey") * 2).alias("k"), (F.col("o_totalprice") + 1).alias("v"), F.lit("N").alias("s"), F.col("o_orderkey").alias("o"))
    return Merge(t, s, ["k"], order="o")


@query(_MERGE_CTE + " SELECT k, CASE WHEN sk IS NOT NULL THEN sv ELSE tv END AS v, CASE WHEN sk IS NOT NULL THEN ss ELSE ts END AS s FROM j")
def merge_upsert(spark, d):
    return _merge(spark, d).when_matched_update().when_not_matched_insert().result().target


@query(_MERGE_CTE + " SELECT k, CASE WHEN tk IS NOT NULL AND sk IS NOT NULL AND ts = 'O' THEN sv ELSE tv END AS v, CASE WHEN tk IS NOT NULL AND sk IS NULL THEN 'X' WHEN tk IS NOT NULL AND sk IS NOT NULL AND ts = 'O' THEN ss ELSE ts END AS s FROM j WHERE tk IS NOT NULL AND NOT (sk IS NOT NULL AND ts = 'F')")
def merge_clauses(spark, d):
    m = _merge(spark, d).when_matched_update("target.s = 'O'").when_matched_delete("target.s = 'F'").when_not_matched_by_source_update({"s": "'X'"})
    return m.result().target


@query(_MERGE_CTE + " SELECT count(*) FILTER (tk IS NULL)::BIGINT AS rows_inserted, count(*) FILTER (tk IS NOT NULL AND sk IS NOT NULL)::BIGINT AS rows_updated, count(*) FILTER (sk IS NULL)::BIGINT AS rows_deleted FROM j")
def merge_counts(spark, d):
    return _merge(spark, d).when_matched_update().when_not_matched_insert().when_not_matched_by_source_delete().result().counts


@query(_MERGE_CTE + " SELECT k FROM j WHERE sk IS NOT NULL AND NOT coalesce(tv > 100000, false)")
def fresh_key_pushdown(spark, d):
    m = _merge(spark, d)
    return fresh_keys(m.source, m.target, ["k"], "v > 100000").select("k")


# relational parity


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc,
  round(avg(l_quantity), 4) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, d):
    l = _t(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")  # noqa: E741
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 4).alias("avg_qty"), F.count("*").alias("n"))


@query("""
SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY 1""")
def join_nations(spark, d):
    o, c, n, r = (_t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r.where("r_name = 'ASIA'"), n.n_regionkey == r.r_regionkey)
    return j.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)")
def anti_join(spark, d):
    big = _t(spark, d, "lineitem").where("l_quantity >= 50")
    return _t(spark, d, "part").join(big, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def top_k_per_group(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return _t(spark, d, "orders").withColumn("k", F.row_number().over(w)).where("k <= 3").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT event_id, user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change FROM events")
def window_lag(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _t(spark, d, "events").select("event_id", "user_id", (F.col("value") - F.lag("value").over(w)).alias("change"))


@query("""SELECT s_suppkey, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 45) AS big FROM supplier""")
def correlated_subquery(spark, d):
    for t in ("supplier", "lineitem"):
        _t(spark, d, t).createOrReplaceTempView(f"webloom_{t}")
    return spark.sql("SELECT s_suppkey, (SELECT count(*) FROM webloom_lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 45) AS big FROM webloom_supplier")


@query("SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(spark, d):
    return _t(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).union(_t(spark, d, "supplier").select("s_nationkey"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_linestatus)::INTEGER AS whole FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(spark, d):
    return _t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping("l_linestatus").cast("int").alias("whole"))


@query("""
SELECT DISTINCT p_type, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS class, len(string_split(p_type, ' '))::INTEGER AS words, regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand_no, TRY_CAST(p_name AS INTEGER) AS bad FROM part WHERE p_name NOT LIKE '%xyz%'""")
def scalar_mix(spark, d):
    p = _t(spark, d, "part").where("p_name not like '%xyz%'")
    return p.select("p_type", F.when(F.col("p_size") > 25, "big").otherwise("small").alias("class"), F.size(F.split("p_type", " ")).alias("words"), F.regexp_replace("p_brand", "[^0-9]", "").alias("brand_no"), F.col("p_name").try_cast("int").alias("bad")).distinct()


# event windows (the batch form of the streaming operators)


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_windows(spark, d):
    return streaming.tumbling(_t(spark, d, "events"), "1 hour", "10 minutes", "ts", "event_type").withColumn("total", F.round("total", 4))


@query("""
SELECT start AS window_start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL '15 minutes', ts) - INTERVAL '15 minutes' * i FOR i IN range(0, 4)]) AS start FROM events) GROUP BY 1""")
def sliding_windows(spark, d):
    return streaming.sliding(_t(spark, d, "events"))


@query("""
WITH e AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, d):
    return streaming.sessions(_t(spark, d, "events"))
