"""Crawling: lists of URLs, lateral fetches, streams of URLs, and link following.

Fetch results are written to the shared folder before they are used again, so no page is
fetched twice by the same crawl.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions.http import content_type_allowed, error_class
from ..functions.urls import same_domain
from ..operators.merge import replace_table
from ..session import written
from .fetch import RESPONSE, Fetcher, HttpFetcher, Options, fetch_all, response

CRAWL = ("url", "status", "content_type", "html", "final_url", "error", "extract", "response_time_ms", "depth")
STREAM = ("url", "status_code", "content_type", "body", "error", "response_time_ms", "content_length", "jsonld", "opengraph", "meta")
STATE = T.StructType([T.StructField("url", T.StringType()), T.StructField("http_status", T.IntegerType()), T.StructField("extracted", T.StringType()), T.StructField("crawled_at", T.TimestampType()), T.StructField("etag", T.StringType()), T.StructField("last_modified", T.StringType())])
CACHE = T.StructType([*(f for f in RESPONSE.fields), T.StructField("cached_at", T.TimestampType())])


def _numbered(spark: SparkSession, urls: Sequence[str | None]) -> DataFrame:
    rows = [(u, i) for i, u in enumerate(u for u in urls if u is not None)]
    return spark.createDataFrame(rows, "url string, seq bigint")


def _raw(spark: SparkSession, rows: DataFrame, fetcher: Fetcher, options: Options, cache: str | None, cache_hours: float, workers: int | None, robots: bool | None, polite: bool = True) -> DataFrame:
    """Responses by way of the cache table: hits within the time to live are joined, the
    rest is fetched and appended, failures too. Of several rows of a URL the last counts,
    so that no round rewrites what it holds; ``compact`` drops the others."""
    if cache is None:
        return written(fetch_all(rows, fetcher, options, workers, polite, robots), "crawl")
    names = [f.name for f in RESPONSE.fields if f.name != "url"]
    if spark.catalog.tableExists(cache):
        held = spark.table(cache)
    else:
        held = spark.createDataFrame([], CACHE)
    now = datetime.now(timezone.utc)
    fresh = held.where(F.col("cached_at") > F.lit(now) - F.expr(f"interval {int(cache_hours * 3600)} seconds")).join(rows.select("url"), "url", "left_semi")
    fresh = written(_latest(fresh), "cached")
    hits = rows.join(fresh.drop("cached_at"), "url").withColumn("error_type", F.lit(None).cast("string"))
    got = written(fetch_all(rows.join(fresh.select("url"), "url", "left_anti"), fetcher, options, workers, polite, robots), "crawl")
    new = got.where("error_type is null").select("url", *names).dropDuplicates(["url"]).withColumn("cached_at", F.lit(now))
    new.write.mode("append").format("parquet").saveAsTable(cache)
    return got.unionByName(hits)


def _latest(cached: DataFrame) -> DataFrame:
    rest = [c for c in cached.columns if c != "url"]
    return cached.groupBy("url").agg(F.max_by(F.struct(*rest), "cached_at").alias("r")).select("url", "r.*").select(*cached.columns)


def compact(spark: SparkSession, cache: str, cache_hours: float | None = None) -> None:
    """Leaves one row for each URL of a cache table, of those within the time to live."""
    rows = spark.table(cache)
    if cache_hours is not None:
        rows = rows.where(F.col("cached_at") > F.current_timestamp() - F.expr(f"interval {int(cache_hours * 3600)} seconds"))
    replace_table(spark, cache, _latest(rows))


def crawl(
    spark: SparkSession,
    urls: str | Sequence[str | None] | DataFrame,
    fetcher: Fetcher | None = None,
    *,
    user_agent: str | None = None,
    timeout: float | None = None,
    workers: int | None = None,
    batch_size: int | None = None,
    delay: int | None = None,
    respect_robots: bool | None = None,
    follow: str | None = None,
    max_depth: int = 1,
    state_table: str | None = None,
    cache: str | None = None,
    cache_ttl: float = 24,
    max_results: int | None = None,
    same_site: bool = False,
    allow_subdomains: bool = False,
    respect_nofollow: bool = False,
    accept: Sequence[str] = (),
    reject: Sequence[str] = (),
    extract: Sequence[dict] | None = None,
    headers: dict | None = None,
    proxy: str | None = None,
    proxies: dict | None = None,
    max_retries: int | None = None,
    adaptive_delay: bool | None = None,
    least_delay: int | None = None,
    most_delay: int | None = None,
    max_response_bytes: int | None = None,
    responses: bool = False,
) -> DataFrame:
    """One row for each URL: url, status, content_type, html, final_url, error, extract,
    response_time_ms, depth. ``follow`` takes links by selector from pages of status 2xx
    above ``max_depth``, breadth first, each URL once. A URL that robots.txt forbids gets
    a row with its error. ``max_results`` bounds the fetches of each round as well. With
    ``responses`` the rows are the responses as they came: url, status, content_type, body,
    final_url, error, error_type, response_time_ms, etag, last_modified, depth."""
    options = Options.of(spark, user_agent=user_agent, timeout_ms=None if timeout is None else int(timeout * 1000), delay_ms=delay, respect_robots=respect_robots, headers=headers, batch_size=batch_size, proxy=proxy, proxies=proxies, max_retries=max_retries, adaptive_delay=adaptive_delay, least_delay_ms=least_delay, most_delay_ms=most_delay, max_response_bytes=max_response_bytes)
    fetcher = fetcher or HttpFetcher()
    if isinstance(urls, DataFrame):
        first = urls.select(F.col(urls.columns[0]).cast("string").alias("url")).na.drop()
        frontier = first.withColumn("seq", F.monotonically_increasing_id())
    else:
        frontier = _numbered(spark, [urls] if isinstance(urls, str) else urls)
    frontier = frontier.where("url <> ''").groupBy("url").agg(F.min("seq").alias("seq"))
    done = None
    if state_table and spark.catalog.tableExists(state_table):
        done = spark.table(state_table).select("url")
        frontier = frontier.join(done, "url", "left_anti")
    rounds: list[DataFrame] = []
    left = max_results
    for depth in range(1, max(1, max_depth) + 1):
        if left is not None:
            frontier = frontier.orderBy("seq", "url").limit(left)
        raw = _raw(spark, frontier.withColumn("depth", F.lit(depth)), fetcher, options, cache, cache_ttl, workers, respect_robots)
        raw = raw.withColumn("_ok", F.col("error_type").isNotNull() | content_type_allowed(F.col("content_type"), accept, reject) | F.col("content_type").isNull())
        raw = raw.withColumn("body", F.when(F.col("_ok"), F.col("body"))).withColumn("error", F.when(F.col("_ok"), F.col("error")).otherwise("content type rejected")).drop("_ok")
        rounds.append(raw)
        if left is not None:
            left -= raw.count()
        if not follow or depth == max_depth or left is not None and left <= 0:
            break
        pages = raw.where("status between 200 and 299 and body is not null and body <> ''")
        base = F.coalesce("final_url", "url")
        if respect_nofollow:
            pages = pages.where(~H.meta_nofollow("body"))
        found = pages.select("seq", F.col("url").alias("_from"), F.posexplode(H.links("body", base, follow)).alias("_pos", "url"))
        if same_site:
            found = found.where(same_domain("_from", "url", allow_subdomains))
        fresh = found.groupBy("url").agg(F.min(F.struct("seq", "_pos")).alias("o"))
        seen = rounds[0].select("url")
        for r in rounds[1:]:
            seen = seen.union(r.select("url"))
        fresh = fresh.join(seen if done is None else seen.union(done), "url", "left_anti")
        # the order of discovery becomes one number again: ranges in order, rows in order
        fresh = fresh.orderBy("o.seq", "o._pos", "url").select("url", F.monotonically_increasing_id().alias("seq"))
        frontier = written(fresh, "frontier")
        if frontier.isEmpty():
            break
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    if state_table:
        _save_state(spark, out, state_table)
    if responses:
        return out.select(*(f.name for f in RESPONSE.fields), F.coalesce("error_type", error_class(F.col("status"), F.col("error"))).alias("error_type"), "depth")
    body = F.coalesce("body", F.lit(""))
    value = F.to_json(H.html_extract(body, extract)) if extract else F.lit(None).cast("string")
    return out.select("url", "status", "content_type", H.html_struct(body, "content_type").alias("html"), "final_url", "error", value.alias("extract"), "response_time_ms", "depth")


def _save_state(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Appends what isn't there yet; a crawl fetches no other URLs."""
    new = rows.groupBy("url").agg(*(F.max_by(c, "depth").alias(c) for c in ("status", "etag", "last_modified")))
    new = new.select("url", F.col("status").alias("http_status"), F.lit(None).cast("string").alias("extracted"), F.current_timestamp().alias("crawled_at"), "etag", "last_modified")
    if spark.catalog.tableExists(table):
        new = written(new.join(spark.table(table).select("url"), "url", "left_anti"), "state")
    new.write.mode("append").format("parquet").saveAsTable(table)


@contextlib.contextmanager
def interruptible(spark: SparkSession, name: str) -> Iterator[None]:
    """What this thread runs within can be stopped from another by ``interrupt``."""
    spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def interrupt(spark: SparkSession, name: str) -> None:
    """Stops a crawl; what it has written to cache and state stays."""
    spark.sparkContext.cancelJobGroup(name)


def crawl_url(rows: DataFrame, url_col: str = "url", fetcher: Fetcher | None = None, *, max_results: int | None = None, cache: str | None = None, cache_ttl: float = 24, **settings) -> DataFrame:
    """One fetch for each row, beside the row's own columns: status, content_type, html,
    final_url, error, extract, response_time_ms. A null URL gives the error ``NULL URL``,
    an empty one no row. Robots and delays are left out, as in a lookup."""
    spark = rows.sparkSession
    options = Options.of(spark, respect_robots=False, delay_ms=0, **settings)
    rows = written(rows.where(f"`{url_col}` is null or `{url_col}` <> ''").withColumn("_row", F.monotonically_increasing_id()), "lateral")
    if max_results is not None:
        rows = rows.orderBy("_row").limit(max_results)
    asked = rows.where(f"`{url_col}` is not null").groupBy(F.col(f"`{url_col}`").alias("url")).agg(F.min("_row").alias("seq"))
    got = _raw(spark, asked, fetcher or HttpFetcher(), options, cache, cache_ttl, None, False, False).drop("seq", "error_type")
    both = rows.join(got.withColumnRenamed("url", "_url"), F.col(f"`{url_col}`") == F.col("_url"), "left")
    own = [F.col(f"`{c}`") for c in rows.columns if c != "_row"]
    empty = F.col(f"`{url_col}`").isNull()
    return both.select(*own, F.coalesce("status", F.lit(0)).alias("status"), "content_type", H.html_struct("body", "content_type").alias("html"), "final_url", F.when(empty, "NULL URL").otherwise(F.col("error")).alias("error"), F.lit(None).cast("string").alias("extract"), F.coalesce("response_time_ms", F.lit(0)).alias("response_time_ms"))


def crawl_stream(spark: SparkSession, urls: str | Sequence[str | None], fetcher: Fetcher | None = None, *, workers: int = 4, crawl_delay: float | None = None, timeout: float | None = None, user_agent: str | None = None, respect_robots_txt: bool | None = None) -> DataFrame:
    """Flat rows: url, status_code, content_type, body, error, response_time_ms,
    content_length, jsonld, opengraph, meta. A string is a query whose first column holds
    the URLs. URLs that robots.txt forbids give no row."""
    if isinstance(urls, str):
        q = spark.sql(urls)
        frontier = q.select(F.col(f"`{q.columns[0]}`").cast("string").alias("url")).na.drop().withColumn("seq", F.monotonically_increasing_id())
    else:
        frontier = _numbered(spark, urls)
    options = Options.of(spark, user_agent=user_agent, timeout_ms=None if timeout is None else int(timeout * 1000), delay_ms=None if crawl_delay is None else int(crawl_delay * 1000), respect_robots=respect_robots_txt)
    got = written(fetch_all(frontier, fetcher or HttpFetcher(), options, workers), "stream").where("error_type is null")
    page = F.when(F.col("status").between(200, 299) & F.lower(F.coalesce("content_type", F.lit(""))).rlike("text/html|application/xhtml"), F.col("body"))
    return got.select("url", F.col("status").alias("status_code"), "content_type", "body", F.coalesce("error", F.lit("")).alias("error"), "response_time_ms", F.octet_length(F.coalesce("body", F.lit(""))).cast("long").alias("content_length"), F.to_json(H.jsonld(page)).alias("jsonld"), F.to_json(H.opengraph(page)).alias("opengraph"), F.lit("").alias("meta"))


def stored_crawl(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """A crawl answered by a join with stored pages (url, status, content_type, body,
    final_url, error), for replays of any size."""
    got = urls.select("url").join(pages, "url", "left")
    missing = F.col("status").isNull()
    return got.select("url", F.coalesce("status", F.lit(404)).alias("status"), "content_type", H.html_struct("body", "content_type").alias("html"), F.coalesce("final_url", "url").alias("final_url"), F.when(missing, "not stored").otherwise(F.col("error")).alias("error"), error_class(F.coalesce("status", F.lit(404)), F.col("error")).alias("error_type"))


def register_crawl_url(spark: SparkSession, fetcher: Fetcher, name: str = "crawl_url", **settings) -> None:
    """``SELECT ... FROM urls u, LATERAL crawl_url(u.url) c``."""
    options = Options.of(spark, respect_robots=False, delay_ms=0, **settings)

    class CrawlUrl:
        def eval(self, url: str) -> Iterator[tuple]:
            if url == "":
                return
            r = response("", error="NULL URL") if url is None else fetcher.fetch(url, options)
            yield (url, r["status"], r["content_type"], r["body"], r["final_url"], r["error"], r["response_time_ms"])

    from pyspark.sql.functions import udtf

    spark.udtf.register(name, udtf(CrawlUrl, returnType="url string, status int, content_type string, body string, final_url string, error string, response_time_ms bigint"))


def register_functions(spark: SparkSession) -> None:
    """jq, css_select, htmlpath and page_info for SQL text."""
    simple: dict[str, tuple[Callable, T.DataType]] = {
        "jq_attr": (H._jq_attr, T.StringType()),
        "css_select": (H._css_select, T.StringType()),
        "htmlpath": (H._htmlpath, T.StringType()),
        "page_info": (H._page_info, T.StringType()),
    }
    for name, (f, kind) in simple.items():
        spark.udf.register(name, F.pandas_udf(H._series(f), kind))

    def jq(html: pd.Series, selector: pd.Series) -> pd.DataFrame:
        rows = [(H._jq(h, s) if h is not None and s is not None else None) or {"text": None, "html": None, "attr": None} for h, s in zip(html, selector)]
        return pd.DataFrame(rows, columns=H.ELEMENT.names)

    spark.udf.register("jq", F.pandas_udf(jq, H.ELEMENT))
