"""Sitemaps as rows: url, lastmod, changefreq, priority."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import row_udf
from ..functions.robots import sitemaps_of
from ..session import written
from .fetch import Fetcher, HttpFetcher, Options, fetch_all, origin

ENTRY = T.StructType([T.StructField("url", T.StringType()), T.StructField("lastmod", T.StringType()), T.StructField("changefreq", T.StringType()), T.StructField("priority", T.DoubleType())])
PARSED = T.StructType([T.StructField("urls", T.ArrayType(ENTRY)), T.StructField("children", T.ArrayType(T.StringType()))])
COMMON_PATHS = ("/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemap.xml.gz", "/sitemap_index.xml.gz", "/sitemap1.xml", "/sitemap.php", "/sitemap.txt", "/sitemaps.xml", "/sitemap/sitemap.xml", "/sitemap/index.xml", "/wp-sitemap.xml", "/sitemap-main.xml")
HOURS = {"always": 0, "hourly": 1, "daily": 24, "weekly": 168, "monthly": 720, "yearly": 8760, "never": 87600}
_BLOCK = re.compile(r"<(?:\w+:)?(url|sitemap)\b[^>]*>(.*?)</(?:\w+:)?\1\s*>", re.S | re.I)


def _field(block: str, name: str) -> str | None:
    m = re.search(rf"<{name}\b[^>]*>\s*(?:<!\[CDATA\[(.*?)\]\]>|(.*?))\s*</{name}\s*>", block, re.S | re.I)
    text = (m[1] if m[1] is not None else unescape(m[2])).strip() if m else ""
    return text or None


def parse_sitemap(xml: str) -> dict:
    """URL entries and child sitemaps; text that isn't a sitemap has neither."""
    urls, children = [], []
    for kind, block in _BLOCK.findall(xml):
        loc = _field(block, "loc")
        if loc is None:
            continue
        if kind.lower() == "sitemap":
            children.append(loc)
            continue
        try:
            priority = float(_field(block, "priority") or "")
        except ValueError:
            priority = None
        urls.append({"url": loc, "lastmod": _field(block, "lastmod"), "changefreq": _field(block, "changefreq"), "priority": priority})
    return {"urls": urls, "children": children}


def sitemap_entries(xml: Column) -> Column:
    """struct(urls, children) of one sitemap's text."""
    return row_udf(parse_sitemap, PARSED)(xml)


def sitemap(spark: SparkSession, urls: str | list[str], fetcher: Fetcher | None = None, *, recursive: bool = True, max_depth: int = 5, discover: bool = False, like: str | None = None, **settings) -> DataFrame:
    """Entries of the sitemaps, of their children down to ``max_depth``. With ``discover``
    the URLs are sites: robots.txt names the sitemaps, else the usual places are tried.
    ``like`` keeps URLs that match a LIKE pattern. What can't be read gives no rows."""
    fetcher = fetcher or HttpFetcher()
    options = Options.of(spark, respect_robots=False, delay_ms=0, **settings)
    start = [urls] if isinstance(urls, str) else list(urls)
    if discover:
        robots = spark.createDataFrame([(origin(u) + "/robots.txt", i) for i, u in enumerate(start)], "url string, seq bigint")
        texts = fetch_all(robots, fetcher, options, robots=False).select("url", "status", "body").collect()  # one row for each site asked for
        start = []
        for r in texts:
            named = sitemaps_of(r.body or "") if r.status == 200 else []
            start += named or [r.url[: -len("/robots.txt")] + p for p in COMMON_PATHS]
    todo = spark.createDataFrame([(u, i) for i, u in enumerate(dict.fromkeys(start))], "url string, seq bigint")
    seen, parts = None, []
    for _ in range(max(1, max_depth)):
        got = fetch_all(todo, fetcher, options, robots=False).where("status between 200 and 299 and body is not null")
        got = written(got.select(F.col("url").alias("at"), sitemap_entries(F.col("body")).alias("s")), "sitemap")
        parts.append(got)
        if not recursive:
            break
        seen = todo.select("url") if seen is None else seen.union(todo.select("url"))
        todo = written(got.select(F.explode("s.children").alias("url")).distinct().join(seen, "url", "left_anti").withColumn("seq", F.monotonically_increasing_id()), "sitemap")
        if todo.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    rows = out.select(F.explode("s.urls").alias("u")).select("u.*")
    return rows.where(F.col("url").like(like)) if like else rows


def stale(entries: DataFrame, crawled: DataFrame, now: Column | None = None) -> DataFrame:
    """Sitemap entries to crawl again: new ones, those changed since, and those older than
    their changefreq (a week if it is missing)."""
    now = F.current_timestamp() if now is None else now
    hours = F.lit(168)
    for name, h in HOURS.items():
        hours = F.when(F.lower("changefreq") == name, h).otherwise(hours)
    both = entries.join(crawled.select("url", "crawled_at"), "url", "left")
    changed = F.coalesce(F.try_to_timestamp("lastmod"), F.try_to_timestamp("lastmod", F.lit("yyyy-MM-dd")))
    return both.where(F.col("crawled_at").isNull() | (changed > F.col("crawled_at")) | (F.unix_timestamp(now) - F.unix_timestamp("crawled_at") >= hours * 3600)).drop("crawled_at")
