"""Fetching, kept behind one interface: stored pages for tests and replays, HTTP for the
rest. A fetcher is pickled to the executors and answers one URL at a time."""

from __future__ import annotations

import heapq
import http.client
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_AGENT = "webloom/0.1"
RESPONSE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("response_time_ms", T.LongType()),
        T.StructField("etag", T.StringType()),
        T.StructField("last_modified", T.StringType()),
    ]
)


@dataclass
class Options:
    """Settings of a crawl; the same names work as ``webloom.<name>`` in the session's
    configuration."""

    user_agent: str = USER_AGENT
    timeout_ms: int = 30_000
    delay_ms: int = 1000
    respect_robots: bool = True
    max_response_bytes: int = 10_485_760
    #: URL prefix -> headers; a text instead of headers is a bearer token
    headers: Mapping[str, Mapping[str, str] | str] = field(default_factory=dict)
    proxy: str | None = None
    #: URL prefix -> proxy, before ``proxy``
    proxies: Mapping[str, str] = field(default_factory=dict)
    #: Attempts after a first that failed or met a status from 500 to 504.
    max_retries: int = 0
    #: Seconds by which the waits between attempts grow.
    retry_base_s: float = 3.0
    #: The delay follows the site's response times, between these bounds.
    adaptive_delay: bool = False
    least_delay_ms: int = 0
    most_delay_ms: int = 60_000
    #: URLs that wait for their sites at the same time.
    batch_size: int = 1000

    @classmethod
    def of(cls, spark, **given) -> Options:
        conf = {}
        for name, kind in (("user_agent", str), ("timeout_ms", int), ("delay_ms", int), ("respect_robots", lambda v: v.lower() == "true"), ("max_response_bytes", int), ("proxy", str), ("max_retries", int), ("batch_size", int)):
            value = spark.conf.get(f"webloom.{name}", None)
            if value is not None:
                conf[name] = kind(value)
        return cls(**(conf | {k: v for k, v in given.items() if v is not None}))

    def headers_for(self, url: str) -> dict[str, str]:
        out: dict[str, str] = {}
        for prefix in sorted(self.headers, key=len):
            if within(url, prefix):
                given = self.headers[prefix]
                out |= {"Authorization": f"Bearer {given}"} if isinstance(given, str) else given
        return out

    def proxy_for(self, url: str) -> str | None:
        fit = [p for p in self.proxies if within(url, p)]
        return self.proxies[max(fit, key=len)] if fit else self.proxy


def within(url: str, prefix: str) -> bool:
    """Same scheme, host and port, and the prefix's path or one below it."""
    try:
        a, b = urlsplit(url), urlsplit(prefix)
    except ValueError:
        return False
    if (a.scheme, a.netloc.lower()) != (b.scheme, b.netloc.lower()):
        return False
    path = b.path.rstrip("/")
    return a.path == path or a.path.startswith(path + "/") or not path


class Fetcher(Protocol):
    def fetch(self, url: str, options: Options) -> dict: ...


def response(url: str, status: int = 0, content_type: str | None = None, body: str | None = None, final_url: str | None = None, error: str | None = None, response_time_ms: int = 0, etag: str | None = None, last_modified: str | None = None) -> dict:
    return dict(zip(RESPONSE.names, (url, status, content_type, body, final_url, error, response_time_ms, etag, last_modified)))


def gunzip(data: bytes, most: int | None = None) -> bytes:
    """Inflated data if it is gzip, nothing if it is damaged gzip, else itself. No more than
    ``most`` bytes and one are inflated."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, rest = [], data
    room = None if most is None else most + 1
    try:
        while rest[:2] == b"\x1f\x8b" and room != 0:
            z = zlib.decompressobj(31)
            out.append(z.decompress(rest, room or 0))
            if room is not None:
                room -= len(out[-1])
            if not z.eof and room != 0:
                return b""
            rest = z.unused_data
    except zlib.error:
        return b""
    return b"".join(out)


class StoredFetcher:
    """Answers from a mapping of URL to (status, content_type, body[, final_url, error])."""

    def __init__(self, pages: Mapping[str, tuple]):
        self.pages = dict(pages)

    @classmethod
    def from_rows(cls, df: DataFrame) -> StoredFetcher:
        """For fixtures of a size that the driver can hold; a large store is joined, see
        ``crawl.stored_crawl``."""
        return cls({r.url: (r.status, r.content_type, r.body, r.final_url, r.error) for r in df.select("url", "status", "content_type", "body", "final_url", "error").collect()})

    def fetch(self, url: str, options: Options) -> dict:
        if url not in self.pages:
            return response(url, 404, "text/plain", "", url)
        status, kind, body, *rest = self.pages[url]
        final, error = (*rest, None, None)[:2]
        if isinstance(body, bytes):
            body = gunzip(body, options.max_response_bytes).decode("utf-8", "replace")
        if body is not None and len(body.encode("utf-8", "replace")) > options.max_response_bytes:
            return response(url, 0, kind, None, final or url, "content too large")
        return response(url, status, kind, body, final or url, error, 1)


class _Redirects(urllib.request.HTTPRedirectHandler):
    """Redirects stay on the web and get the headers of the place they lead to, so that a
    secret isn't carried to another site."""

    def __init__(self, options: Options):
        self.options = options

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        if not origin(newurl):
            raise urllib.error.URLError(f"redirect to {newurl[:80]} isn't followed")
        new = super().redirect_request(req, fp, code, msg, headers, newurl)
        if new is not None:
            new.headers = {"User-agent": self.options.user_agent, "Accept-encoding": "gzip"}
            for k, v in self.options.headers_for(newurl).items():
                new.add_header(k, v)
        return new


class HttpFetcher:
    def fetch(self, url: str, options: Options) -> dict:
        """A response whatever happens: what can't be fetched has status 0 and an error.
        Only http and https are fetched."""
        began = time.monotonic()
        ms = lambda: int((time.monotonic() - began) * 1000)
        if not origin(url):
            return response(url, error="not an http or https URL")
        proxy = options.proxy_for(url)
        handlers = [_Redirects(options), *([urllib.request.ProxyHandler({"http": proxy, "https": proxy})] if proxy else [])]
        try:
            ask = urllib.request.Request(url, headers={"User-Agent": options.user_agent, "Accept-Encoding": "gzip", **options.headers_for(url)})
            with urllib.request.build_opener(*handlers).open(ask, timeout=options.timeout_ms / 1000) as r:
                return self._read(url, r, r.status, options, ms)
        except urllib.error.HTTPError as e:
            return self._read(url, e, e.code, options, ms)
        except (OSError, ValueError, http.client.HTTPException) as e:
            return response(url, error=str(e) or type(e).__name__, response_time_ms=ms())

    @staticmethod
    def _read(url, r, status, options, ms) -> dict:
        kind = r.headers.get("Content-Type")
        try:
            data = r.read(options.max_response_bytes + 1)
        except (OSError, ValueError, http.client.HTTPException) as e:
            return response(url, error=str(e) or type(e).__name__, response_time_ms=ms())
        told = r.headers.get("Content-Length") or ""
        if told.isdigit() and len(data) < min(int(told), options.max_response_bytes + 1):
            return response(url, error="connection closed before the whole response came", response_time_ms=ms())
        data = gunzip(data, options.max_response_bytes) if len(data) <= options.max_response_bytes else data
        if len(data) > options.max_response_bytes:
            return response(url, 0, kind, None, r.geturl(), "content too large", ms())
        try:
            body = data.decode(r.headers.get_content_charset() or "utf-8", "replace")
        except (LookupError, ValueError):  # a charset that nobody knows
            body = data.decode("utf-8", "replace")
        out = response(url, status, kind, body, r.geturl(), None, ms(), r.headers.get("ETag"), r.headers.get("Last-Modified"))
        return out | {"retry_after": r.headers.get("Retry-After")}


def origin(url: str) -> str:
    try:
        p = urlsplit(url)
    except ValueError:
        return ""
    return f"{p.scheme}://{p.netloc}" if p.scheme in ("http", "https") and p.netloc else ""


class Site:
    """What a worker knows of one host: when it may be asked again, and who waits."""

    def __init__(self, options: Options, polite: bool):
        from ..functions.http import AdaptiveDelay

        self.delay = options.delay_ms / 1000 if polite else 0.0
        self.free = 0.0
        self.adaptive = AdaptiveDelay(self.delay, options.least_delay_ms / 1000, options.most_delay_ms / 1000) if polite and options.adaptive_delay else None
        #: (earliest time, place in the order, attempts so far)
        self.waiting: list[tuple[float, int, int]] = []


class Visitor:
    """Fetches URLs site by site, each when its site may be asked: the earliest first, no
    site sooner than its delay (Crawl-delay, or one that adapts), failures again after a
    growing wait, and a whole site later after a 429. Both schemes of a host are one site."""

    SITES, RULES = 10_000, 1000

    def __init__(self, fetcher: Fetcher, options: Options, check: bool, polite: bool, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.fetcher, self.options, self.check, self.polite, self.clock, self.sleep = fetcher, options, check, polite, clock, sleep
        self.sites: dict[str, Site] = {}
        self.rules: dict[str, str] = {}

    def site(self, url: str) -> Site:
        host = origin(url).partition("://")[2].lower()
        if host not in self.sites:
            if len(self.sites) >= self.SITES:
                now = self.clock()
                self.sites = {h: s for h, s in self.sites.items() if s.waiting or s.free > now}
            self.sites[host] = Site(self.options, self.polite)
        return self.sites[host]

    def _rules(self, home: str, site: Site) -> str:
        from ..functions.robots import crawl_delay

        if home not in self.rules:
            while len(self.rules) >= self.RULES:
                del self.rules[next(iter(self.rules))]
            r = self.fetcher.fetch(home + "/robots.txt", self.options)
            self.rules[home] = (r["body"] or "") if 200 <= r["status"] < 300 else ""
            wait = crawl_delay(self.rules[home], self.options.user_agent) if self.polite else None
            if wait is not None and wait == wait:
                site.delay = max(site.delay, min(wait, self.options.most_delay_ms / 1000))
                if site.adaptive:
                    site.adaptive.delay = site.adaptive.least = max(site.adaptive.least, site.delay)
        return self.rules[home]

    def visit(self, urls: Sequence[str]) -> list[dict]:
        """The responses, in the order of ``urls``."""
        from ..functions.robots import allowed

        out: list[dict] = [{}] * len(urls)
        line: list[tuple[float, int, Site]] = []
        for i, url in enumerate(urls):
            home, site = origin(url), self.site(url)
            if self.check and home and not allowed(self._rules(home, site), self.options.user_agent, url[len(home) :].partition("#")[0] or "/"):
                out[i] = response(url, error="disallowed by robots.txt") | {"error_type": "robots_disallowed"}
                continue
            if not site.waiting:
                line.append((site.free, i, site))
            heapq.heappush(site.waiting, (0.0, i, 0))
        heapq.heapify(line)
        while line:
            at, _, site = heapq.heappop(line)
            ready = max(site.waiting[0][0], site.free)
            if ready > at:
                heapq.heappush(line, (ready, site.waiting[0][1], site))
                continue
            _, i, tries = heapq.heappop(site.waiting)
            if ready > self.clock():
                self.sleep(ready - self.clock())
            got = self.fetcher.fetch(urls[i], self.options)
            again = self._after(site, got, tries)
            if again is None:
                got.pop("retry_after", None)
                out[i] = got | {"error_type": None}
            else:
                heapq.heappush(site.waiting, (again, i, tries + 1))
            if site.waiting:
                heapq.heappush(line, (max(site.waiting[0][0], site.free), site.waiting[0][1], site))
        return out

    def _after(self, site: Site, got: dict, tries: int) -> float | None:
        """When to try again, if at all; the site's next time follows the response."""
        now = self.clock()
        if site.adaptive and got["status"] > 0:
            site.delay = site.adaptive.add(float(got["response_time_ms"] or 0))
        site.free = now + site.delay
        if tries >= self.options.max_retries or not (got["status"] == 429 or got["status"] <= 0 or 500 <= got["status"] <= 504):
            return None
        if got.get("error") in ("content too large", "not an http or https URL"):
            return None
        a, b = 1, 2
        for _ in range(tries):
            a, b = b, a + b
        told = str(got.get("retry_after") or "").strip()
        wait = max(float(told) if told.isdigit() else 0.0, self.options.retry_base_s * a)
        wait = min(wait, 3600.0)
        if got["status"] == 429:
            site.free = max(site.free, now + wait)
        return now + wait


#: URLs of a site from which it counts as giant, and about as many that one task gets of it.
GIANT = 10_000


def _spread_sites(rows: DataFrame, fetcher: Fetcher, options: Options) -> DataFrame:
    """``rows`` whose ``_site`` is split for giant sites that ask for no delay."""
    from ..functions.robots import crawl_delay
    from ..session import written

    if rows.limit(GIANT + 1).count() <= GIANT:
        return rows

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for site, n, homes in zip(pdf["_site"], pdf["n"], pdf["homes"]):
                got = [fetcher.fetch(h + "/robots.txt", options) for h in sorted(homes) if origin(h)]
                waits = [crawl_delay(r["body"] or "", options.user_agent) for r in got if 200 <= r["status"] < 300]
                if not any(waits):
                    out.append((site, -(-n // GIANT)))
            yield pd.DataFrame(out, columns=["_site", "_parts"])

    home = F.lower(F.regexp_extract("url", r"^([^/]*?://[^/?#]*)", 1))
    giant = rows.groupBy("_site").agg(F.count("*").alias("n"), F.collect_set(home).alias("homes")).where(F.col("n") > GIANT)
    giant = written(giant.mapInPandas(parts, "_site string, _parts bigint"), "sites")
    split = F.concat("_site", F.lit("#"), F.pmod(F.xxhash64("url"), "_parts"))
    return rows.join(giant, "_site", "left").withColumn("_site", F.coalesce(split, "_site")).drop("_parts")


def fetch_all(urls: DataFrame, fetcher: Fetcher, options: Options, partitions: int | None = None, polite: bool = True, robots: bool | None = None) -> DataFrame:
    """Responses for the rows of ``urls`` (url, seq and further columns). All URLs of one
    host are in one partition and in order, so its delay needs no clock beyond the task.
    A giant site is spread over the cluster if neither the settings nor its robots.txt
    (asked for once more in each task) want a delay and no 429 can hold it back.
    Without politeness a host's URLs are spread over the cluster, so that a giant site
    isn't one task. Write the result before using it twice: a second evaluation would
    fetch again."""
    check = options.respect_robots if robots is None else robots
    site = F.lower(F.regexp_extract("url", r"^[^/]*?://([^/?#]*)", 1))
    rows = urls.withColumn("_site", site if polite and (options.delay_ms or check) else F.hash("url").cast("string"))
    if polite and check and not (options.delay_ms or options.adaptive_delay or options.max_retries):
        rows = _spread_sites(rows, fetcher, options)
    rows = (rows.repartition(partitions, "_site") if partitions else rows.repartition("_site")).sortWithinPartitions("_site", "seq")
    schema = T.StructType([*urls.schema.fields, *(f for f in RESPONSE.fields if f.name != "url"), T.StructField("error_type", T.StringType())])
    names = schema.names

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        visitor = Visitor(fetcher, options, check, polite)
        for whole in parts:
            for k in range(0, len(whole), max(1, options.batch_size)):
                pdf = whole.iloc[k : k + max(1, options.batch_size)]
                got = visitor.visit(list(pdf["url"]))
                out = pdf.drop(columns=["_site"])
                for c in names:
                    if c not in out.columns:
                        out[c] = pd.Series([g[c] for g in got], dtype=object, index=out.index)
                yield out[names]

    return rows.mapInPandas(run, schema)
