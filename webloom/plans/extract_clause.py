"""The ``EXTRACT (...)`` clause and the ``CRAWL`` builder.

An item is ``source.path``, ``source 'selector'`` or ``COALESCE(item, ...)``, followed by
``AS name`` — or ``name [TYPE] FROM source 'selector' [OR source 'selector' ...]`` with ``|
transform`` or ``TRANSFORM transform [SEPARATOR 's']``, ``DEFAULT value``, ``REQUIRED`` and
``WARN_FALLBACK`` behind it. A css selector may end in ``::text``, ``::html`` or
``::attr(x)``; without it the outer HTML is taken. With a type such as ``TEXT[]``, or for
``join_array``, all matches are taken.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.urls import content_hash, surt
from ..functions.values import TRANSFORMS, coerce, join_array, transform
from ..functions.xpath import XPathError, steps_of
from .statement import StatementError, _inside, _split, _top_level

SOURCES = frozenset(("jsonld", "microdata", "og", "opengraph", "meta", "js", "css", "hydration", "regex", "reader", "xpath", "attr"))


def _css(selector: str) -> dict[str, Any]:
    m = re.fullmatch(r"(.*?)::(text|html|attr\(\s*([\w\-:]+)\s*\))", selector.strip(), re.S)
    if not m:
        return {"selector": selector.strip(), "accessor": "html"}
    return {"selector": m[1].strip(), "accessor": f"attr:{m[3]}" if m[3] else m[2]}


def _source(text: str) -> dict[str, Any]:
    s = text.strip()
    m = re.fullmatch(r"COALESCE\s*(\(.*\))", s, re.S | re.I)
    if m:
        first, *rest = [_source(p) for p in _split(_inside(m[1]), ",")]
        return first | {"alternatives": rest}
    m = re.fullmatch(r"attr\s*'((?:[^']|'')*)'\s*'((?:[^']|'')*)'", s, re.S | re.I)
    if m:
        return {"source": "css", "selector": m[1].replace("''", "'"), "accessor": f"attr:{m[2]}"}
    m = re.fullmatch(r"(\w+)\s*'((?:[^']|'')*)'", s, re.S)
    if m and m[1].lower() in SOURCES:
        name, value = m[1].lower(), m[2].replace("''", "'")
        if name == "css":
            return {"source": "css", **_css(value)}
        if name in ("regex", "xpath"):
            if name == "xpath":
                try:
                    steps_of(value)
                except XPathError as e:
                    raise StatementError(str(e)) from e
            return {"source": name, "selector": value}
        return {"source": "og" if name == "opengraph" else name, "path": _steps(value)}
    m = re.fullmatch(r"(\w+)\s*\.\s*(.+)", s, re.S)
    if m and m[1].lower() in SOURCES:
        return {"source": "og" if m[1].lower() == "opengraph" else m[1].lower(), "path": _steps(m[2])}
    raise StatementError(f"unknown source: {s[:40]}")


def _steps(text: str) -> list[str]:
    return [a or b for a, b in re.findall(r"([^.\[\]]+)|\[(\d+)\]", text)]


@dataclass
class Item:
    name: str
    spec: dict[str, Any]
    kind: str | None = None
    transforms: list[str] = field(default_factory=list)
    separator: str = ", "
    default: str | None = None
    required: bool = False
    noted: bool = False


def parse_extract(text: str) -> list[Item]:
    body = re.sub(r"^\s*EXTRACT\s*", "", text.strip(), flags=re.I)
    return [_item(part) for part in _split(_inside(body), ",")]


def _item(part: str) -> Item:
    head, *pipes = _split(part, r"\|")
    names, more = [], {}
    for k, p in enumerate(pipes):
        name, _, tail = p.strip().partition(" ")
        names.append(name)
        more |= _tail(tail, names) if k == len(pipes) - 1 else {}
    m = re.fullmatch(r"\s*(\w+)(?:\s+([A-Za-z]+(?:\s*\([\d\s,]+\))?(?:\[\])?))?\s+FROM\s+(.+)", head, re.S | re.I)
    if m:
        flat = _top_level(m[3])
        at = re.search(r"\b(?:TRANSFORM|DEFAULT|REQUIRED|WARN_FALLBACK)\b", flat, re.I)
        body = m[3][: at.start()] if at else m[3]
        if at:
            more |= _tail(m[3][at.start() :], names)
        first, *rest = [_source(x) for x in _split(body, r"\bOR\b")]
        spec = first | ({"alternatives": [*first.get("alternatives", []), *rest]} if rest else {})
        out = Item(m[1], spec, m[2], names, **more)
    else:
        sides = _split(head, r"\bAS\b")
        spec = _source(sides[0])
        name = sides[1].strip() if len(sides) == 2 else (spec.get("path") or ["value"])[-1]
        out = Item(name, spec, None, names, **more)
    for n in names:
        if n not in TRANSFORMS:
            raise StatementError(f"unknown transform: {n}")
    if (out.kind or "").endswith("[]") or "join_array" in names:
        for one in (out.spec, *out.spec.get("alternatives", [])):
            one["all"] = True
    return out


def _tail(text: str, names: list[str]) -> dict[str, Any]:
    """What follows the source: ``TRANSFORM x [SEPARATOR 's']``, ``DEFAULT v``, flags."""
    out: dict[str, Any] = {}
    rest = text.strip()
    while rest:
        m = re.match(r"TRANSFORM\s+(\w+)|SEPARATOR\s+'((?:[^']|'')*)'|DEFAULT\s+(?:'((?:[^']|'')*)'|([\w.+-]+))|(REQUIRED)\b|(WARN_FALLBACK)\b", rest, re.I)
        if not m:
            raise StatementError(f"not expected: {rest[:40]}")
        if m[1]:
            names.append(m[1])
        elif m[2] is not None:
            out["separator"] = m[2].replace("''", "'")
        elif m[5]:
            out["required"] = True
        elif m[6]:
            out["noted"] = True
        else:
            out["default"] = m[4] if m[3] is None else m[3].replace("''", "'")
        rest = rest[m.end() :].strip()
    return out


def extract_columns(html: Column | str, items: list[Item], notes: bool = False) -> list[Column]:
    """One parse for all items; transforms and casts are built-in functions. With ``notes``
    there is a last column ``_extraction_meta``: for each item its source, whether there was
    a value and whether it came from an alternative, as JSON."""
    noted = notes or any(i.noted for i in items)
    m = H.html_extract(html, [i.spec | {"alias": i.name, "noted": noted} for i in items])
    out = []
    for i in items:
        c = m[i.name]
        for t in i.transforms:
            c = join_array(c, i.separator) if t == "join_array" else transform(c, t)
        if i.default is not None:
            c = F.coalesce(c, F.lit(i.default))
        out.append((coerce(c, i.kind) if i.kind else c).alias(i.name))
    if noted:
        about = []
        for i in items:
            k = m[f"{i.name}#source"].cast("int")
            sources = F.array(*(F.lit(x["source"]) for x in (i.spec, *i.spec.get("alternatives", []))))
            about.append(F.struct(F.get(sources, F.greatest(k, F.lit(0))).alias("source"), (k >= 0).alias("success"), (k > 0).alias("fallback")).alias(i.name))
        out.append(F.to_json(F.struct(*about)).alias("_extraction_meta"))
    return out


def missing(items: list[Item]) -> Column | None:
    """Names of the REQUIRED items that have no value, or null where none is missing."""
    need = [i for i in items if i.required]
    if not need:
        return None
    names = F.concat_ws(", ", *(F.when(F.col(f"`{i.name}`").isNull(), F.lit(i.name)) for i in need))
    return F.when(names != "", names)


def select_extract(df: DataFrame, html: str, clause: str, *keep: str) -> DataFrame:
    """``keep`` and the items; rows without a REQUIRED value are left out."""
    items = parse_extract(clause)
    out = df.select(*keep, *extract_columns(html, items))
    lack = missing(items)
    return out if lack is None else out.where(lack.isNull())


#: Options of ``WITH (...)``: our name, and what the value becomes.
_OPTIONS: dict[str, tuple[str, Any]] = {
    "user_agent": ("user_agent", str),
    "timeout_seconds": ("timeout", float),
    "max_retries": ("max_retries", int),
    "default_crawl_delay": ("delay", lambda v: int(float(v) * 1000)),
    "min_crawl_delay": ("least_delay", lambda v: int(float(v) * 1000)),
    "max_crawl_delay": ("most_delay", lambda v: int(float(v) * 1000)),
    "max_crawl_pages": ("max_results", int),
    "max_crawl_depth": ("max_depth", int),
    "allow_subdomains": ("allow_subdomains", lambda v: v.lower() == "true"),
    "respect_robots_txt": ("respect_robots", lambda v: v.lower() == "true"),
    "respect_nofollow": ("respect_nofollow", lambda v: v.lower() == "true"),
    "accept_content_types": ("accept", lambda v: [x for x in re.split(r"\s*,\s*", v.strip()) if x]),
    "reject_content_types": ("reject", lambda v: [x for x in re.split(r"\s*,\s*", v.strip()) if x]),
    "max_response_bytes": ("max_response_bytes", int),
    "max_total_connections": ("workers", int),
    "cache_table": ("cache", str),
}
#: Options that steer the statement itself, or that nothing here needs.
_OTHERS = frozenset(("include_extraction_meta", "follow_links", "extract_js", "update_stale", "url_filter", "sitemap_cache_hours", "log_skipped", "compress", "max_parallel_per_domain", "max_retry_backoff_seconds"))


@dataclass
class CrawlStatement:
    query: str
    table: str
    sites: bool = False
    extract: str | None = None
    where: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    limit: int | None = None

    def settings(self) -> dict[str, Any]:
        out: dict[str, Any] = {}
        for k, v in self.options.items():
            if k in _OPTIONS:
                name, make = _OPTIONS[k]
                try:
                    out[name] = make(v)
                except ValueError as e:
                    raise StatementError(f"{k}: {v}") from e
            elif k not in _OTHERS:
                raise StatementError(f"unknown option: {k}")
        if self.flag("follow_links"):
            out |= {"follow": "a[href]", "same_site": True, "max_depth": out.get("max_depth", 10), "respect_nofollow": out.get("respect_nofollow", True)}
        else:
            out.pop("max_depth", None)
        return out

    def flag(self, name: str, default: bool = False) -> bool:
        return self.options.get(name, str(default)).lower() == "true"


def parse_crawl(text: str) -> CrawlStatement:
    """``CRAWL [SITES] (query) INTO table [EXTRACT (...)] [WHERE ...] [WITH (...)] [LIMIT n]``."""
    body = text.strip().rstrip(";")
    flat = _top_level(body)
    m = re.match(r"\s*CRAWL(\s+SITES)?\s*\(", body, re.I)
    into = re.search(r"\bINTO\s+([\w.]+|`[^`]+`)", flat, re.I) or re.search(r"\bINTO\s+(`[^`]+`)", body, re.I)
    if not m or not into:
        raise StatementError("CRAWL (query) INTO table expected")
    out = CrawlStatement(_inside(body[m.end() - 1 : into.start()]), into[1].strip("`"), bool(m[1]))
    marks = [(x.start(), x.end(), x[1].upper()) for x in re.finditer(r"\b(EXTRACT|WHERE|WITH|LIMIT)\b", flat[into.end() :], re.I)]
    rest = body[into.end() :]
    if rest[: marks[0][0] if marks else None].strip():
        raise StatementError(f"not expected: {rest.strip()[:40]}")
    for (_, a, word), b in zip(marks, [*(x[0] for x in marks[1:]), len(rest)]):
        part = rest[a:b].strip()
        if word == "EXTRACT":
            out.extract = f"EXTRACT {part}"
        elif word == "WHERE":
            out.where = part
        elif word == "LIMIT":
            if not part.isdigit():
                raise StatementError(f"LIMIT {part}")
            out.limit = int(part)
        else:
            for o in filter(str.strip, _split(_inside(part), ",")):
                x = re.fullmatch(r"\s*(\w+)\s*=?\s*(?:'((?:[^']|'')*)'|([\w.+-]+))\s*", o)
                if not x:
                    raise StatementError(f"not an option: {o.strip()}")
                out.options[x[1].lower()] = x[3] if x[2] is None else x[2].replace("''", "'")
    return out


def _crawled(got: DataFrame, clause: str | None, js: bool, notes: bool = False) -> DataFrame:
    """The 18 columns of a crawl's table, and the extracted ones."""
    page = F.when(F.lower(F.coalesce("content_type", F.lit("text/html"))).rlike("html"), F.col("body"))
    cols = [
        F.col("url"), surt("url").alias("surt_key"), F.col("status").alias("status_code"), F.col("body"), F.col("content_type"), F.current_timestamp().alias("crawled_at"), F.col("response_time_ms").alias("elapsed_ms"), F.col("error"), F.col("error_type"), F.col("final_url"),
        F.when(F.col("final_url") != F.col("url"), 1).otherwise(0).alias("redirect_count"), F.col("etag"), F.col("last_modified"), content_hash("body").alias("content_hash"), F.to_json(H.jsonld(page)).alias("jsonld"), F.to_json(H.opengraph(page)).alias("opengraph"), F.to_json(H.meta(page)).alias("meta"),
        (F.to_json(H.js_variables(page)) if js else F.lit(None).cast("string")).alias("js"),
    ]
    items = parse_extract(clause) if clause else []
    out = got.select(*cols, *(extract_columns(page, items, notes) if items else []))
    lack = missing(items)
    # a page without a required value is kept, and says so
    return out if lack is None else out.withColumn("error", F.coalesce("error", F.concat(F.lit("missing: "), lack)))


def crawl_into(spark: SparkSession, urls: DataFrame | list[str], table: str, clause: str | None = None, *, fetcher=None, limit: int | None = None, js: bool = False, notes: bool = False, **options) -> DataFrame:
    """Crawl, extract and append to a table; returns rows_inserted. ``redirect_count`` is 1
    where the response came from another URL."""
    from ..session import written
    from ..sources.crawl import crawl

    bounds = [n for n in (limit, options.pop("max_results", None)) if n is not None]
    got = crawl(spark, urls, fetcher, max_results=min(bounds, default=None), responses=True, **options)
    rows = written(_crawled(got, clause, js, notes), "crawl-into")
    if spark.catalog.tableExists(table):
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        rows.write.format("parquet").saveAsTable(table)
    return spark.range(1).select(F.lit(rows.count()).cast("long").alias("rows_inserted"))


MOST_SITES = 100_000


def run_crawl(spark: SparkSession, s: CrawlStatement, fetcher=None) -> DataFrame:
    """Runs the statement; returns rows_inserted, and for sites rows_updated too. Sites
    give the URLs of their sitemaps that the table lacks, and with ``update_stale`` those
    that have changed since, new ones first."""
    from ..operators.merge import Merge, merge_table
    from ..session import written
    from ..sources.crawl import crawl
    from ..sources.sitemap import sitemap, stale

    settings, js = s.settings(), s.flag("extract_js")
    settings["notes"] = notes = s.flag("include_extraction_meta")
    q = spark.sql(s.query)
    urls = q.select(F.col(f"`{q.columns[0]}`").cast("string").alias("url")).na.drop()
    if not s.sites:
        if s.where:
            urls = urls.where(s.where)
        return crawl_into(spark, urls, s.table, s.extract, fetcher=fetcher, limit=s.limit, js=js, **settings)
    hosts = [r.url for r in urls.distinct().limit(MOST_SITES + 1).collect()]
    if len(hosts) > MOST_SITES:
        raise StatementError(f"more than {MOST_SITES} sites")
    sites = [h if "://" in h else f"https://{h}" for h in sorted(hosts)]
    found = sitemap(spark, sites, fetcher, discover=True, like=s.options.get("url_filter")).dropDuplicates(["url"])
    if s.where:
        found = found.where(s.where)
    if not spark.catalog.tableExists(s.table):
        return crawl_into(spark, found.orderBy("url").select("url"), s.table, s.extract, fetcher=fetcher, limit=s.limit, js=js, **settings).withColumn("rows_updated", F.lit(0).cast("long"))
    held = spark.table(s.table)
    known = held.groupBy("url").agg(F.max("crawled_at").alias("crawled_at"))
    del settings["notes"]
    todo = stale(found, known) if s.flag("update_stale") else found.join(known, "url", "left_anti")
    todo = todo.join(known.select("url", F.lit(1).alias("_old")), "url", "left").orderBy(F.coalesce("_old", F.lit(0)), "url").select("url")
    bounds = [n for n in (s.limit, settings.pop("max_results", None)) if n is not None]
    got = crawl(spark, written(todo, "sites"), fetcher, max_results=min(bounds, default=None), responses=True, **settings)
    rows = written(_crawled(got, s.extract, js, notes), "crawl-sites")
    merge = Merge(held, rows, ["url"]).when_matched_update().when_not_matched_insert()
    return merge_table(spark, s.table, merge).select("rows_inserted", "rows_updated")
