"""HTML extraction as Spark columns. Each function is one Arrow-batched UDF that parses a
page once; columns that aren't selected are pruned with their UDF. ``page_fields`` gives
several fields of one parse.

Null in, null out. What "no match" gives is said by each function.
"""

from __future__ import annotations

import contextlib
import gc
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .extract import MISS, Page, dumps

ELEMENT = T.StructType([T.StructField("text", T.StringType()), T.StructField("html", T.StringType()), T.StructField("attr", T.MapType(T.StringType(), T.StringType()))])
TABLE = T.StructType([T.StructField("headers", T.ArrayType(T.StringType())), T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType())))])
LINK = T.StructType([T.StructField("url", T.StringType()), T.StructField("nofollow", T.BooleanType())])
READABLE = T.StructType([T.StructField(n, T.StringType() if n != "length" else T.LongType()) for n in ("title", "content", "text_content", "length", "excerpt")])
JSON_MAP = T.MapType(T.StringType(), T.StringType())
HTML = T.StructType([T.StructField("document", T.StringType()), T.StructField("js", T.StringType()), T.StructField("meta", T.StringType()), T.StructField("opengraph", T.StringType()), T.StructField("schema", JSON_MAP), T.StructField("readability", T.StringType())])
STRINGS = T.ArrayType(T.StringType())


#: Characters of the pages that stay parsed: more than a batch of ``session.page_batches``.
KEPT = 3 << 20
_parsed: OrderedDict[str, Page] = OrderedDict()
_size = 0


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Within, Python doesn't look for cycles: pages have many and are closed when they go,
    so it would read the trees of a batch again and again and find nothing."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def page(html: str) -> Page:
    """A worker runs the functions of one page over a whole batch, one after another; the
    last pages stay parsed, so that all of them read the same tree."""
    global _size
    found = _parsed.get(html)
    if found is None:
        found = _parsed[html] = Page(html)
        _size += len(html)
        while _size > KEPT and len(_parsed) > 1:
            html, old = _parsed.popitem(last=False)
            _size -= len(html)
            old.close()
    else:
        _parsed.move_to_end(html)
    return found


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal(v: Column | str) -> Column:
    return F.lit(v) if isinstance(v, str) else v


def row_udf(f: Callable[..., Any], kind: T.DataType, once: bool = False) -> Callable[..., Column]:
    """A batched UDF that calls ``f`` for rows without nulls. What is filtered on is run
    ``once``: what is taken for deterministic is copied into the filter, which Spark pushes
    below the UDF and below the spreading of a small file over the cores."""

    # a pandas frame can't hold a null struct, so structs travel as lists of one
    if isinstance(kind, T.StructType):
        wrapped = T.ArrayType(kind)
        udf = F.pandas_udf(_lists(f), wrapped)
        udf = udf.asNondeterministic() if once else udf
        return lambda *c: F.get(udf(*c), F.lit(0))
    return F.pandas_udf(_series(f), kind)


def _series(f: Callable[..., Any]) -> Callable[..., pd.Series]:
    def batch(first: pd.Series, *rest: pd.Series) -> pd.Series:
        with uncollected():
            return pd.Series([None if any(v is None for v in r) else f(*r) for r in zip(first, *rest)], dtype=object)

    return _annotated(batch, f)


def _lists(f: Callable[..., Any]) -> Callable[..., pd.Series]:
    def batch(first: pd.Series, *rest: pd.Series) -> pd.Series:
        out = []
        with uncollected():
            for r in zip(first, *rest):
                v = None if any(x is None for x in r) else f(*r)
                out.append(None if v is None else [v])
        return pd.Series(out, dtype=object)

    return _annotated(batch, f)


def _annotated(batch: Callable[..., pd.Series], f: Callable[..., Any]) -> Callable[..., pd.Series]:
    batch.__name__ = f.__name__.strip("_<>")
    return batch


def _jq(html: str, selector: str) -> dict | None:
    return page(html).element(selector) if html else None


def _jq_attr(html: str, selector: str, name: str) -> str:
    return page(html).attribute(selector, name) if html else ""


def _css_select(html: str, selector: str, accessor: str) -> str:
    return (page(html).css(selector, accessor) or "") if html else ""


def _htmlpath(html: str, path: str) -> str:
    v = page(html).path(path) if html else MISS
    return "null" if v is MISS else dumps(v)


def _page_info(html: str, url: str) -> str:
    return dumps(page(html).info()) if html else "{}"


def jq(html: Column | str, selector: Column | str, attribute: Column | str | None = None) -> Column:
    """First match as struct(text, html, attr): trimmed text, inner HTML, attributes; null
    without a match. With ``attribute`` that attribute's text, ``''`` without a match."""
    if attribute is None:
        return row_udf(_jq, ELEMENT)(_col(html), _literal(selector))
    return row_udf(_jq_attr, T.StringType())(_col(html), _literal(selector), _literal(attribute))


def css_select(html: Column | str, selector: Column | str, accessor: Column | str = "text") -> Column:
    """Text of the first match by accessor: ``text`` (also any unknown word), ``html``
    (outer), ``attr:x``, ``parent.…``, ``children.N.…``; ``''`` without a match."""
    return row_udf(_css_select, T.StringType())(_col(html), _literal(selector), _literal(accessor))


def htmlpath(html: Column | str, path: Column | str) -> Column:
    """JSON text at ``css@attr[*].json.path``, or of a script's variable at
    ``css@$name…``; the text ``null`` without a match."""
    return row_udf(_htmlpath, T.StringType())(_col(html), _literal(path))


def page_info(html: Column | str, url: Column | str) -> Column:
    """JSON inventory: meta, og, readability, schema, js, links, tables; ``{}`` for an
    empty page."""
    return row_udf(_page_info, T.StringType())(_col(html), _col(url))


def css_texts(html: Column | str, selector: Column | str) -> Column:
    """Trimmed texts of all matches."""
    return row_udf(_texts, STRINGS)(_col(html), _literal(selector))


def _texts(html: str, selector: str) -> list[str]:
    return page(html).texts(selector)


def _json_map(d: dict[str, Any]) -> dict[str, str]:
    return {k: dumps(v) for k, v in d.items()}


def _jsonld(html: str) -> dict[str, str]:
    return _json_map(page(html).jsonld)


def _jsonld_loose(html: str) -> dict[str, str]:
    return _json_map(page(html).jsonld_loose())


def _microdata(html: str) -> dict[str, str]:
    return _json_map(page(html).microdata)


def _schema(html: str) -> dict[str, str]:
    return _json_map(page(html).schema)


def _opengraph(html: str) -> dict[str, str]:
    return page(html).opengraph


def _opengraph_loose(html: str) -> str:
    return dumps(page(html).opengraph_loose())


def _meta(html: str) -> dict[str, str]:
    return page(html).meta


def _meta_basic(html: str) -> dict[str, str]:
    return page(html).meta_basic()


def _js(html: str) -> dict[str, str]:
    return _json_map(page(html).js())


def _js_window(html: str) -> dict[str, str]:
    return _json_map(page(html).js(True))


def _hydration(html: str) -> dict[str, str]:
    return _json_map(page(html).hydration)


def _readability(html: str) -> dict[str, Any]:
    return page(html).readability


def _links(html: str, base: str, selector: str) -> list[str]:
    return page(html).links(selector, base)


def _link_records(html: str, base: str) -> list[dict]:
    return page(html).link_records(base)


def _canonical(html: str, base: str) -> str | None:
    return page(html).canonical(base)


def _robots_meta(html: str, word: str) -> bool:
    return page(html).robots_meta(word)


def _table(html: str, selector: str, index: int, citations: bool) -> dict | None:
    try:
        headers, rows = page(html).table(selector, int(index), bool(citations))
    except ValueError:
        return None
    return {"headers": headers, "rows": rows}


def _html(document: str, content_type: str) -> dict:
    kind = content_type.lower()
    empty = {"document": document, "js": None, "meta": None, "opengraph": None, "schema": None, "readability": None}
    if not document or not ("text/html" in kind or "application/xhtml" in kind):
        return empty
    p = page(document)
    js = p.js()
    return {"document": document, "js": dumps(js) if js else None, "meta": dumps(p.meta) if p.meta else None, "opengraph": dumps(p.opengraph) if p.opengraph else None, "schema": _json_map(p.schema), "readability": dumps(p.readability)}


def jsonld(html: Column | str, loose: bool = False) -> Column:
    """Map of type to a JSON array of its JSON-LD objects; with ``loose`` comments and
    trailing commas are allowed and single objects stand alone."""
    return row_udf(_jsonld_loose if loose else _jsonld, JSON_MAP)(_col(html))


def microdata(html: Column | str) -> Column:
    """Map of type to a JSON array of flat items."""
    return row_udf(_microdata, JSON_MAP)(_col(html))


def schema(html: Column | str) -> Column:
    """JSON-LD and microdata together; an empty map if there is none."""
    return row_udf(_schema, JSON_MAP)(_col(html))


def opengraph(html: Column | str) -> Column:
    return row_udf(_opengraph, JSON_MAP)(_col(html))


def opengraph_twitter(html: Column | str) -> Column:
    """JSON object of OpenGraph with a ``twitter`` object."""
    return row_udf(_opengraph_loose, T.StringType())(_col(html))


def meta(html: Column | str, basic: bool = False) -> Column:
    return row_udf(_meta_basic if basic else _meta, JSON_MAP)(_col(html))


def js_variables(html: Column | str, include_window: bool = False) -> Column:
    """Map of variable to JSON."""
    return row_udf(_js_window if include_window else _js, JSON_MAP)(_col(html))


def hydration(html: Column | str) -> Column:
    return row_udf(_hydration, JSON_MAP)(_col(html))


def readability(html: Column | str) -> Column:
    return row_udf(_readability, READABLE)(_col(html))


def links(html: Column | str, base: Column | str, selector: str = "a[href]") -> Column:
    """Absolute http(s) links, encoded, repeats and fragments kept."""
    return row_udf(_links, STRINGS)(_col(html), _col(base), F.lit(selector))


def link_records(html: Column | str, base: Column | str) -> Column:
    """Distinct links without fragment, not encoded, as struct(url, nofollow)."""
    return row_udf(_link_records, T.ArrayType(LINK))(_col(html), _col(base))


def canonical(html: Column | str, base: Column | str) -> Column:
    return row_udf(_canonical, T.StringType())(_col(html), _col(base))


def meta_noindex(html: Column | str) -> Column:
    return row_udf(_robots_meta, T.BooleanType())(_col(html), F.lit("noindex"))


def meta_nofollow(html: Column | str) -> Column:
    return row_udf(_robots_meta, T.BooleanType())(_col(html), F.lit("nofollow"))


def html_table(html: Column | str, selector: str = "table", index: int = 1, citations: bool = True) -> Column:
    """struct(headers, rows) of the index-th table or list; null if there is none."""
    return row_udf(_table, TABLE, once=True)(_col(html), F.lit(selector), F.lit(index), F.lit(citations))


def html_struct(body: Column | str, content_type: Column | str) -> Column:
    """struct(document, js, meta, opengraph, schema, readability) of one parse; for other
    content types the document and nulls."""
    return row_udf(_html, HTML)(F.coalesce(_col(body), F.lit("")), F.coalesce(_col(content_type), F.lit("")))


def html_extract(html: Column | str, specs: Sequence[dict]) -> Column:
    """Map of alias to the value of each specification (see ``Page.extract``)."""

    def extract(html: str) -> dict[str, str | None]:
        p = page(html)
        out: dict[str, str | None] = {}
        for s in specs:
            if s.get("noted"):
                out[s["alias"]], k = p.extract_noted(s)
                out[f"{s['alias']}#source"] = str(k)
            else:
                out[s["alias"]] = p.extract(s)
        return out

    return row_udf(extract, JSON_MAP)(_col(html))


def html_expand(html: Column | str, spec: dict) -> Column:
    """Array of the values an expanding specification has; explode it to get rows."""

    def expand(html: str) -> list[str]:
        return page(html).expanded(spec)

    return row_udf(expand, STRINGS)(_col(html))


def page_fields(html: Column | str, url: Column | str, fields: dict[str, tuple[str, ...]]) -> Column:
    """Several string fields of one parse: name -> (function, arguments...), with the
    functions ``text``, ``attr``, ``css``, ``path`` and ``count``."""
    kind = T.StructType([T.StructField(n, T.StringType()) for n in fields])

    def read(html: str, url: str) -> dict[str, str | None]:
        p = page(html)
        out: dict[str, str | None] = {}
        for name, (what, *args) in fields.items():
            if what == "text":
                e = p.first(args[0])
                out[name] = None if e is None else e.text().strip()
            elif what == "attr":
                e = p.first(args[0])
                out[name] = None if e is None else e.attrs.get(args[1])
            elif what == "count":
                out[name] = str(len(p.all(args[0])))
            elif what == "path":
                out[name] = _htmlpath(html, args[0])
            else:
                out[name] = p.css(*args)
        return out

    return row_udf(read, kind)(_col(html), F.coalesce(_col(url), F.lit("")))
