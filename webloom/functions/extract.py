"""What can be read from one HTML page, as plain Python functions over ``dom`` trees.

``Page`` parses a page once; Spark columns over these functions are in ``html``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property
from typing import Any
from urllib.parse import urljoin, urlsplit

from .dom import Element, tree
from .jsvars import WINDOWS, ScriptError, read_variables, tokens
from .selectors import SelectorError, compile_selector
from .xpath import select as xpath_select

MISS = object()
#: Characters of a script whose tokens stay with its page; those of longer ones take too much.
SHORT = 1 << 12
HYDRATION = ("__NEXT_DATA__", "__NUXT__", "__INITIAL_STATE__", "__PRELOADED_STATE__", "__DATA__", "__APOLLO_STATE__", "__RELAY_STORE__", "__REDUX_STATE__")
_SCHEMA_ORG = re.compile(r"^https?://schema\.org/")
_SPACES = re.compile(r"\s+")


_JSON = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"))


def dumps(v: Any) -> str:
    return _JSON.encode(v)


def loads(s: str) -> Any:
    """JSON value, or MISS."""
    try:
        return json.loads(s)
    except (ValueError, RecursionError):
        return MISS


def dig(value: Any, path: list[str]) -> Any:
    """Value at the path of keys and indexes, or MISS."""
    for part in path:
        if isinstance(value, list) and part.isdigit() and int(part) < len(value):
            value = value[int(part)]
        elif isinstance(value, dict) and part in value:
            value = value[part]
        else:
            return MISS
    return value


def as_text(v: Any) -> str:
    return v if isinstance(v, str) else dumps(v)


def collapse(s: str) -> str:
    return " ".join(s.split())


class Page:
    def __init__(self, html: str):
        self.html = html
        self.root, self.elements = tree(html)
        self._tokens: dict[str, list] = {}
        self._variables: dict[tuple[str, bool], dict[str, Any]] = {}

    def close(self) -> None:
        """Takes the tree apart, so that its memory goes with the page."""
        for e in self.elements:
            e.parent = None

    # selection

    @cached_property
    def by_tag(self) -> dict[str, list[Element]]:
        out: dict[str, list[Element]] = {}
        for e in self.elements:
            out.setdefault(e.tag, []).append(e)
        return out

    def select(self, selector: str) -> Iterator[Element]:
        """Matches in document order. Raises ``SelectorError``."""
        s = compile_selector(selector)
        return s.among(self.elements if s.tag is None else self.by_tag.get(s.tag, ()))

    def all(self, selector: str) -> list[Element]:
        """Matches in document order; none for text that isn't a selector."""
        try:
            return list(self.select(selector))
        except SelectorError:
            return []

    def first(self, selector: str) -> Element | None:
        try:
            return next(self.select(selector), None)
        except SelectorError:
            return None

    def variables(self, script: str, include_window: bool = False) -> dict[str, Any]:
        """``js_variables`` of a script, which is read once for all that ask."""
        window = include_window and any(w in script for w in WINDOWS)
        found = self._variables.get((script, window))
        if found is None:
            toks = self._tokens.get(script)
            if toks is None:
                try:
                    toks = tokens(script)
                except ScriptError:
                    toks = []
                if len(script) <= SHORT:
                    self._tokens[script] = toks
            found = self._variables[script, window] = read_variables(toks, window)
        return found

    def element(self, selector: str) -> dict | None:
        """text, inner html and attributes of the first match."""
        if " @" in selector:
            css, _, name = selector.rpartition(" @")
            e = self.first(css.strip())
            return None if e is None or name.strip() not in e.attrs else {"text": None, "html": None, "attr": {}}
        e = self.first(selector)
        return None if e is None else {"text": e.text().strip(), "html": e.inner_html(), "attr": dict(e.attrs)}

    def attribute(self, selector: str, name: str) -> str:
        e = self.first(selector)
        return "" if e is None else e.attrs.get(name, "")

    def css(self, selector: str, accessor: str = "text") -> str | None:
        e = self.first(selector)
        if e is None:
            return None
        if accessor.startswith("parent."):
            e, accessor = e.parent, accessor[7:]
            if e is None or e.tag == "#document":
                return None
        elif accessor.startswith("children."):
            index, dot, accessor = accessor[9:].partition(".")
            inside = e.elements()
            if not dot or not index.isdigit() or int(index) >= len(inside):
                return None
            e = inside[int(index)]
        if accessor == "html":
            return e.outer_html()
        if accessor.startswith("attr:"):
            return e.attrs.get(accessor[5:])
        return e.text().strip()

    def texts(self, selector: str) -> list[str]:
        return [e.text().strip() for e in self.all(selector)]

    def path(self, path: str) -> Any:
        """Value of ``css@attr[*].json.path``, or MISS."""
        css, at, rest = path.strip().rpartition("@")
        css = css.strip()
        name = re.match(r"[^\[.]*", rest)[0]  # type: ignore[index]
        if not at or not name:
            return MISS
        parts, every, tail = [], False, rest[len(name) :]
        while tail:
            if tail.startswith("[*]"):
                every, tail = True, tail[3:]
            elif m := re.match(r"\[([^\]]*)\]", tail):
                parts.append(m[1])
                tail = tail[m.end() :]
            elif m := re.match(r"\.([^\[.]*)", tail):
                if m[1]:
                    parts.append(m[1])
                tail = tail[m.end() :]
            else:
                break
        if name.startswith("$"):
            for e in self.all(css or "script"):
                text = e.text()
                # a name stands in the script as it is
                found = self.variables(text) if name[1:] in text else {}
                if name[1:] in found:
                    return _follow(found[name[1:]], parts, every)
            return MISS
        e = self.first(css) if css else None
        if e is None:
            return MISS
        if name in ("text", "innerText"):
            raw = e.text().strip()
        elif name in ("html", "innerHTML"):
            raw = e.inner_html()
        elif name in e.attrs:
            raw = e.attrs[name]
        else:
            return MISS
        if not parts and not every:
            return raw
        value = loads(raw)
        return MISS if value is MISS else _follow(value, parts, every)

    # structured data

    @cached_property
    def jsonld(self) -> dict[str, list]:
        """Objects of every JSON-LD script by type."""
        out: dict[str, list] = {}

        def visit(v: Any) -> None:
            if isinstance(v, list):
                for x in v:
                    visit(x)
            elif isinstance(v, dict):
                kinds = v.get("@type")
                for k in kinds if isinstance(kinds, list) else [kinds]:
                    if isinstance(k, str):
                        out.setdefault(_SCHEMA_ORG.sub("", k), []).append(v)
                if "@graph" in v:
                    visit(v["@graph"])

        for e in self.all('script[type="application/ld+json"]'):
            value = loads(e.text())
            if value is not MISS:
                visit(value)
        return out

    def jsonld_loose(self) -> dict[str, Any]:
        """Older reading: comments and trailing commas are allowed, an object counts under
        its first type, and a type with one object isn't an array."""
        out: dict[str, list] = {}
        for e in self.all('script[type="application/ld+json"]'):
            s = re.sub(r'("(?:[^"\\]|\\.)*")|//[^\n]*|/\*.*?\*/', lambda m: m[1] or "", e.text(), flags=re.S)
            value = loads(re.sub(r'("(?:[^"\\]|\\.)*")|,(?=\s*[}\]])', lambda m: m[1] or "", s))
            todo = [] if value is MISS else [value]
            while todo:
                v = todo.pop(0)
                if isinstance(v, list):
                    todo = v + todo
                elif isinstance(v, dict):
                    kind = v.get("@type")
                    kind = kind[0] if isinstance(kind, list) and kind else kind
                    if isinstance(kind, str):
                        out.setdefault(_SCHEMA_ORG.sub("", kind), []).append(v)
                    if "@graph" in v:
                        todo.insert(0, v["@graph"])
        return {k: v[0] if len(v) == 1 else v for k, v in out.items()}

    @cached_property
    def microdata(self) -> dict[str, list[dict]]:
        out: dict[str, list[dict]] = {}
        for scope in self.all("[itemscope][itemtype]"):
            kind = scope.attrs["itemtype"].rstrip("/").rpartition("/")[2] if scope.attrs["itemtype"] else ""
            item: dict[str, str] = {}
            for e in scope.walk():
                if "itemprop" in e.attrs:
                    value = next((e.attrs[a] for a in ("content", "href", "src") if a in e.attrs), None)
                    item[e.attrs["itemprop"]] = e.text().strip() if value is None else value
            if kind:
                out.setdefault(kind, []).append(item)
        return out

    @cached_property
    def schema(self) -> dict[str, list]:
        """JSON-LD objects by type, then microdata items."""
        out = {k: list(v) for k, v in self.jsonld.items()}
        for k, items in self.microdata.items():
            out.setdefault(k, []).extend(items)
        return out

    @cached_property
    def opengraph(self) -> dict[str, str]:
        return {e.attrs["property"][3:]: e.attrs["content"] for e in self.all('meta[property^="og:"]') if "content" in e.attrs}

    @cached_property
    def meta(self) -> dict[str, str]:
        return {e.attrs["name"]: e.attrs["content"] for e in self.all("meta[name]") if "content" in e.attrs}

    def opengraph_loose(self) -> dict[str, Any]:
        """OpenGraph with the Twitter card as an object of its own."""
        out: dict[str, Any] = dict(self.opengraph)
        card = {}
        for e in self.all("meta[content]"):
            name = e.attrs.get("name", e.attrs.get("property", ""))
            if name.startswith("twitter:"):
                card[name[8:]] = e.attrs["content"]
        return out | ({"twitter": card} if card else {})

    def meta_basic(self) -> dict[str, str]:
        """description, keywords, author, robots and the canonical link."""
        low = {k.lower(): v for k, v in self.meta.items()}
        out = {k: low[k] for k in ("description", "keywords", "author", "robots") if k in low}
        e = self.first('link[rel~="canonical"][href]')
        return out | ({"canonical": e.attrs["href"]} if e is not None else {})

    def js(self, include_window: bool = False) -> dict[str, Any]:
        out: dict[str, Any] = {}
        for e in self.all("script"):
            if e.attrs.get("type", "text/javascript") in ("text/javascript", ""):
                out |= self.variables(e.text(), include_window)
        return out

    @cached_property
    def hydration(self) -> dict[str, Any]:
        """State that frameworks leave in the page, by script id or assignment."""
        out: dict[str, Any] = {}
        for e in self.all("script"):
            text = e.text()
            if e.attrs.get("id") in HYDRATION:
                v = loads(text.strip())
                if v is not MISS:
                    out.setdefault(e.attrs["id"], v)
            elif "__" in text:
                for k, v in self.variables(text, True).items():
                    if k in HYDRATION:
                        out.setdefault(k, v)
        return out

    # links

    def links(self, selector: str = "a[href]", base: str = "") -> list[str]:
        """http(s) targets of the matches, in order, repeats and fragments kept."""
        out = []
        for e in self.all(selector):
            href = e.attrs.get("href", "").strip()
            if href and not re.match(r"(?i)javascript:|mailto:|tel:|#", href):
                url = join(base, href)
                if url.startswith(("http://", "https://")):
                    out.append(url)
        return out

    def link_records(self, base: str = "") -> list[dict]:
        """Distinct links without fragments, with their nofollow mark."""
        out: dict[str, bool] = {}
        for e in self.all("a[href]"):
            href = e.attrs["href"].strip()
            if href and not re.match(r"(?i)javascript:|mailto:|tel:|data:|#", href):
                url = resolve_url(base, href).partition("#")[0]
                out.setdefault(url, "nofollow" in e.attrs.get("rel", "").lower().split())
        return [{"url": u, "nofollow": n} for u, n in out.items()]

    def canonical(self, base: str = "") -> str | None:
        e = self.first('link[rel~="canonical" i][href]')
        return None if e is None else resolve_url(base, e.attrs["href"].strip())

    def robots_meta(self, word: str) -> bool:
        return any(e.attrs.get("name", "").lower() == "robots" and word in e.attrs.get("content", "").lower() for e in self.all("meta[name][content]"))

    # tables

    def table(self, selector: str, index: int = 1, citations: bool = True) -> tuple[list[str], list[list[str]]]:
        """(headers, rows) of the index-th match, counted from 1; without ``citations``
        reference marks are left out. Raises ValueError where there is none."""
        if index < 1:
            raise ValueError("index starts at 1")
        found = list(self.select(selector))
        if index > len(found):
            raise ValueError(f"no element {index} for {selector!r}, there are {len(found)}")
        e = found[index - 1]
        cell = lambda c: collapse(c.text() if citations else _without_citations(c))
        if e.tag in ("ul", "ol"):
            return ["item"], [[cell(x)] for x in e.walk() if x.tag == "li"]
        rows = [r for r in e.walk() if r.tag == "tr"]
        heads = [h for r in rows if r.closest("thead", "table") is not None and r.closest("thead", "table").tag == "thead" for h in r.walk() if h.tag == "th"]  # type: ignore[union-attr]
        heads = heads or [h for r in rows for h in r.walk() if h.tag == "th"]
        heads = heads or [d for r in rows if r.parent is not None and r.parent.elements()[0] is r for d in r.walk() if d.tag == "td"]
        headers = [cell(h) for h in heads]
        data = []
        for r in rows:
            if r.closest("tbody") is None:
                continue
            td = [c for c in r.walk() if c.tag == "td"]
            if td:
                data.append([cell(c) for c in td])
        width = max(len(headers), len(data[0]) if data else 0)
        return headers + [f"column{i + 1}" for i in range(len(headers), width)], data

    # readable text

    @cached_property
    def readability(self) -> dict[str, Any]:
        """Title, main content, its text, length in bytes and excerpt."""
        e = self._main()
        text = collapse(_readable(e)) if e is not None else ""
        title = self.first("title")
        name = collapse(title.text()) if title is not None else ""
        if not name:
            h = self.first("h1")
            name = collapse(h.text()) if h is not None else ""
        size = len(text.encode("utf-8", "replace"))
        return {"title": name, "content": e.outer_html() if e is not None else "", "text_content": text, "length": size, "excerpt": text[:200] + ("..." if size > 200 else "")}

    def _main(self) -> Element | None:
        body = self.first("body")
        if body is None:
            return None
        score: dict[int, tuple[float, Element]] = {}
        for e in body.walk():
            if e.tag in ("p", "pre", "td", "blockquote"):
                s = _readable(e).strip()
                if len(s) < 25:
                    continue
                points = 1 + s.count(",") + min(3, len(s) // 100)
                up, share = e.parent, 1.0
                while up is not None and share > 0.2 and up.tag not in ("html", "#document"):
                    old = score.get(id(up), (_weight(up), up))[0]
                    score[id(up)] = (old + points * share, up)
                    up, share = up.parent, share / 2
        if not score:
            return body
        return max(((v * (1 - _link_density(e)), -i, e) for i, (v, e) in enumerate(score.values())), key=lambda x: x[:2])[2]

    # inventory

    def info(self) -> dict[str, Any]:
        kinds = []
        for k in dict.fromkeys([*self.jsonld, *self.microdata]):
            parts = [d[k] for d in (self.jsonld, self.microdata) if k in d]
            size = sum(len(dumps(p).encode()) for p in parts)
            kinds.append({"type": k, "count": len(parts[0]) if len(parts) == 1 else len(parts), "size": size})
        names = {list: "array", dict: "object", str: "string", bool: "bool", int: "number", float: "number", type(None): "null"}
        js = []
        for k, v in self.js().items():
            js.append({"name": k, "type": names[type(v)], "size": len(dumps(v).encode())} | ({"items": len(v)} if isinstance(v, list) else {}))
        r = self.readability
        return {
            "meta": self.meta,
            "og": self.opengraph,
            "readability": {"title": r["title"], "length": r["length"], "excerpt": r["excerpt"][:150]},
            "schema": kinds,
            "js": sorted(js, key=lambda x: -x["size"]),
            "links": len(self.all("a[href]")),
            "tables": len(self.all("table")),
        }

    # many values at once

    def extract(self, spec: dict) -> str | None:
        """One value of a specification: source (jsonld, microdata, og, meta, js, css,
        hydration), path or selector and accessor, alternatives, JSON cast and path."""
        value = self._single(spec)
        if value is None or not (spec.get("is_json_cast") or spec.get("expand_array")):
            return value
        v = loads(value)
        if v is MISS:
            return value
        v = json_arrow(v, spec.get("json_path") or "")
        if v is MISS:
            return None
        if spec.get("expand_array") and isinstance(v, list):
            return None
        return dumps(v)

    @staticmethod
    def _of(e: Element, accessor: str) -> str | None:
        if accessor.startswith("attr:"):
            return e.attrs.get(accessor[5:])
        return e.outer_html() if accessor == "html" else e.text().strip()

    def extract_noted(self, spec: dict) -> tuple[str | None, int]:
        """The value, and which of the specification and its alternatives gave it (-1: none)."""
        for k, one in enumerate([{**spec, "alternatives": []}, *(spec.get("alternatives") or [])]):
            v = self.extract(one)
            if v is not None:
                return v, k
        return None, -1

    def expanded(self, spec: dict) -> list[str]:
        """Elements of an array specification; of their ``array_field`` where it is set."""
        v = loads(self._single(spec) or "")
        v = MISS if v is MISS else json_arrow(v, spec.get("json_path") or "")
        if not isinstance(v, list):
            return []
        name = spec.get("array_field")
        return [as_text(x) for x in (v if not name else [i[name] for i in v if isinstance(i, dict) and name in i])]

    def _single(self, spec: dict) -> str | None:
        source, path = spec.get("source"), list(spec.get("path") or [])
        out: str | None = None
        if source in ("jsonld", "microdata", "js", "hydration"):
            data = {"jsonld": lambda: self.jsonld, "microdata": lambda: self.microdata, "js": self.js, "hydration": lambda: self.hydration}[source]()
            if path and path[0] in data:
                v: Any = data[path[0]]
                if source in ("jsonld", "microdata") and len(path) > 1 and isinstance(v, list) and not path[1].isdigit():
                    v = v[0]
                v = dig(v, path[1:])
                out = None if v is MISS else as_text(v) if spec.get("return_text", True) else dumps(v)
        elif source == "og":
            out = self.opengraph.get(path[0]) if path else None
        elif source == "meta":
            out = self.meta.get(path[0]) if path else None
        elif source == "css" and spec.get("all"):
            found = [self._of(e, spec.get("accessor") or "text") for e in self.all(spec.get("selector") or "")]
            out = dumps([v for v in found if v is not None]) if found else None
        elif source == "css":
            out = self.css(spec.get("selector") or "", spec.get("accessor") or "text")
        elif source == "xpath":
            found = [v if isinstance(v, str) else v.outer_html() for v in xpath_select(self.root, spec.get("selector") or "")]
            out = None if not found else dumps([v.strip() for v in found]) if spec.get("all") else found[0].strip()
        elif source == "regex":
            m = re.search(spec.get("selector") or "(?!)", self.html)
            out = (m[1] if m.re.groups else m[0]) if m else None
        elif source == "reader":
            v = self.readability.get(path[0]) if path else None
            out = None if v is None else str(v)
        if out is None:
            for other in spec.get("alternatives") or []:
                out = self._single(other)
                if out is not None:
                    break
        return out


def json_arrow(value: Any, path: str) -> Any:
    """``->'a'->[0]->>'b'`` on a JSON value, or MISS."""
    parts = re.findall(r"""->>?\s*(?:'([^']*)'|"([^"]*)"|\[?(\d+)\]?|([^\s'"\[\->]+))""", path)
    return dig(value, [a or b or c or d for a, b, c, d in parts])


def _follow(value: Any, parts: list[str], every: bool) -> Any:
    if not every:
        return dig(value, parts)
    if not isinstance(value, list):
        return MISS
    return [v for v in (dig(x, parts) for x in value) if v is not MISS]


def _without_citations(e: Element) -> str:
    out: list[str] = []
    for c in e.children:
        if isinstance(c, str):
            out.append(c)
        elif not (c.tag == "sup" and (c.attrs.get("id", "").startswith("cite_ref") or "reference" in c.attrs.get("class", ""))):
            out.append(_without_citations(c))
    return "".join(out)


_POSITIVE = re.compile(r"article|body|content|entry|main|page|post|text|blog|story", re.I)
_NEGATIVE = re.compile(r"combx|comment|contact|foot|masthead|media|meta|nav|promo|related|scroll|shoutbox|sidebar|sponsor|tags|widget|\bads?\b", re.I)


def _weight(e: Element) -> float:
    name = e.attrs.get("class", "") + " " + e.attrs.get("id", "")
    w = 25.0 * bool(_POSITIVE.search(name)) - 25.0 * bool(_NEGATIVE.search(name))
    return w + {"article": 8, "main": 8, "div": 5, "pre": 3, "td": 3, "blockquote": 3}.get(e.tag, 0) - 5 * (e.tag in ("ul", "ol", "form", "nav", "footer", "header", "aside"))


_UNREAD = frozenset(("script", "style", "noscript", "nav", "form"))
_APART = frozenset(("br", "p", "div", "li", "tr", "td", "h1", "h2", "h3"))


def _readable(e: Element) -> str:
    out: list[str] = []
    todo = e.children[::-1]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag not in _UNREAD:
            if n.tag in _APART:
                out.append(" ")
            todo += n.children[::-1]
    return "".join(out)


def _link_density(e: Element) -> float:
    whole = len(e.text()) or 1
    return sum(len(a.text()) for a in e.walk() if a.tag == "a") / whole


def join(base: str, href: str) -> str:
    """Absolute URL as browsers form it; non-ASCII and blanks are percent-encoded."""
    try:
        url = urljoin(base, re.sub(r"[\t\r\n]", "", href))
        parts = urlsplit(url)
    except ValueError:
        return ""
    if not parts.netloc:
        return url
    path = parts.path or "/"
    url = f"{parts.scheme}://{parts.netloc.lower()}{path}" + (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else "")
    return "".join(c if " " < c < "\x7f" and c not in '"<>`' else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def resolve_url(base: str, href: str) -> str:
    """Absolute URL by text alone: nothing is encoded, ``.`` and ``..`` are taken out."""
    if re.match(r"[a-zA-Z][\w+.\-]*:", href):
        return href
    m = re.match(r"([a-zA-Z][\w+.\-]*):(//[^/?#]*)?([^?#]*)", base)
    if not m:
        return href
    scheme, origin = m[1], m[2] or ""
    if href.startswith("//"):
        return f"{scheme}:{href}"
    if href.startswith(("?", "#")):
        return base.partition("#")[0].partition("?")[0] + href if href[0] == "?" else base.partition("#")[0] + href
    path = href if href.startswith("/") else (m[3] or "/").rpartition("/")[0] + "/" + href
    p, mark, rest = re.match(r"([^?#]*)([?#]?)(.*)", path, re.S).groups()  # type: ignore[union-attr]
    return f"{scheme}:{origin}{normalise_path(p)}{mark}{rest}"


def normalise_path(path: str) -> str:
    out: list[str] = []
    parts = path.split("/")
    for i, s in enumerate(parts):
        last = i == len(parts) - 1
        if s == "..":
            if len(out) > 1:
                out.pop()
            if last:
                out.append("")
        elif s == ".":
            if last:
                out.append("")
        else:
            out.append(s)
    s = "/".join(out)
    return s if s.startswith("/") or not path.startswith("/") else "/" + s


def is_script(text: str) -> bool:
    try:
        tokens(text)
    except ScriptError:
        return False
    return True
