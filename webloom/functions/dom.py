"""A small HTML tree: tokenizer, tree builder, serializer.

It follows the parts of the HTML standard that shape ordinary pages: implied html, head,
body and tbody, void and raw-text elements, and the elements that close others (p, li, dd,
dt, option, tr, td, th, table sections, headings, a). The adoption agency and foster
parenting are left out: misnested formatting stays where it stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "xmp", "iframe", "noembed", "noframes"))
ESCAPABLE_RAW = frozenset(("title", "textarea"))
HEAD = frozenset("base link meta script style title template noscript".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SCOPE = frozenset("html table td th caption template button marquee object applet".split())
SECTIONS = frozenset(("tbody", "thead", "tfoot"))
#: A tag; whole, if all its attributes have values in double quotes, else up to its name.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)(?:((?:\s+[^\s/>=]+="[^"]*")*)\s*>)?""")
_QUOTED = re.compile(r"""\s+([^\s/>=]+)="([^"]*)\"""")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


_P, _LI, _DD, _A, _TR, _TD, _TABLE = (frozenset(t.split()) for t in ("p", "li", "dd dt", "a", "tr", "td th", "table"))
_LIST_SCOPE, _DD_SCOPE, _A_SCOPE = SCOPE | {"ul", "ol", "menu", "dir"}, SCOPE | {"dl"}, SCOPE | {"div", "p", "li", "article", "section"}
_TABLE_SCOPE, _ROW_SCOPE, _TOP_SCOPE = frozenset(("table", "html", "template")), frozenset(("tr", "table", "html", "template")), frozenset(("html", "template"))
_BETWEEN, _CAPTIONS = SECTIONS | {"caption", "colgroup"}, frozenset(("caption", "colgroup"))
_IN_TABLE = frozenset(("tr", "td", "th", "caption")) | SECTIONS
#: Tags that ``start`` has more to do for than to add an element.
_SPECIAL = CLOSES_P | SECTIONS | frozenset("html head body li dd dt option optgroup a caption colgroup tr td th".split())
_CLOSED = frozenset(("svg", "path", "circle", "rect", "line", "use", "g"))
_OPENS = frozenset(("html", "head", "body"))
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW | ESCAPABLE_RAW}


class Element:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Element | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Element | str] = []

    def add(self, child: Element | str) -> None:
        if isinstance(child, str):
            if self.children and isinstance(self.children[-1], str):
                self.children[-1] += child
                return
        else:
            child.parent = self
        self.children.append(child)

    def elements(self) -> list[Element]:
        return [c for c in self.children if not isinstance(c, str)]

    def walk(self) -> Iterator[Element]:
        """Descendant elements in document order."""
        todo = self.children[::-1]
        while todo:
            e = todo.pop()
            if not isinstance(e, str):
                yield e
                todo += e.children[::-1]

    def text(self) -> str:
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children[0]
        out: list[str] = []
        todo = self.children[::-1]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                todo += n.children[::-1]
        return "".join(out)

    def inner_html(self) -> str:
        out: list[str] = []
        _serialize(self, out)
        return "".join(out)

    def outer_html(self) -> str:
        out: list[str] = []
        _open(self, out)
        if self.tag not in VOID:
            _serialize(self, out)
            out.append(f"</{self.tag}>")
        return "".join(out)

    def closest(self, *tags: str) -> Element | None:
        e = self.parent
        while e is not None and e.tag not in tags:
            e = e.parent
        return e


def _open(e: Element, out: list[str]) -> None:
    if not e.attrs:
        out.append(f"<{e.tag}>")
        return
    out.append("<" + e.tag)
    for k, v in e.attrs.items():
        quoted = v.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace('"', "&quot;")
        out.append(f' {k}="{quoted}"')
    out.append(">")


def _escaped(s: str) -> str:
    return s.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace("<", "&lt;").replace(">", "&gt;")


def _inside(e: Element) -> list[Element | str | tuple[str]]:
    """Its children from the last to the first; a text that stands as it is, in a tuple."""
    if e.tag in RAW:
        return [(c,) if isinstance(c, str) else c for c in reversed(e.children)]
    return e.children[::-1]  # type: ignore[return-value]


def _serialize(root: Element, out: list[str]) -> None:
    todo = _inside(root)
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(_escaped(n))
        elif isinstance(n, tuple):
            out.append(n[0])
        else:
            _open(n, out)
            if n.tag in VOID:
                continue
            kids = n.children
            if len(kids) == 1 and isinstance(kids[0], str):
                out.append(kids[0] if n.tag in RAW else _escaped(kids[0]))
            elif kids:
                todo.append((f"</{n.tag}>",))
                todo += _inside(n)
                continue
            out.append(f"</{n.tag}>")


class _Builder:
    def __init__(self) -> None:
        self.root = Element("#document")
        #: Elements in the order they are made, which is the document's: each is the last
        #: child of an element that is open.
        self.made: list[Element] = []
        self.html = self.child(self.root, "html")
        self.head = self.child(self.html, "head")
        self.body: Element | None = None
        self.stack: list[Element] = [self.html, self.head]

    def child(self, parent: Element, tag: str, attrs: dict[str, str] | None = None) -> Element:
        e = Element(tag, attrs, parent)
        parent.children.append(e)
        self.made.append(e)
        return e

    def to_body(self) -> None:
        if self.body is None:
            self.body = self.child(self.html, "body")
            self.stack = [self.html, self.body]

    def text(self, s: str) -> None:
        if not s:
            return
        if self.body is None and self.stack[-1] is self.head:
            if not s.strip():
                return
            self.to_body()
        last = self.stack[-1].children
        if last and isinstance(last[-1], str):
            last[-1] += s
        else:
            last.append(s)

    def pop_to(self, names: frozenset[str], stop: frozenset[str] = SCOPE) -> bool:
        stack = self.stack
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in names:
                if stack[i] is not self.body and stack[i] is not self.head:
                    del stack[i:]
                return True
            if tag in stop:
                return False
        return False

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if self.body is None and tag not in HEAD and tag not in _OPENS and len(self.stack) == 2:
            self.to_body()
        if tag in _SPECIAL and not self.special(tag, attrs):
            return
        stack = self.stack
        e = Element(tag, attrs, stack[-1])
        stack[-1].children.append(e)
        self.made.append(e)
        if tag not in VOID and not (closed and tag in _CLOSED):
            stack.append(e)

    def special(self, tag: str, attrs: dict[str, str]) -> bool:
        """What a tag closes and opens before its element, and whether it gets one."""
        if tag == "html":
            for k, v in attrs.items():
                self.html.attrs.setdefault(k, v)
            return False
        if tag == "head":
            self.head.attrs |= attrs if self.body is None else {}
            return False
        if tag == "body":
            self.to_body()
            for k, v in attrs.items():
                self.body.attrs.setdefault(k, v)  # type: ignore[union-attr]
            return False
        if tag in CLOSES_P:
            self.pop_to(_P)
            if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
                self.stack.pop()
        if tag == "li":
            self.pop_to(_LI, _LIST_SCOPE)
            self.pop_to(_P)
        elif tag in _DD:
            self.pop_to(_DD, _DD_SCOPE)
            self.pop_to(_P)
        elif tag in ("option", "optgroup"):
            if self.stack[-1].tag == "option":
                self.stack.pop()
            if tag == "optgroup" and self.stack[-1].tag == "optgroup":
                self.stack.pop()
        elif tag == "a":
            self.pop_to(_A, _A_SCOPE)
        elif tag in _BETWEEN:
            self.pop_to(_BETWEEN, _TABLE_SCOPE)
        elif tag == "tr":
            self.pop_to(_TR, _TABLE_SCOPE)
            self.pop_to(_CAPTIONS, _TABLE_SCOPE)
            if self.stack[-1].tag == "table":
                self.push("tbody")
        elif tag in _TD:
            self.pop_to(_TD, _ROW_SCOPE)
            if self.stack[-1].tag == "table":
                self.push("tbody")
            if self.stack[-1].tag in SECTIONS:
                self.push("tr")
        return True

    def push(self, tag: str) -> None:
        self.stack.append(self.child(self.stack[-1], tag))

    def end(self, tag: str) -> None:
        if self.stack[-1].tag == tag and tag not in _OPENS:
            self.stack.pop()
            return
        if tag == "head":
            if self.body is None:
                self.stack = [self.html, self.head]
            return
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.start("br", {}, True)
        elif tag == "p":
            if not self.pop_to(_P):
                self.to_body()
                self.child(self.stack[-1], "p")
        elif tag in HEADINGS:
            self.pop_to(HEADINGS)
        elif tag in VOID:
            return
        elif tag == "table":
            self.pop_to(_TABLE, _TOP_SCOPE)
        elif tag in _IN_TABLE:
            self.pop_to(frozenset((tag,)), _TABLE_SCOPE)
        else:
            self.pop_to(frozenset((tag,)), SCOPE - {tag})


def parse(html: str) -> Element:
    """The document element's parent; always holds html > head, body."""
    return tree(html)[0]


def tree(html: str) -> tuple[Element, list[Element]]:
    """The same, and all elements below it in document order."""
    b = _Builder()
    find, at, n = html.find, 0, len(html)
    tag_at, attribute_at = _TAG.match, _ATTRIBUTE.match
    while at < n:
        lt = find("<", at)
        if lt < 0:
            b.text(unescape(html[at:]))
            break
        if lt > at:
            s = html[at:lt]
            b.text(unescape(s) if "&" in s else s)
        m = tag_at(html, lt)
        if not m:
            after = html[lt + 1 : lt + 2]
            if after == "!":
                if html.startswith("<!--", lt):
                    to = find("-->", lt + 4)
                    at = n if to < 0 else to + 3
                else:
                    to = find(">", lt)
                    at = n if to < 0 else to + 1
            elif after == "?" or after == "/":
                to = find(">", lt)
                at = n if to < 0 else to + 1
            else:
                b.text("<")
                at = lt + 1
            continue
        closing, tag, given = m.groups()
        tag, at, closed = tag.lower(), m.end(), False
        attrs: dict[str, str] = {}
        if given is not None:
            for name, value in _QUOTED.findall(given) if given else ():
                name = name.lower()
                if name not in attrs:
                    attrs[name] = unescape(value) if "&" in value else value
        else:
            while not html.startswith(">", at):
                a = attribute_at(html, at)
                if not a:
                    break
                at = a.end()
                name, double, single, plain = a.groups()
                value = double if double is not None else single if single is not None else plain or ""
                name = name.lower()
                if name not in attrs:
                    attrs[name] = unescape(value) if "&" in value else value
            end = find(">", at)
            closed = end > 0 and html[end - 1] == "/"
            at = n if end < 0 else end + 1
        if closing:
            b.end(tag)
            continue
        b.start(tag, attrs, closed)
        if tag in _RAW_END:
            close = _RAW_END[tag].search(html, at)
            to = close.start() if close else n
            raw = html[at:to]
            if raw:
                b.stack[-1].add(unescape(raw) if tag in ESCAPABLE_RAW else raw)
            if b.stack[-1].tag == tag:
                b.stack.pop()
            end = find(">", to)
            at = n if end < 0 else end + 1
    b.to_body()
    return b.root, b.made
