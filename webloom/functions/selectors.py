"""CSS selectors over the tree of ``dom``: compounds, groups, the four combinators,
attribute operators and structural pseudo-classes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

from .dom import Element

Test = Callable[[Element], bool]


class SelectorError(ValueError):
    pass


_IDENT = re.compile(r"-?(?:[_a-zA-Z\u0080-\U0010ffff]|\\.)(?:[\w\-\u0080-\U0010ffff]|\\.)*|--[\w\-]*")
_ATTR = re.compile(r"""\[\s*([\w\-:|\\.\u0080-\U0010ffff]+?)\s*(?:([~|^$*]?=)\s*(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)'|([^\s\]"']+))\s*([iIsS])?\s*)?\]""")
_NTH = re.compile(r"\s*(?:(even|odd)|([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))\s*$", re.I)


def _unescape(s: str) -> str:
    return re.sub(r"\\(.)", r"\1", s)


def _siblings(e: Element) -> list[Element]:
    return e.parent.elements() if e.parent is not None else [e]


def _nth(arg: str, of_type: bool, last: bool) -> Test:
    m = _NTH.match(arg)
    if not m:
        raise SelectorError(arg)
    if m[1]:
        a, b = 2, int(m[1].lower() == "odd")
    elif m[5]:
        a, b = 0, int(m[5])
    else:
        a = int(m[2] + "1") if m[2] in ("", "+", "-") else int(m[2])
        b = int(m[3] + m[4]) if m[4] else 0

    def test(e: Element) -> bool:
        s = [x for x in _siblings(e) if not of_type or x.tag == e.tag]
        i = next(k for k, x in enumerate(reversed(s) if last else s) if x is e) + 1
        return i == b if a == 0 else (i - b) % a == 0 and (i - b) // a >= 0

    return test


def _attribute(m: re.Match) -> Test:
    name, op = _unescape(m[1]).lower(), m[2]
    if op is None:
        return lambda e: name in e.attrs
    want = _unescape(next(v for v in (m[3], m[4], m[5]) if v is not None))
    fold = (m[6] or "").lower() == "i"
    want = want.lower() if fold else want

    def got(e: Element) -> str | None:
        v = e.attrs.get(name)
        return v.lower() if fold and v is not None else v

    tests: dict[str, Callable[[str], bool]] = {
        "=": lambda v: v == want,
        "~=": lambda v: bool(want) and not re.search(r"\s", want) and want in v.split(),
        "|=": lambda v: v == want or v.startswith(want + "-"),
        "^=": lambda v: bool(want) and v.startswith(want),
        "$=": lambda v: bool(want) and v.endswith(want),
        "*=": lambda v: bool(want) and want in v,
    }
    check = tests[op]
    return lambda e: (v := got(e)) is not None and check(v)


class _Parser:
    def __init__(self, text: str):
        self.s, self.i = text, 0

    def skip(self) -> bool:
        at = self.i
        while self.i < len(self.s) and self.s[self.i] in " \t\r\n\f":
            self.i += 1
        return self.i > at

    def argument(self) -> str:
        depth, at, quote = 1, self.i, ""
        while self.i < len(self.s):
            c = self.s[self.i]
            if quote:
                quote = "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == "(":
                depth += 1
            elif c == ")":
                depth -= 1
                if not depth:
                    self.i += 1
                    return self.s[at : self.i - 1]
            self.i += 1
        raise SelectorError("unclosed (")

    def ident(self) -> str:
        m = _IDENT.match(self.s, self.i)
        if not m:
            raise SelectorError(self.s)
        self.i = m.end()
        return _unescape(m[0])

    def pseudo(self) -> Test:
        name = self.ident().lower()
        arg = None
        if self.s[self.i : self.i + 1] == "(":
            self.i += 1
            arg = self.argument()
        simple: dict[str, Test] = {
            "first-child": _nth("1", False, False),
            "last-child": _nth("1", False, True),
            "first-of-type": _nth("1", True, False),
            "last-of-type": _nth("1", True, True),
            "only-child": lambda e: len(_siblings(e)) == 1,
            "only-of-type": lambda e: sum(x.tag == e.tag for x in _siblings(e)) == 1,
            "empty": lambda e: not e.children,
            "root": lambda e: e.tag == "html" and e.parent is not None and e.parent.tag == "#document",
        }
        if arg is None:
            if name not in simple:
                raise SelectorError(f":{name}")
            return simple[name]
        nth = {"nth-child": (False, False), "nth-last-child": (False, True), "nth-of-type": (True, False), "nth-last-of-type": (True, True)}
        if name in nth:
            return _nth(arg, *nth[name])
        if name in ("not", "is", "where", "matches"):
            inner = compile_selector(arg)
            return (lambda e: not inner.matches(e)) if name == "not" else inner.matches
        if name == "has":
            child = arg.lstrip().startswith(">")
            inner = compile_selector(arg.lstrip().lstrip(">"))
            return lambda e: any(inner.matches(d) for d in (e.elements() if child else e.walk()))
        raise SelectorError(f":{name}()")

    def compound(self) -> tuple[str | None, list[Test]]:
        tag, tests, at = None, [], self.i
        if self.s[self.i : self.i + 1] == "*":
            self.i += 1
        elif _IDENT.match(self.s, self.i):
            tag = self.ident().lower()
        while self.i < len(self.s):
            c = self.s[self.i]
            if c == ".":
                self.i += 1
                name = self.ident()
                tests.append(lambda e, n=name: n in e.attrs.get("class", "").split())
            elif c == "#":
                self.i += 1
                m = re.compile(r"(?:[\w\-\u0080-\U0010ffff]|\\.)+").match(self.s, self.i)
                if not m:
                    raise SelectorError(self.s)
                self.i = m.end()
                tests.append(lambda e, n=_unescape(m[0]): e.attrs.get("id") == n)
            elif c == "[":
                m = _ATTR.match(self.s, self.i)
                if not m:
                    raise SelectorError(self.s)
                self.i = m.end()
                tests.append(_attribute(m))
            elif c == ":":
                self.i += 1
                tests.append(self.pseudo())
            else:
                break
        if self.i == at:
            raise SelectorError(self.s)
        return tag, tests

    def complex(self) -> list[tuple[str, str | None, list[Test]]]:
        self.skip()
        out = [("", *self.compound())]
        while True:
            space = self.skip()
            c = self.s[self.i : self.i + 1]
            if c in ("", ","):
                return out
            if c in ">+~":
                self.i += 1
                self.skip()
            elif space:
                c = " "
            else:
                raise SelectorError(self.s)
            out.append((c, *self.compound()))


class Selector:
    def __init__(self, text: str):
        p = _Parser(text)
        self.groups = [p.complex()]
        while p.i < len(p.s):
            p.i += 1
            self.groups.append(p.complex())

    def matches(self, e: Element) -> bool:
        return any(_match(g, len(g) - 1, e) for g in self.groups)

    def select(self, root: Element) -> Iterator[Element]:
        """Matching descendants of ``root`` in document order."""
        return self.among(root.walk())

    def among(self, elements: Iterable[Element]) -> Iterator[Element]:
        if len(self.groups) > 1:
            return (e for e in elements if self.matches(e))
        g = self.groups[0]
        (_, tag, tests), k = g[-1], len(g) - 1
        if k == 0 and len(tests) == 1 and tag is None:
            return filter(tests[0], elements)
        if k == 0 and not tests:
            return (e for e in elements if tag is None or e.tag == tag)
        return (e for e in elements if (tag is None or e.tag == tag) and _match(g, k, e))

    @property
    def tag(self) -> str | None:
        """The one tag that all matches have, if the selector names it."""
        return self.groups[0][-1][1] if len(self.groups) == 1 else None

    def first(self, root: Element) -> Element | None:
        return next(iter(self.select(root)), None)


def _match(g: list[tuple[str, str | None, list[Test]]], k: int, e: Element) -> bool:
    combinator, tag, tests = g[k]
    if tag is not None and e.tag != tag:
        return False
    for t in tests:
        if not t(e):
            return False
    if not combinator:
        return True
    if combinator in " >":
        up = e.parent
        while up is not None and up.tag != "#document":
            if _match(g, k - 1, up):
                return True
            if combinator == ">":
                return False
            up = up.parent
        return False
    s = _siblings(e)
    i = next(j for j, x in enumerate(s) if x is e)
    before = s[i - 1 : i] if combinator == "+" and i else s[:i] if combinator == "~" else []
    return any(_match(g, k - 1, x) for x in before)


@lru_cache(4096)
def compile_selector(text: str) -> Selector:
    """Raises ``SelectorError`` if the text isn't a selector."""
    if not text.strip():
        raise SelectorError("empty selector")
    return Selector(text)
