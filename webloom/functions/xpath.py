"""The part of XPath that pages are scraped with: steps by tag or ``*`` after ``/`` or ``//``,
tests in brackets (``@a``, ``@a="v"``, ``contains(@a | text(), "v")``, ``text()="v"``, a
position), and at the end an element, ``text()`` or ``@a``."""

from __future__ import annotations

import re
from functools import lru_cache

from .dom import Element

_STEP = re.compile(r"(//?)(?:(text\(\))|@([\w:-]+|\*)|([\w-]+|\*|\.\.|\.))((?:\[[^\[\]]*\])*)")
_TEST = re.compile(r"""(?:(contains|starts-with)\(\s*(@[\w:-]+|text\(\)|\.)\s*,\s*(?:"([^"]*)"|'([^']*)')\s*\)|(@[\w:-]+|text\(\)|\.)\s*=\s*(?:"([^"]*)"|'([^']*)')|@([\w:-]+)|(\d+)|last\(\))""")


class XPathError(ValueError):
    pass


@lru_cache(1024)
def steps_of(path: str) -> tuple:
    at, out = 0, []
    text = path.strip()
    while at < len(text):
        m = _STEP.match(text, at)
        if not m:
            raise XPathError(f"not a path: {path[:80]}")
        tests = []
        for part in re.findall(r"\[([^\[\]]*)\]", m[5]):
            one = []
            for t in re.split(r"\s+and\s+", part.strip()):
                x = _TEST.fullmatch(t.strip())
                if not x:
                    raise XPathError(f"not a test: {t[:80]}")
                one.append(x)
            tests.append(one)
        out.append((m[1] == "//", bool(m[2]), m[3], m[4], tuple(tests)))
        at = m.end()
    if not out or any(s[1] or s[2] for s in out[:-1]):
        raise XPathError(f"not a path: {path[:80]}")
    return tuple(out)


def _own_text(e: Element) -> str:
    return "".join(c for c in e.children if isinstance(c, str))


def _value(e: Element, what: str) -> str | None:
    return e.attrs.get(what[1:]) if what[0] == "@" else _own_text(e) if what == "text()" else e.text()


def _holds(e: Element, x: re.Match) -> bool:
    if x[1]:
        v, want = _value(e, x[2]), x[3] if x[3] is not None else x[4]
        return v is not None and (want in v if x[1] == "contains" else v.startswith(want))
    if x[5]:
        return _value(e, x[5]) == (x[6] if x[6] is not None else x[7])
    return x[8] in e.attrs


def _filtered(found: list[Element], tests: tuple) -> list[Element]:
    for one in tests:
        for x in one:
            if x[9]:
                found = found[int(x[9]) - 1 : int(x[9])] if int(x[9]) > 0 else []
            elif x[0].startswith("last"):
                found = found[-1:]
            else:
                found = [e for e in found if _holds(e, x)]
    return found


def select(root: Element, path: str) -> list[str | Element]:
    """The matches in document order: elements, texts or attribute values."""
    at: list[Element] = [root]
    for deep, text, attribute, tag, tests in steps_of(path):
        if text or attribute:
            # below // the nodes themselves come too
            nodes = at if not deep else [e for a in at for e in (a, *a.walk())]
            if text:
                return [t for e in nodes for t in (c for c in e.children if isinstance(c, str)) if t.strip()]
            return [v for e in nodes for v in (e.attrs.values() if attribute == "*" else [e.attrs[attribute]] if attribute in e.attrs else [])]
        new: dict[int, Element] = {}
        for e in at:
            if tag in (".", ".."):
                some = [e] if tag == "." else [e.parent] if e.parent is not None else []
                groups = [some]
            elif deep:
                # positions count among the children of one parent
                groups = [[c for c in a.elements() if tag == "*" or c.tag == tag] for a in (e, *e.walk())]
            else:
                groups = [[c for c in e.elements() if tag == "*" or c.tag == tag]]
            for g in groups:
                new |= {id(x): x for x in _filtered(g, tests)}
        at = list(new.values())
    order = {id(e): k for k, e in enumerate(root.walk())} if len(at) > 1 else {}
    return sorted(at, key=lambda e: order.get(id(e), -1))
