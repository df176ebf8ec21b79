"""Top-level JavaScript variables with literal values.

A script counts as a whole: unbalanced brackets or an unterminated string, comment or
template make it void. This is a check of tokens, not of the full grammar.
"""

from __future__ import annotations

import json
import re
from typing import Any

_SPACE = re.compile(r"(?:[\s\ufeff]+|//[^\n\r]*|/\*.*?\*/|<!--[^\n]*)+", re.S)
_NAME = re.compile(r"[A-Za-z_$\u0080-\U0010ffff][\w$\u0080-\U0010ffff]*")
_NUMBER = re.compile(r"0[xX][0-9a-fA-F_]+|0[oO][0-7_]+|0[bB][01_]+|(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?n?")
_STRING = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'""", re.S)
_REGEX = re.compile(r"/(?![*/])(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*")
_PUNCT = re.compile(r">>>=|\.\.\.|===|!==|\*\*=|<<=|>>=|>>>|&&=|\|\|=|\?\?=|=>|==|!=|<=|>=|&&|\|\||\?\?|\?\.|\+\+|--|\+=|-=|\*=|/=|%=|&=|\|=|\^=|<<|>>|\*\*|[{}()\[\];,<>+\-*/%&|^!~?:=.@#]")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}
_ESCAPE = re.compile(r"\\(?:x([0-9a-fA-F]{2})|u\{([0-9a-fA-F]+)\}|u([0-9a-fA-F]{4})|(\r\n|.))", re.S)
_PAIRS = {")": "(", "]": "[", "}": "{"}
#: What ``include_window`` takes variables from.
WINDOWS = ("window", "globalThis", "self")
_BEFORE_REGEX = frozenset("return typeof case in of delete void throw new else do instanceof".split())


class ScriptError(ValueError):
    pass


class _None:
    """An expression that isn't a literal."""


NONE = _None()


def _string(body: str) -> str:
    if "\\" not in body:
        return body

    def one(m: re.Match) -> str:
        if m[1] or m[2] or m[3]:
            return chr(int(m[1] or m[2] or m[3], 16))
        return "" if m[4] in ("\n", "\r", "\r\n") else _ESCAPES.get(m[4], m[4])

    s = _ESCAPE.sub(one, body)
    return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _template(s: str, at: int) -> int:
    """End of the template literal that starts at ``at``."""
    i = at + 1
    while i < len(s):
        if s[i] == "\\":
            i += 2
        elif s[i] == "`":
            return i + 1
        elif s.startswith("${", i):
            depth, i = 1, i + 2
            while i < len(s) and depth:
                if s[i] == "`":
                    i = _template(s, i) - 1
                elif s[i] in "\"'":
                    m = _STRING.match(s, i)
                    if not m:
                        raise ScriptError("string")
                    i = m.end() - 1
                depth += (s[i] == "{") - (s[i] == "}")
                i += 1
        else:
            i += 1
    raise ScriptError("template")


_TOKEN = re.compile(f"({_SPACE.pattern})|({_NAME.pattern})|({_NUMBER.pattern})|({_STRING.pattern.replace('((?:', '(?:(?:')})|({_PUNCT.pattern})", re.S)


def tokens(s: str) -> list[tuple[str, Any, bool]]:
    """(kind, value, newline before) of the whole script; raises ``ScriptError``."""
    out: list[tuple[str, Any, bool]] = []
    stack: list[str] = []
    i, newline, n, token_at = 0, False, len(s), _TOKEN.match
    while i < n:
        m = token_at(s, i)
        if m is None:
            if s[i] != "`":
                raise ScriptError(s[i])
            to = _template(s, i)
            body = s[i + 1 : to - 1]
            out.append(("template", NONE if "${" in body else _string(body), newline))
            i, newline = to, False
            continue
        kind, t = m.lastindex, m[0]
        if kind == 1:
            newline = newline or "\n" in t or "\r" in t
            i = m.end()
            continue
        if kind == 2:
            out.append(("name", t, newline))
        elif kind == 3:
            out.append(("number", t, newline))
        elif kind == 4:
            out.append(("string", _string(t[1:-1]), newline))
        else:
            if t[0] == "/":
                last = out[-1] if out else ("punct", ";", False)
                regex = _REGEX.match(s, i) if last[0] == "punct" and last[1] not in _PAIRS or last[0] == "name" and last[1] in _BEFORE_REGEX else None
                if regex:
                    out.append(("regex", regex[0], newline))
                    i, newline = regex.end(), False
                    continue
                if s.startswith("/*", i):
                    raise ScriptError("/*")
            elif t in "([{":
                stack.append(t)
            elif t in _PAIRS and (not stack or stack.pop() != _PAIRS[t]):
                raise ScriptError("brackets")
            out.append(("punct", t, newline))
        i, newline = m.end(), False
    if stack:
        raise ScriptError("brackets")
    return out


def _number(t: str) -> int | float:
    t = t.replace("_", "").rstrip("n")
    if t[:2].lower() in ("0x", "0o", "0b"):
        return int(t, 0)
    v = float(t)
    return int(v) if v.is_integer() and abs(v) < 1 << 63 else v


_END = ("end", None, True)


class _Reader:
    def __init__(self, toks: list[tuple[str, Any, bool]]):
        self.t, self.i, self.n = toks, 0, len(toks)

    def peek(self, k: int = 0) -> tuple[str, Any, bool]:
        k += self.i
        return self.t[k] if k < self.n else _END

    def skip_expression(self, stop: tuple[str, ...]) -> None:
        """Up to a stop sign at this depth."""
        depth = 0
        while (tok := self.peek())[0] != "end":
            if tok[0] == "punct":
                if not depth and tok[1] in stop:
                    return
                depth += (tok[1] in "([{") - (tok[1] in ")]}")
                if depth < 0:
                    return
            self.i += 1

    def literal(self, stop: tuple[str, ...]) -> Any:
        """The value if the whole expression up to a stop sign is a literal, else NONE."""
        at = self.i
        v = self.primary()
        tok = self.peek()
        if v is not NONE and (tok[0] == "end" or tok[0] == "punct" and tok[1] in stop or tok[2] and tok[0] != "punct"):
            return v
        self.i = at
        self.skip_expression(stop)
        return NONE

    def primary(self) -> Any:
        kind, value, _ = self.peek()
        self.i += 1
        if kind in ("string", "template"):
            return value
        if kind == "number":
            return _number(value)
        if kind == "name":
            if value in ("true", "false", "null"):
                return {"true": True, "false": False, "null": None}[value]
            if value == "JSON" and [x[:2] for x in (self.peek(), self.peek(1), self.peek(2))] == [("punct", "."), ("name", "parse"), ("punct", "(")]:
                arg, close = self.peek(3), self.peek(4)
                if arg[0] in ("string", "template") and arg[1] is not NONE and close[:2] == ("punct", ")"):
                    self.i += 5
                    try:
                        return json.loads(arg[1])
                    except ValueError:
                        return NONE
            return NONE
        if (kind, value) == ("punct", "-") and self.peek()[0] == "number":
            self.i += 1
            return -_number(self.t[self.i - 1][1])
        if (kind, value) == ("punct", "["):
            return self.array()
        if (kind, value) == ("punct", "{"):
            return self.object()
        return NONE

    def array(self) -> Any:
        out: list[Any] = []
        while True:
            tok = self.peek()
            if tok[:2] == ("punct", "]"):
                self.i += 1
                return out
            if tok[:2] == ("punct", ","):
                out.append(None)
                self.i += 1
                continue
            if tok[:2] == ("punct", "..."):
                self.skip_expression((",", "]"))
            else:
                v = self.literal((",", "]"))
                out.append(None if v is NONE else v)
            if self.peek()[:2] == ("punct", ","):
                self.i += 1

    def object(self) -> Any:
        out: dict[str, Any] | _None = {}
        while True:
            kind, value, _ = self.peek()
            if (kind, value) == ("punct", "}"):
                self.i += 1
                return out
            if (kind, value) == ("punct", ","):
                self.i += 1
                continue
            after = self.peek(1)
            if kind in ("name", "string", "number") and after[:2] == ("punct", ":"):
                self.i += 2
                v = self.literal((",", "}"))
                if v is NONE or out is NONE:
                    out = NONE
                else:
                    out[str(_number(value)) if kind == "number" else value] = v  # type: ignore[index]
            elif (kind, value) == ("punct", "...") or kind == "name" and after[:2] in (("punct", ","), ("punct", "}")):
                self.skip_expression((",", "}"))
            else:
                out = NONE
                self.skip_expression((",", "}"))


def js_variables(script: str, include_window: bool = False) -> dict[str, Any]:
    """Variables that the script sets at top level to a literal; a later one wins. With
    ``include_window`` also ``window.x = literal``."""
    try:
        return read_variables(tokens(script), include_window)
    except ScriptError:
        return {}


def read_variables(toks: list[tuple[str, Any, bool]], include_window: bool = False) -> dict[str, Any]:
    """The same of a script's tokens."""
    out: dict[str, Any] = {}
    r, fresh = _Reader(toks), True
    while (tok := r.peek())[0] != "end":
        kind, value, newline = tok
        fresh = fresh or newline
        if fresh and kind == "name" and value in ("var", "let", "const"):
            r.i += 1
            while r.peek()[0] == "name":
                name = r.peek()[1]
                r.i += 1
                if r.peek()[:2] == ("punct", "="):
                    r.i += 1
                    v = r.literal((",", ";"))
                    if v is not NONE:
                        out[name] = v
                if r.peek()[:2] == ("punct", ","):
                    r.i += 1
                else:
                    break
            if r.peek()[0] == "punct" and r.peek()[1] in ("{", "["):
                r.skip_expression((";",))
            fresh = True
            continue
        if fresh and kind == "name":
            window = include_window and value in WINDOWS and r.peek(1)[:2] == ("punct", ".") and r.peek(2)[0] == "name"
            at = 2 if window else 0
            if r.peek(at + 1)[:2] == ("punct", "="):
                name = r.peek(at)[1]
                r.i += at + 2
                v = r.literal((";",))
                if v is not NONE:
                    out[name] = v
                fresh = True
                continue
        fresh = (kind, value) in (("punct", ";"), ("punct", "}"))
        if kind == "punct" and value in "([{":
            depth = 1
            r.i += 1
            while depth and r.peek()[0] != "end":
                t = r.peek()
                if t[0] == "punct":
                    depth += (t[1] in "([{") - (t[1] in ")]}")
                r.i += 1
            fresh = value == "{"
            continue
        r.i += 1
    return out
