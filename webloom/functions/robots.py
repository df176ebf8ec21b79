"""robots.txt: rules, delays and sitemaps, in Python and as Spark columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .html import row_udf


@dataclass
class Rules:
    agents: list[str]
    rules: list[tuple[bool, str]] = field(default_factory=list)
    crawl_delay: float | None = None
    request_delay: float | None = None

    @property
    def delay(self) -> float | None:
        known = [d for d in (self.crawl_delay, self.request_delay) if d is not None]
        return max(known) if known else None


@dataclass
class Robots:
    groups: list[Rules]
    sitemaps: list[str]


def _lines(text: str) -> list[tuple[str, str]]:
    out = []
    for line in re.split(r"\r\n|\r|\n", text.lstrip("﻿")):
        name, colon, value = line.partition("#")[0].partition(":")
        if colon:
            out.append((name.strip().lower(), value.strip()))
    return out


@lru_cache(256)
def parse_robots(text: str, shared_groups: bool = True) -> Robots:
    """Groups of rules and the sitemaps. With ``shared_groups`` User-agent lines that
    follow each other share their rules, as RFC 9309 says; without, every such line
    starts a set of its own."""
    groups: list[Rules] = []
    sitemaps: list[str] = []
    open_for_agents = False
    for name, value in _lines(text):
        if name == "user-agent":
            if shared_groups and open_for_agents:
                groups[-1].agents.append(value.lower())
            else:
                groups.append(Rules([value.lower()]))
            open_for_agents = True
            continue
        if name == "sitemap":
            if value:
                sitemaps.append(value)
            continue
        if not groups:
            continue
        if name in ("allow", "disallow"):
            if value:
                groups[-1].rules.append((name == "allow", value))
        elif name == "crawl-delay":
            try:
                d = float(value)
                if d >= 0:
                    groups[-1].crawl_delay = d
            except ValueError:
                pass
        elif name == "request-rate":
            m = re.match(r"(\d+)\s*/\s*(\d+)", value)
            if m and int(m[1]):
                groups[-1].request_delay = int(m[2]) / int(m[1])
        open_for_agents = False
    return Robots(groups, sitemaps)


def rules_for(robots: Robots, agent: str) -> Rules | None:
    """The agent's own group, else one whose name begins the agent's, else ``*``."""
    low = agent.lower()
    product = re.split(r"[/\s]", low)[0]
    for test in (lambda a: a in (low, product), lambda a: a not in ("*", "") and (low.startswith(a) or product.startswith(a)), lambda a: a == "*"):
        mine = [g for g in robots.groups if any(test(a) for a in g.agents)]
        if mine:
            best = max((max(len(a) for a in g.agents if test(a)) for g in mine))
            same = [g for g in mine if max(len(a) for a in g.agents if test(a)) == best]
            whole = Rules(same[0].agents, [r for g in same for r in g.rules])
            for g in same:
                whole.crawl_delay = g.crawl_delay if whole.crawl_delay is None else whole.crawl_delay
                whole.request_delay = g.request_delay if whole.request_delay is None else whole.request_delay
            return whole
    return None


@lru_cache(4096)
def _pattern(rule: str) -> re.Pattern:
    end = rule.endswith("$")
    return re.compile(".*".join(re.escape(p) for p in (rule[:-1] if end else rule).split("*")) + ("$" if end else ""), re.S)


def allowed(text: str, agent: str, url_path: str, prefix_only: bool = False) -> bool:
    """Whether ``agent`` may fetch the path. The longest matching rule decides, Allow on a
    tie. With ``prefix_only`` rules are plain prefixes and any matching Allow wins."""
    group = rules_for(parse_robots(text, not prefix_only), agent)
    if group is None or url_path.partition("?")[0] == "/robots.txt":
        return True
    if prefix_only:
        hits = [ok for ok, rule in group.rules if url_path.startswith(rule)]
        return any(hits) or not hits
    hits = [(len(rule), ok) for ok, rule in group.rules if _pattern(rule).match(url_path)]
    return max(hits)[1] if hits else True


def crawl_delay(text: str, agent: str) -> float | None:
    """The delay of the first section for ``*`` or for a part of the agent's name; else
    the first delay anywhere."""
    first, mine, inside = None, None, False
    for name, value in _lines(text):
        if name == "user-agent":
            inside = value == "*" or value.lower() in agent.lower() and value != ""
        elif name == "crawl-delay":
            try:
                d = float(value)
            except ValueError:
                continue
            first = d if first is None else first
            mine = d if inside and mine is None else mine
    return first if mine is None else mine


def effective_delay(text: str, agent: str) -> float | None:
    g = rules_for(parse_robots(text), agent)
    return None if g is None else g.delay


def sitemaps_of(text: str) -> list[str]:
    return list(parse_robots(text).sitemaps)


def robots_allowed(text: Column, agent: Column, path: Column) -> Column:
    """Null where robots.txt is null; callers take that as allowed."""
    return row_udf(allowed, T.BooleanType())(text, agent, path)


def robots_delay(text: Column, agent: Column) -> Column:
    return row_udf(crawl_delay, T.DoubleType())(text, agent)


def robots_sitemaps(text: Column) -> Column:
    return row_udf(sitemaps_of, T.ArrayType(T.StringType()))(text)


def sitemap_lines(text: Column) -> Column:
    """The same by built-in functions alone."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?im)^[ \t]*sitemap[ \t]*:[ \t]*([^\s#]+)"), 1), lambda x: F.trim(x))
