"""URL scalars as expressions of built-in functions: nothing leaves the JVM.

Null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def domain(url: Column | str) -> Column:
    """What stands between ``://`` and the next ``/``, without the port; case is kept and
    ``''`` stands for a URL without scheme."""
    return F.regexp_extract(_col(url), r"^[^/]*?://([^/:]*)", 1)


def host(url: Column | str) -> Column:
    """Lower-case host; also ends at ``?`` and ``#``."""
    return F.lower(F.regexp_extract(_col(url), r"^[^/]*?://([^/:?#]*)", 1))


def path(url: Column | str) -> Column:
    """From the first ``/`` after the host on, with query and fragment; else ``/``."""
    p = F.regexp_extract(_col(url), r"^[^/]*?://[^/]*(/.*)$", 1)
    return F.when(_col(url).isNull(), None).otherwise(F.when(p == "", "/").otherwise(p))


def bare_path(url: Column | str) -> Column:
    """The path without query and fragment."""
    p = F.regexp_extract(_col(url), r"^[^/]*?://[^/?#]*(/[^?#]*)", 1)
    return F.when(_col(url).isNull(), None).otherwise(F.when(p == "", "/").otherwise(p))


def query_parameter(url: Column | str, name: str) -> Column:
    """Raw value of a query parameter; null if it is absent."""
    q = F.regexp_extract(_col(url), r"\?([^#]*)", 1)
    hit = F.regexp_extract(q, rf"(?:^|&)({name}=[^&]*)", 1)
    return F.when(hit != "", F.substring_index(F.concat(hit, F.lit("")), "=", -1)) if "=" not in name else F.lit(None).cast("string")


def _surt_host(url: Column) -> Column:
    h = F.regexp_replace(F.regexp_extract(F.lower(url), r"^[^/]*?://([^/:]*)", 1), r"^www\.", "")
    return F.array_join(F.reverse(F.split(h, r"\.")), ",")


def surt(url: Column | str) -> Column:
    """Sort key: host labels reversed, ``)``, path. Without ``://`` the URL itself."""
    u = _col(url)
    return F.when(~F.contains(u, F.lit("://")), u).otherwise(F.concat(_surt_host(u), F.lit(")"), path(u)))


def surt_domain(url: Column | str) -> Column:
    u = _col(url)
    return F.when(~F.contains(u, F.lit("://")), u).otherwise(F.concat(_surt_host(u), F.lit(")")))


def url_problem(url: Column | str, longest: int = 8192) -> Column:
    """Why a URL can't be fetched: empty, too_long, scheme, host, control_character; null
    for a good one."""
    u = _col(url)
    h = F.regexp_extract(u, r"^[^/]*?://([^/?#]*)", 1)
    return (
        F.when(u.isNull() | (u == ""), "empty")
        .when(F.length(u) > longest, "too_long")
        .when(~F.lower(u).rlike(r"^https?://"), "scheme")
        .when(F.regexp_replace(h, r":\d*$", "") == "", "host")
        .when(h.rlike(r"[\x00-\x20\x7f]"), "control_character")
    )


def content_hash(body: Column | str) -> Column:
    return F.sha2(_col(body), 256)


def same_domain(a: Column | str, b: Column | str, subdomains: bool = False) -> Column:
    """Equal hosts but for ``www.``; with ``subdomains`` one may lie below the other."""
    x, y = (F.regexp_replace(host(c), r"^www\.", "") for c in (a, b))
    same = (x == y) & (x != "")
    return same | ((x != "") & (y != "") & (F.endswith(x, F.concat(F.lit("."), y)) | F.endswith(y, F.concat(F.lit("."), x)))) if subdomains else same
