"""URL filter by empirical-Bayes host reputation.

Labelled outcomes of pages are counted by host, registered domain and public suffix. Each
level's rate is shrunk towards its parent's posterior mean by a beta-binomial prior whose
strength is estimated from that level's own overdispersion. A page stays if the lower
bound of its host's posterior reaches the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written

_SECOND = {
    "ar": "com net org gob edu int mil tur", "au": "com net org edu gov id asn", "br": "com net org gov edu art blog eco ind jus mil", "cn": "com net org gov edu ac mil", "co": "com net org gov edu mil nom",
    "es": "com org gob edu nom", "fr": "gouv asso com nom", "gr": "com edu net org gov", "hk": "com net org gov edu idv", "id": "co ac go or web sch net my", "il": "co org net ac gov muni k12",
    "in": "co net org gov ac edu firm gen ind res nic mil", "jp": "co ne or ac go ad ed gr lg", "kr": "co ne or go ac re pe hs ms es sc", "mx": "com org gob edu net", "my": "com net org gov edu mil name",
    "nz": "co net org govt ac school geek gen maori iwi mil cri", "pe": "com net org gob edu nom", "pl": "com net org gov edu info biz waw", "pt": "com org gov edu int nome", "sg": "com net org gov edu per",
    "th": "co ac go in or net mi", "tr": "com net org gov edu bel k12 av gen web biz info name tv", "tw": "com net org gov edu idv game club", "ua": "com net org gov edu kiev lviv", "uk": "co org ac gov ltd plc me net sch nhs police",
    "ve": "com net org gob edu co info web", "vn": "com net org gov edu ac info name", "za": "co org net gov ac web nom school law", "com": "blogspot wordpress appspot herokuapp azurewebsites myshopify weebly",
    "io": "github gitlab", "app": "vercel netlify web fly", "dev": "pages workers", "net": "cloudfront", "us": "ak al ar az ca co ct dc de fl ga hi ia id il in ks ky la ma md me mi mn mo ms mt nc nd ne nh nj nm nv ny oh ok or pa ri sc sd tn tx ut va vt wa wi wv wy",
}
#: Suffixes of more than one label under which names are registered, where no list is
#: given. Suffixes of one label need no entry.
SUFFIXES = tuple(f"{a}.{cc}" for cc, names in _SECOND.items() for a in names.split()) + ("s3.amazonaws.com", "k12.ca.us", "k12.tx.us", "k12.ny.us")
#: The greatest number of rules that a table of suffixes may have.
MOST_RULES = 50_000
#: By how much of it a host may fall short of the bound of an unknown one.
SLACK = 0.01


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, ``www.`` and trailing dot, an IPv6 address with
    its brackets; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[0-9a-f:.]+\]|[^/?#:@\[\]]+)", 1)
    host = F.regexp_replace(host, r"^www\.|\.$", "")
    return F.when(host != "", host)


def is_address(host: Column) -> Column:
    return host.startswith("[") | host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")


def rules_of(suffixes: Sequence[str] | DataFrame) -> list[str]:
    """The rules of a list, or of the first column of a table of ``MOST_RULES`` at most."""
    if isinstance(suffixes, DataFrame):
        rows = suffixes.select(F.lower(F.col(f"`{suffixes.columns[0]}`")).alias("s")).na.drop().distinct().limit(MOST_RULES + 1).collect()
        if len(rows) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} suffix rules")
        return sorted(r.s for r in rows)
    return list(suffixes)


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest matching rule, else the last label. ``*.x`` stands for any label below
    x and ``!y.x`` for an exception from it. An IP address stands for itself."""
    plain = {r for r in suffixes if r[:1] not in "*!" and "." in r}
    wild, but = ({r.lstrip("*!.") for r in suffixes if r[:1] == c} for c in "*!")
    last = lambda k: F.substring_index(host, ".", -k)
    out = F.when(is_address(host), host)
    for k in range(max((r.count(".") + 1 for r in suffixes), default=1), 1, -1):
        named = lambda rules, n: last(n).isin(*rules) if rules else F.lit(False)  # noqa: B023,E731
        out = out.when(named({r for r in but if r.count(".") == k - 1}, k), last(k - 1))
        out = out.when(named({r for r in plain if r.count(".") == k - 1}, k) | named({r for r in wild if r.count(".") == k - 2}, k - 1) & (last(k) != last(k - 1)), last(k))
    return out.otherwise(last(1))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Registered domain: the suffix and one label more; a bare suffix stands for itself."""
    suffix = suffix_of(host, suffixes)
    head = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(host == suffix, host).otherwise(F.concat_ws(".", F.substring_index(head, ".", -1), suffix))


def _strength(df: DataFrame, k: str, n: str, mu: str, alias: str) -> DataFrame:
    """One row: prior strength M of a level, by the moments of the beta-binomial."""
    v = F.col(mu) * (1 - F.col(mu))
    num = F.sum((F.col(k) - F.col(n) * F.col(mu)) ** 2 - F.col(n) * v)
    den = F.sum(F.col(n) * (F.col(n) - 1) * v)
    rho = F.least(F.lit(0.99), F.greatest(F.lit(0.001), F.coalesce(num / F.nullif(den, F.lit(0.0)), F.lit(0.001))))
    return df.agg((1 / rho - 1).alias(alias))


def _bound(a: Column, b: Column, z: float) -> Column:
    """Lower bound of a beta posterior."""
    return F.round(F.greatest(F.lit(0.0), a / (a + b) - z * F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))), 6)


def host_reputation(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id", outcome_col: str = "quality", z: float = 1.645, suffixes: Sequence[str] | DataFrame = SUFFIXES) -> DataFrame:
    """(host, domain, suffix, good, total, mean, bound, unknown), one row for each host of
    a page. ``unknown`` is the bound that a host would have of which, and of whose domain
    and suffix, nothing were known: that of the prior around the rate of all labels.

    ``good`` and ``total`` count labelled pages of the host by outcome 1 and by outcome 0
    or 1; other outcomes, null ids and labels without a page count nowhere, repeated rows
    count as often as they occur. Pages without a host are ignored. Where nothing is
    labelled, the mean is that of a uniform prior, 1/2. An IP address is its own domain and
    suffix. ``suffixes`` are rules as in the public suffix list, as a list or a table. An
    empty table of pages gives no rows.
    """
    rules = rules_of(suffixes)
    p = pick(pages, id=id_col, url=url_col).select("id", host_of(F.col("url")).alias("host")).where("host is not null")
    seen = pick(labels, id=label_id_col, y=outcome_col).where("y in (0, 1)")
    marked = p.join(seen, "id", "left")
    hosts = marked.groupBy("host").agg(F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0)).alias("k"), F.count("y").alias("n"))
    # every level below is made of this one table
    hosts = written(hosts.select("host", domain_of(F.col("host"), rules).alias("domain"), suffix_of(F.col("host"), rules).alias("suffix"), "k", "n"), "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("k").alias("dk"), F.sum("n").alias("dn"))
    sufs = domains.groupBy("suffix").agg(F.sum("dk").alias("sk"), F.sum("dn").alias("sn"))
    whole = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("mu0"))
    # the one-row tables are aggregates without keys: their size doesn't grow
    sufs = sufs.crossJoin(F.broadcast(whole))
    sufs = sufs.crossJoin(F.broadcast(_strength(sufs, "sk", "sn", "mu0", "m0")))
    sufs = written(sufs.select("suffix", ((F.col("m0") * F.col("mu0") + F.col("sk")) / (F.col("m0") + F.col("sn"))).alias("mu1")), "url-suffixes")
    domains = domains.join(sufs, "suffix")
    domains = domains.crossJoin(F.broadcast(_strength(domains, "dk", "dn", "mu1", "m1")))
    domains = written(domains.select("domain", ((F.col("m1") * F.col("mu1") + F.col("dk")) / (F.col("m1") + F.col("dn"))).alias("mu2")), "url-domains")
    hosts = hosts.join(domains, "domain")
    hosts = hosts.crossJoin(F.broadcast(_strength(hosts, "k", "n", "mu2", "m2"))).crossJoin(F.broadcast(whole))
    a, b = F.col("m2") * F.col("mu2") + F.col("k"), F.col("m2") * (1 - F.col("mu2")) + F.col("n") - F.col("k")
    unknown = _bound(F.col("m2") * F.col("mu0"), F.col("m2") * (1 - F.col("mu0")), z)
    return hosts.select("host", "domain", "suffix", F.col("k").alias("good"), F.col("n").alias("total"), F.round(a / (a + b), 6).alias("mean"), _bound(a, b, z).alias("bound"), unknown.alias("unknown"))


def reputable_pages(pages: DataFrame, labels: DataFrame, min_bound: float | None = None, slack: float = SLACK, id_col: str = "page_id", url_col: str = "url", **how) -> DataFrame:
    """(id, url, host, domain, suffix, mean, bound) of the pages whose host's posterior
    bound is at least ``min_bound``, or, without it, at least that of a host of which
    nothing is known, less a share of ``slack``: who is known to be worse than that goes,
    and who only seems so by a little chance stays. Pages without a host (null
    or malformed URL) go; repeated rows stay repeated; hosts that tie with the limit stay;
    other columns are ignored; an empty label table leaves the bound of the bare prior,
    and an empty table of pages gives no rows."""
    hosts = host_reputation(pages, labels, id_col, url_col, **how)
    hosts = hosts.where(F.col("bound") >= (F.col("unknown") * (1 - slack) if min_bound is None else F.lit(min_bound))).drop("unknown")
    p = pick(pages, id=id_col, url=url_col).withColumn("host", host_of(F.col("url"))).where("host is not null")
    return p.join(hosts, "host").select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "domain", "suffix", "mean", "bound")
