"""Rules about responses: errors, retries, delays, content types, dates."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def error_class(status: Column, error: Column) -> Column:
    """rate_limited, server_error, client_error, or by the message of a failed fetch
    timeout, dns_failure, ssl_error, connection_refused, timeout; ``''`` for none."""
    e = F.lower(F.coalesce(error, F.lit("")))
    has = lambda *words: F.lit(False) if not words else e.rlike("|".join(words))
    return (
        F.when(status == 429, "rate_limited")
        .when((status >= 500) & (status < 600), "server_error")
        .when((status >= 400) & (status < 500), "client_error")
        .when((status <= 0) & has("robots"), "robots_disallowed")
        .when((status <= 0) & has("too large"), "content_too_large")
        .when((status <= 0) & has("content.type"), "content_type_rejected")
        .when((status <= 0) & has("timeout", "timed out"), "timeout")
        .when((status <= 0) & has("dns", "resolve", "name or service"), "dns_failure")
        .when((status <= 0) & has("ssl", "certificate", "tls"), "ssl_error")
        .when((status <= 0) & has("refused", "connect"), "connection_refused")
        .when(status <= 0, "timeout")
        .otherwise("")
    )


def fibonacci_backoff(n: Column, base: int = 3, most: int = 3600) -> Column:
    """Seconds before attempt n: base x 1, 2, 3, 5, 8, ..., at most ``most``."""
    steps, a, b = [base], 1, 2
    while base * b < most and len(steps) < 64:
        steps.append(base * b)
        a, b = b, a + b
    steps.append(most)
    i = F.least(F.greatest(n, F.lit(1)), F.lit(len(steps)))
    return F.element_at(F.array(*map(F.lit, steps)), i.cast("int"))


def retryable(status: Column) -> Column:
    """Failures and 500 to 504; 429 is left to the domain's block."""
    return (status <= 0) | status.between(500, 504)


def retry_after_ms(header: Column) -> Column:
    """Milliseconds of a Retry-After header of whole seconds, else 0."""
    return F.when(F.trim(header).rlike(r"^\d{1,9}$"), F.trim(header).try_cast("long") * 1000).otherwise(F.lit(0).cast("long"))


def next_action(status: Column, attempt: Column, header: Column, most: int = 5) -> Column:
    """struct(action, wait_ms): ``retry``, ``block_domain`` on 429, ``give_up`` after
    ``most`` attempts, else ``done``."""
    wait = F.greatest(retry_after_ms(header), F.lit(1000).cast("long") * fibonacci_backoff(attempt))
    action = F.when((status == 429) & (attempt < most), "block_domain").when(retryable(status) & (attempt < most), "retry").when(retryable(status) | (status == 429), "give_up").otherwise("done")
    return F.struct(action.alias("action"), F.when(action.isin("retry", "block_domain"), wait).otherwise(F.lit(0).cast("long")).alias("wait_ms"))


def content_type_allowed(content_type: Column, accept: Sequence[str] = (), reject: Sequence[str] = ()) -> Column:
    """Main type against an accept list, then a reject list; ``text/*`` matches all of
    text. An empty accept list takes everything."""
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))

    def listed(names: Sequence[str]) -> Column:
        out = F.lit(False)
        for n in (x.strip().lower() for x in names):
            out = out | (F.startswith(kind, F.lit(n[:-1])) if n.endswith("/*") else F.lit(True) if n == "*" else kind == n)
        return out

    return (listed(accept) if accept else F.lit(True)) & ~listed(reject)


def server_date(header: Column, now: Column | None = None, minutes: int = 15) -> Column:
    """The Date header, if it lies within ``minutes`` of ``now``; else null."""
    clean = F.regexp_replace(F.regexp_replace(header, r"^\s*\w{3},\s*", ""), r"\s*(?:GMT|UTC)\s*$", "")
    t = F.try_to_timestamp(clean, F.lit("d MMM yyyy HH:mm:ss"))
    now = F.current_timestamp() if now is None else now
    return F.when(F.abs(F.unix_timestamp(t) - F.unix_timestamp(now)) <= minutes * 60, t)


class AdaptiveDelay:
    """Delay of one domain that follows its response times: a moving average (weight 0.2);
    from the third response on more than twice the average makes the delay half as long
    again, less than half of it a tenth shorter."""

    def __init__(self, delay: float, least: float = 0.0, most: float = 60.0):
        self.delay, self.least, self.most = delay, least, most
        self.average, self.n = 0.0, 0

    def add(self, response_ms: float) -> float:
        self.n += 1
        self.average = response_ms if self.n == 1 else 0.2 * response_ms + 0.8 * self.average
        if self.n >= 3:
            if response_ms > 2 * self.average:
                self.delay = min(self.most, self.delay * 1.5)
            elif response_ms < 0.5 * self.average:
                self.delay = max(self.least, self.delay * 0.9)
        return self.delay


def adaptive_delays(responses: DataFrame, start: float = 1.0, least: float = 0.1, most: float = 60.0) -> DataFrame:
    """(domain, seq, response_ms, delay): the delay after each response, in the order of
    ``seq``, by domain."""
    schema = T.StructType([responses.schema["domain"], responses.schema["seq"], T.StructField("response_ms", T.DoubleType()), T.StructField("delay", T.DoubleType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable")
        state = AdaptiveDelay(start, least, most)
        return pdf.assign(delay=[state.add(ms) for ms in pdf["response_ms"]])

    rows = responses.select("domain", "seq", F.col("response_ms").cast("double").alias("response_ms"))
    return rows.groupBy("domain").applyInPandas(fold, schema)
