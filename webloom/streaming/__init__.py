"""Structured Streaming counterparts: windows, sessions, late data, keyed state, upserts of
micro-batches, and a crawl frontier fed by a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.http import AdaptiveDelay
from ..operators.merge import Merge, merge_table
from ..session import written


def tumbling(events: DataFrame, every: str = "1 hour", late: str = "10 minutes", ts: str = "ts", *keys: str) -> DataFrame:
    """Count and sum of ``value`` by window and keys; rows later than ``late`` are dropped
    when streaming."""
    w = F.window(ts, every)
    out = events.withWatermark(ts, late).groupBy(w, *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total")


def sliding(events: DataFrame, length: str = "1 hour", every: str = "15 minutes", late: str = "10 minutes", ts: str = "ts", *keys: str) -> DataFrame:
    out = events.withWatermark(ts, late).groupBy(F.window(ts, length, every), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", ts: str = "ts", key: str = "user_id") -> DataFrame:
    out = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def distinct_events(events: DataFrame, keys: list[str], late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Each key once; state is kept as long as a row may be late."""
    if events.isStreaming:
        return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def domain_delays(responses: DataFrame, start: float = 1.0, least: float = 0.1, most: float = 60.0, idle: str = "1 hour") -> DataFrame:
    """Adaptive delay of every domain over a stream of (domain, response_ms), kept as
    keyed state; a domain that is silent for ``idle`` is forgotten."""
    ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        d = AdaptiveDelay(start, least, most)
        if state.exists:
            d.delay, d.average, d.n = state.get
        for pdf in parts:
            for v in pdf["response_ms"]:
                d.add(float(v))
        state.update((d.delay, d.average, d.n))
        state.setTimeoutDuration(ms)
        yield pd.DataFrame({"domain": [key[0]], "delay": [d.delay], "n": [d.n]})

    return responses.groupBy("domain").applyInPandasWithState(step, "domain string, delay double, n long", "delay double, average double, n long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def merge_stream(rows: DataFrame, table: str, key: str, checkpoint: str, order: str | None = None) -> StreamingQuery:
    """Upsert every micro-batch into a saved table by ``key``; the last row of a key wins.
    A batch that is replayed leaves the same table."""

    def upsert(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        if not spark.catalog.tableExists(table):
            batch.limit(0).write.format("parquet").saveAsTable(table)
        m = Merge(spark.table(table), batch, [key], order=order).when_matched_update().when_not_matched_insert()
        merge_table(spark, table, m)

    return rows.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def crawl_frontier(urls: DataFrame, fetch: Callable[[DataFrame], DataFrame], table: str, checkpoint: str) -> StreamingQuery:
    """Fetch the new URLs of every micro-batch; ``fetch`` turns rows with a url into
    responses. URLs that the table holds aren't fetched again."""

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.select("url").na.drop().distinct()
        if spark.catalog.tableExists(table):
            # only what is new is written, so a batch costs what it holds
            new = written(new.join(spark.table(table).select("url"), "url", "left_anti"), "frontier")
        fetch(new).write.mode("append").format("parquet").saveAsTable(table)

    return urls.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
