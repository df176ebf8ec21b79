"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of documents in a seeded pseudo-random order; a document is a run
of packets of at most ``packet`` tokens. In every round each source is credited its
quantum, in proportion to its target weight, and sends the packets its credit covers; what
it can't spend is its deficit and is carried on. A packet that ends at token C of its
queue leaves in round ceil(C / quantum), so the deficits need no sequential pass: running
sums of the queues, taken in blocks that are added up afterwards, carry them across
partitions exactly. The rounds, one after another, are a stream that is cut into windows
of equal length; only the last window may be shorter. A queue that runs dry drops out and
the others share its place in proportion to their weights.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import content_key, once, pick, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
BLOCK_ROWS, BLOCKS = 20000, 4096


class _Words(dict):
    """Tokens of a word that follows a space, counted once. A word that is empty or has
    white space at an end counts ``ODD``: it can't be told apart from its neighbours."""

    ODD = 1 << 50

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> int:
        if not word or word[0].isspace() or word[-1].isspace():
            n = self.ODD
        elif word[-1] in ".,;:!?" and word[:-1].isalpha():
            n = self[word[:-1]] + 1  # letters and a sign are two pretokens
        else:
            n = len(self.encode(" " + word))
        if len(word) < 40:
            self[word] = n
        return n


class Counter:
    """Token counts. Pretokens never contain an inner space, so a text whose spaces stand
    between two other characters is the sum of its space-led words, which are kept."""

    MOST = 200_000

    def __init__(self, path: str = TOKENIZER):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self.encoding.encode_ordinary)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        first, _, rest = text.partition(" ")
        if not rest or not first or first[0].isspace() or first[-1].isspace():
            return len(self.encode(text))
        if len(self.words) > self.MOST:
            self.words.clear()
        n = sum(map(self.words.__getitem__, rest.split(" ")))
        return len(self.encode(text)) if n >= _Words.ODD else len(self.encode(first)) + n


def token_count(text: Column | str, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of the whole text; 0 for null and empty."""

    @F.pandas_udf(T.LongType())
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(tokenizer)
        for texts in parts:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return once(count)(F.col(text) if isinstance(text, str) else text)


def pack(docs: DataFrame, targets: Mapping[str, float] | None = None, window: int = 4096, packet: int = 64, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", temperature: float = 0.7, tokenizer: str = TOKENIZER, seed: int = 0) -> DataFrame:
    """(window_id, position, source, id, token_start, token_end): the tokens
    [token_start, token_end) of a document stand from ``position`` on in the window. A
    document ends with one end-of-text token, counted as its last.

    ``targets`` maps sources to token weights; without it a source weighs its tokens to
    the power ``temperature``. A source that isn't named gets one token a round, so it is
    packed too. Null is a source of its own. Documents with null or empty text have no
    tokens and stand in no window; null ids and repeated rows are packed like others;
    identical rows are interchangeable, and ties of the order's hash go by id and length.
    Texts of any length are packed whole; an empty table gives no rows. Other columns are
    ignored.
    """
    raw = pick(docs, id=id_col, text=text_col, source=source_col)
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    t = raw.select("id", key.alias("queue"), F.shiftrightunsigned(content_key("id", "text", seed=seed), 1).alias("h"), token_count("text", tokenizer).alias("n"))
    t = written(t.where("n > 0").withColumn("n", F.col("n") + 1), "pack-tokens")

    queues = t.groupBy("queue").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs"))
    if targets is None:
        weight = F.pow(F.col("tokens").cast("double"), F.lit(float(temperature)))
    else:
        pairs = [x for k, v in targets.items() for x in (F.lit("+" + str(k)), F.lit(float(v)))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("queue")), F.lit(0.0)) if pairs else F.lit(0.0)
    queues = queues.withColumn("weight", weight)
    whole = F.nullif(F.sum("weight").over(Window.partitionBy(F.lit(0))), F.lit(0.0))
    quantum = F.greatest(F.lit(1), F.coalesce(F.round(window * F.col("weight") / whole), F.lit(1.0)).cast("long"))
    # one row for each source
    queues = queues.select("queue", quantum.alias("q"), (F.expr(f"docs div {BLOCK_ROWS}") + 1).alias("blocks"))

    t = t.join(queues, "queue").withColumn("block", F.shiftright(F.shiftright("h", 31) * F.col("blocks"), 32))
    ends = _running(t, ["queue"], "block", ["h", "id", "n"], "n")
    s = ends.select("queue", "id", "q", "n", (F.col("end") - F.col("n")).alias("s"))
    sent = lambda r: f"greatest(0, if(({r}) * q - s >= n, n, (({r}) * q - s) div {packet} * {packet}))"
    rounds = F.expr(f"sequence((s + least({packet}, n) + q - 1) div q, (s + n + q - 1) div q)")
    spans = s.select("*", F.explode(rounds).alias("round")).selectExpr("queue", "id", "s", "round", f"{sent('round - 1')} AS a", f"{sent('round')} AS b").where("b > a")
    spans = written(spans.withColumn("n", F.col("b") - F.col("a")), "pack-spans")

    # rounds are of equal length, so blocks of rounds are too
    spans = spans.withColumn("block", F.expr("round div 256"))
    placed = _running(spans, [], "block", ["round", "queue", "s", "a", "id"], "n")
    placed = placed.withColumn("at", F.col("end") - F.col("n")).withColumn("window_id", F.explode(F.expr(f"sequence(at div {window}, (end - 1) div {window})")))
    lo, hi = F.greatest("at", F.col("window_id") * window), F.least("end", (F.col("window_id") + 1) * window)
    source = F.when(F.col("queue") != "-", F.expr("substring(queue, 2)"))
    return placed.select("window_id", (lo - F.col("window_id") * window).alias("position"), source.alias("source"), F.col("id").alias(id_col), (F.col("a") + lo - F.col("at")).alias("token_start"), (F.col("a") + hi - F.col("at")).alias("token_end"))


def _running(df: DataFrame, group: list[str], block: str, order: list[str], n: str) -> DataFrame:
    """``df`` with ``end``, the running sum of ``n`` by ``group`` in the order of block
    and ``order``: sums within blocks, plus the sum of the blocks before. The blocks are
    summed in the same way, by blocks of ``BLOCKS`` of them, so that one task never has
    more than a row for each of these."""
    blocks = df.groupBy(*group, block).agg(F.sum(n).alias("total")).withColumn("_over", F.expr(f"{block} div {BLOCKS}"))
    whole = blocks.groupBy(*group, "_over").agg(F.sum("total").alias("all"))
    of = lambda *by: Window.partitionBy(*group, *by) if group or by else Window.partitionBy(F.lit(0))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*group, "_over", F.coalesce(F.sum("all").over(until(of().orderBy("_over"))), F.lit(0)).alias("far"))
    near = F.coalesce(F.sum("total").over(until(of("_over").orderBy(block))), F.lit(0))
    before = blocks.withColumn("near", near).join(whole, [*group, "_over"]).select(*group, block, (F.col("near") + F.col("far")).alias("before"))
    own = F.sum(n).over(Window.partitionBy(*group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("end", own).join(before, [*group, block]).withColumn("end", F.col("end") + F.col("before")).drop("before")


def window_tokens(layout: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(window_id, tokens): the token ids of each window of a layout made by ``pack``
    from documents with unique ids."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(tokenizer)
        for part in texts:
            yield pd.Series([[*counter.encode(t), END_OF_TEXT] if t else [] for t in part])

    coded = pick(docs, id=id_col, text=text_col).select("id", tokens("text").alias("tokens"))
    cut = layout.join(coded, layout[id_col] == coded["id"]).select("window_id", "position", F.expr("slice(tokens, int(token_start + 1), int(token_end - token_start))").alias("piece"))
    rows = cut.groupBy("window_id").agg(F.sort_array(F.collect_list(F.struct("position", "piece"))).alias("p"))
    return rows.select("window_id", F.flatten(F.transform("p", lambda x: x.piece)).alias("tokens"))
