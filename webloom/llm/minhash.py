"""Near-duplicate documents by one-permutation MinHash.

Word shingles are hashed once; the top bits of a hash name its bin and each bin keeps its
least hash. Empty bins borrow from a non-empty one by optimal densification (a 2-universal
draw per attempt), which keeps the collision probability equal to the Jaccard similarity.
Bands of rows make buckets; in a bucket every document gets one edge, to the least
document, so a bucket of n documents has n - 1 edges. Edges are verified on the whole
signatures. Documents that share a bucket but aren't like its centre get a second star, and
what that leaves meets again in the buckets of its rarest signature entries, where stars
with more and more centres go on until nothing is left. One that isn't like a centre isn't
compared in that bucket with those that are, so a pair near the threshold can be missed if
all buckets it shares part it so.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, discard, mix64, pick, words_of, written

BINS, BANDS, SHINGLE, THRESHOLD = 128, 32, 3, 0.5
#: Rows of an id and a hash that may be broadcast, and hash classes of signature entries.
SMALL, CLASSES = 200_000, 1 << 18


def signatures(texts: list[str | None], bins: int = BINS, shingle: int = SHINGLE, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(has words, uint32 signature) of each text; a text of fewer words than a shingle is
    one shingle of all its words, one without words has no signature."""
    bounds, h = words_of(texts)
    n, count = len(texts), np.diff(bounds)
    out = np.full((n, bins), np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        doc = np.repeat(np.arange(n), count)
        left = np.repeat(bounds[1:], count) - np.arange(len(h))
        s = h.copy()
        for k in range(1, shingle):
            step = np.zeros_like(h)
            step[: len(h) - k] = h[k:]
            s = np.where(left > k, mix64(s * np.uint64(0x100000001B3) + step), s)
        at = np.arange(len(h)) - bounds[doc]
        keep = (left >= shingle) | (at == 0)
        s, doc = mix64(s[keep] + mix64(np.full(1, seed, np.uint64))), doc[keep]
        bit = bins.bit_length() - 1
        flat = doc * bins + (s >> np.uint64(64 - bit)).astype(np.int64)
        np.minimum.at(out.reshape(-1), flat, s)
        empty = out == np.uint64(2**64 - 1)
        some = count > 0
        free = empty & some[:, None]
        row, col = np.nonzero(free)
        attempt = np.uint64(1)
        while len(row):
            draw = (mix64(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + attempt) >> np.uint64(64 - bit)).astype(np.int64)
            hit = ~empty[row, draw]
            out[row[hit], col[hit]] = out[row[hit], draw[hit]]
            row, col = row[~hit], col[~hit]
            attempt += np.uint64(1)
    return some, (mix64(out) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _sign(rows: Iterator[pa.RecordBatch], bins: int, bands: int, shingle: int) -> Iterator[pa.RecordBatch]:
    width = bins // bands
    for batch in batches(rows, "text"):
        some, sig = signatures(batch.column("text").to_pylist(), bins, shingle)
        with np.errstate(over="ignore"):
            key = np.zeros((len(sig), bands), np.uint64)
            for k in range(width):
                key = mix64(key * np.uint64(0x100000001B3) + sig[:, k::width].astype(np.uint64) + np.uint64(1))
            key = mix64(key + np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
        ids, h = (batch.column(c).filter(pa.array(some)) for c in ("id", "h"))
        sig, key = sig[some].astype(np.uint16), key[some]
        raw, step = sig.tobytes(), bins * 2
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                h,
                pa.array([raw[i * step : (i + 1) * step] for i in range(len(sig))], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, bands), pa.int32()), pa.array(key.reshape(-1))),
            ],
            ["id", "h", "sig", "keys"],
        )


@F.pandas_udf(T.DoubleType())
def _similar(a, b):
    import pandas as pd

    if not len(a):
        return pd.Series([], dtype="float64")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(axis=1))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bands: int = BANDS, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (id, kept_id): each document that goes, and the least document of its group,
    which stays. A group is a connected component of verified edges.

    Null ids are ignored; null texts and texts without words belong to no group. Rows
    that share an id count as one document, with the text of least hash among those that
    have words. Texts are compared whole, without case and punctuation. Other columns are
    ignored. The result has the id's type, and no rows for an empty table. A document that
    stays never goes itself.
    """
    if bins & (bins - 1) or bins % bands:
        raise ValueError("bins must be a power of two and a multiple of bands")
    raw = pick(docs, id=id_col, text=text_col).where("id is not null and text is not null").withColumn("h", F.xxhash64("text"))
    schema = T.StructType([T.StructField("id", raw.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    signed = raw.mapInArrow(lambda it: _sign(it, bins, bands, shingle), schema)
    # a node is a signature: a large group of exact copies is one node
    signed = _one_text_per_id(written(signed.withColumn("node", F.xxhash64("sig")), "minhash-sig"))
    nodes = written(signed.select("node", "sig", "keys").dropDuplicates(["node"]), "minhash-node")
    edges, held = _edges(nodes, bins, threshold)
    parts = components(edges)
    for table in held:
        discard(table)

    ids = signed.select("id", "node").join(parts, "node", "left").select("id", F.coalesce("least", "node").alias("part"))
    kept = ids.groupBy("part").agg(F.min("id").alias("kept_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = ids.join(kept, "part").groupBy("id").agg(F.min("kept_id").alias("kept_id")).where("id <> kept_id")
    return out.select(F.col("id").alias(id_col), "kept_id")


def _one_text_per_id(signed: DataFrame) -> DataFrame:
    """Of rows that share an id, those with the text of least hash."""
    twice = signed.groupBy("id").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least < most").select("id", "least")
    twice = written(twice, "minhash-twice")
    n = twice.count()
    if not n:
        return signed
    return signed.join(F.broadcast(twice) if n <= SMALL else twice, "id", "left").where("least is null or h = least").drop("least")


def _edges(nodes: DataFrame, bins: int, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """(centre, node): the verified edges, and the tables that hold them. Two stars in each
    bucket of the bands; members that are like neither centre meet again in the buckets of
    their rare tokens."""
    rows = nodes.select(F.explode("keys").alias("key"), "node")
    links: list[DataFrame] = []
    rows = _star(rows, nodes, threshold, 1, links)
    rows = _next(rows, nodes, threshold, 1, links)
    if rows.isEmpty():
        return reduce(DataFrame.union, links), links
    some = written(nodes.select("node", "sig").join(rows.select("node").distinct(), "node", "left_semi"), "minhash-rest")
    frequency = _frequencies(some, bins)
    prefix = bins - max(1, int(np.ceil(threshold * bins))) + 1
    discard(rows)
    rows = some.mapInArrow(lambda it: _rare(it, bins, prefix, frequency), "key bigint, node bigint")
    centres, rows = 1, _star(rows, some, threshold, 1, links)
    while not rows.isEmpty():
        centres *= 2
        rows = _next(rows, some, threshold, centres, links)
    discard(some)
    return reduce(DataFrame.union, links), links


def _next(rows: DataFrame, *how) -> DataFrame:
    """A star over a written table, which nothing else reads."""
    left = _star(rows, *how)
    discard(rows)
    return left


def _star(rows: DataFrame, nodes: DataFrame, threshold: float, centres: int, links: list[DataFrame]) -> DataFrame:
    """One star for each slot of each bucket of ``rows`` (key, node): its least node in a
    pseudo-random order is a centre and every other node of the bucket is compared with
    it. ``links`` gets the edges; the result is what is like no centre. Centres leave."""
    slot = F.pmod(F.xxhash64(F.lit(centres), "node"), F.lit(centres)) if centres > 1 else F.lit(0)
    # partial aggregates: a hot bucket isn't gathered anywhere
    each = rows.groupBy("key", slot.alias("slot")).agg(F.min("node").alias("centre"), F.max("node").alias("most"))
    if centres == 1:
        each = each.where("centre < most")
    met = rows.join(each.select("key", "centre"), "key").where("node <> centre")
    met = written(met, "minhash-star")
    pairs = met.select(F.least("centre", "node").alias("centre"), F.greatest("centre", "node").alias("node")).distinct()
    checked = written(_verify(pairs, nodes, threshold), "minhash-edge")
    links.append(checked.where("ok").select("centre", "node"))
    ends = met.select("key", "node", F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
    found = ends.join(checked.select(F.col("centre").alias("a"), F.col("node").alias("b"), "ok"), ["a", "b"])
    rest = found.groupBy("key", "node").agg(F.max("ok").alias("ok")).where("not ok").select("key", "node")
    if centres > 1:
        rest = rest.join(each.select("key", F.col("centre").alias("node")), ["key", "node"], "left_anti")
    left = written(rest, "minhash-left")
    discard(met)
    return left


def _tokens(batch: pa.RecordBatch, bins: int) -> np.ndarray:
    """A token is a bin with its value; each row of the result has those of a node."""
    sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, bins)
    return mix64((np.arange(bins, dtype=np.uint64)[None, :] << np.uint64(16) | sig.astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15))


def _frequencies(nodes: DataFrame, bins: int) -> np.ndarray:
    """How often the tokens of each hash class occur: ``CLASSES`` numbers at any size."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in rows:
            total += np.bincount((_tokens(batch, bins) % np.uint64(CLASSES)).astype(np.int64).ravel(), minlength=CLASSES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["class", "n"])

    t = nodes.mapInArrow(count, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES, np.int64)
    out[np.asarray(t.column("class"), np.int64)] = np.asarray(t.column("n"), np.int64)
    return out


def _rare(rows: Iterator[pa.RecordBatch], bins: int, prefix: int, frequency: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The ``prefix`` rarest tokens of each node: of two nodes that agree in enough bins
    one at least is among the rarest of both, and a passage that many share isn't."""
    for batch in rows:
        if not batch.num_rows:
            continue
        token = _tokens(batch, bins)
        often = frequency[(token % np.uint64(CLASSES)).astype(np.int64)]
        order = np.lexsort((token, often), axis=1)[:, :prefix]
        key = np.take_along_axis(token, order, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(np.asarray(batch.column("node")), key.shape[1]))], ["key", "node"])


def _verify(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    one = nodes.select(F.col("node").alias("centre"), F.col("sig").alias("centre_sig"))
    both = pairs.join(nodes.select("node", "sig"), "node").join(one, "centre")
    return both.select("centre", "node", (_similar("sig", "centre_sig") >= threshold).alias("ok"))


def components(edges: DataFrame) -> DataFrame:
    """(node, least): every end of an edge (centre, node) and the least end of its
    connected component, by alternating large and small stars until nothing changes.
    Each round is written, so a lost executor costs one round at most."""
    now = written(edges.select(F.greatest("centre", "node").alias("a"), F.least("centre", "node").alias("b")).where("a <> b").distinct(), "cc")
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        new = large.join(small, "a").select(F.explode(ends).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        new = written(new, "cc")
        state = new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(now)
        if state == seen:
            return new.select(F.col("a").alias("node"), F.col("b").alias("least"))
        now, seen = new, state
