"""Sparse linear models over hashed words: softmax regression with an L1 penalty, fitted
on the driver from a bounded sample, applied on the executors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, content_key, doc_features, pick

BITS = 20


@dataclass
class Model:
    """Weights of the active buckets (sorted) for every class, of extra columns, and bias."""

    buckets: np.ndarray
    weights: np.ndarray
    extra: np.ndarray
    bias: np.ndarray

    def probabilities(self, n: int, doc: np.ndarray, bucket: np.ndarray, extra: np.ndarray | None = None) -> np.ndarray:
        z = np.tile(self.bias, (n, 1))
        if len(self.buckets):
            lookup = np.zeros(1 << BITS, bool)
            lookup[self.buckets] = True
            hit = lookup[bucket]
            key = np.unique(doc[hit].astype(np.int64) << BITS | bucket[hit])
            d, col = key >> BITS, np.searchsorted(self.buckets, key & ((1 << BITS) - 1))
            for k in range(z.shape[1]):
                z[:, k] += np.bincount(d, self.weights[col, k], n)
        if extra is not None and self.extra.size:
            z += extra @ self.extra
        return _softmax(z)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(n: int, doc: np.ndarray, bucket: np.ndarray, y: np.ndarray, classes: int, extra: np.ndarray | None = None, l1: float = 3e-4, rounds: int = 200, min_docs: int = 3, least_z: float = 3.0) -> Model:
    """Fit on documents 0..n-1. (doc, bucket) holds distinct pairs. Buckets in fewer than
    ``min_docs`` documents, or whose share differs by less than ``least_z`` standard
    errors in every class, are screened out; the rest is an accelerated proximal gradient."""
    extra = np.zeros((n, 0)) if extra is None else extra
    share = np.array([(y == k).mean() if n else 0 for k in range(classes)])
    bias = np.log(np.maximum(share, 1e-6))
    if not n or (share == 1).any():
        return Model(np.zeros(0, np.int64), np.zeros((0, classes)), np.zeros((extra.shape[1], classes)), bias)
    df = np.bincount(bucket, minlength=1 << BITS)
    p, use = df / n, df >= min_docs
    best = np.zeros(1 << BITS)
    for k in range(classes):
        m = (y == k).sum()
        if 0 < m < n:
            inside = np.bincount(bucket[(y == k)[doc]], minlength=1 << BITS)
            se = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / m + 1 / (n - m)))
            best = np.maximum(best, np.abs(inside / m - (df - inside) / (n - m)) / se)
    kept = np.flatnonzero(use & (best >= least_z))
    place = np.full(1 << BITS, -1)
    place[kept] = np.arange(len(kept))
    at = place[bucket]
    rows, cols = doc[at >= 0], at[at >= 0]
    target = np.eye(classes)[y]
    width = len(kept)
    w, u, b = np.zeros((width, classes)), np.zeros((extra.shape[1], classes)), bias.copy()
    vw, vu, vb, t = w, u, b, 1.0
    per_doc = np.bincount(rows, minlength=n).max(initial=0) + (extra**2).sum(axis=1).max(initial=0) + 1
    # the greatest eigenvalue of X'X / n by power iteration, with room
    x = np.random.default_rng(0).random(width + extra.shape[1] + 1)
    top = float(per_doc)
    for _ in range(12):
        x /= np.linalg.norm(x)
        z = np.bincount(rows, x[cols], n) + extra @ x[width:-1] + x[-1]
        x = np.concatenate([np.bincount(cols, z[rows], width) if width else np.zeros(0), extra.T @ z, [z.sum()]]) / n
        top = np.linalg.norm(x)
    step = 1 / (0.5 * 1.2 * top)
    for _ in range(rounds):
        z = np.tile(vb, (n, 1)) + extra @ vu
        for k in range(classes):
            z[:, k] += np.bincount(rows, vw[cols, k], n)
        g = (_softmax(z) - target) / n
        gw = np.stack([np.bincount(cols, g[rows, k], width) if width else np.zeros(0) for k in range(classes)], axis=1)
        nw = vw - step * gw
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nu, nb = vu - step * (extra.T @ g), vb - step * g.sum(axis=0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        m = (t - 1) / nt
        vw, vu, vb = nw + m * (nw - w), nu + m * (nu - u), nb + m * (nb - b)
        w, u, b, t = nw, nu, nb, nt
    on = np.abs(w).max(axis=1) > 0 if width else np.zeros(0, bool)
    return Model(kept[on], w[on], u, b)


def _featurise(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, "text"):
        n = batch.num_rows
        doc, bucket = doc_features(batch.column("text").to_pylist(), BITS)
        key = np.unique(doc.astype(np.int64) << BITS | bucket)
        edge = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << BITS)
        lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array((key & ((1 << BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), lists], [*(c for c in batch.schema.names if c != "text"), "buckets"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_cols: list[str], max_rows: int, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id") -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, doc, bucket, labels, fold key) of at most ``max_rows`` labelled documents, those
    of least id hash; of rows that share an id one, that with the text of least hash. The
    bound keeps the driver's memory fixed at every size and whatever repeats."""
    d = pick(docs, id=id_col, text=text_col).where("id is not null and text is not null").withColumn("t", F.xxhash64("text"))
    y = pick(labels, id=label_id_col, **{f"y{i}": c for i, c in enumerate(label_cols)}).where(" and ".join(f"y{i} is not null" for i in range(len(label_cols))))
    names = [f"y{i}" for i in range(len(label_cols))]
    ids = y.select("id", *(F.col(c).cast("int").alias(c) for c in names)).withColumn("h", content_key("id", seed=11))
    ids = ids.groupBy("id").agg(F.min(F.struct("h", *names)).alias("y")).select("id", "y.*")
    ids = ids.join(d.groupBy("id").agg(F.min("t").alias("t")), "id").orderBy("h", "id").limit(max_rows)
    # at most max_rows short rows: small at any size of the input
    df = d.join(F.broadcast(ids), ["id", "t"]).dropDuplicates(["id"]).select("text", "h", *names)
    schema = "h bigint, " + ", ".join(f"{c} int" for c in names) + ", buckets array<int>"
    t = df.mapInArrow(_featurise, schema).toArrow().combine_chunks()
    order = np.argsort(np.asarray(t.column("h")), kind="stable") if t.num_rows else np.zeros(0, np.int64)
    t = t.take(pa.array(order))
    col = t.column("buckets").combine_chunks() if t.num_rows else None
    bucket = np.asarray(col.flatten(), np.int64) if t.num_rows else np.zeros(0, np.int64)
    size = np.asarray(pc.list_value_length(col), np.int64) if t.num_rows else np.zeros(0, np.int64)
    ys = np.stack([np.asarray(t.column(c), np.int64) for c in names], axis=1) if t.num_rows else np.zeros((0, len(names)), np.int64)
    return t.num_rows, np.repeat(np.arange(t.num_rows), size), bucket, ys, np.asarray(t.column("h"), np.int64)
