"""Mixing to target weights with soft membership.

A classifier fitted on the label table gives every document a posterior over domains.
Accelerated projected gradient finds non-negative document rates whose expected domain
totals, sum of rate x tokens x posterior, come closest to the targets in (relative) least
squares. The momentum restarts when the distance grows.
Each step is one aggregate over the table; the rate of a document is a function of its
posterior and the gradients so far. Every ``STATE`` steps the rates reached are written, so
that a step replays no more than these.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, bound_batches, content_key, discard, doc_features, once, pick, written
from .linear import BITS, Model, fit, labelled_sample

DOMAINS = ("fine", "poor", "toxic")
TARGETS = {"fine": 0.85, "poor": 0.1, "toxic": 0.05}
STATE = 16


def train_domains(docs: DataFrame, labels: DataFrame, max_rows: int = 12000, quality_col: str = "quality", toxic_col: str = "toxic", **columns: str) -> Model:
    """Softmax model of the domains fine, poor and toxic, on at most ``max_rows`` labelled
    documents: toxic ones, of the others those of quality 0, and the rest."""
    n, doc, bucket, y, _ = labelled_sample(docs, labels, [quality_col, toxic_col], max_rows, **columns)
    domain = np.where(y[:, 1] == 1, 2, np.where(y[:, 0] == 0, 1, 0)) if n else np.zeros(0, int)
    return fit(n, doc, bucket, domain, len(DOMAINS)) if n else Model(np.zeros(0, np.int64), np.zeros((0, 3)), np.zeros((0, 3)), np.zeros(3))


def _posteriors(rows: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, "text"):
        texts = batch.column("text").to_pylist()
        doc, bucket = doc_features(texts, BITS)
        n = len(texts)
        p = model.probabilities(n, doc, bucket)
        tokens = np.bincount(doc, minlength=n) - 3 if n else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(tokens.astype(np.int64)), lists], ["id", "tokens", "p"])


Steps = list[tuple[float, np.ndarray]]


def _points(p: np.ndarray, steps: Steps, x: np.ndarray | None = None, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rates, the points ahead of them at which the next gradient is taken), from 1 or from
    the rates and points before the steps."""
    if x is None or y is None:
        x = y = np.ones(len(p))
    for move, g in steps:
        new = np.maximum(0.0, y - p @ g)
        x, y = new, new + move * (new - x)
    return x, y


def _rate(p: np.ndarray, steps: Steps) -> np.ndarray:
    return _points(p, steps)[0]


def _held(batch: pa.RecordBatch, steps: Steps, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p = np.asarray(batch.column("p").flatten()).reshape(batch.num_rows, d)
    at = [np.asarray(batch.column(c)) for c in "xy"] if "x" in batch.schema.names else []
    return p, *_points(p, steps, *at)


def _moved(rows: Iterator[pa.RecordBatch], steps: Steps, d: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        _, x, y = _held(batch, steps, d)
        yield pa.RecordBatch.from_arrays([batch.column("tokens"), batch.column("p"), pa.array(x), pa.array(y)], ["tokens", "p", "x", "y"])


def _sums(rows: Iterator[pa.RecordBatch], steps: Steps, d: int) -> Iterator[pa.RecordBatch]:
    total, ahead, gram = np.zeros(d), np.zeros(d), np.zeros((d, d))
    for batch in rows:
        p, x, y = _held(batch, steps, d)
        t = np.asarray(batch.column("tokens"), float)
        total += (t * x) @ p
        ahead += (t * y) @ p
        if not steps and "x" not in batch.schema.names:
            gram += (p * t[:, None]).T @ p
    yield pa.RecordBatch.from_arrays([pa.array([a.reshape(-1).tolist()]) for a in (total, ahead, gram)], ["total", "ahead", "gram"])


def fit_rates(scored: DataFrame, domains: int, targets: list[float], rounds: int = 200, tolerance: float = 1e-6) -> Steps:
    """The steps (momentum, gradient) that turn posteriors into rates. ``targets`` are
    shares; the total is that of the input. Stops when the totals are met, and with a
    warning that says how far they are off when they no longer move (a target for a domain
    that no document belongs to can't be met) or after ``rounds``."""
    share = np.array(targets) / sum(targets)
    steps: Steps = []
    now_at, recent = scored.select("tokens", "p"), 0
    want = eta = scale = last = None
    pace, off = 1.0, np.inf
    while True:
        # one row for each partition
        late = steps[recent:]
        rows = now_at.mapInArrow(lambda it: _sums(it, late, domains), "total array<double>, ahead array<double>, gram array<double>")
        got = rows.agg(*(F.sum(F.col(c)[i]).alias(f"{c[0]}{i}") for c, n in (("total", domains), ("ahead", domains), ("gram", domains**2)) for i in range(n))).first()
        total, ahead = (np.array([got[f"{c}{i}"] or 0.0 for i in range(domains)]) for c in "ta")
        if want is None:
            want = total.sum() * share
            gram = np.array([got[f"g{i}"] or 0.0 for i in range(domains**2)]).reshape(domains, domains)
            scale = np.maximum(np.diag(gram), 1e-9 * max(1.0, total.sum()))
            eta = 1 / max(1e-12, np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max())
        if not total.sum() and not steps or np.abs(total - want).max() <= tolerance * max(1.0, want.sum()):
            return steps
        if len(steps) >= rounds or last is not None and np.abs(total - last).max() <= 1e-3 * tolerance * max(1.0, want.sum()):
            warnings.warn(f"after {len(steps)} rounds a domain's total is off by {np.abs(total - want).max() / want.sum():.2%} of all tokens", stacklevel=2)
            return steps
        now = float(((total - want) ** 2 / scale).sum())
        if now > off:
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        steps = [*steps, ((pace - 1) / faster, eta * (ahead - want) / scale)]
        last, off, pace = total, now, faster
        if len(steps) - recent >= STATE:
            late = steps[recent:]
            before, now_at = now_at, written(now_at.mapInArrow(lambda it: _moved(it, late, domains), "tokens bigint, p array<double>, x double, y double"), "mix-state")  # noqa: B023
            if recent:
                discard(before)
            recent = len(steps)


def document_rates(docs: DataFrame, model: Model, targets: Mapping[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text", rounds: int = 200, tolerance: float = 1e-6) -> DataFrame:
    """(id, tokens, p_<domain>..., rate) of every document. A token is a word. Null and
    empty texts have no tokens; their posterior is that of the bare prior. Null ids and
    repeated rows are kept as they come, each repetition counting; an empty table gives
    no rows; other columns are ignored."""
    raw = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([raw.schema["id"], T.StructField("tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))])
    scored = written(raw.mapInArrow(lambda it: _posteriors(it, model), schema), "mix-scored")
    steps = fit_rates(scored, len(DOMAINS), [targets.get(d, 0.0) for d in DOMAINS], rounds, tolerance)

    @F.pandas_udf(T.DoubleType())
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(_rate(np.stack(p.to_numpy()), steps) if len(p) else [], dtype="float64")

    return scored.select(F.col("id").alias(id_col), "tokens", *(F.round(F.col("p")[i], 6).alias(f"p_{d}") for i, d in enumerate(DOMAINS)), rate("p").alias("rate"))


def mixed(docs: DataFrame, model: Model, targets: Mapping[str, float] = TARGETS, seed: int = 3, text_col: str = "text", rounds: int = 200, tolerance: float = 1e-6) -> DataFrame:
    """``docs`` with every row as often as its rate says: the whole part of the rate, and
    once more if the row's content hash falls below the fraction. All columns are kept.
    Rows that are alike in all columns get the same number of copies; null and empty texts
    have the rate of the bare prior; an empty table gives no rows."""
    bound_batches(docs.sparkSession)
    raw = docs.select(F.col(f"`{text_col}`").alias("text"), F.lit(None).cast("long").alias("id"))
    schema = "id bigint, tokens bigint, p array<double>"
    scored = written(raw.mapInArrow(lambda it: _posteriors(it, model), schema), "mix-scored")
    steps = fit_rates(scored, len(DOMAINS), [targets.get(d, 0.0) for d in DOMAINS], rounds, tolerance)

    @F.pandas_udf(T.DoubleType())
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            texts = [t if isinstance(t, str) else None for t in texts]
            doc, bucket = doc_features(texts, BITS)
            yield pd.Series(_rate(model.probabilities(len(texts), doc, bucket), steps), dtype="float64")

    plain = [c for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    draw = F.shiftrightunsigned(content_key(*(F.col(f"`{c}`") for c in plain), seed=seed), 11) / F.lit(float(1 << 53))
    copies = F.floor(once(rate)(F.col(f"`{text_col}`")) + 1 - draw).cast("int")
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), copies.alias("copies"))
    return out.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
