"""Toxicity by classifier chains.

The categories are predicted one after another by sparse linear models over hashed words;
each model also sees the probabilities of the categories before it. In training these are
out-of-fold predictions, so a later model learns how far an earlier one can be trusted on
documents it hasn't seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_features, once, pick
from .linear import BITS, Model, fit, labelled_sample


@dataclass
class Chain:
    categories: list[str]
    models: list[Model]

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        n = len(texts)
        doc, bucket = doc_features(texts, BITS)
        out = np.zeros((n, 0))
        for m in self.models:
            out = np.column_stack([out, m.probabilities(n, doc, bucket, out)[:, 1]])
        return out


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], folds: int = 5, max_rows: int = 12000, **columns: str) -> Chain:
    """Chain over 0/1 label columns, fitted on at most ``max_rows`` labelled documents.
    Documents without text or without one of the labels aren't used; any label but 1
    counts as 0. Without labelled documents every probability is about 0."""
    n, doc, bucket, y, h = labelled_sample(docs, labels, categories, max_rows, **columns)
    y = (y == 1).astype(int)
    fold = (h.astype(np.uint64) % np.uint64(folds)).astype(int)
    seen, models = np.zeros((n, 0)), []
    for k in range(len(categories)):
        out = np.zeros(n)
        for f in range(folds):
            inside, held = fold != f, fold == f
            place = np.cumsum(inside) - 1
            m = fit(int(inside.sum()), place[doc[inside[doc]]], bucket[inside[doc]], y[inside, k], 2, seen[inside])
            where = np.cumsum(held) - 1
            out[held] = m.probabilities(int(held.sum()), where[doc[held[doc]]], bucket[held[doc]], seen[held])[:, 1]
        models.append(fit(n, doc, bucket, y[:, k], 2, seen) if n else Model(np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros((k, 2)), np.array([0.0, -20.0])))
        seen = np.column_stack([seen, out])
    return Chain(list(categories), models)


def toxicity_of(text: Column | str, chain: Chain) -> Column:
    """Column struct of one probability for each category, from the whole text; a null or
    blank text has the probabilities of a text without words."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in chain.categories])

    @F.pandas_udf(schema)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame(chain.probabilities([t if isinstance(t, str) else None for t in texts]), columns=chain.categories)

    return once(score)(F.col(text) if isinstance(text, str) else text)


def toxic_documents(docs: DataFrame, chain: Chain, category: str = "toxic", threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category>...) of the documents whose probability of ``category`` is at
    least ``threshold``. Null ids and repeated rows are kept as they come, null and empty
    texts are judged as texts without words, and one whose probability equals the
    threshold is in; other columns are ignored; an empty table gives no rows."""
    df = pick(docs, id=id_col, text=text_col)
    out = df.select(F.col("id").alias(id_col), toxicity_of("text", chain).alias("p"))
    return out.select(id_col, *(F.round(f"p.{c}", 6).alias(f"p_{c}") for c in chain.categories)).where(F.col(f"p_{category}") >= threshold)
