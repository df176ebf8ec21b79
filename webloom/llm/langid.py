"""Language identification by compression.

Each language has a zstandard dictionary of raw content, made of whole labelled documents.
A text is folded to lower case and encoded whole, in chunks of one size and at one level
whatever its length, with every dictionary; the language whose dictionary gives the fewest
bytes wins. A narrow margin is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
import zstandard as zs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import content_key, once, pick

RESULT = T.StructType([T.StructField("language", T.StringType()), T.StructField("margin", T.DoubleType())])
LEVEL, CHUNK = 12, 512


def profiles(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_bytes: int = 32768, docs_per_language: int = 60, max_languages: int = 64) -> dict[str, bytes]:
    """Raw-content dictionaries from a bounded sample of the documents whose ids are in the
    first column of ``good``: of the ``max_languages`` languages with most of them, at most
    ``docs_per_language`` documents, those of least id hash among those of up to
    ``max_bytes / 8`` bytes. They are taken whole, as far as ``max_bytes`` holds them. The
    choice moves ids alone; the driver receives no more than the sample, whatever repeats.
    Rows with a null id, text or language are ignored."""
    df = pick(docs, id=id_col, text=text_col, lang=lang_col).where("id is not null and text is not null and lang is not null")
    df = df.where(F.octet_length("text") <= max_bytes // 8).withColumn("t", F.xxhash64("text"))
    ids = df.select("id", "lang", "t").join(good.select(F.col(good.columns[0]).alias("id")).distinct(), "id").distinct()
    langs = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).select("lang")
    w = Window.partitionBy("lang").orderBy("h", "id", "t")
    # at most max_languages rows, and then at most docs_per_language for each of them
    chosen = ids.join(F.broadcast(langs), "lang", "left_semi").withColumn("h", content_key("id", seed=7))
    chosen = chosen.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= docs_per_language).select("id", "lang", "t", "rank")
    rows = df.join(F.broadcast(chosen), ["id", "lang", "t"]).dropDuplicates(["lang", "rank"]).select("lang", "rank", "text").collect()
    out: dict[str, bytes] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r["rank"])):
        more = _folded(r.text) + b" "
        if len(out.get(r.lang, b"")) + len(more) <= max_bytes:
            out[r.lang] = out.get(r.lang, b"") + more
    return dict(sorted(out.items()))


def _folded(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


class Coder:
    """Compressors of every language."""

    def __init__(self, dictionaries: Mapping[str, bytes], level: int = LEVEL):
        self.names = list(dictionaries)
        self.coders = [self._make(b, level) for b in dictionaries.values()]

    @staticmethod
    def _make(raw: bytes, level: int) -> zs.ZstdCompressor:
        d = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zs.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, text: str | None) -> list[int]:
        b = _folded(text or "")
        chunks = [b[i : i + CHUNK] for i in range(0, len(b), CHUNK)]
        return [sum(len(c.compress(x)) for x in chunks) for c in self.coders]

    def judge(self, text: str | None, min_margin: float) -> tuple[str | None, float]:
        ranked = sorted(zip(self.sizes(text), self.names))
        if not ranked or not ranked[0][0]:
            return None, 0.0
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        margin = (ranked[1][0] - ranked[0][0]) / ranked[0][0]
        return (ranked[0][1] if margin >= min_margin and margin > 0 else None), margin


def language_of(text: Column | str, dictionaries: Mapping[str, bytes], min_margin: float = 0.01, level: int = LEVEL) -> Column:
    """Column struct(language, margin): the margin is the second best size over the best,
    less one. The language is null where the margin is below ``min_margin`` or zero (a
    tie), and for null and blank texts. Texts of any length are encoded whole."""

    @F.pandas_udf(RESULT)
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Coder(dictionaries, level)
        for texts in parts:
            yield pd.DataFrame([coder.judge(t, min_margin) for t in texts], columns=["language", "margin"])

    return once(judge)(F.col(text) if isinstance(text, str) else text)


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float = 0.01) -> DataFrame:
    """(id, language, margin) of the documents whose language is clear; the others are
    rejected, and so are null and blank texts and ties. Repeated rows and null ids are kept
    as they come; other columns are ignored; an empty table gives no rows."""
    df = pick(docs, id=id_col, text=text_col)
    out = df.select(F.col("id").alias(id_col), language_of("text", dictionaries, min_margin).alias("found"))
    return out.select(id_col, "found.language", F.round("found.margin", 6).alias("margin")).where("language is not null")
