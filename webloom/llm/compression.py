"""Quality rules by zstandard ratios: bytes over compressed bytes, of whole documents and
of fixed chunks, must lie in bands that depend on the length."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import once, pick

#: (bytes below which the band holds, least ratio, greatest ratio). Short texts hardly
#: compress, so they have no lower limit; longer ones find more of themselves again.
BANDS: tuple[tuple[float, float, float], ...] = ((256, 0.0, 3.0), (1024, 1.15, 3.5), (8192, 1.25, 4.0), (65536, 1.4, 4.5), (float("inf"), 1.5, 6.0))
CHUNK = 4096
RESULT = T.StructType([T.StructField(n, t()) for n, t in (("n_bytes", T.LongType), ("ratio", T.DoubleType), ("low_chunk", T.DoubleType), ("high_chunk", T.DoubleType), ("bad_chunks", T.DoubleType), ("verdict", T.StringType))])


def band(n: int, bands: Sequence[tuple[float, float, float]] = BANDS) -> tuple[float, float]:
    return next((lo, hi) for below, lo, hi in bands if n < below)


def measure(b: bytes, z: zs.ZstdCompressor, bands: Sequence[tuple[float, float, float]] = BANDS, chunk: int = CHUNK, max_bad: float = 0.25) -> tuple:
    """(bytes, ratio, least and greatest chunk ratio, share of bytes in bad chunks, verdict)."""
    n = len(b)
    if not n:
        return 0, None, None, None, None, "empty"
    ratio = n / len(z.compress(b))
    lo, hi = band(n, bands)
    verdict = "repetitive" if ratio > hi else "incompressible" if ratio < lo else "ok"
    if n <= chunk:
        return n, ratio, ratio, ratio, float(verdict != "ok"), verdict
    seen, repetitive, incompressible = [], 0, 0
    for i in range(0, n, chunk):
        part = b[i : i + chunk]
        r = len(part) / len(z.compress(part))
        low, high = band(len(part), bands)
        seen.append(r)
        repetitive += len(part) * (r > high)
        incompressible += len(part) * (r < low)
    if verdict == "ok" and repetitive + incompressible > max_bad * n:
        verdict = "repetitive chunks" if repetitive >= incompressible else "incompressible chunks"
    return n, ratio, min(seen), max(seen), (repetitive + incompressible) / n, verdict


def compression_bands(text: Column | str, bands: Sequence[tuple[float, float, float]] = BANDS, chunk: int = CHUNK, max_bad: float = 0.25, level: int = 3) -> Column:
    """Column struct(n_bytes, ratio, low_chunk, high_chunk, bad_chunks, verdict). The
    verdict is ``ok``, ``repetitive``, ``incompressible``, one of these with `` chunks``
    where only the chunks show it (more than ``max_bad`` of the bytes), or ``empty`` for
    null and empty texts. Whole texts are compressed, whatever their length."""

    @F.pandas_udf(RESULT)
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        z = zs.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        for texts in parts:
            rows = [measure((t or "").encode("utf-8", "surrogatepass"), z, bands, chunk, max_bad) for t in texts]
            yield pd.DataFrame(rows, columns=RESULT.names).astype({"n_bytes": "int64", "ratio": "float64", "low_chunk": "float64", "high_chunk": "float64", "bad_chunks": "float64"})

    return once(judge)(F.col(text) if isinstance(text, str) else text)


def within_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(id, n_bytes, ratio, low_chunk, high_chunk, bad_chunks) of the documents that pass;
    null, empty, repetitive and incompressible texts go. Null ids and repeated rows are
    kept as they come; a ratio that equals a limit is within it; other columns are ignored;
    an empty table gives no rows."""
    df = pick(docs, id=id_col, text=text_col)
    out = df.select(F.col("id").alias(id_col), compression_bands("text", **limits).alias("m")).where("m.verdict = 'ok'")
    return out.select(id_col, "m.n_bytes", *(F.round(f"m.{c}", 6).alias(c) for c in ("ratio", "low_chunk", "high_chunk", "bad_chunks")))
