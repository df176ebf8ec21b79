"""Helpers shared by the training-data operators: tables in the cluster's shared
folder, vectorised word hashing, hashed linear features."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, written  # noqa: F401  (written is for the operators)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 18
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bucketed(df: DataFrame, tag: str, key: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``, as many as the session has
    shuffle partitions, and read again: what groups by the key needs no shuffle."""
    spark = df.sparkSession
    name = f"webloom_{tag.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/webloom/{tag}-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(n, key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the table that was read knows its buckets
    return out


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends, not when the driver happens to
    collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` gave and nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB (one row at least), where the session sets no bound
    of its own: Spark's default of 10,000 rows can be gigabytes of long texts."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(8 << 20))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that extra columns of
    the input can't clash with internal ones. Every operator starts here, so this also
    bounds the batches that Python workers get."""
    bound_batches(df.sparkSession)
    return df.select(*(F.col(f"`{c}`").alias(name) for name, c in columns.items()))


def once(udf):
    """A UDF that a filter on its result doesn't evaluate a second time: what is taken for
    deterministic is copied into the filter that Spark pushes below it."""
    return udf.asNondeterministic()


def content_key(*cols: str | Column, seed: int = 0) -> Column:
    """Deterministic pseudo-random order key."""
    return F.xxhash64(F.lit(seed), *(F.col(c) if isinstance(c, str) else c for c in cols))


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * _CHUNK)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)])) for p in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1]


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and 64-bit hash of each word of UTF-8 ``data``. A word is a run of
    ASCII letters, digits and non-ASCII characters; a character of three or more bytes
    (CJK and the like) starts a word of its own."""
    c = np.frombuffer(data, np.uint8)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = _WORD[c]
    before = np.concatenate([[False], word[:-1]])
    wide = c >= 0xE0
    start = np.flatnonzero(word & (~before | wide))
    after = np.concatenate([word[1:], [False]])
    inner = np.concatenate([(wide & before)[1:], [False]])
    end = np.flatnonzero(word & (~after | inner)) + 1
    power, inverse = _powers(len(c))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c.astype(np.uint64) + np.uint64(1)) * power)])
        return start, mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def words_of(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the words of text i, in lower case, are
    ``hashes[bounds[i]:bounds[i + 1]]``. Null counts as empty. Texts of any length are
    hashed in pieces of bounded size, cut between words; only a word of more than 256 KB
    counts as several."""
    counts: list[np.ndarray] = []
    found: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            start, h = hash_words(b"\n".join(held))
            edge = np.cumsum([0] + [len(b) + 1 for b in held])
            counts.append(np.diff(np.searchsorted(start, edge)))
            found.append(h)
            held.clear()
            size = 0

    for t in texts:
        b = t.lower().encode("utf-8", "surrogatepass") if t else b""
        if len(b) > _CHUNK:
            flush()
            own = [hash_words(part)[1] for part in _pieces(b)]
            counts.append(np.array([sum(map(len, own))]))
            found.extend(own)
            continue
        held.append(b)
        size += len(b) + 1
        if size > _CHUNK:
            flush()
    flush()
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(n)]).astype(np.int64), np.concatenate(found) if found else np.zeros(0, np.uint64)


def _pieces(b: bytes) -> Iterator[bytes]:
    """Cut between words. A single word of more than ``_CHUNK`` bytes is cut where a
    character starts."""
    c, at = np.frombuffer(b, np.uint8), 0
    while at < len(b):
        to = min(len(b), at + _CHUNK)
        if to < len(b):
            # after what belongs to no word, or before a character that starts one
            ends = np.flatnonzero(~_WORD[c[at:to]] | (c[at + 1 : to + 1] >= 0xE0))
            if len(ends):
                to = at + int(ends[-1]) + 1
            while to < len(b) and b[to] & 0xC0 == 0x80:
                to += 1
        yield b[at:to]
        at = to


def batches(rows: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` characters, so that a worker's memory
    doesn't depend on how long the texts are."""
    for batch in rows:
        n = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < batch.num_rows:
            base = n[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(n, base + most, "right")))
            yield batch.slice(at, to - at)
            at = to


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#$%&*!|<>{}[]=~^@_\\")] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def doc_features(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, bucket): for each text its words' hash buckets below ``2 ** bits``, repeats
    included, and three marks of its surface (symbols, capitals, repeated words)."""
    bounds, h = words_of(texts)
    n = len(texts)
    words = np.diff(bounds)
    doc = np.repeat(np.arange(n), words)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]) if len(h) else np.zeros(0, bool)
    parts = [np.bincount(doc[same], minlength=n) / np.maximum(1, words)]
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(b) for b in raw], np.int64)
    for table in (_SYMBOL, _UPPER):
        parts.append(np.array([table[np.frombuffer(b, np.uint8)].sum() for b in raw], float) / np.maximum(1, size))
    marks = [mix64(np.minimum(9, (20 * p).astype(np.uint64)) + np.uint64(1000 * (k + 1))) for k, p in enumerate(parts)]
    bucket = np.concatenate([h, *marks]) >> np.uint64(64 - bits)
    return np.concatenate([doc, *[np.arange(n)] * 3]), bucket.astype(np.int32)
