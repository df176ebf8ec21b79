"""Hidden Markov language model.

Every word of the corpus has emission counts of its own, in a table that is spread over
the cluster by word hash and grows with the corpus; words that it lacks share the mass of
one word. Texts are kept in blocks of bounded size. A round of Baum-Welch sends each block
the counts of its words, and the sums of the blocks' expected counts are the next table.
Rounds go on until the log-likelihood settles. The scaled forward recursion then gives the
exact likelihood of every whole document.

With ``vocabulary`` the table is instead one of so many frequent words and ``rare`` hashed
classes for all others, which each worker holds whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, bucketed, content_key, discard, mix64, pick, shuffles_dropped, words_of, written

STATES, VOCABULARY, RARE, SEGMENT = 6, 30000, 256, 128
#: Words of a block, of a row of it, and of the texts that the training starts from.
BLOCK, CHUNK, SAMPLE = 1 << 22, 1 << 17, 1 << 20
#: Training ends when a round's relative gain in log-likelihood is below TOLERANCE, after
#: ROUNDS at the latest. On the sample, where it starts, the states first have to part.
ROUNDS, TOLERANCE, SMOOTH = 100, 1e-4, 0.01


@dataclass
class Hmm:
    vocabulary: np.ndarray  # sorted word hashes; symbols 0.. are these, then the rare classes
    rare: int
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol x state

    def symbols(self, h: np.ndarray) -> np.ndarray:
        return symbols(h, self.vocabulary, self.rare)


def symbols(h: np.ndarray, vocabulary: np.ndarray, rare: int) -> np.ndarray:
    other = (len(vocabulary) + (mix64(h) % np.uint64(rare))).astype(np.int32)
    if not len(vocabulary):
        return other
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return np.where(vocabulary[at] == h, at.astype(np.int32), other)


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, "text", 8 << 20):
        h = np.sort(words_of(batch.column("text").to_pylist())[1])
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.concatenate([first, [len(h)]]))
        yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def vocabulary_of(docs: DataFrame, text_col: str = "text", size: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words, counted over all texts; ties go
    by the hash. The driver receives these alone."""
    counts = pick(docs, text=text_col).mapInArrow(_count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(size).select("h").toArrow()
    return np.sort(np.asarray(top.column("h"), np.int64).view(np.uint64)) if top.num_rows else np.zeros(0, np.uint64)


def _encode(rows: Iterator[pa.RecordBatch], vocabulary: np.ndarray, rare: int) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, "text"):
        bounds, h = words_of(batch.column("text").to_pylist())
        seq = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(symbols(h, vocabulary, rare)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), seq], ["id", "seq"])


def initial(vocabulary: np.ndarray, rare: int, states: int, seed: int = 0) -> Hmm:
    """Random start: every word leans to some of the states."""
    g = np.random.default_rng(seed)
    emit = g.gamma(2.0, size=(len(vocabulary) + rare, states))
    move = g.dirichlet(np.full(states, 5.0), states)
    return Hmm(vocabulary, rare, g.dirichlet(np.full(states, 5.0)), move, emit / emit.sum(axis=0))


def _grid(bounds: np.ndarray, flat: np.ndarray, pad: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols as a matrix, ``pad`` where a sequence has ended; how many are longer than
    each step) of sequences of like length, longest first."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    at = 0
    while at < len(order):
        longest = n[order[at]]
        take = order[at : at + max(1, int((1 << 18) // longest))]
        m, step = n[take], np.arange(longest)
        mat = flat[np.minimum(bounds[take] + step[:, None], len(flat) - 1)]
        live = np.searchsorted(-m, -step, "left")
        if live[-1] < len(m):
            mat[step[:, None] >= m] = pad
        yield mat, live
        at += len(take)


def expected_counts(model: Hmm, bounds: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward-backward over the sequences: expected starts, moves and emissions, and the
    log-likelihood. States come first in memory, so that sums over states are sums of whole
    rows and a state's emissions are looked up and counted in one piece; what pads the
    sequences is a symbol of its own, which is dropped."""
    k, pad = len(model.start), len(model.emit)
    move, start = (np.ascontiguousarray(a.T, np.float32) for a in (model.move, model.start))
    back, emit = np.ascontiguousarray(model.move, np.float32), np.zeros((k, pad + 1), np.float32)
    emit[:, :pad] = model.emit.T
    starts, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, pad + 1)), 0.0
    for mat, live in _grid(bounds, flat, pad):
        steps, width = mat.shape
        b, a = np.empty((k, steps, width), np.float32), np.zeros((k, steps, width), np.float32)
        for j in range(k):
            emit[j].take(mat, out=b[j], mode="clip")
        scale = np.ones((steps, width), np.float32)
        cur = start[:, None] * b[:, 0]
        for t in range(steps):
            w = live[t]
            if t:
                cur = move @ a[:, t - 1, :w]
                cur *= b[:, t, :w]
            s = np.maximum(cur.sum(axis=0), np.float32(1e-37))
            scale[t, :w] = s
            np.divide(cur, s, out=a[:, t, :w])
        total += float(np.log(scale).sum(dtype=np.float64))
        beta = np.ones((k, width), np.float32)
        for t in range(steps - 1, -1, -1):
            w = live[t]
            if t < steps - 1:
                nxt = live[t + 1]
                v = b[:, t + 1, :nxt] * beta[:, :nxt]
                v /= scale[t + 1, :nxt]
                moves += back * (a[:, t, :nxt] @ v.T)
                beta[:, :nxt] = back @ v
            g = a[:, t, :w]
            g *= beta[:, :w]
            g /= np.maximum(g.sum(axis=0), np.float32(1e-37))
        starts += a[:, 0].sum(axis=1)
        sym = mat.ravel().astype(np.intp)
        for j in range(k):
            emits[j] += np.bincount(sym, a[j].ravel(), pad + 1)
    return starts, moves, np.ascontiguousarray(emits[:, :pad].T), total


def log_likelihood(model: Hmm, bounds: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each sequence by the scaled forward recursion; 0 for an
    empty one."""
    n = np.diff(bounds)
    emit, move = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    out = np.zeros(len(n))
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    at = 0
    while at < len(order):
        take = order[at : at + max(64, int((1 << 21) // n[order[at]]))]
        m = n[take]
        live = np.searchsorted(-m, -np.arange(m[0]), "left")
        first, acc = bounds[take], np.zeros(len(take))
        cur = model.start[:, None] * emit[:, flat[first]]
        for t in range(m[0]):
            w = live[t]
            if t:
                cur = (move @ cur[:, :w]) * emit[:, flat[first[:w] + t]]
            s = np.maximum(cur.sum(axis=0), 1e-300)
            acc[:w] += np.log(s)
            cur /= s
        out[take] = acc
        at += len(take)
    return out


def _cut(bounds: np.ndarray, segment: int) -> np.ndarray:
    edges = [np.arange(a, b, segment) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    return np.concatenate([*edges, bounds[-1:]]) if edges else bounds[:1]


def _expect(rows: Iterator[pa.RecordBatch], model: Hmm, segment: int) -> Iterator[pa.RecordBatch]:
    k = len(model.start)
    starts, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros(model.emit.shape), 0.0
    for batch in rows:
        seq = batch.column("seq")
        flat = np.asarray(seq.flatten(), np.int32)
        bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(seq), np.int64))])
        one = expected_counts(model, _cut(bounds, segment), flat)
        starts, moves, emits, total = starts + one[0], moves + one[1], emits + one[2], total + one[3]
    at = np.flatnonzero(emits.sum(axis=1) > 0)
    key = np.concatenate([at, np.arange(-k - 2, 0)]).astype(np.int32)
    value = np.concatenate([emits[at], moves, starts[None, :], np.full((1, k), total)])
    yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(value[:, j]) for j in range(k))], ["key", *(f"c{j}" for j in range(k))])


def baum_welch(encoded: DataFrame, model: Hmm, rounds: int = 3, segment: int = SEGMENT, smooth: float = 0.01) -> tuple[Hmm, list[float]]:
    """(model, log-likelihood before each round) of exactly ``rounds`` rounds. Sequences
    are the texts cut into segments of ``segment`` words, all of them. A round's result is
    one row for each symbol, whatever the size of the corpus."""
    k, seen = len(model.start), []
    schema = "key int, " + ", ".join(f"c{j} double" for j in range(k))
    for _ in range(rounds):
        rows = encoded.select("seq").mapInArrow(lambda it, m=model: _expect(it, m, segment), schema)
        t = rows.groupBy("key").agg(*(F.sum(f"c{j}").alias(f"c{j}") for j in range(k))).toArrow()
        key = np.asarray(t.column("key"), np.int64)
        value = np.stack([np.asarray(t.column(f"c{j}"), float) for j in range(k)], axis=1)
        order = np.argsort(key)
        key, value = key[order], value[order]
        head = k + 2 if len(key) else 0
        if not head or not (key >= 0).any():
            return model, seen
        moves, starts, total = value[:k] + smooth, value[k] + smooth, value[k + 1, 0]
        emits = np.full(model.emit.shape, smooth)
        emits[key[head:]] += value[head:]
        seen.append(float(total))
        model = Hmm(model.vocabulary, model.rare, starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
    return model, seen


def _score(rows: Iterator[pa.RecordBatch], model: Hmm) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        seq = batch.column("seq")
        n = np.asarray(pc.list_value_length(seq), np.int64)
        ll = log_likelihood(model, np.concatenate([[0], np.cumsum(n)]), np.asarray(seq.flatten(), np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(ll)], ["id", "n", "ll"])


# every word: blocks of texts, counts by word


@dataclass
class Totals:
    """What the driver holds of a model: sums over all words."""

    move: np.ndarray
    start: np.ndarray
    state: np.ndarray  # expected words in each state
    words: int  # different ones
    ll: float = 0.0


def emissions(counts: np.ndarray, totals: Totals) -> np.ndarray:
    """Probabilities of words from their counts. Smoothing follows the states' shares, so a
    word without counts tells nothing of its state; all such words have the mass of one."""
    whole = totals.state.sum()
    return (counts + SMOOTH * totals.state / whole) / (totals.state * (1 + SMOOTH * (totals.words + 1) / whole))


def leaning(h: np.ndarray, states: int, seed: int) -> np.ndarray:
    """Random start by hash alone: every word leans to some of the states."""
    out = np.ones((len(h), states))
    for j in range(states):
        for i in (1, 2):
            x = mix64(h + mix64(np.array([seed * 1000003 + 2 * j + i], np.uint64)))
            out[:, j] *= (x >> np.uint64(11)).astype(float) * 2.0**-53 + 1e-12
    return -np.log(out)


def initial_totals(states: int, words: int, seed: int) -> Totals:
    g = np.random.default_rng(seed)
    start = g.dirichlet(np.full(states, 5.0))
    return Totals(g.dirichlet(np.full(states, 5.0), states), start, np.zeros(states), words)


def _slices(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's words begin among sorted hashes, and their number."""
    edges = np.array([(q << 64) // buckets for q in range(buckets)], np.uint64)
    return np.append(np.searchsorted(h, edges), len(h))


def _block(rows: list[tuple[list, np.ndarray, np.ndarray]], block: int, buckets: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    h, seq = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
    seq, at, docs = seq.astype(np.int32), 0, []
    for ids, bounds, words in rows:
        docs.append((block, -1, ids, np.diff(bounds).tobytes(), seq[at : at + len(words)].tobytes(), None))
        at += len(words)
    cut = _slices(h, buckets)
    docs += [(block, q, None, None, None, h[a:b].tobytes()) for q, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
    types = (pa.int64(), pa.int32(), pa.list_(kind), pa.binary(), pa.binary(), pa.binary())
    for row in docs:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["block", "bucket", "ids", "n", "seq", "h"])


def _blocks(rows: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of about ``most`` words of whole texts: rows of ids, lengths and the places
    of words among the block's own sorted words, and a row of those for each bucket."""
    held, size, block, kind = [], 0, TaskContext.get().partitionId() << 32, pa.null()
    for batch in batches(rows, "text", 6 * min(CHUNK, most)):
        bounds, h = words_of(batch.column("text").to_pylist())
        kind = batch.column("id").type
        held.append((batch.column("id").to_pylist(), bounds, h))
        size += len(h)
        if size >= most:
            yield from _block(held, block, buckets, kind)
            held, size, block = [], 0, block + 1
    if held:
        yield from _block(held, block, buckets, kind)


COUNTS = "block bigint, bucket int, h binary, c binary"
#: Of words whose places in their bucket are known.
SUMS = "block bigint, bucket int, c binary"
PLACES = "block bigint, bucket int, gaps binary, n bigint"


def _counted(block: int, counts: np.ndarray, cut: list[tuple[int, int, int]], totals: Totals) -> pa.Table:
    """Rows of counts for each bucket; one of bucket -1 with what the driver sums up."""
    c = counts.astype(np.float32)
    rest = np.concatenate([totals.move.ravel(), totals.start, counts.sum(axis=0), [totals.ll]])
    rows = [(block, -1, rest.tobytes())] + [(block, q, c[a:b].tobytes()) for q, a, b in cut]
    return _table(rows, SUMS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [x.split() for x in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(named)], names=[name for name, _ in named])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(v or b"" for v in column.to_pylist()), kind)


def _pool(t: pa.Table, states: int) -> pa.Table:
    """Each block's words of this bucket with their counts in all blocks. Rows without
    counts only ask, those of block -1 only give."""
    h = [np.frombuffer(x, np.uint64) for x in t.column("h").to_pylist()]
    c = [np.zeros((len(x), states)) if y is None else np.frombuffer(y, np.float32).reshape(-1, states) for x, y in zip(h, t.column("c").to_pylist())]
    words, at = np.unique(np.concatenate(h), return_inverse=True)
    flat = np.concatenate(c)
    total = np.stack([np.bincount(at, flat[:, j], len(words)) for j in range(states)], axis=1).astype(np.float32)
    ends = np.cumsum([len(x) for x in h])
    rows = [(b, q, x.tobytes(), total[at[e - len(x) : e]].tobytes()) for b, q, x, e in zip(t.column("block").to_pylist(), t.column("bucket").to_pylist(), h, ends) if b >= 0]
    return _table(rows, COUNTS)


def _places(t: pa.Table) -> pa.Table:
    """Where each block's words are among the sorted ones of this bucket, as gaps; and how
    many these are, in one of the rows."""
    h = [np.frombuffer(x, np.uint64) for x in t.column("h").to_pylist()]
    words, at = np.unique(np.concatenate(h), return_inverse=True)
    parts = np.split(at.astype(np.int32), np.cumsum([len(x) for x in h])[:-1])
    rows = [(b, q, np.diff(x, prepend=np.int32(0)).tobytes(), 0 if i else len(words)) for i, (b, q, x) in enumerate(zip(t.column("block").to_pylist(), t.column("bucket").to_pylist(), parts))]
    return _table(rows, PLACES)


def _sums(t: pa.Table, places: pa.Table, states: int) -> pa.Table:
    """What ``_pool`` gives, of words whose places are known, without their hashes."""
    at = {b: np.cumsum(np.frombuffer(x, np.int32)) for b, x in zip(places.column("block").to_pylist(), places.column("gaps").to_pylist())}
    total = np.zeros((pc.sum(places.column("n")).as_py(), states))
    for b, c in zip(t.column("block").to_pylist(), t.column("c").to_pylist()):
        total[at[b]] += np.frombuffer(c, np.float32).reshape(-1, states)
    total, q = total.astype(np.float32), places.column("bucket")[0].as_py()
    return _table([(b, q, total[x].tobytes()) for b, x in at.items()], SUMS)


def _model(words: pa.Table, totals: Totals, seed: int) -> Hmm:
    """The model with the emissions of a block's words, which come in order of buckets."""
    k = len(totals.start)
    if not totals.state.any():
        h = _joined(words.column("h"), np.uint64)
        return Hmm(h, 0, totals.start, totals.move, leaning(h, k, seed))
    c = _joined(words.column("c"), np.float32).reshape(-1, k)
    return Hmm(np.zeros(0, np.uint64), 0, totals.start, totals.move, emissions(c, totals))


def _expect_block(docs: pa.Table, words: pa.Table, totals: Totals, segment: int, seed: int) -> pa.Table:
    words, k = words.sort_by("bucket"), len(totals.start)
    bounds = np.concatenate([[0], np.cumsum(_joined(docs.column("n"), np.int64))])
    starts, moves, emits, ll = expected_counts(_model(words, totals, seed), _cut(bounds, segment), _joined(docs.column("seq"), np.int32))
    ends = np.cumsum([len(c) // (4 * k) for c in words.column("c").to_pylist()], dtype=np.int64)
    cut = list(zip(words.column("bucket").to_pylist(), [0, *ends], ends))
    return _counted(docs.column("block")[0].as_py(), emits, cut, Totals(moves, starts, emits.sum(axis=0), 0, ll))


def _score_block(docs: pa.Table, words: pa.Table, totals: Totals, seed: int) -> pa.Table:
    model = _model(words.sort_by("bucket"), totals, seed)
    n = _joined(docs.column("n"), np.int64)
    ll = log_likelihood(model, np.concatenate([[0], np.cumsum(n)]), _joined(docs.column("seq"), np.int32))
    return pa.table([pa.chunked_array([x.flatten() for x in docs.column("ids").chunks]), pa.array(n), pa.array(ll)], names=["id", "n", "ll"])


def _updated(rest: np.ndarray, words: int, states: int) -> Totals:
    k = states
    move, start = rest[: k * k].reshape(k, k) + SMOOTH, rest[k * k : k * k + k] + SMOOTH
    return Totals(move / move.sum(axis=1, keepdims=True), start / start.sum(), rest[k * k + k : -1], words, float(rest[-1]))


def _settled(seen: list[float], tolerance: float) -> bool:
    return len(seen) > 1 and seen[-1] - seen[-2] < tolerance * abs(seen[-2])


def _fit_sample(t: pa.Table, states: int, rounds: int, tolerance: float, buckets: int, segment: int, seed: int) -> pa.Table:
    bounds, flat = words_of(t.column("text").to_pylist())
    h, seq = np.unique(flat, return_inverse=True)
    cut, seq, totals, seen = _cut(bounds, segment), seq.astype(np.int32), initial_totals(states, len(h), seed), []
    emit = leaning(h, states, seed)
    emit /= emit.sum(axis=0)
    for _ in range(rounds):
        starts, moves, counts, ll = expected_counts(Hmm(h, 0, totals.start, totals.move, emit), cut, seq)
        if not counts.any():
            break
        found = Totals(moves, starts, counts.sum(axis=0), len(h), ll)
        totals = _updated(np.concatenate([moves.ravel(), starts, counts.sum(axis=0), [ll]]), len(h), states)
        emit = emissions(counts, totals)
        seen.append(ll)
        # a gain as small as this also occurs before the states part
        if len(seen) > 20 and _settled(seen, tolerance):
            break
    if not seen:
        return _table([], COUNTS)
    ends = _slices(h, buckets)
    cut = [(q, a, b) for q, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a]
    given = _counted(-1, counts, cut, found)
    return given.add_column(2, "h", pa.array([None, *(h[a:b].tobytes() for _, a, b in cut)], pa.binary()))


@dataclass
class Fitted:
    blocks: DataFrame
    places: DataFrame  # of the blocks' words in their buckets
    counts: DataFrame  # of all words, by block and bucket; before the first round those of the sample, with hashes
    totals: Totals
    seen: list[float]  # log-likelihood of all texts before each round
    seed: int

    def asked(self) -> DataFrame:
        return self.blocks.where("bucket >= 0").select("block", "bucket", "h")

    def sums(self) -> DataFrame:
        """Of each block and bucket the words' counts in all blocks."""
        k, counts = len(self.totals.start), self.counts.where("bucket >= 0")
        if "h" in self.counts.columns:
            rows = counts.unionByName(self.asked().withColumn("c", F.lit(None).cast("binary")))
            return rows.groupBy("bucket").applyInArrow(lambda t: _pool(t, k), COUNTS)
        return counts.groupBy("bucket").cogroup(self.places.groupBy("bucket")).applyInArrow(lambda t, p: _sums(t, p, k), SUMS)

    def pooled(self) -> DataFrame:
        """The same with the words' hashes."""
        sums = self.sums()
        return sums if "h" in sums.columns else self.asked().join(sums, ["block", "bucket"])

    def by_block(self, f: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
        """``f`` of each block's texts, which stay where they are, and of its words with
        their counts."""
        texts = self.blocks.where("bucket = -1").select("block", "ids", "n", "seq")
        return texts.groupBy("block").cogroup(self.sums().groupBy("block")).applyInArrow(f, schema)

    def summed(self) -> np.ndarray | None:
        rows = self.counts.where("bucket = -1").select("c").toArrow().column("c").to_pylist()
        return np.sum([np.frombuffer(r) for r in rows], axis=0) if rows else None


def fit(raw: DataFrame, states: int = STATES, rounds: int = ROUNDS, tolerance: float = TOLERANCE, segment: int = SEGMENT, seed: int = 0, block: int = BLOCK, sample: int = SAMPLE) -> Fitted:
    """Baum-Welch over all texts and words of ``raw`` (id, text) until the log-likelihood
    of all texts settles. It starts from a model of about ``sample`` words, that of some of
    the texts by hash, so that the states have parted before all texts are read."""
    chars = raw.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    buckets, part = max(8, chars >> 26), max(1, chars // (6 * sample))
    some = raw.where(F.pmod(content_key("text", seed=seed), F.lit(part)) == 0).select(F.lit(0).alias("one"), "text")
    begun = written(some.groupBy("one").applyInArrow(lambda t: _fit_sample(t, states, rounds, tolerance / 5, buckets, segment, seed), COUNTS), "hmm-sample")
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("ids", T.ArrayType(raw.schema["id"].dataType)), *(T.StructField(c, T.BinaryType()) for c in ("n", "seq", "h"))])
    blocks = bucketed(raw.mapInArrow(lambda it: _blocks(it, buckets, block), schema), "hmm-blocks", "block")
    asked = blocks.where("bucket >= 0").select("block", "bucket", "h")
    places = bucketed(asked.groupBy("bucket").applyInArrow(_places, PLACES), "hmm-places", "bucket")
    words = places.agg(F.sum("n")).first()[0] or 0
    fitted = Fitted(blocks, places, begun, initial_totals(states, words, seed), [], seed)
    rest = fitted.summed()
    if rest is not None:
        fitted.totals = _updated(rest, words, states)
    for _ in range(rounds if words else 0):
        totals = fitted.totals
        with shuffles_dropped(raw.sparkSession):
            counts = written(fitted.by_block(lambda a, b: _expect_block(a, b, totals, segment, seed), SUMS), "hmm-counts", "snappy")
        discard(begun)
        begun = fitted.counts = counts
        fitted.totals = _updated(fitted.summed(), words, states)
        if totals.state.any():  # a random start has no proper likelihood
            fitted.seen.append(fitted.totals.ll)
        if _settled(fitted.seen, tolerance):
            break
    return fitted


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, vocabulary: int | None = None, rare: int = RARE, rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """(id, n_words, log_likelihood, perplexity) of every document under a model trained
    on all of them, until it settles or for ``rounds``. Words are compared in lower case.
    A null, empty or wordless text has no words, likelihood 0 and a null perplexity. Null
    ids and repeated rows are kept as they come, each repetition counting in the training;
    other columns are ignored; an empty table gives no rows. Without ``vocabulary`` every
    word counts as itself."""
    raw = pick(docs, id=id_col, text=text_col)
    out = T.StructType([raw.schema["id"], T.StructField("n", T.LongType()), T.StructField("ll", T.DoubleType())])
    if vocabulary is None:
        fitted = fit(raw, states, rounds, seed=seed)
        totals = fitted.totals
        scored = fitted.by_block(lambda a, b: _score_block(a, b, totals, seed), out)
    else:
        words = vocabulary_of(raw, "text", vocabulary)
        schema = T.StructType([raw.schema["id"], T.StructField("seq", T.ArrayType(T.IntegerType()))])
        encoded = written(raw.mapInArrow(lambda it: _encode(it, words, rare), schema), "hmm-encoded")
        model, _ = baum_welch(encoded, initial(words, rare, states, seed), rounds)
        scored = encoded.mapInArrow(lambda it: _score(it, model), out)
    return scored.select(F.col("id").alias(id_col), F.col("n").alias("n_words"), F.round("ll", 4).alias("log_likelihood"), F.when(F.col("n") > 0, F.round(F.exp(-F.col("ll") / F.col("n")), 4)).alias("perplexity"))
