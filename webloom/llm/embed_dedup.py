"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors are rotated at random and split into low-dimensional blocks. If two vectors
are within squared distance e, some block of d' of the d dimensions is within e d'/d. Each
block is range-joined within that budget and the union of the candidates is verified on
the whole vectors, so the result is exact.

The range join of a block has two levels. Cells of a k-d tree over the block's dimensions
spread it over the cluster: a vector is at home in one cell and reaches every cell whose
box is within the block's radius. A cell that many vectors reach is salted, so that no
task gets more than a bounded number of either. Within a task the vectors at home are
split further, each part meets what reaches its box, and distances are matrix products.
Pairs leave no task: a pair counts in the first block whose budget it keeps, and a task
gives the sums of its counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, pick, written

BLOCKS = 8
#: Vectors at home in a cell, vectors that a task lets reach it, and vectors on which the
#: cells are fitted (they decide where work is done, not what is found).
CELL, REACH, SAMPLE = 1 << 15, 1 << 17, 1 << 14
LEAF, TILE, PAIRS = 512, 8192, 1 << 12
#: Rows that are spread at once, and rows of a batch that comes out of them.
PIECE, OUT = 1 << 12, 1 << 13


def rotation(dims: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


class Subspaces:
    """The blocks of one length of vectors, with the budget of each."""

    def __init__(self, dims: int, min_cosine: float, blocks: int):
        blocks = max(1, min(blocks, dims))
        self.min_cosine, self.turn = min_cosine, rotation(dims)
        self.bounds = [round(i * dims / blocks) for i in range(blocks + 1)]
        budget = max(0.0, 2 - 2 * min_cosine)
        self.limits = np.array([budget * (b - a) / dims * (1 + 1e-9) + 1e-12 for a, b in zip(self.bounds, self.bounds[1:])])

    def part(self, unit: np.ndarray, block: int) -> np.ndarray:
        return unit @ self.turn[:, self.bounds[block] : self.bounds[block + 1]]

    def belongs(self, diff: np.ndarray, block: int) -> np.ndarray:
        """Whether ``block`` is the first whose budget each difference keeps. Element by
        element, so that every task finds the same to the last bit."""
        out = np.zeros(len(diff), bool)
        left, d = np.arange(len(diff)), np.ascontiguousarray(diff.T)
        for b in range(block + 1):
            part = self.turn[:, self.bounds[b] : self.bounds[b + 1]]
            turned = np.zeros((part.shape[1], len(left)))
            for j in range(len(d)):
                turned += part[j][:, None] * d[j][None, :]
            total = np.zeros(len(left))
            for row in turned:
                total += row * row
            kept = total <= self.limits[b]
            if b == block:
                out[left[kept]] = True
            left, d = left[~kept], d[:, ~kept]
        return out


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(float)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def outside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points from a box."""
    gap = np.maximum(low - x, 0) + np.maximum(x - high, 0)
    return (gap * gap).sum(axis=1)


def boxes(x: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The cells of a k-d tree that halves the points of ``x`` ``depth`` times along their
    widest dimension. They cover the whole space."""
    every = np.full(x.shape[1], np.inf)
    cells = [(x, -every, every)]
    for _ in range(depth):
        new = []
        for points, low, high in cells:
            k = int(np.argmax(np.ptp(points, axis=0))) if len(points) else 0
            at = float(np.median(points[:, k])) if len(points) else 0.0
            left, right = high.copy(), low.copy()
            left[k] = right[k] = min(max(at, low[k]), high[k])
            new += [(points[points[:, k] < at], low, left), (points[points[:, k] >= at], right, high)]
        cells = new
    return [(low, high) for _, low, high in cells]


Cells = list[tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]]


def cells_of(space: Subspaces, sample: np.ndarray, n: int, cell: int, reach: int) -> Cells:
    """For each block its cells and the salts of each."""
    depth = max(0, int(np.ceil(np.log2(max(1, n) / cell))))
    depth = min(depth, max(0, int(np.log2(max(1, len(sample)) / 16))))
    out = []
    for b, limit in enumerate(space.limits):
        x = space.part(sample, b)
        found = boxes(x, depth)
        out.append((found, [max(1, int(np.ceil(n * (outside(x, *c) <= limit).mean() / reach))) if len(x) else 1 for c in found]))
    return out


def _code(rows: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The vectors as bytes; null where an entry is null or not finite, or all are zero."""
    for batch in rows:
        col = batch.column("v")
        size = np.asarray(pc.fill_null(pc.list_value_length(col), 0), np.int64)
        x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), float) + 0.0
        end = np.cumsum(size)
        start = end - size
        odd, some = (np.concatenate([[0], np.cumsum(m)]) for m in (~(np.abs(x) < 1e300), x != 0))
        good = (odd[end] == odd[start]) & (some[end] > some[start])
        data, w = x.astype(kind).tobytes(), np.dtype(kind).itemsize
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([data[a * w : b * w] if g else None for a, b, g in zip(start, end, good)], pa.binary())], ["id", "vec"])


def _spread(rows: Iterator[pa.RecordBatch], space: Subspaces, cells: Cells, kind: str) -> Iterator[pa.RecordBatch]:
    """A row for each task a vector takes part in; ``role`` 1: at home, 2: in reach, 3: both.
    The more vectors, the more tasks one of them takes part in, so batches are bounded by
    what comes out of them."""
    for whole in rows:
        for k in range(0, whole.num_rows, PIECE):
            batch = whole.slice(k, PIECE)
            u = units(batch.column("vec").to_pylist(), kind)
            node = np.asarray(batch.column("node"), np.int64)
            h = mix64(node.view(np.uint64))
            for b, (found, salts) in enumerate(cells):
                x = space.part(u, b)
                away = np.stack([outside(x, *c) for c in found], axis=1)
                home = away.argmin(axis=1)  # the first of the boxes that hold it
                at, c = np.nonzero(away <= space.limits[b])
                own, count = home[at] == c, np.array(salts)[c]
                slot = (h[at] % count.astype(np.uint64)).astype(np.int64)
                # at home in all salts of a cell, in reach in one of them
                times = np.where(own, count, 1)
                first = np.cumsum(times) - times
                at, c, own, slot = (np.repeat(z, times) for z in (at, c, own, slot))
                salt = np.where(own, np.arange(len(at)) - np.repeat(first, times), slot)
                role = own * 1 + (salt == slot) * 2
                for i in range(0, len(at), OUT):
                    on = slice(i, i + OUT)
                    picked = batch.take(pa.array(at[on]))
                    rest = (np.full(len(at[on]), b), c[on], salt[on], role[on])
                    yield pa.RecordBatch.from_arrays([picked.column("node"), picked.column("copies"), picked.column("vec"), *(pa.array(z.astype(np.int32)) for z in rest)], ["node", "copies", "vec", "block", "cell", "salt", "role"])


def _join(space: Subspaces, block: int, home: np.ndarray, reach: np.ndarray, u: np.ndarray, node: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each vector at home (by index into ``u``), how many rows among those in reach
    are near it and belong to this block."""
    y = space.part(u, block)
    limit = float(space.limits[block])
    small, loose = y.astype(np.float32), np.float32(limit + 1e-5)
    links = np.zeros(len(u), np.int64)

    def leaf(own: np.ndarray, near: np.ndarray) -> None:
        a = small[own]
        a2 = (a * a).sum(axis=1)[:, None]
        for k in range(0, len(near), TILE):
            other = near[k : k + TILE]
            b = small[other]
            apart2 = a @ (-2 * b.T)
            apart2 += a2
            apart2 += (b * b).sum(axis=1)
            i, j = np.divmod(np.flatnonzero(apart2 <= loose), len(other))
            i, j = own[i], other[j]
            apart = node[i] != node[j]
            i, j = i[apart], j[apart]
            for p in range(0, len(i), PAIRS):
                x, z = i[p : p + PAIRS], j[p : p + PAIRS]
                close = (u[x] * u[z]).sum(axis=1) >= space.min_cosine
                x, z = x[close], z[close]
                if len(x):
                    mine = space.belongs(u[x] - u[z], block)
                    np.add.at(links, x[mine], copies[z[mine]])

    todo = [(home, reach)]
    while todo:
        own, near = todo.pop()
        if not len(own):
            continue
        low, high = y[own].min(axis=0), y[own].max(axis=0)
        near = near[outside(y[near], low, high) <= limit + 1e-9]
        if len(own) <= LEAF or not len(near):
            leaf(own, near)
            continue
        order = own[np.argpartition(y[own, int(np.argmax(high - low))], len(own) // 2)]
        todo += [(order[: len(own) // 2], near), (order[len(own) // 2 :], near)]
    return links


def _task(rows: Iterator[pa.RecordBatch], space: Subspaces, kind: str) -> Iterator[pa.RecordBatch]:
    """Reads its group batch by batch, so that of each vector only its numbers stay."""
    parts: list[tuple[np.ndarray, ...]] = []
    block = 0
    for batch in rows:
        if batch.num_rows:
            block = batch.column("block")[0].as_py()
            # copies, as the batch goes
            parts.append((units(batch.column("vec").to_pylist(), kind), *(np.array(batch.column(c), np.int64) for c in ("role", "node", "copies"))))
    if not parts:
        return
    u, role, node, copies = (np.concatenate(p) for p in zip(*parts))
    parts.clear()
    links = _join(space, block, np.flatnonzero(role & 1), np.flatnonzero(role & 2), u, node, copies)
    on = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(links[on])], ["node", "links"])


def near_links(vectors: DataFrame, min_cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", blocks: int = BLOCKS, cell: int = CELL, reach: int = REACH) -> DataFrame:
    """(id, class_id, copies, links), one row for each row of ``vectors``. A class is the
    rows whose vectors are equal, named by its least id, and ``copies`` is their number;
    ``links`` counts the other rows whose cosine is at least ``min_cosine``, copies
    included. Nothing is capped: every such row counts.

    Null, empty and zero vectors and vectors with a null or non-finite entry are in no
    class (null) and have no copies or links; vectors of different lengths aren't compared
    with each other. Rows that repeat an id are each a row, null ids too. Other columns
    are ignored; an empty table gives no rows.
    """
    raw = pick(vectors, id=id_col, v=vector_col)
    kind = "<f4" if raw.schema["v"].dataType.elementType == T.FloatType() else "<f8"
    if kind == "<f8":
        raw = raw.withColumn("v", F.col("v").cast("array<double>"))
    schema = T.StructType([raw.schema["id"], T.StructField("vec", T.BinaryType())])
    coded = written(raw.mapInArrow(lambda it: _code(it, kind), schema), "emb-coded")
    classes = coded.where("vec is not null").groupBy("vec").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    # equal vectors are one node, so copies don't multiply the work
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "emb-class")
    lengths = classes.groupBy(F.octet_length("vec").alias("bytes")).count().collect()
    width = np.dtype(kind).itemsize
    found = [_counts(classes.where(F.octet_length("vec") == r["bytes"]), r["bytes"] // width, r["count"], min_cosine, blocks, cell, reach, kind) for r in sorted(lengths)]
    own = F.col("copies") - 1 if min_cosine <= 1 else F.lit(0)
    if found:
        links = reduce(DataFrame.union, found).groupBy("node").agg(F.sum("links").alias("links"))
        classes = classes.join(links, "node", "left")
    else:
        classes = classes.withColumn("links", F.lit(0).cast("long"))
    classes = classes.select("vec", "class_id", "copies", (own + F.coalesce("links", F.lit(0))).alias("links"))
    out = coded.join(classes, "vec", "left")
    return out.select(F.col("id").alias(id_col), "class_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("copies", "links")))


def _counts(nodes: DataFrame, dims: int, n: int, min_cosine: float, blocks: int, cell: int, reach: int, kind: str) -> DataFrame:
    """(node, links) of the vectors of one length; a node may occur more than once."""
    space = Subspaces(dims, min_cosine, blocks)
    sample = []
    if n > cell:
        sample = [bytes(r.vec) for r in nodes.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(SAMPLE).collect()]
    cells = cells_of(space, units(sample, kind) if sample else np.zeros((0, dims)), n, cell, reach)
    rows = nodes.select("node", "copies", "vec").mapInArrow(lambda it: _spread(it, space, cells, kind), "node bigint, copies bigint, vec binary, block int, cell int, salt int, role int")

    def task(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _task(group, space, kind)

    counts = rows.groupBy("block", "cell", "salt").applyInArrow(task, "node bigint, links bigint")
    return written(counts, "emb-links")
