"""Nearest neighbours by randomly rotated one-bit codes.

Every vector's direction is turned by one random rotation (after padding to
``code_bits`` axes) and only the signs are kept, packed eight to a byte, with two
correction scalars: the vector's length, and the inner product of the turned
direction with its own signs.  The inner product of the signs with a turned
query, divided by that correction, is an unbiased estimate of the inner product
of the directions; its error is within ``bound * sqrt((1 - f^2) / f^2 / (D - 1))``
for a correction ``f`` and ``D`` axes, but for one pair in some ten thousand at
``bound`` = 4.  Vectors whose estimate plus error reaches the worst of the
query's ``k`` best are reranked by the inner product of the original vectors in
double precision.

Queries are a set of rows that is searched in blocks: each block of queries
meets each chunk of the coded vectors once, in a task that streams the chunk and
holds the block with its ``k`` best.  What a task returns is ``k`` rows a query
at most; the last step ranks those.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import ready_workers, written
from riskspark.llm.embed_dedup import rotation

#: Vectors estimated at once, pairs reranked at once, and pairs held before only the best stay.
SCAN_ROWS = 1024
RERANK_PAIRS = 1 << 14
HELD_PAIRS = 1 << 19


def code_width(dim: int, bits_per_axis: int) -> int:
    """Axes of the code: a multiple of 64."""
    return -(-dim * bits_per_axis // 64) * 64


@cache
def _turn(dim: int, width: int) -> np.ndarray:
    """Rows of a random rotation of ``width`` axes: what padding with zeros and turning does to the first ``dim`` axes."""
    return np.ascontiguousarray(rotation(width)[:dim])


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; scaled by the largest component first, so that tiny or huge vectors keep their direction."""
    top = np.abs(x).max(1, keepdims=True)
    u = x / top
    size = np.linalg.norm(u, axis=1, keepdims=True)
    with np.errstate(over="ignore"):
        return u / size, (size * top)[:, 0]


def encode(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, corrections) of vectors in double precision."""
    u, size = directions(x)
    turned = u @ _turn(x.shape[1], width)
    return np.packbits(turned >= 0, axis=1), size, np.abs(turned).sum(1) / math.sqrt(width)


class Block:
    """A block of queries with the best rows seen so far."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, k: int, width: int, bound: float):
        self.rows, self.q, self.k, self.width, self.bound = rows, q, k, width, bound
        u, self.size = directions(q)
        self.turned = np.ascontiguousarray((u @ _turn(q.shape[1], width)).T.astype(np.float32))
        self.columns = np.ascontiguousarray(q.T)
        # the best so far, by query, score descending, id ascending (no id last)
        self.at, self.score, self.ident, self.void = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64, bool))
        self.floor = np.full(len(rows), -math.inf)

    def scan(self, rows: np.ndarray, ident: np.ndarray, void: np.ndarray, x: np.ndarray, code: np.ndarray, size: np.ndarray, fit: np.ndarray) -> None:
        signs = np.unpackbits(code, axis=1, count=self.width).astype(np.float32)
        signs *= 2
        signs -= 1
        with np.errstate(all="ignore"):
            length = size[:, None] * self.size[None, :]
            about = (signs @ self.turned) / (math.sqrt(self.width) * fit)[:, None].astype(np.float32)
            # the slack covers single precision
            off = (self.bound * np.sqrt(np.maximum(1 - fit * fit, 0) / (fit * fit * max(1, self.width - 1))) + 1e-4)[:, None]
            most, least = (about + off) * length, (about - off) * length
            own = rows[:, None] == self.rows[None, :]
            if own.any():
                least[own] = -math.inf
            floor = self.floor
            if len(rows) >= self.k:
                floor = np.fmax(floor, np.partition(least, len(rows) - self.k, axis=0)[len(rows) - self.k])
            # written so that what overflows is reranked
            v, q = np.nonzero(~(most < floor[None, :]) & ~own)
        held = [(self.at, self.score, self.ident, self.void)]
        for s in range(0, len(v), RERANK_PAIRS):
            a, c = v[s:s + RERANK_PAIRS], q[s:s + RERANK_PAIRS]
            exact = inner(x, self.columns, a, c)
            good = exact >= self.floor[c]
            a, c = a[good], c[good]
            held.append((c, exact[good], ident[a], void[a]))
            if sum(len(h[0]) for h in held) > HELD_PAIRS:
                held = [self._best(held)]
        if len(held) > 1 or held[0][0] is not self.at:
            self.at, self.score, self.ident, self.void = self._best(held)
            full = np.flatnonzero(np.bincount(self.at, minlength=len(self.rows)) >= self.k)
            if len(full):
                last = np.searchsorted(self.at, full, "right") - 1
                self.floor[full] = self.score[last]

    def _best(self, held):
        at, score, ident, void = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((ident, void, -score, at))
        at = at[order]
        order = order[np.arange(len(at)) - np.searchsorted(at, at) < self.k]
        return tuple(c[order] for c in (np.concatenate([h[0] for h in held]), score, ident, void))


def inner(x: np.ndarray, columns: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows ``a`` of x with columns ``c``, summed from the first component to the last."""
    out = np.zeros(len(a))
    with np.errstate(all="ignore"):
        for j, column in enumerate(columns):
            out += x[a, j] * column[c]
    return out


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, bits_per_axis: int = 4,
            bound: float = 4.0, block_rows: int = 1024, chunk_rows: int = 4096) -> DataFrame:
    """The ``k`` rows of largest inner product for each row where ``is_query`` holds: (query_id, rank, vec_id, score).

    Nearest first, equal scores by id, rows without an id last; all candidates
    if there are fewer.  A query's own row is no candidate, other rows with the
    same id or vector are.  ``score`` is the inner product of the original
    vectors in double precision, summed from the first component.  Vectors that
    are null, empty or zero or hold a null or non-finite component take no part,
    and vectors of another length are no candidates of a query.  An id that is
    no integer raises; an empty table, or one without a query, gives no rows.
    """
    if not isinstance(vectors.schema[id_col].dataType, T.IntegralType):
        raise TypeError("ids are integers")
    ready_workers(vectors.sparkSession)
    vec = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("ident"), F.col(vector_col).cast("array<double>").alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("ask"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False)))

    def code(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                own = b.take(pa.array(np.flatnonzero(dims == d)))
                x = own.column("vec").flatten().to_numpy().reshape(-1, d)
                bits, size, fit = encode(x, code_width(int(d), bits_per_axis))
                yield pa.RecordBatch.from_arrays(
                    [own.column("ident"), own.column("ask"), own.column("dim"), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in bits], pa.binary()), pa.array(size), pa.array(fit)],
                    names=["ident", "ask", "dim", "v", "code", "size", "fit"])

    index = rows.select("ident", "ask", F.size("vec").alias("dim"), "vec").mapInArrow(
        code, "ident long, ask boolean, dim int, v binary, code binary, size double, fit double")
    # the written table is the index, and fixes the row numbers
    index = written(index.withColumn("row", F.monotonically_increasing_id()))
    total, asked = index.agg(F.count(F.lit(1)), F.count_if("ask")).first()
    blocks, chunks = max(1, -(-asked // block_rows)), max(1, -(-total // chunk_rows))
    part = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    cols = ["dim", "block", "chunk", "query", "row", "ident", "v", "code", "size", "fit"]
    asks = index.where("ask").withColumn("query", F.lit(True)).withColumn("block", part(blocks, 1)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    held = index.withColumn("query", F.lit(False)).withColumn("chunk", part(chunks, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "block", "chunk"]
    met = asks.select(*cols).unionByName(held.select(*cols)).repartition(*keys).sortWithinPartitions(*keys, F.desc("query"))

    def search(batches):
        now, block, gathered = None, None, []

        def closed():
            if block is not None and len(block.at):
                yield pa.RecordBatch.from_arrays([pa.array(block.rows[block.at]), pa.array(block.ident, mask=block.void), pa.array(block.score)],
                                                 names=["ask_row", "vec_id", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(c).to_numpy() for c in keys], 1)
            query = b.column("query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1) | (query[1:] != query[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if now != tuple(key[s]):
                    yield from closed()
                    now, block, gathered = tuple(key[s]), None, []
                dim = int(key[s][0])
                own = b.slice(s, e - s)
                x = np.frombuffer(b"".join(own.column("v").to_pylist()), np.float64).reshape(-1, dim)
                row = own.column("row").to_numpy()
                if query[s]:
                    gathered.append((row, x))
                    continue
                if not gathered:
                    continue
                if block is None:
                    block = Block(np.concatenate([g[0] for g in gathered]), np.concatenate([g[1] for g in gathered]), k, code_width(dim, bits_per_axis), bound)
                bits = np.frombuffer(b"".join(own.column("code").to_pylist()), np.uint8).reshape(len(row), -1)
                ident, void = own.column("ident").fill_null(0).to_numpy(), own.column("ident").is_null().to_numpy(zero_copy_only=False)
                size, fit = own.column("size").to_numpy(), own.column("fit").to_numpy()
                for t in range(0, len(row), SCAN_ROWS):
                    at = slice(t, t + SCAN_ROWS)
                    block.scan(row[at], ident[at], void[at], x[at], bits[at], size[at], fit[at])
        yield from closed()

    found = met.mapInArrow(search, "ask_row long, vec_id long, score double")
    best = Window.partitionBy("ask_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = index.where("ask").select(F.col("row").alias("ask_row"), F.col("ident").alias("query_id"))
    return ranked.join(names, "ask_row").select("query_id", "rank", "vec_id", "score")
