"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors of cosine ``c`` lie within squared distance 2 - 2c.  A rotation
spreads that distance over the axes; the axes are cut into ``blocks``, each with
a share of the squared distance in proportion to its axes.  A close pair keeps
within the share of at least one block, so the union of the blocks' range joins
holds every close pair.  The range join of a block lays a grid over its first
``grid_dims`` axes: a vector lives in one cell and visits the neighbouring cells
its range reaches.  Pairs that meet are held to the block's share, then verified
by their cosine in double precision, and counted in the first block whose share
they keep, hence once.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import bucket_cells, components, sorted_groups, written

#: Slack on squared distances for rounding in the rotation.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """A random rotation that depends on the dimension only."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, blocks: int) -> list[tuple[int, int]]:
    b = min(blocks, dim)
    edge = [dim * i // b for i in range(b + 1)]
    return list(zip(edge, edge[1:]))


def _units(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, so that tiny or huge vectors keep their length."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def grid_rows(x: np.ndarray, budget: float, blocks: int, grid_dims: int):
    """(row, block, cell coordinates, home) of vectors (already unit length): their own cells and those they visit.

    Visits go to lexicographically later cells only: of two vectors in different cells the one in the earlier visits the other.
    """
    z = x @ rotation(x.shape[1])
    for b, (s, e) in enumerate(block_edges(x.shape[1], blocks)):
        share = np.sqrt(budget * (e - s) / x.shape[1]) + SLACK
        axes = z[:, s:min(e, s + grid_dims)]
        width = 2 * share
        home = np.floor(axes / width).astype(np.int64)
        low = np.floor((axes - share) / width).astype(np.int64) - home
        high = np.floor((axes + share) / width).astype(np.int64) - home
        for step in product((-1, 0, 1), repeat=axes.shape[1]):
            if step < (0,) * len(step):
                continue
            step = np.array(step)
            rows = np.flatnonzero(((step >= low) & (step <= high)).all(1))
            if len(rows):
                yield rows, b, home[rows] + step, not step.any()


def cell_links(g: dict[str, np.ndarray], block: int, cosine: float, blocks: int, kind: type):
    """Direct links found in one cell: (places u, v), each pair once."""
    home, slice_ = g["home"], g["_s"]
    x = _units(np.frombuffer(b"".join(g["v"]), kind).reshape(len(home), -1))
    dim = x.shape[1]
    budget = 2 - 2 * cosine
    z = x @ rotation(dim)
    cut = block_edges(dim, blocks)
    shares = [budget * (e - s) / dim + SLACK for s, e in cut]
    s, e = cut[block]
    own = np.ascontiguousarray(z[:, s:e])
    sq = (own * own).sum(1)
    cross = g["_a"][0] != g["_b"][0]
    place = np.arange(len(x))
    step = max(1, (1 << 20) // max(1, len(x)))
    for i in range(0, len(x), step):
        rows = place[i:i + step]
        near = sq[rows][:, None] + sq[None, :] - 2 * own[rows] @ own.T <= shares[block] + SLACK
        near &= rows[:, None] < place[None, :]
        near &= home[rows][:, None] | home[None, :]
        if cross:
            near &= slice_[rows][:, None] != slice_[None, :]
        u, v = np.nonzero(near)
        u = rows[u]
        for t in range(0, len(u), 1 << 15):
            a, c = u[t:t + (1 << 15)], v[t:t + (1 << 15)]
            ok = (x[a] * x[c]).sum(1) >= cosine
            a, c = a[ok], c[ok]
            gap = (z[a] - z[c]) ** 2
            within = [gap[:, i:j].sum(1) <= share for (i, j), share in zip(cut[:block + 1], shares)]
            # counted in the first block whose share the pair keeps
            first = within[block]
            for earlier in within[:block]:
                first = first & ~earlier
            yield a[first], c[first]


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
                              cosine: float = 0.98, blocks: int = 4, grid_dims: int = 3, cell_rows: int = 2048) -> DataFrame:
    """One row (id, n_links, component_id, kept) per input row.

    Vectors are compared where their labels are equal and not null (everywhere
    with ``label_col=None``) and their lengths agree.  A vector that is null,
    empty or zero or holds a null or non-finite component links with nothing: it
    has 0 links and is its own component.  ``n_links`` counts the other rows at
    cosine ``cosine`` or more, exactly; ``component_id`` is the smallest id
    reachable; ``kept`` is id = component_id.  Equal vectors of one label are
    compared as one and counted with their number, so a group of copies costs
    one row.  Near copies are counted where they meet and leave as star links:
    no pair is ever a row.  A crowded cell is dealt out over tasks
    (``common.bucket_cells``).  Rows that repeat an id are separate vectors for
    counting; a null id takes part but names no component.
    """
    dtype = vectors.schema[id_col].dataType
    # single-precision input travels as such; all arithmetic is in double precision
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    kind, element = (np.float32, "float") if single else (np.float64, "double")
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("vec"),
                          (F.col(label_col) if label_col else F.lit(0)).cast("string").alias("label"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(v.isNotNull() & F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", usable)
    # one node per distinct (label, vector); the written table fixes the numbers
    groups = rows.where("ok").groupBy("label", "vec").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    groups = written(groups.withColumn("node", F.monotonically_increasing_id()))
    nodes = groups.withColumn("dim", F.size("vec"))

    budget = 2 - 2 * cosine
    cell_schema = "label string, dim int, block short, c0 long, c1 long, c2 long, c3 long, home boolean, node long, copies long, v binary"
    if not 1 <= grid_dims <= 4:
        raise ValueError("grid_dims is 1 to 4")

    def lay(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                own = b.take(pa.array(at))
                flat = own.column("vec").flatten().to_numpy().reshape(len(at), d)
                raw = [r.tobytes() for r in flat]
                label = own.column("label")
                node, copies = (own.column(c).to_numpy() for c in ("node", "copies"))
                for r, block, cell, home in grid_rows(_units(flat), budget, blocks, grid_dims):
                    n = len(r)
                    cell = np.pad(cell, ((0, 0), (0, 4 - cell.shape[1])))
                    yield pa.RecordBatch.from_arrays(
                        [label.take(pa.array(r)), pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, block, np.int16)), *[pa.array(cell[:, i]) for i in range(4)],
                         pa.array(np.full(n, home)), pa.array(node[r]), pa.array(copies[r]), pa.array([raw[i] for i in r], pa.binary())],
                        names=["label", "dim", "block", "c0", "c1", "c2", "c3", "home", "node", "copies", "v"])

    keys = ["label", "dim", "block", "c0", "c1", "c2", "c3"]
    cells = bucket_cells(nodes.select("label", "dim", "vec", "node", "copies").mapInArrow(lay, cell_schema), keys, "node", cell_rows)
    whole = [*keys, "_a", "_b"]

    def link(batches):
        for g in sorted_groups(batches, whole):
            if not g["home"].any():
                continue
            n = len(g["node"])
            met, parent = np.zeros(n, np.int64), np.arange(n)
            hit = False
            for a, c in cell_links(g, int(g["block"][0]), cosine, blocks, kind):
                if not len(a):
                    continue
                hit = True
                np.add.at(met, a, g["copies"][c])
                np.add.at(met, c, g["copies"][a])
                _union(parent, a, c)
            if hit:
                root = _roots(parent)
                at = np.flatnonzero((met > 0) | (root != np.arange(n)))
                yield pa.RecordBatch.from_arrays([pa.array(g["node"][at]), pa.array(g["node"][root[at]]), pa.array(met[at])], names=["u", "v", "met"])

    found = written(cells.select(*whole, "_s", "home", "node", "copies", "v").repartition(*whole).sortWithinPartitions(*whole)
                    .mapInArrow(link, "u long, v long, met long"))
    counts = found.groupBy("u").agg(F.sum("met").alias("met"))
    roots = components(found.select("u", "v"))

    placed = nodes.select("node", "label", "vec", "low", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    done = placed.join(named, "root").join(counts, F.col("node") == F.col("u"), "left").select(
        F.col("label").alias("g_label"), F.col("vec").alias("g_vec"), "component_id", (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(done, F.col("ok") & (F.col("label") == F.col("g_label")) & (F.col("vec") == F.col("g_vec")), "left")
    comp = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id")).cast(dtype)
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))


def _union(parent: np.ndarray, a: np.ndarray, c: np.ndarray) -> None:
    """Merges the trees of linked places, the smaller place as root, a whole array of links at a time."""
    while True:
        ra, rc = _find(parent, a), _find(parent, c)
        differ = ra != rc
        if not differ.any():
            return
        np.minimum.at(parent, np.maximum(ra, rc)[differ], np.minimum(ra, rc)[differ])


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == parent[up]).all():
            return up
        x = up


def _roots(parent: np.ndarray) -> np.ndarray:
    return _find(parent, np.arange(len(parent)))
