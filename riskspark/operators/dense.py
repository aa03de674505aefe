"""Dense and hybrid retrieval (TXT-09): exact top-k cosine with blocks that are skipped, and reciprocal-rank fusion.

Every vector goes to the cell of its nearest pivot and, in it, to the ring of its
angle to the pivot; crowded rings are dealt into slices.  A block is a slice of a
ring, with the smallest and largest angle to its pivot.  By the triangle
inequality of angles no vector of a block can be closer to a query than the gap
between the query's angle to that pivot and the block's.  A query first looks
into the blocks it may be closest to, as many as hold k vectors; the k-th cosine
found there is a floor, and of the other blocks only those whose bound reaches
it are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.joins import top_n_per_key
from riskspark.session import cut_lineage

#: Slack on angles for rounding.
SLACK = 1e-6


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def usable(vec: str) -> Column:
    """Not null, finite, not zero."""
    v = F.col(vec)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(v.isNotNull() & fine, F.lit(False))


def blocks_of(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str, pivots: int, rings: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(vectors with their block and, for queries, the angles to all pivots; blocks with size and angles)."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("ask")).where(usable("vec"))
    v = v.withColumn("norm", F.sqrt(_dot(F.col("vec"), F.col("vec")))).select("id", "ask", F.transform("vec", lambda x: x / F.col("norm")).alias("u"))
    # a fixed number of pivots: the vectors of the smallest hashes
    chosen = [r.u for r in v.orderBy(F.xxhash64("id"), "id").limit(pivots).select("u").collect()]
    dim = len(chosen[0]) if chosen else 0
    centre = np.array([c for c in chosen if len(c) == dim])

    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            u = np.array(b.column("u").to_pylist())
            angle = np.arccos(np.clip(u @ centre.T, -1, 1))
            own = angle.argmin(1)
            near = angle[np.arange(len(u)), own]
            ask = b.column("ask").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("ask"), b.column("u"), pa.array(own.astype(np.int32)), pa.array(near),
                 pa.array([a if q else None for a, q in zip(angle.tolist(), ask)], pa.list_(pa.float64()))], names=["id", "ask", "u", "pivot", "near", "angles"])

    kind = vectors.schema[id_col].dataType.simpleString()
    v = v.where(F.size("u") == dim).mapInArrow(place, f"id {kind}, ask boolean, u array<double>, pivot int, near double, angles array<double>")
    v = cut_lineage(v.withColumn("ring", F.floor(F.col("near") * F.lit(rings / math.pi)).cast("int")))
    crowd = v.groupBy("pivot", "ring").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("slices"))
    v = v.join(crowd, ["pivot", "ring"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).drop("slices")
    blocks = v.groupBy("pivot", "ring", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("low"), F.max("near").alias("high"))
    return v, cut_lineage(blocks)


def dense_top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                pivots: int = 32, rings: int = 32, block_rows: int = 2048) -> tuple[DataFrame, DataFrame]:
    """TXT-09: ((query_id, rank, id, score) of the k largest cosines to other rows, exact; (query_id, blocks, looked)).

    Cosines are rounded to 1e-9 before ranking, ties by id.  Rows whose vector is
    null, zero, not finite or of another length than the pivots' take no part.
    ``looked`` is how many of the blocks were read for the query.
    """
    v, blocks = blocks_of(vectors, is_query, id_col, vec_col, pivots, rings, block_rows)
    key = ["pivot", "ring", "slice"]
    asks = v.where("ask").select(F.col("id").alias("query_id"), F.col("u").alias("q"), "angles")
    gap = F.greatest(F.lit(0.0), F.col("angle") - F.col("high"), F.col("low") - F.col("angle"))
    reach = asks.select("query_id", F.posexplode("angles").alias("pivot", "angle")).join(blocks, "pivot")
    reach = reach.select("query_id", *key, "n", F.cos(F.greatest(F.lit(0.0), gap - SLACK)).alias("bound"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("bound"), *key)
    before = F.coalesce(F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # k vectors and the query's own row
    reach = cut_lineage(reach.withColumn("first", before < k + 1))

    kind = vectors.schema[id_col].dataType.simpleString()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def nearest_of(found: pa.Table, asked: pa.Table) -> pa.Table:
        """The k nearest of a block's vectors to each query that looks there; ties by id."""
        at, hits, scores = [], [], []
        if found.num_rows and asked.num_rows:
            found = found.take(pc.sort_indices(found, sort_keys=[("id", "ascending")]))
            ids = pc.unique(found["id"].combine_chunks())
            own, asking = (pc.fill_null(pc.index_in(x.combine_chunks(), value_set=ids), -1).to_numpy(zero_copy_only=False) for x in (found["id"], asked["query_id"]))
            u, q = (x.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) for x in (found["u"], asked["q"]))
            for lo in range(0, len(q), 256):
                cosines = q[lo:lo + 256] @ u.T
                cosines[asking[lo:lo + 256, None] == own[None, :]] = -np.inf
                for i, c in enumerate(cosines, lo):
                    r = np.round(c, 9)
                    able = np.flatnonzero((r > -np.inf) & (r >= np.partition(r, max(len(r) - k, 0))[max(len(r) - k, 0)]))
                    able = able[np.lexsort((able, -r[able]))[:k]]
                    at.append(np.full(len(able), i))
                    hits.append(able)
                    scores.append(c[able])
        at, hits, scores = (np.concatenate(x).astype(t) if x else np.zeros(0, t) for x, t in ((at, int), (hits, int), (scores, float)))
        return pa.table([asked["query_id"].take(pa.array(at)), found["id"].take(pa.array(hits)), pa.array(scores)], names=["query_id", "id", "score"])

    def scored(pairs: DataFrame) -> DataFrame:
        """Of each (query, block) the k nearest vectors: a task multiplies a block by the queries that look there."""
        looks = pairs.select("query_id", *key).join(asks.select("query_id", "q"), "query_id").repartition(tasks, *key)
        members = v.where("id IS NOT NULL").select(*key, "id", "u").repartition(tasks, *key)
        met = members.groupBy(*key).cogroup(looks.groupBy(*key)).applyInArrow(nearest_of, f"query_id {kind}, id {kind}, score double")
        return met.select("query_id", "id", F.round("score", 9).alias("score"))

    order = [F.desc("score"), F.asc("id")]
    head = cut_lineage(top_n_per_key(scored(reach.where("first")), "query_id", order, k, tiebreak=["id"]))
    floor = head.where(F.col("rn") == k).select("query_id", F.col("score").alias("floor"))
    rest = reach.where("not first").join(floor, "query_id", "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK))
    rest = cut_lineage(rest.select("query_id", *key))
    found = top_n_per_key(head.drop("rn").unionByName(scored(rest)), "query_id", order, k, tiebreak=["id"])
    looked = reach.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"), F.count_if("first").alias("looked"))
    more = rest.groupBy("query_id").agg(F.count(F.lit(1)).alias("more"))
    looked = looked.join(more, "query_id", "left").select("query_id", "blocks", (F.col("looked") + F.coalesce("more", F.lit(0))).alias("looked"))
    return found.select("query_id", F.col("rn").alias("rank"), "id", "score"), looked


def reciprocal_rank_fusion(lists: list[DataFrame], qid: str, key: str, k: int, constant: int = 60) -> DataFrame:
    """TXT-09: (qid, key, score, lists, rank): sum of 1 / (constant + rank) over ranked lists (qid, key, rank), the first ``k``; ties by key."""
    ranked = lists[0].select(qid, key, "rank")
    for more in lists[1:]:
        ranked = ranked.unionByName(more.select(qid, key, "rank"))
    fused = ranked.groupBy(qid, key).agg(F.round(F.sum(F.lit(1.0) / (F.lit(constant) + F.col("rank"))), 9).alias("score"), F.count(F.lit(1)).alias("lists"))
    return top_n_per_key(fused, qid, [F.desc("score"), F.asc(key)], k, tiebreak=[key]).withColumnRenamed("rn", "rank")
