"""Dense and hybrid retrieval over ``embeddings`` and ``documents`` (TXT-09), isotonic fits (CAL-02, ML-02, ML-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import dense, isotonic
from riskspark.operators import text as tx
from riskspark.plans.catalog import register
from riskspark.plans.q_text import BENCH_Q, bench_queries, score_sql, scores
from riskspark.session import cut_lineage
from riskspark.sources.io import table

DENSE_K = 10
FUSED_K = 5


def dense_sql(where: str) -> str:
    return f"""
v AS (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings WHERE embedding IS NOT NULL),
dp AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_dot_product(list_transform(q.e, lambda x: x / q.n), list_transform(v.e, lambda x: x / v.n)), 9) AS score
       FROM v q JOIN v ON v.vec_id <> q.vec_id AND q.n > 0 AND v.n > 0 WHERE {where}),
dr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM dp QUALIFY rank <= {DENSE_K})"""


@register("txt09_dense_topk", f"WITH {dense_sql('q.vec_id % 100 = 0')} SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM dr")
def q_dense(spark, sf):
    """TXT-09: exact 10 nearest rows by cosine for every vector whose id is divisible by 100; blocks out of reach are not read."""
    found, _ = dense.dense_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, DENSE_K)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


@register("txt09_hybrid", f"""WITH {score_sql(BENCH_Q)},
{dense_sql('q.vec_id IN (SELECT item_id FROM benchmark)')},
bd AS (SELECT qid, doc_id, max(round(score, 9)) AS score FROM sc GROUP BY qid, doc_id),
br AS (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM bd QUALIFY rank <= {DENSE_K}),
u AS (SELECT qid, doc_id AS id, rank FROM br UNION ALL SELECT query_id, vec_id, rank FROM dr),
fu AS (SELECT qid, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score, count(*) AS lists FROM u GROUP BY qid, id)
SELECT qid AS item_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank, id, lists, round(score, 6) AS score
FROM fu QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) <= {FUSED_K}""")
def q_hybrid(spark, sf):
    """TXT-09: BM25 over documents and cosine over the vectors of the same ids, fused by reciprocal ranks, for every benchmark item."""
    sparse = cut_lineage(scores(spark, sf, bench_queries(spark, sf), best=DENSE_K, by=["doc_id"]))
    sparse = tx.top_k(sparse, "qid", ["doc_id"], DENSE_K).select("qid", F.col("doc_id").alias("id"), "rank")
    vectors = table(spark, sf, "embeddings")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("vec_id"), F.lit(True).alias("asked")).distinct()
    found, _ = dense.dense_top_k(vectors.join(items, "vec_id", "left"), F.col("asked"), DENSE_K)
    fused = dense.reciprocal_rank_fusion([sparse, found.select(F.col("query_id").alias("qid"), "id", "rank")], "qid", "id", FUSED_K)
    return fused.select(F.col("qid").alias("item_id"), "rank", "id", "lists", F.round("score", 6).alias("score"))


def pav_sql(points: str) -> str:
    """The monotone fit by its definition: the value at i is the largest, over starts j <= i, of the smallest mean from j to any end k >= i."""
    return f"""pt AS ({points}),
cu AS (SELECT g, x, row_number() OVER w AS i, sum(t) OVER w AS ct, sum(n) OVER w AS cn, t, n FROM pt WINDOW w AS (PARTITION BY g ORDER BY x)),
mean AS (SELECT a.g, a.i AS j, b.i AS k, (b.ct - a.ct + a.t) / (b.cn - a.cn + a.n) AS m FROM cu a JOIN cu b ON a.g = b.g AND a.i <= b.i),
low AS (SELECT cu.g, cu.i, mean.j, min(m) AS m FROM cu JOIN mean ON mean.g = cu.g AND mean.j <= cu.i AND mean.k >= cu.i GROUP BY ALL),
iso AS (SELECT cu.g, cu.x, cu.t, cu.n, max(low.m) AS v FROM cu JOIN low ON low.g = cu.g AND low.i = cu.i GROUP BY ALL),
pool AS (SELECT g, min(x) AS low, max(x) AS high, sum(n) AS weight, round(max(v), 6) AS value FROM iso GROUP BY g, round(v, 9))"""


ISO_POINTS = """SELECT o_orderpriority AS g, round(o_totalprice / 500000.0, 2) AS x, sum(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)::DOUBLE AS t, count(*)::DOUBLE AS n
FROM orders GROUP BY ALL"""


@register("cal02_isotonic_pools", f'WITH {pav_sql(ISO_POINTS)} SELECT g AS "group", low, high, weight, value FROM pool')
def q_isotonic(spark, sf):
    """CAL-02: isotonic calibration of a score per group, by pools of blocks (no fit ends on the driver)."""
    o = table(spark, sf, "orders").withColumn("x", F.round(F.col("o_totalprice") / 500000.0, 2))
    p = isotonic.isotonic_pools(o, "o_orderpriority", "x", (F.col("o_orderstatus") == "F").cast("double"), F.lit(1.0))
    return p.select("group", "low", "high", "weight", F.round("value", 6).alias("value"))


MONO = ["l_quantity", "l_discount", "l_tax"]
MONO_POINTS = " UNION ALL ".join(
    f"SELECT '{c}' AS g, {c}::DOUBLE AS x, -sum(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE AS t, count(*)::DOUBLE AS n FROM lineitem GROUP BY {c}" for c in MONO)


@register("ml06_monotone_woe", f"""WITH {pav_sql(MONO_POINTS)},
tot AS (SELECT sum(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE AS bad, count(*)::DOUBLE AS n FROM lineitem),
b AS (SELECT g, min(x) AS low, max(x) AS high, sum(n) AS n, -sum(t) AS bad, max(v) AS v FROM iso GROUP BY g, round(v, 9))
SELECT g AS feature, low, high, b.n, b.bad, round(ln(((b.n - b.bad + 0.5) / (tot.n - tot.bad + 0.5)) / ((b.bad + 0.5) / (tot.bad + 0.5))), 6) AS woe FROM b, tot""")
def q_monotone_woe(spark, sf):
    """ML-02 / ML-06: bins of a scorecard whose bad rate never rises along the feature, merged from the distinct values, with their weight of evidence."""
    li = table(spark, sf, "lineitem").withColumn("bad", (F.col("l_returnflag") == "R").cast("double"))
    long = li.select("bad", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in MONO])).alias("f")).select("bad", "f.*")
    p = isotonic.isotonic_pools(long, "feature", "v", F.col("bad"), F.lit(1.0), increasing=False)
    tot = li.agg(F.struct(F.sum("bad").alias("bad"), F.count(F.lit(1)).cast("double").alias("n"))).scalar()
    good = (F.col("weight") - F.col("total") + 0.5) / (tot["n"] - tot["bad"] + 0.5)
    return p.select(F.col("group").alias("feature"), "low", "high", F.col("weight").alias("n"), F.col("total").alias("bad"),
                    F.round(F.log(good / ((F.col("total") + 0.5) / (tot["bad"] + 0.5))), 6).alias("woe"))
