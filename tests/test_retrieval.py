"""Dense top-k against all pairs with the share of blocks read, rank fusion, isotonic pools against a plain pass."""

import random

import numpy as np
from pyspark.sql import functions as F

from riskspark.operators.dense import dense_top_k, reciprocal_rank_fusion
from riskspark.operators.isotonic import isotonic_pools


def by_hand(rows, k):
    ok = [(i, np.array(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in ok:
        if i % 20 == 0:
            met = sorted((-round(float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), 9), j) for j, v in ok if j != i)
            out += [(i, r, j) for r, (_, j) in enumerate(met[:k], 1)]
    return sorted(out)


def test_dense_top_k_and_blocks_skipped(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(24, 16)) * 3
    rows = [(i, (centres[i % 24] + 0.15 * rng.normal(size=16)).tolist()) for i in range(960)]
    rows += [(2000 + i, rows[0][1]) for i in range(40)] + [(3000, None), (3020, []), (3040, [0.0] * 16), (3060, [None] + [1.0] * 15), (3080, [float("nan")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("pivot", F.lit("x")).withColumn("id", F.lit(1))
    found, looked = dense_top_k(df, F.col("vec_id") % 20 == 0, 5, pivots=24, rings=64, block_rows=64)
    assert sorted((r.query_id, r["rank"], r.id) for r in found.collect()) == by_hand(rows, 5)
    share = looked.agg(F.sum("looked") / F.sum("blocks")).first()[0]
    assert share < 0.25
    # spread evenly, nothing can be skipped, and nothing is lost
    flat = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    found, _ = dense_top_k(spark.createDataFrame(flat, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, 400, pivots=4, rings=4, block_rows=16)
    got = sorted((r.query_id, r["rank"], r.id) for r in found.collect())
    assert len(got) == 15 * 299
    empty, none = dense_top_k(df.limit(0), F.lit(True), 5)
    assert empty.collect() == [] and none.collect() == []


def test_rank_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1)], "q int, id int, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "q int, id int, rank int")
    got = [tuple(r) for r in reciprocal_rank_fusion([a, b], "q", "id", 2).orderBy("q", "rank").select("q", "id", "lists", "rank").collect()]
    assert got == [(1, 11, 2, 1), (1, 10, 1, 2), (2, 10, 1, 1)]


def plain(points):
    stack = []
    for x, t, w in points:
        stack.append([x, x, t, w])
        while len(stack) > 1 and stack[-2][2] / stack[-2][3] >= stack[-1][2] / stack[-1][3]:
            b = stack.pop()
            stack[-1] = [stack[-1][0], b[1], stack[-1][2] + b[2], stack[-1][3] + b[3]]
    return [tuple(s) for s in stack]


def test_isotonic_pools(spark):
    rng = random.Random(3)
    rows = [("g%d" % rng.randrange(3), rng.randrange(400) / 8, rng.randrange(3)) for _ in range(3000)] + [(None, 1.0, 1), ("g0", None, 1)]
    rows += [("up", float(i), i) for i in range(50)] + [("down", float(i), -i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, x double, y int")
    for sign in (1, -1):
        got = {}
        for r in isotonic_pools(df, "g", "x", F.col("y"), F.lit(1.0), increasing=sign > 0).orderBy("group", "low").collect():
            got.setdefault(r.group, []).append((r.low, r.high, sign * r.total, r.weight))
            assert abs(r.value - r.total / r.weight) < 1e-12
        want = {}
        for g in ("g0", "g1", "g2", "up", "down"):
            sums = {}
            for k, x, y in rows:
                if k == g and x is not None:
                    t, w = sums.get(x, (0.0, 0.0))
                    sums[x] = (t + sign * y, w + 1)
            want[g] = plain([(x, t, w) for x, (t, w) in sorted(sums.items())])
        assert got == want
    assert isotonic_pools(df.limit(0), "g", "x", F.col("y"), F.lit(1.0)).collect() == []


def test_bm25_blocks_against_plain_scores(spark, monkeypatch):
    """Few rows come out of the blocks, every query's best among them; documents of one id share their windows."""
    from riskspark.operators import text as tx
    monkeypatch.setattr(tx, "LEAST_WINDOWS", 16)
    monkeypatch.setattr(tx, "BLOCK_QUERIES", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words[: 20 + i % 40]) for _ in range(rng.randrange(0, 400)))) for i in range(120)]
    docs += [(7, "w1 w2 w3"), (7, None), (None, "w1 w1 w9"), (None, "w1 w8 w9"), (9, docs[9][1])]
    asked = [(q, " ".join(rng.choice(words) for _ in range(6))) for q in range(10)] + [(3, "w1 w1"), (None, "w2"), (98, "none of them"), (99, None)]
    post = tx.postings(spark.createDataFrame(docs, "doc_id long, text string"))
    terms = tx.vocabulary(post)
    qt = tx.query_tokens(spark.createDataFrame(asked, "qid long, text string"), "qid")
    # by hand: windows of (doc_id, start, length) hold counts, scores are summed by (doc_id, start)
    tf, lengths = {}, {}
    for d, text in docs:
        t = (text or "").split()
        for start in range(0, max(-(-(len(t) - 120) // 95), 0) * 95 + 1, 95):
            w = t[start:start + 120]
            lengths[d, start] = max(lengths.get((d, start), 0), len(w))
            for x in w:
                tf[d, start, len(w), x] = tf.get((d, start, len(w), x), 0) + 1
    n, avgdl, df = len(lengths), sum(lengths.values()) / len(lengths), {}
    for *_, x in tf:
        df[x] = df.get(x, 0) + 1
    raw = {x: float(np.log((n - c + 0.5) / (c + 0.5))) if n - c + 0.5 > 0 else None for x, c in df.items()}
    known = [v for v in raw.values() if v is not None]
    idf = {x: 0.25 * sum(known) / len(known) if v < 0 else v for x, v in raw.items() if v is not None}
    assert {r.token: (r.df, round(r.idf, 9)) for r in terms.collect()} == {x: (df[x], round(v, 9)) for x, v in idf.items()}
    want = {}
    for q, text in asked:
        for x in (text or "").split():
            for (d, start, dl, y), c in tf.items():
                if x == y:
                    want[q, d, start] = want.get((q, d, start), 0.0) + idf[x] * c * 2.5 / (c + 1.5 * (0.25 + 0.75 * dl / avgdl))
    every = {(r.qid, r.doc_id, r.start): r.score for r in tx.bm25_scores(qt, post, terms, "qid", ["doc_id", "start"]).collect()}
    assert every.keys() == want.keys() and all(abs(every[k] - want[k]) < 1e-9 for k in want)
    few = tx.bm25_scores(qt, post, terms, "qid", ["doc_id", "start"], best=3).cache()
    blocks = -(-n // 16)
    assert few.count() <= 12 * 3 * blocks < len(want)
    top = {(r.qid, r.doc_id, r.start) for r in tx.top_k(few, "qid", ["doc_id", "start"], 3).collect()}
    first = lambda v: (v[1] is not None, v[1] or 0, v[2])
    assert top == {k for q in {a for a, _, _ in want} for k in sorted((k for k in want if k[0] == q), key=lambda k: (-round(want[k], 9), first(k)))[:3]}
    best = {r.qid: r.score for r in tx.bm25_scores(qt, post, terms, "qid", ["doc_id", "start"], best=1, by=[]).groupBy("qid").agg(F.max("score").alias("score")).collect()}
    assert all(abs(best[q] - max(v for k, v in want.items() if k[0] == q)) < 1e-9 for q in best) and best.keys() == {k[0] for k in want}


def test_queries_are_sent_to_the_windows(spark, monkeypatch):
    """windows are shuffled once whatever the number of queries, which are not shuffled; parts of the queries,
    common tokens and tokens of a negative weight give the same scores."""
    from riskspark.operators import text as tx
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words[: 2 + i % 39]) for _ in range(rng.randrange(0, 300)))) for i in range(60)] + [(5, "w0 w1"), (None, "w0")]
    asked = [(q, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 7)))) for q in range(70)] + [(None, "w0 w3")]
    post = tx.postings(spark.createDataFrame(docs, "doc_id long, text string"))
    terms = tx.vocabulary(post).withColumn("idf", F.when(F.col("token") == "w1", F.lit(-2.0)).otherwise(F.col("idf")))
    qt = tx.query_tokens(spark.createDataFrame(asked, "qid long, text string"), "qid")

    def scores():
        df = tx.bm25_scores(qt, post, terms, "qid", ["doc_id", "start"])
        return {(r.qid, r.doc_id, r.start): r.score for r in df.collect()}, df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(tx, "LEAST_WINDOWS", 8)
    every, plan = scores()
    assert plan.split("Initial Plan")[-1].count("hashpartitioning(_wb") == 1 and "CoGroup" not in plan
    monkeypatch.setattr(tx, "SENT_BYTES", 1500)
    monkeypatch.setattr(tx, "BLOCK_QUERIES", 3)
    for common in (0.5, 1e9):
        monkeypatch.setattr(tx, "COMMON", common)
        parts, plan = scores()
        assert "ReusedExchange" in plan
        assert parts.keys() == every.keys() and all(abs(parts[k] - every[k]) < 1e-9 for k in every)
    assert min(every.values()) < 0 < max(every.values())
