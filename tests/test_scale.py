"""Steps whose rows must not meet in few tasks or be multiplied: bootstrap, levels, weights of evidence, chains, fits."""

import hashlib
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from riskspark.operators import dense
from riskspark.operators import metrics as mx
from riskspark.operators import models as md
from riskspark.operators import policy as po
from riskspark.operators import prep as pr
from riskspark.plans import q_models


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def no_small_tables(spark):
    """Spark broadcasts nothing by its own estimate of sizes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def weight(key, b):
    u = int(hashlib.md5(f"{key}:boot:{b}".encode()).hexdigest()[:8], 16) / 4294967296.0
    return sum(c <= u for c in mx.POISSON1_CDF)


def test_poisson_weights_and_bootstrap_means(spark):
    """the weights by their definition, no row a feature, sums a batch."""
    rng = random.Random(2)
    keys = [None, *range(400)]
    rows = [(k, [(f, rng.choice([None, rng.random()])) for f in ("a", "b")] + [("c", None)]) for k in keys] + [(7, None), (8, [])]
    df = spark.createDataFrame(rows, "k int, v array<struct<feature:string,v:double>>")
    got = dict(df.where("size(v) = 3").select("k", mx.poisson_weights("k", 9).alias("w")).collect())
    assert got == {k: [0] * 9 if k is None else [weight(k, b) for b in range(1, 10)] for k in keys}
    means = {(r.feature, r.b): r.m for r in mx.bootstrap_means(df, "k", F.col("v"), 9).collect()}
    for i, f in enumerate("abc"):
        for b in range(9):
            all_w = [(got[k][b], v[i][1]) for k, v in rows if v]
            known = [w * x for w, x in all_w if x is not None]
            want = sum(known) / sum(w for w, _ in all_w) if known else None
            assert means[f, b] == want if want is None else abs(means[f, b] - want) < 1e-12
    assert "Generate" not in plan(mx.bootstrap_means(df, "k", F.col("v"), 9)).split("MapInArrow")[-1]


def test_bootstrap_auc_ties_across_batches_and_tasks(spark):
    """sums stay sums a segment: the plan has no buffer a replicate; ties count half wherever they lie."""
    rng = random.Random(4)
    rows = [(i, rng.choice([0.5, 0.5, 0.5, round(rng.random(), 2), float("nan")]), rng.randrange(2)) for i in range(600)] + [(1, None, 1), (2, 0.5, None), (None, 0.1, 1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = mx.bootstrap_auc(spark.createDataFrame(rows, "id int, p double, y int"), "id", B=5)
        got = df.first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "pos5" not in plan(df)
    aucs = []
    for b in range(1, 6):
        d = [(2.0 if p != p else p, y, weight(k, b)) for k, p, y in rows if p is not None and y is not None and k is not None]
        pos, neg = [(p, w) for p, y, w in d if y and w], [(p, w) for p, y, w in d if not y and w]
        aucs.append(sum(w * v * ((p > n) + 0.5 * (p == n)) for p, w in pos for n, v in neg) / sum(w for _, w in pos) / sum(v for _, v in neg))
    assert abs(got.auc_mid - sorted(aucs)[2]) < 1e-6 and got.replicates == 5


def test_levels_are_sent_to_the_rows(spark):
    """rows do not meet by level."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["b", "a", "b", None, "z"])], "id int, c string")
    with no_small_tables(spark):
        out = pr.apply_levels(df, pr.fit_levels(df.where("id < 3"), ["c"]), ["c"])
        assert "SortMergeJoin" not in plan(out) and "ShuffledHashJoin" not in plan(out)
        assert [r.c_code for r in out.orderBy("id").collect()] == [1, 0, 1, 1, -1]


def test_woe_is_applied_in_place(spark):
    """no row a feature and no shuffle of rows."""
    rng = random.Random(6)
    df = spark.createDataFrame([(i, rng.randrange(2), rng.choice([None, rng.random()]), float(rng.randrange(3))) for i in range(300)], "id int, y int, a double, b double")
    fit = pr.fit_woe(df.where("id < 200 AND a IS NOT NULL"), ["a", "b"]).cache()
    bins = {(r.feature, r.bin): r.woe for r in fit.collect()}
    edges = {r.feature: r.edges for r in fit.collect()}
    out = pr.apply_woe(df.unionByName(df.where("id = 0")), fit, ["a", "b"])
    got = {r.id: r for r in out.collect()}
    assert out.count() == 301 and out.columns == df.columns
    for r in df.collect():
        for c in ("a", "b"):
            at = -1 if r[c] is None else sum(e < r[c] for e in edges[c])
            assert got[r.id][c] == bins.get((c, at))


def test_chains_of_both_contents_in_one_pass(spark):
    """only first rows of ranges are joined."""
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, None]), k, f"x{k}", f"y{k % 7}") for k in rng.sample(range(4000), 500)] + [(1, None, "x", "y")]
    df = spark.createDataFrame(rows, "g int, k long, a string, b string")
    got = {r.k: (r.ca, r.cb) for r in po.chain(df, {"a": "ca", "b": "cb"}, "g", "k", width=100).collect()}
    want = {}
    for g in (1, 2, None):
        before = ("", "")
        for _, k, a, b in sorted((r for r in rows if r[0] == g and r[1] is not None), key=lambda r: r[1]):
            want[k] = tuple(hashlib.sha256((x + p).encode()).hexdigest() for x, p in zip((a, b), before))
            before = (a, b)
    assert got == want


def test_rows_of_a_period_do_not_meet(spark, sf):
    """parameters of a period go to its rows."""
    with no_small_tables(spark):
        joins = plan(q_models.q_cal06(spark, sf)).count("BroadcastHashJoin")
    assert joins >= 2


def test_fits_read_rows_in_tasks_by_their_number(spark, sf, monkeypatch):
    """a frame of few bytes is still spread."""
    small = q_models.model_frame(spark, sf)
    monkeypatch.setattr(q_models, "ROWS_A_TASK", 100)
    spread = q_models.model_frame(spark, sf)
    assert spread.rdd.getNumPartitions() >= 10 and spread.exceptAll(small).count() == 0 and spread.count() == small.count()


def test_forest_rows_keep_their_nodes_in_few_tasks(spark):
    """nodes are kept between passes, the trees are those of a fit without, tasks go with cores and rows."""
    rng = random.Random(6)
    rows = [(float(rng.randrange(9)), rng.random(), None if i % 50 == 0 else rng.random(), rng.randrange(2)) for i in range(800)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int").fillna(0.5).repartition(64, "b").cache()
    cores = spark.sparkContext.defaultParallelism
    assert md.forest_rows(df).rdd.getNumPartitions() == min(cores, 64)
    assert md.forest_rows(df, 20).rdd.getNumPartitions() == min(max(cores, 40), 64)
    assert md.forest_rows(df.repartition(2)).rdd.getNumPartitions() == 2 and md.forest_rows(df).exceptAll(df).count() == 0
    kept = md.random_forest(["a", "b", "c"], trees=5, depth=6)
    assert kept.getStages()[-1].getCacheNodeIds()
    walked = kept.copy()
    walked.getStages()[-1].setCacheNodeIds(False)
    trees = [p.fit(df).stages[-1].toDebugString.split("\n", 1)[1] for p in (kept, walked)]
    assert trees[0] == trees[1]


@pytest.mark.parametrize("k", [3, 50])
def test_blocks_give_out_their_nearest_only(spark, k):
    """F8: a block and the queries that look there meet in a task, which gives out k rows a query."""
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)] + [(5, [1.0, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    found, _ = dense.dense_top_k(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), F.col("vec_id") % 40 == 0, k, pivots=4, rings=4, block_rows=32)
    assert "CoGroupsInArrow" in plan(found)
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = set()
    for q, u in rows:
        if q is not None and q % 40 == 0:
            met = sorted((-round(sum(a * b for a, b in zip(u, v)) / norm(u) / norm(v), 9), i) for i, v in rows if i is not None and i != q)
            want |= {(q, r, i) for r, (_, i) in enumerate(met[:k], 1)}
    assert {(r.query_id, r["rank"], r.id) for r in found.collect()} == want
