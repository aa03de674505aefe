"""Golden arithmetic on tiny literal frames (known answers)."""

import pytest
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import audit as au
from riskspark.operators import fairness as fa
from riskspark.operators import metrics as mx
from riskspark.operators import policy as po
from riskspark.operators import split as sp


def test_pol03_three_zone_fixture(spark):
    agg = spark.createDataFrame([(3907, 419, 1138, 309, 955, 955 - 356)], "n_ap long, bad_ap long, n_rv long, bad_rv long, n_rj long, bad_rj long")
    r = po.zone_metrics_from_counts(agg, []).first()
    assert r.fn_review == 154 and r.fp_review == 414
    assert r.expected_loss == pytest.approx(1.140233, abs=1e-6)


def test_pol04_no_review_split_fixture(spark):
    agg = spark.createDataFrame([(50000, 3183, 6028, 1000, 5475, 5340)], "n_ap long, bad_ap long, n_rv long, bad_rv long, n_rj long, bad_rj long")
    r = po.zone_metrics_from_counts(agg, [], review_split=False).first()
    assert r.expected_loss == pytest.approx(0.549134, abs=1e-6)


def test_eval09_fixtures(spark):
    df = spark.createDataFrame([(654, 467, 4206, 673), (1782, 4538, 52000, 3183)], "tp long, fp long, tn long, fn long")
    rows = df.select(*mx.confusion_columns(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))).collect()
    assert (round(rows[0].precision, 4), round(rows[0].recall, 4), round(rows[0].f1, 4)) == (0.5834, 0.4928, 0.5343)
    assert (round(rows[1].approval_rate, 4), round(rows[1].recall, 4)) == (0.8972, 0.3589)


def test_pol01_bayes_threshold(spark):
    r = spark.range(1).select(*[F.round(po.bayes_threshold(c, 1.0), 6).alias(f"t{c}") for c in (10, 5, 2)]).first()
    assert (r.t10, r.t5, r.t2) == (0.090909, 0.166667, 0.333333)


def test_leak09_fixture(spark):
    train = spark.range(0, 10000).select(F.col("id").alias("entity"), F.lit("train").alias("split"))
    val = spark.range(9500, 20000).select(F.col("id").alias("entity"), F.lit("val").alias("split"))
    r = au.entity_contamination(train.unionByName(val), "entity", "split").first()
    assert r.status == "FAIL" and r.overlap == 500 and r.contamination_pct == 4.762
    assert r.examples == ",".join(str(i) for i in range(9500, 9510))


def test_spl01_sizes_fixture(spark):
    df = spark.range(307511).withColumn("y", (F.col("id") % 12 == 0).cast("int"))
    s = sp.stratified_split(df, ["y"], "id")
    sizes = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes == {"train": 184506, "val": 61502, "test": 61503}
    rates = {r.split: r.rate for r in s.groupBy("split").agg(F.avg("y").alias("rate")).collect()}
    assert max(rates.values()) - min(rates.values()) < 1e-3


def test_fair02_fixture(spark):
    gm = spark.createDataFrame([("F", 0.229826, 0.882012, 0.5, 0.7, 0.01), ("M", 0.22694, 0.86, 0.5, 0.7, 0.01)],
                               "g string, approval_rate double, tpr double, ppv double, auc double, ece double")
    r = fa.gap_table(gm, "g", "M").first()
    assert r.disparate_impact == pytest.approx(1.012717, abs=1e-6) and r.di_status == "PASS"
    assert r.eq_opp_gap == pytest.approx(0.022012, abs=1e-6)


def test_prj04_row_functions(spark):
    df = spark.createDataFrame([(0.2, None, 0.4), (None, None, None)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    r = df.select(X.row_mean(cols).alias("m"), X.row_product(cols).alias("p"), X.row_std(cols).alias("s"), X.row_count(cols).alias("n")).collect()
    assert r[0].m == pytest.approx(0.3) and r[0].p == pytest.approx(0.08) and r[0].s == pytest.approx(0.141421, abs=1e-6) and r[0].n == 2
    assert r[1].m is None and r[1].p == 1.0 and r[1].s is None and r[1].n == 0


def test_prj07_null_flag_and_prj14_bands(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.19999,), (0.2,), (0.39999,), (0.4,), (1.0,)], "p double")
    out = df.select(X.flag(F.col("p") > 0).alias("f"), X.band("p", X.THREE_CUTS, X.THREE_BANDS).alias("b")).collect()
    assert out[0].f == 0
    assert [r.b for r in out[1:]] == ["GREEN", "GREEN", "AMBER", "AMBER", "RED", "RED"]


def test_eval01_auc_fixture(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "p double, y int")
    assert mx.ranking_metrics(df).first().auc == 0.875


def test_eval05_ece_variants(spark):
    ones = spark.createDataFrame([(1.0, 1)] * 5, "p double, y int")
    zeros = spark.createDataFrame([(1.0, 0)] * 5, "p double, y int")
    assert mx.ece(ones, variant="L").first().ece == 0.0 and mx.ece(ones, variant="O").first().ece == 0.0
    assert mx.ece(zeros, variant="L").first().ece == 1.0 and mx.ece(zeros, variant="O").first().ece == 0.0


def test_drift01_psi_identity(spark):
    from riskspark.operators import drift as dr
    x = spark.range(500).select(F.lit(1).alias("batch_day"), F.lit("f").alias("feature"), (F.col("id") * 0.37 % 11).alias("v"))
    assert abs(dr.psi(x, x, "batch_day").first().psi) < 1e-12


def test_win02_padding(spark):
    from riskspark.operators import joins as jn
    df = spark.createDataFrame([(1, 1, 3.0), (1, 2, 2.0), (1, 3, 1.0)], "k long, rn int, a double")  # rn 1 = newest
    r = jn.fixed_sequence(df, "k", "rn", ["a"], 5).first()
    assert [x.a for x in r.seq] == [0.0, 0.0, 1.0, 2.0, 3.0] and r.n_real == 3


def test_win10_runs(spark):
    from riskspark.operators import drift as dr
    st = ["A", "A", "O", "A", "A", "A"]
    df = spark.createDataFrame([("f", i + 1, s) for i, s in enumerate(st)], "feature string, day int, status string")
    r = dr.alert_runs(df, "feature", "day", F.col("status") == "A").orderBy("day").collect()
    assert [x.consecutive for x in r] == [1, 2, 0, 1, 2, 3]
    assert [x.action for x in r].count("RETRAIN") == 2


def test_count_le_binary_search_matches_linear_count(spark):
    import random
    rnd = random.Random(7)
    cuts = sorted({round(rnd.random(), 3) for _ in range(300)})
    vals = [rnd.random() for _ in range(500)] + cuts[:20] + [-1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double").withColumn("c", F.array(*[F.lit(c) for c in cuts]))
    got = df.select("v", X.count_le("c", "v", 1024).alias("k")).collect()
    assert all(r.k == sum(1 for c in cuts if c <= r.v) for r in got)
