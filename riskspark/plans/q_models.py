"""Model, calibration and scoring queries (ML-*, CAL-*, EXP-03, EVAL-15).  Rows-only checks:
fitted coefficients have no SQL twin; the evaluation around them reuses the oracle-checked operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import features as fx
from riskspark.operators import metrics as mx
from riskspark.operators import models as md
from riskspark.operators import prep as pr
from riskspark.operators import split as sp
from riskspark.plans.catalog import register
from riskspark.plans.frames import scored
from riskspark.session import cut_lineage
from riskspark.sources.io import table
from riskspark.streaming import stream as st

#: Rows that a task of a fit reads in each of its passes.
ROWS_A_TASK = 50_000
FEATURES = ["p_raw", "acc_overdue_ratio", "acc_past_due_mean", "acc_open_ratio", "bal_neg", "nation", "prio"]


def model_frame(spark, sf):
    """Scored orders + applicant features + order features, split 60/20/20 stratified on y."""
    s = scored(spark, sf).withColumn("prio", F.substring("o_orderpriority", 1, 1).cast("double"))
    f = fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders")) \
          .select(F.col("applicant_id").alias("entity"), "acc_overdue_ratio", "acc_past_due_mean", "acc_open_ratio", "bal_neg")
    d = s.join(f, "entity", "left").select("id", "entity", "grp", "y", *[F.col(c).cast("double").alias(c) for c in FEATURES])
    # iterative fitting re-reads its input many times: materialise once in the shared checkpoint folder, in tasks
    # by its rows, as the few columns shrink to a handful of tasks otherwise
    tasks = table(spark, sf, "orders").count() // ROWS_A_TASK
    d = sp.stratified_split(d, ["y"], "id")
    return cut_lineage(d.repartition(tasks, "id") if tasks > 1 else d)


def fitted_inputs(spark, sf):
    d = model_frame(spark, sf)
    train = d.where(F.col("split") == "train")
    med = pr.fit_medians(train, FEATURES)
    d = pr.apply_medians(d, med, FEATURES)
    return cut_lineage(md.with_class_weight(d)), med


def panel(pred, name, score="p_model"):
    test = cut_lineage(pred.where(F.col("split") == "test").select("id", "y", score).withColumn("model", F.lit(name)))
    return mx.metric_panel(test, "model", score, "y")


@register("ml01_logistic_regression")
def q_ml01(spark, sf):
    """ML-01: balanced-weight L2 logistic regression (C = 0.1), evaluated on test."""
    d, _ = fitted_inputs(spark, sf)
    train = d.where(F.col("split") == "train")
    m = md.logistic(FEATURES, n=train.count()).fit(train)
    return panel(md.prob1(m.transform(d)), "logistic")


@register("ml02_woe_scorecard")
def q_ml02(spark, sf):
    """ML-02: logistic regression on WOE-transformed features (FE-03) + points per bin."""
    d, _ = fitted_inputs(spark, sf)
    train = d.where(F.col("split") == "train")
    woe = pr.fit_woe(train, FEATURES)
    wx = pr.apply_woe(d.where(F.col("id").isNotNull()), woe, FEATURES)
    wx = cut_lineage(wx.select("id", "y", "split", "w", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FEATURES]))
    m = md.logistic(FEATURES, n=train.count()).fit(wx.where(F.col("split") == "train"))
    return panel(md.prob1(m.transform(wx)), "woe_scorecard")


@register("ml03_decision_tree")
def q_ml03(spark, sf):
    d, _ = fitted_inputs(spark, sf)
    m = md.decision_tree(FEATURES).fit(d.where(F.col("split") == "train"))
    return panel(md.prob1(m.transform(d)), "decision_tree")


@register("ml04_random_forest")
def q_ml04(spark, sf):
    d, _ = fitted_inputs(spark, sf)
    m = md.random_forest(FEATURES).fit(md.forest_rows(d.where(F.col("split") == "train")))
    return panel(md.prob1(m.transform(d)), "random_forest")


@register("ml05_gradient_boosting")
def q_ml05(spark, sf):
    """ML-05: GBT with instance weights, early stopping on the validation rows."""
    d, _ = fitted_inputs(spark, sf)
    tv = d.where(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val")
    m = md.gbt(FEATURES, validation="is_val").fit(tv)
    return panel(md.prob1(m.transform(d)), "gbt")


@register("ml07_other_families")
def q_ml07(spark, sf):
    """ML-07: Gaussian naive Bayes and a small MLP."""
    d, _ = fitted_inputs(spark, sf)
    train = d.where(F.col("split") == "train")
    a = panel(md.prob1(md.naive_bayes(FEATURES).fit(train).transform(d)), "naive_bayes")
    b = panel(md.prob1(md.mlp(FEATURES).fit(train).transform(d)), "mlp")
    return a.unionByName(b)


@register("ml08_grid_search")
def q_ml08(spark, sf):
    """ML-08: three families and their parameters fitted on train, chosen by AUC on the validation split."""
    d, _ = fitted_inputs(spark, sf)
    train, val = d.where(F.col("split") == "train"), d.where(F.col("split") == "val")
    n = train.count()  # the penalty of a fit is stated per row
    grid = {f"logistic C={c}": md.logistic(FEATURES, C=c, n=n) for c in (0.01, 0.1, 1.0)}
    grid |= {f"tree depth={k}": md.decision_tree(FEATURES, depth=k) for k in (4, 8)}
    grid |= {f"forest depth={k}": md.random_forest(FEATURES, trees=20, depth=k) for k in (4, 8)}
    return md.select_on_validation(grid, train, val)[0]


@register("exp03_gain_importance")
def q_exp03(spark, sf):
    """EXP-03: random-forest gain importances, top 10."""
    d, _ = fitted_inputs(spark, sf)
    m = md.random_forest(FEATURES, trees=50, depth=8).fit(d.where(F.col("split") == "train"))
    return md.feature_importance(m, FEATURES, spark).orderBy(F.col("importance").desc(), "feature").limit(10)


@register("cal01_05_calibration")
def q_cal(spark, sf):
    """CAL-01..05 + EVAL-15: Platt, isotonic and beta calibrators of the raw score fitted on val,
    ECE/Brier on test before and after, the min-ECE choice, and the calibration slope."""
    d = model_frame(spark, sf)
    val, test = d.where(F.col("split") == "val"), d.where(F.col("split") == "test")
    a, b = md.fit_platt(val, "p_raw")
    ba, bb, bc = md.fit_beta(val, "p_raw")
    iso = md.fit_isotonic(val, "p_raw")
    t = iso.transform(test).withColumn("p_platt", md.apply_platt("p_raw", a, b)).withColumn("p_beta", md.apply_beta("p_raw", ba, bb, bc))
    long = t.select("y", F.explode(F.array(*[F.struct(F.lit(n).alias("calibrator"), F.col(c).alias("p")) for n, c in
                                             [("none", "p_raw"), ("platt", "p_platt"), ("isotonic", "p_iso"), ("beta", "p_beta")]])).alias("u")).select("y", "u.*")
    e = mx.ece(long, "p", "y", ["calibrator"]).join(mx.brier(long, "p", "y", ["calibrator"]), "calibrator")
    base = e.where(F.col("calibrator") == "none").select(F.lit(1).alias("_k"), F.col("ece").alias("ece_before"))
    e = e.withColumn("_k", F.lit(1)).join(base, "_k").drop("_k")
    e = e.withColumn("ece_reduction_pct", F.round(100 * (F.col("ece_before") - F.col("ece")) / F.col("ece_before"), 3))
    e = e.withColumn("ece_delta", F.round(F.col("ece") - F.col("ece_before"), 6)) \
         .withColumn("verdict", F.when(F.col("calibrator") != "none", F.when(F.col("ece") < F.col("ece_before"), "IMPROVED").otherwise("NO_IMPROVEMENT")))
    best = e.where(F.col("calibrator") != "none").agg(F.min_by("calibrator", F.struct("ece", "calibrator")).alias("chosen"))
    slope, icpt = md.calibration_slope(test, "p_raw")
    return e.withColumn("_k", F.lit(1)).join(best.withColumn("_k", F.lit(1)), "_k").drop("_k") \
            .withColumn("raw_slope", F.lit(round(slope, 6))).withColumn("raw_intercept", F.lit(round(icpt, 6)))


def fitted_scorer(spark, sf):
    """(rows with absent values, a function that scores a batch or a stream of them): model, medians, calibration and means of train."""
    d = model_frame(spark, sf)
    train = d.where(F.col("split") == "train")
    med = cut_lineage(pr.fit_medians(train, FEATURES))
    filled = cut_lineage(md.with_class_weight(pr.apply_medians(d, med, FEATURES)))
    fit = filled.where(F.col("split") == "train")
    m = md.logistic(FEATURES, n=fit.count()).fit(fit)
    platt = md.fit_platt(md.prob1(m.transform(filled.where(F.col("split") == "val"))), "p_model")
    means = cut_lineage(fit.agg(*[F.avg(c).alias(c) for c in FEATURES]))
    return d, lambda rows: md.score_frame(rows, m, med, FEATURES, platt, means=means)


SCORED_COLUMNS = ["id", "split", "p_cal", "band", "reasons"]


@register("ml09_batch_scoring")
def q_ml09(spark, sf):
    """ML-09: batch scorer (medians, model, Platt calibration, band, reasons) over every row; per split and band
    the rows, the mean probability, the rows with a reason and how many different first reasons they have."""
    d, score = fitted_scorer(spark, sf)
    first = F.split(F.try_element_at("reasons", F.lit(1)), ":")[0]
    return score(d).groupBy("split", "band").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_cal"), 6).alias("mean_p"),
                                                 F.count(first).alias("with_reason"), F.count_distinct(first).alias("first_reasons"))


@register("st03_model_scorer")
def q_st03_model(spark, sf):
    """ST-03: the fitted model, its calibration, bands and reasons applied inside a stream of applications, a row each."""
    d, score = fitted_scorer(spark, sf)
    src = st.scratch(spark, "st03-src")
    d.write.parquet(src)
    out = st.run_to_table(score(st.file_stream(spark, src)).select(*SCORED_COLUMNS), "st03-model", mode="append")
    return out.withColumn("p_cal", F.round("p_cal", 6))


@register("cal06_periodic_recalibration")
def q_cal06(spark, sf):
    """CAL-06: Platt recalibration fitted on each labelled period (year) and applied to the
    next one, with that next period's ECE before and after (all periods fitted in one pass per
    Newton step)."""
    s = scored(spark, sf, with_group=False).withColumn("period", F.year("ts").cast("int"))
    theta = md.grouped_platt(s, "period", "p_raw", "y")
    nxt = theta.select((F.col("period") + 1).alias("period"), "a", "b")  # fitted on t, used in t + 1
    # one row a period: the rows of a year do not meet in one task
    applied = s.join(F.broadcast(nxt), "period").withColumn("p_recal", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * F.col("p_raw") + F.col("b")))))
    before = mx.ece(applied, "p_raw", "y", ["period"]).withColumnRenamed("ece", "ece_before")
    after = mx.ece(applied, "p_recal", "y", ["period"]).withColumnRenamed("ece", "ece_after")
    return before.join(after, "period").join(theta.select("period", F.round("a", 6).alias("a_prev_fit"), F.round("b", 6).alias("b_prev_fit"))
                                             .withColumn("period", F.col("period") + 1), "period")
