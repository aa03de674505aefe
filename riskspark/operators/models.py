"""Models and calibration on Spark ML (ML-01..09, CAL-01..05, EXP-03).

Training uses MLlib estimators on an assembled vector; everything around them
(class weights, splits, metrics, calibration application) stays DataFrame
code.  Fitted calibrators are applied as column expressions.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import log_terms, logit

# Rows that a task of a forest's fit reads: some hundred times what its counts of nodes cost.
FOREST_ROWS = 250_000


def with_class_weight(df: DataFrame, label: str = "y", out: str = "w") -> DataFrame:
    """AGG-19: balanced weights n/(2·n_class) from one aggregation."""
    c = df.agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_p")).withColumn("_k", F.lit(1))
    j = df.withColumn("_k", F.lit(1)).join(c, "_k")
    w = F.when(F.col(label) == 1, F.col("_n") / (2.0 * F.col("_p"))).otherwise(F.col("_n") / (2.0 * (F.col("_n") - F.col("_p"))))
    return j.withColumn(out, w).drop("_k", "_n", "_p")


def assemble(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def prob1(df: DataFrame, col: str = "probability", out: str = "p_model") -> DataFrame:
    """Positive-class probability as a double column; the model's vector columns are dropped."""
    return df.withColumn(out, vector_to_array(F.col(col))[1]).drop("rawPrediction", "probability", "prediction", "features")


def logistic(features: list[str], label: str = "y", weight: str | None = "w", C: float = 0.1, n: int = 1) -> Pipeline:
    """ML-01: L2 logistic regression; sklearn's C maps to regParam = 1/(C·n) under mean loss."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=200)
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[assemble(features), lr])


def decision_tree(features, label="y", depth=8):
    """ML-03."""
    return Pipeline(stages=[assemble(features), DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=42)])


def random_forest(features, label="y", trees=100, depth=12):
    """ML-04.  A row keeps the node it has reached in each tree, so that no pass walks the trees from their roots again;
    that changes no tree."""
    return Pipeline(stages=[assemble(features), RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=42,
                                                                       cacheNodeIds=True, checkpointInterval=-1)])


def forest_rows(train: DataFrame, rows: int = FOREST_ROWS) -> DataFrame:
    """The rows in as few tasks as keep all cores busy, or of ``rows`` each: in every pass a task makes, writes and
    sends the counts of all open nodes, however few rows it has."""
    tasks = max(math.ceil(train.count() / rows), train.sparkSession.sparkContext.defaultParallelism)
    return train.coalesce(tasks)


def gbt(features, label="y", weight="w", iters=50, depth=5, validation: str | None = None):
    """ML-05: gradient-boosted trees with instance weights and optional early stopping on a validation flag."""
    g = GBTClassifier(labelCol=label, maxIter=iters, maxDepth=depth, seed=42, weightCol=weight)
    if validation:
        g.setValidationIndicatorCol(validation)
    return Pipeline(stages=[assemble(features), g])


def naive_bayes(features, label="y"):
    """ML-07: Gaussian naive Bayes."""
    return Pipeline(stages=[assemble(features), NaiveBayes(labelCol=label, modelType="gaussian")])


def mlp(features, label="y", hidden=(8,)):
    """ML-07: multilayer perceptron."""
    return Pipeline(stages=[assemble(features), MultilayerPerceptronClassifier(labelCol=label, layers=[len(features), *hidden, 2], seed=42, maxIter=100)])


def select_on_validation(candidates: dict[str, Pipeline], train: DataFrame, val: DataFrame, label: str = "y") -> tuple[DataFrame, dict]:
    """ML-08: every candidate (any family, any parameters) fitted on ``train`` and ranked by its AUC on ``val``,
    the split that no fit has seen.  Returns (candidate, val_auc, val_ap, rank, chosen) and the fitted models;
    ties go to the smaller name.  All candidates are evaluated in one pass of the exact ranking metrics."""
    from functools import reduce

    from pyspark.sql import Window

    from riskspark.operators.metrics import ranking_metrics
    models = {name: p.fit(train) for name, p in candidates.items()}
    scored = [prob1(m.transform(val)).select(F.lit(name).alias("candidate"), label, F.col("p_model").alias("p")) for name, m in models.items()]
    r = ranking_metrics(reduce(DataFrame.unionByName, scored), "p", label, ["candidate"])
    w = Window.partitionBy(F.lit(1)).orderBy(F.col("val_auc").desc(), "candidate")  # one row per candidate
    r = r.select("candidate", F.round("auc", 6).alias("val_auc"), F.round("ap", 6).alias("val_ap")).withColumn("rank", F.row_number().over(w))
    return r.withColumn("chosen", F.col("rank") == 1), models


def feature_importance(model, features: list[str], spark) -> DataFrame:
    """EXP-03: tree-model gain importances as a (feature, importance) DataFrame (features-sized)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")


def fit_platt(val: DataFrame, score: str, label: str = "y") -> tuple[float, float]:
    """CAL-01: 1-D logistic regression of the label on the raw score (no regularisation)."""
    m = LogisticRegression(featuresCol="_x", labelCol=label, regParam=0.0, standardization=False, maxIter=100) \
        .fit(assemble([score], "_x").transform(val))
    return float(m.coefficients[0]), float(m.intercept)


def apply_platt(score: str | Column, a: float, b: float) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * s + F.lit(b))))


def fit_beta(val: DataFrame, score: str, label: str = "y") -> tuple[float, float, float]:
    """CAL-03: logistic regression on (ln p, ln(1−p))."""
    lp, l1p = log_terms(score)
    d = val.withColumn("_lp", lp).withColumn("_l1p", l1p)
    m = LogisticRegression(featuresCol="_x", labelCol=label, regParam=0.0, standardization=False, maxIter=100) \
        .fit(assemble(["_lp", "_l1p"], "_x").transform(d))
    return float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept)


def apply_beta(score: str, a: float, b: float, c: float) -> Column:
    lp, l1p = log_terms(score)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * lp + F.lit(b) * l1p + F.lit(c))))


def fit_isotonic(val: DataFrame, score: str, label: str = "y", out: str = "p_iso"):
    """CAL-02: isotonic regression (MLlib parallel PAV, linear interpolation,
    clamped outside the fitted range).  Apply with ``model.transform``: the
    model's knots can be as many as the distinct scores, so they are not
    inlined as literals."""
    return IsotonicRegression(featuresCol=score, labelCol=label, predictionCol=out, isotonic=True) \
        .fit(val.withColumn(label, F.col(label).cast("double")))


def calibration_slope(df: DataFrame, score: str, label: str = "y") -> tuple[float, float]:
    """CAL-05: slope and intercept of a 1-D logistic regression of y on logit(p)."""
    d = df.withColumn("_lg", logit(score))
    m = LogisticRegression(featuresCol="_x", labelCol=label, regParam=0.0, standardization=False, maxIter=100) \
        .fit(assemble(["_lg"], "_x").transform(d))
    return float(m.coefficients[0]), float(m.intercept)


def score_frame(df: DataFrame, model, medians: DataFrame, features: list[str], platt: tuple[float, float],
                cuts=(0.20, 0.40), labels=("GREEN", "AMBER", "RED"), means: DataFrame | None = None, k: int = 3) -> DataFrame:
    """ML-09 / ST-03: batch (or streaming) scorer: medians for absent inputs,
    model probability, Platt calibration, band, and with ``means`` (one row, of the rows
    a linear model was fitted on) the k strongest ``reasons`` that raise the risk, each
    ``name: value (+contribution)``.  Column expressions, joins with one-row tables and
    ``model.transform``: a streaming DataFrame is scored by the same code."""
    from riskspark.functions.exprs import band, reason_string
    from riskspark.operators.explain import contributions, top_k_contribs
    m = medians.select(F.lit(1).alias("_k"), *[F.col(c).alias(f"_m_{c}") for c in features])
    d = df.withColumn("_k", F.lit(1)).join(m, "_k")
    for c in features:
        d = d.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")))
    d = d.drop("_k", *[f"_m_{c}" for c in features])
    scored = prob1(model.transform(d), "probability", "p_model")
    scored = scored.withColumn("p_cal", apply_platt("p_model", *platt))
    scored = scored.withColumn("band", band("p_cal", list(cuts), list(labels)))
    if means is None:
        return scored
    coefs = dict(zip(features, [float(x) for x in model.stages[-1].coefficients]))
    top = top_k_contribs("contribs", k, positive_only=True)
    named = F.transform(top, lambda x: reason_string(x["feature"], F.round(x["value"], 4), x["contrib"]))
    return contributions(scored, coefs, means).withColumn("reasons", named).drop("contribs")


def grouped_platt(df: DataFrame, group: str, score: str, label: str = "y", iters: int = 50, tolerance: float = 1e-8) -> DataFrame:
    """CAL-01 per group (CAL-06): Platt parameters (a, b) of sigmoid(a·s + b) for every
    group at once by Newton's method.  Each iteration is one aggregation of the
    gradient and the 2×2 Hessian per group, followed by a closed-form solve on the
    (group-sized) parameter table.  Passes end when no group moves by more than
    ``tolerance``; ``converged`` tells the groups that still did after ``iters``
    passes or whose Hessian is singular (one class, one score)."""
    from riskspark.session import cut_lineage
    d = cut_lineage(df.select(group, F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y")))
    theta = d.select(group).distinct().withColumn("a", F.lit(1.0)).withColumn("b", F.lit(0.0)).withColumn("converged", F.lit(False))
    for _ in range(iters):
        j = d.join(F.broadcast(theta.drop("converged")), group)  # one row a group: no group's rows meet in one task
        mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * F.col("_s") + F.col("b"))))
        w = mu * (F.lit(1.0) - mu)
        g = j.groupBy(group).agg(
            F.first("a").alias("a"), F.first("b").alias("b"),
            F.sum((F.col("_y") - mu) * F.col("_s")).alias("ga"), F.sum(F.col("_y") - mu).alias("gb"),
            F.sum(w * F.col("_s") * F.col("_s")).alias("haa"), F.sum(w * F.col("_s")).alias("hab"), F.sum(w).alias("hbb"))
        det = F.col("haa") * F.col("hbb") - F.col("hab") * F.col("hab")
        da = F.try_divide(F.col("hbb") * F.col("ga") - F.col("hab") * F.col("gb"), det)
        db = F.try_divide(F.col("haa") * F.col("gb") - F.col("hab") * F.col("ga"), det)
        theta = cut_lineage(g.select(group, (F.col("a") + F.coalesce(da, F.lit(0.0))).alias("a"),
                                     (F.col("b") + F.coalesce(db, F.lit(0.0))).alias("b"),
                                     F.coalesce(F.greatest(F.abs(da), F.abs(db)) <= tolerance, F.lit(False)).alias("converged"),
                                     F.coalesce(F.greatest(F.abs(da), F.abs(db)) > tolerance, F.lit(False)).alias("_moving")))
        # singular groups stand still: they are reported, not waited for
        moving = theta.where("_moving").limit(1).count()
        theta = theta.drop("_moving")
        if not moving:
            break
    return theta
