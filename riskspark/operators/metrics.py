"""Evaluation operators (EVAL-01..18) on a scored frame (score p, label y).

Ranking metrics reduce the frame to the per-score cumulative table of
``prefix.score_cdf`` and aggregate it; grid metrics (ECE, calibration curve,
sweep, histograms) bin each row once and do arithmetic on at most a hundred
rows per group.  Nothing here sorts raw rows globally or loops over jobs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.prefix import GKEY, _groups, score_cdf


def _finish(df: DataFrame, groups_given) -> DataFrame:
    return df.drop(GKEY) if not groups_given else df


def ranking_metrics(df: DataFrame, score: str = "p", label: str = "y", groups=(), n_buckets: int = 1024) -> DataFrame:
    """EVAL-01/02/03/06: AUC (ties averaged), average precision (step), PR-AUC
    (trapezoid, sklearn curve with the (0,1) start point), KS and the
    KS-optimal threshold, per group.  AUC/KS are NULL when a class is absent."""
    given = list(groups)
    df, g = _groups(df, groups)
    c = score_cdf(df, score, label, g, n_buckets)
    P, N = F.col("Tpos"), F.col("Tneg")
    tp = P - F.col("cpos") + F.col("pos")          # predicted positive at threshold s: score >= s
    fp = N - F.col("cneg") + F.col("neg")
    prec = tp / (tp + fp)
    tp0, fp0 = P - F.col("cpos"), N - F.col("cneg")  # at the next higher threshold
    prec0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(F.try_divide(tp0, tp0 + fp0))
    d = F.abs(F.try_divide(F.col("cpos"), P) - F.try_divide(F.col("cneg"), N))
    c = c.withColumn("_d", d)
    out = c.groupBy(*g).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.max("Tpos").alias("n_pos"),
        F.round(F.try_divide(F.sum(F.col("pos") * (F.col("cneg") - F.col("neg") + F.col("neg") / 2.0)), F.max(P) * F.max(N)), 6).alias("auc"),
        F.round(F.try_divide(F.sum(F.col("pos") * prec), F.max(P)), 6).alias("ap"),
        F.round(F.try_divide(F.sum(F.col("pos") * (prec + prec0) / 2.0), F.max(P)), 6).alias("pr_auc"),
        F.round(F.max("_d"), 6).alias("ks"),
        F.max_by(F.col("s"), F.struct(F.col("_d"), -F.col("s"))).alias("ks_threshold"),
    )
    return _finish(out, given)


def roc_points(df: DataFrame, score: str = "p", label: str = "y", groups=(), n_buckets: int = 1024) -> DataFrame:
    """EVAL-08: one ROC point per distinct threshold (predict positive if score >= s)."""
    given = list(groups)
    df, g = _groups(df, groups)
    c = score_cdf(df, score, label, g, n_buckets)
    tp = F.col("Tpos") - F.col("cpos") + F.col("pos")
    fp = F.col("Tneg") - F.col("cneg") + F.col("neg")
    out = c.select(*g, F.col("s").alias("threshold"),
                   F.round(F.try_divide(fp, F.col("Tneg")), 6).alias("fpr"),
                   F.round(F.try_divide(tp, F.col("Tpos")), 6).alias("tpr"))
    return _finish(out, given)


def brier(df: DataFrame, score: str = "p", label: str = "y", groups=()) -> DataFrame:
    """EVAL-04."""
    return df.groupBy(*groups).agg(F.round(F.avg((F.col(score) - F.col(label)) ** 2), 6).alias("brier"))


def ece_bin(score: str | Column, n_bins: int = 10, variant: str = "L") -> Column:
    """Equal-width bin index; L: last bin closed (p = 1 in the top bin);
    O: right-open, p = 1 falls outside every bin."""
    s = F.col(score) if isinstance(score, str) else score
    b = F.floor(s * F.lit(n_bins)).cast("int")
    return F.least(b, F.lit(n_bins - 1)) if variant == "L" else b


def ece(df: DataFrame, score: str = "p", label: str = "y", groups=(), n_bins: int = 10, variant: str = "L") -> DataFrame:
    """EVAL-05: Σ n_b/N · |mean(y) − mean(p)| over non-empty bins; N counts every row."""
    given = list(groups)
    df, g = _groups(df, groups)
    bins = df.withColumn("_bin", ece_bin(score, n_bins, variant)).groupBy(*g, "_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.avg(label).alias("_acc"), F.avg(score).alias("_conf"))
    w = Window.partitionBy(*g)
    bins = bins.withColumn("_ntot", F.sum("_n").over(w))
    ok = (F.col("_bin") >= 0) & (F.col("_bin") < n_bins)
    out = bins.groupBy(*g).agg(F.round(F.sum(F.when(ok, F.col("_n") / F.col("_ntot") * F.abs(F.col("_acc") - F.col("_conf"))).otherwise(0.0)), 6).alias("ece"))
    return _finish(out, given)


def calibration_curve(df: DataFrame, score: str = "p", label: str = "y", groups=(), n_bins: int = 10) -> DataFrame:
    """EVAL-07: per non-empty bin: mean predicted, observed rate, n."""
    return df.withColumn("bin", ece_bin(score, n_bins, "L")).groupBy(*groups, "bin").agg(
        F.round(F.avg(score), 6).alias("mean_pred"), F.round(F.avg(label), 6).alias("frac_pos"),
        F.count(F.lit(1)).alias("n"))


def confusion_columns(tp: Column, fp: Column, tn: Column, fn: Column) -> list[Column]:
    """EVAL-09 arithmetic from the four counts (0 when undefined)."""
    n = tp + fp + tn + fn
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    fpr = F.coalesce(F.try_divide(fp, fp + tn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return [
        F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"), F.round(fpr, 6).alias("fpr"),
        F.round(f1, 6).alias("f1"), F.round(F.try_divide(tp + tn, n), 6).alias("accuracy"),
        F.round(rec - fpr, 6).alias("youden_j"),
        F.round(F.try_divide(tn + fn, n), 6).alias("approval_rate"),
        F.round(F.try_divide(tp + fp, n), 6).alias("rejection_rate"),
    ]


def confusion_at(df: DataFrame, threshold: float, score: str = "p", label: str = "y", groups=()) -> DataFrame:
    """EVAL-09: confusion matrix and rates at ``score >= threshold``."""
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    agg = df.groupBy(*groups).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn"))
    return agg.select(*groups, "tp", "fp", "tn", "fn",
                      *confusion_columns(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")))


def threshold_sweep(df: DataFrame, score: str = "p", label: str = "y", groups=(), start_micro: int = 50000,
                    step_micro: int = 10000, n_steps: int = 75, c_bad: float = 10.0, c_reject: float = 1.0) -> DataFrame:
    """EVAL-10: metrics at thresholds start + k·step (k < n_steps), in micro-units
    so grid comparisons are exact.  Each row is binned once to the number of grid
    thresholds it clears; the sweep is a cumulative sum over at most
    ``n_steps + 1`` bins per group — no row × threshold product."""
    given = list(groups)
    df, g = _groups(df, groups)
    pm = F.round(F.col(score) * F.lit(1000000.0)).cast("long")
    k = F.least(F.greatest(F.floor((pm - F.lit(start_micro)) / F.lit(step_micro)).cast("int") + 1, F.lit(0)), F.lit(n_steps))
    bins = df.groupBy(*g, k.alias("k")).agg(F.sum(label).alias("pos"), F.sum(F.lit(1) - F.col(label)).alias("neg"))
    keys = bins.select(*g).distinct()
    # every (group, k) cell; keys is the group list (small), grid has n_steps+1 rows
    cells = keys.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_steps))))
    full = cells.join(bins, g + ["k"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*g).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wa = Window.partitionBy(*g)
    full = full.withColumn("cpos", F.sum("pos").over(w)).withColumn("cneg", F.sum("neg").over(w)) \
               .withColumn("P", F.sum("pos").over(wa)).withColumn("N", F.sum("neg").over(wa))
    # threshold j (0-based) -> predicted positive = rows with k > j
    sw = full.where(F.col("k") < n_steps).select(
        *g, F.col("k").alias("step"),
        F.round((F.lit(start_micro) + F.col("k") * F.lit(step_micro)) / F.lit(1000000.0), 6).alias("threshold"),
        (F.col("P") - F.col("cpos")).alias("tp"), (F.col("N") - F.col("cneg")).alias("fp"),
        F.col("cneg").alias("tn"), F.col("cpos").alias("fn"))
    out = sw.select(*g, "step", "threshold", "tp", "fp", "tn", "fn",
                    *confusion_columns(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")),
                    F.round((F.lit(c_bad) * F.col("fn") + F.lit(c_reject) * F.col("fp")) / (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")), 6).alias("expected_loss"))
    return _finish(out, given)


def score_histogram(df: DataFrame, score: str = "p", by=(), n_bins: int = 20) -> DataFrame:
    """EVAL-11: equal-width [0,1] histogram (last bin closed) per class/group."""
    return df.groupBy(*by, ece_bin(score, n_bins, "L").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def local_calibration(df: DataFrame, cuts: list[float], width: float, score: str = "p", label: str = "y") -> DataFrame:
    """EVAL-18: observed vs predicted among rows within ``width`` of each decision cut.

    The cut list is a literal array (a handful of policy thresholds); rows are
    expanded only for the cuts they are near."""
    arr = F.array(*[F.lit(float(c)) for c in cuts])
    near = F.filter(arr, lambda c: F.abs(F.col(score) - c) <= F.lit(width))
    return df.select(F.explode(near).alias("cut"), score, label).groupBy("cut").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 6).alias("mean_pred"),
        F.round(F.avg(label), 6).alias("observed"),
        F.round(F.avg(label) - F.avg(score), 6).alias("gap"))


def metric_panel(df: DataFrame, by: str, score: str = "p", label: str = "y") -> DataFrame:
    """EVAL-12/16/17: AUC, AP, KS, Brier, ECE, base rate per value of ``by``
    (split, model, ...) in one result."""
    r = ranking_metrics(df, score, label, [by])
    b = df.groupBy(by).agg(F.round(F.avg((F.col(score) - F.col(label)) ** 2), 6).alias("brier"),
                           F.round(F.avg(label), 6).alias("rate"))
    e = ece(df, score, label, [by])
    return r.join(b, by).join(e, by).select(by, "n", "n_pos", "auc", "ap", "pr_auc", "ks", "brier", "ece", "rate")


def generalisation_gap(panel: DataFrame, by: str, base: str, other: str, metrics=("auc", "ks", "brier", "ece")) -> DataFrame:
    """EVAL-12: metric(base) − metric(other) from a long panel (pivot of ≤ #splits rows)."""
    long = panel.select(by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("m")) \
                .select(by, "m.metric", "m.v")
    pv = long.groupBy("metric").pivot(by, [base, other]).agg(F.first("v"))
    return pv.select("metric", F.col(base).alias("base_value"), F.col(other).alias("other_value"),
                     F.round(F.col(base) - F.col(other), 6).alias("gap"))


# Poisson(1) cumulative probabilities P(K <= k), as far as a 32-bit draw can tell them from 1.
POISSON1_CDF = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(13)]


def _draw(key: str, b: int, salt: str = ":boot") -> Column:
    """Eight hexadecimal digits of md5(key:salt:b), a number below 2^32."""
    return F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"{salt}:{b}"))), 1, 8)


def _poisson(draw: Column) -> Column:
    """The Poisson(1) value of a draw (inverse CDF): digits of one length are ordered like their numbers."""
    limits = [f"{math.ceil(c * 2 ** 32):08x}" for c in POISSON1_CDF if c * 2 ** 32 <= 2 ** 32 - 1]
    w = F.when(draw.isNull() | (draw < limits[0]), 0)
    for k, limit in enumerate(limits[1:], 1):
        w = w.when(draw < limit, k)
    return w.otherwise(len(limits))


def poisson_weights(key: str, B: int) -> Column:
    """A row's deterministic Poisson(1) weights in replicates 1 to B, one array."""
    return F.transform(F.array(*[_draw(key, b) for b in range(1, B + 1)]), _poisson)


def bootstrap_means(df: DataFrame, key: str, values: Column, B: int) -> DataFrame:
    """WIN-16: (feature, b from 0, m): Poisson-bootstrap means of a row's ``values`` (feature, v).

    A row's weights are drawn once for all its features; a batch of rows is summed up to one row a feature."""
    d = df.select(poisson_weights(key, B).alias("w"), values.alias("values"))

    def sums(batches):
        for batch in batches:
            each = batch.column("values")
            row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(each), 0).to_numpy(zero_copy_only=False))
            if not len(row):
                continue
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, B).astype(float)
            name = each.flatten().field("feature").dictionary_encode()
            v = each.flatten().field("v")
            known, v = pc.is_valid(v).to_numpy(zero_copy_only=False), pc.fill_null(v, 0.0).to_numpy(zero_copy_only=False)
            code = pc.fill_null(name.indices, -1).to_numpy(zero_copy_only=False)
            out = []
            for c in np.unique(code):
                some = known & (code == c)
                out.append((name.dictionary[int(c)].as_py() if c >= 0 else None, (v[some] @ w[row[some]]).tolist() if some.any() else [None] * B, w[row[code == c]].sum(0).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), *[pa.array([x[i] for x in out], pa.list_(pa.float64())) for i in (1, 2)]],
                                             names=["feature", "total", "weight"])

    s = d.mapInArrow(sums, "feature string, total array<double>, weight array<double>")
    s = s.select("feature", F.posexplode(F.arrays_zip("total", "weight")).alias("b", "x"))
    return s.groupBy("feature", "b").agg((F.sum("x.total") / F.sum("x.weight")).alias("m"))


def bootstrap_auc(df: DataFrame, key: str, score: str = "p", label: str = "y", B: int = 50) -> DataFrame:
    """EVAL-13: B Poisson-bootstrap replicates of the AUC and their 2.5 / 50 / 97.5 percentiles.

    Rows are dealt by ranges of score and sorted there.  Each batch of them gives three segments, the rows of
    its first score, of its last one and those between, with their sums a class and replicate; segments of one
    score are summed up, so that ties may lie across batches and tasks, and the few segments are run up."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
    d = d.repartitionByRange(n, "s", "k").sortWithinPartitions("s").select("s", "y", poisson_weights("k", B).alias("w"))

    def segments(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s, y = batch.column("s").to_numpy(zero_copy_only=False), batch.column("y").to_numpy(zero_copy_only=False)[:, None]
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(len(s), B).astype(float)
            new = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) & ~(np.isnan(s[1:]) & np.isnan(s[:-1]))))
            pos, neg = np.add.reduceat(y * w, new), np.add.reduceat((1 - y) * w, new)
            inner = pos * (np.cumsum(neg, 0) - neg / 2)
            parts = {(0, 1), (len(new) - 1, len(new))} | ({(1, len(new) - 1)} if len(new) > 2 else set())
            out = [(s[new[i]], s[new[j - 1]], pos[i:j].sum(0), neg[i:j].sum(0), (inner[i:j] - pos[i:j] * neg[:i].sum(0)).sum(0)) for i, j in sorted(parts)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out]),
                                              *[pa.array([x[c].tolist() for x in out], pa.list_(pa.float64())) for c in (2, 3, 4)]], names=["lo", "hi", "pos", "neg", "inner"])

    seg = d.mapInArrow(segments, "lo double, hi double, pos array<double>, neg array<double>, inner array<double>")
    seg = seg.select("lo", "hi", F.posexplode(F.arrays_zip("pos", "neg", "inner")).alias("b", "v")).groupBy("b", "lo", "hi").agg(
        F.sum("v.pos").alias("pos"), F.sum("v.neg").alias("neg"), F.sum("v.inner").alias("inner"))
    before = F.coalesce(F.sum("neg").over(Window.partitionBy("b").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    within = F.when(F.col("lo") == F.col("hi"), F.col("pos") * F.col("neg") / 2.0).otherwise(F.col("inner"))
    a = seg.select("b", "pos", "neg", (F.col("pos") * before + within).alias("under"))
    a = a.groupBy("b").agg((F.sum("under") / (F.sum("pos") * F.sum("neg"))).alias("auc"))
    a = df.sparkSession.range(B).select(F.col("id").cast("int").alias("b")).join(a, "b", "left")
    return a.agg(F.round(F.percentile("auc", 0.025), 6).alias("auc_lo"), F.round(F.percentile("auc", 0.5), 6).alias("auc_mid"),
                 F.round(F.percentile("auc", 0.975), 6).alias("auc_hi"), F.count(F.lit(1)).alias("replicates"))


def placements(df: DataFrame, key: str, score: str, label: str = "y", groups=()) -> DataFrame:
    """DeLong placement values per row: positives get (neg below + ½ tied)/N,
    negatives get (pos above + ½ tied)/P, from the per-score cumulative table."""
    from riskspark.operators.prefix import score_cdf
    g = list(groups)
    c = score_cdf(df, score, label, g)
    c = c.select(*g, "s", ((F.col("cneg") - F.col("neg") + F.col("neg") / 2.0) / F.col("Tneg")).alias("v10"),
                 ((F.col("Tpos") - F.col("cpos") + F.col("pos") / 2.0) / F.col("Tpos")).alias("v01"))
    return df.select(key, *g, label, F.col(score).alias("s")).join(c, g + ["s"]).select(
        key, *g, label, F.when(F.col(label) == 1, F.col("v10")).otherwise(F.col("v01")).alias("v"))


def normal_sf(z: Column) -> Column:
    """Upper tail of the standard normal via the Abramowitz-Stegun 7.1.26 erfc approximation."""
    x = F.abs(z) / F.lit(2 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    erfc = poly * F.exp(-x * x)
    return F.when(z >= 0, erfc / 2).otherwise(F.lit(1.0) - erfc / 2)


def delong(df: DataFrame, key: str, score_a: str, score_b: str, label: str = "y") -> DataFrame:
    """EVAL-14: DeLong test of two correlated AUCs on the same rows."""
    pa = placements(df, key, score_a, label).withColumnRenamed("v", "va")
    pb = placements(df, key, score_b, label).select(key, F.col("v").alias("vb"))
    j = pa.join(pb, key)
    s = j.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg("va").alias("ma"), F.avg("vb").alias("mb"),
                             F.var_samp("va").alias("saa"), F.var_samp("vb").alias("sbb"), F.covar_samp("va", "vb").alias("sab"))
    pos = s.where(F.col(label) == 1).select(F.lit(1).alias("_k"), *[F.col(c).alias(f"p_{c}") for c in ("n", "ma", "mb", "saa", "sbb", "sab")])
    neg = s.where(F.col(label) == 0).select(F.lit(1).alias("_k"), *[F.col(c).alias(f"n_{c}") for c in ("n", "saa", "sbb", "sab")])
    r = pos.join(neg, "_k")
    var = (F.col("p_saa") + F.col("p_sbb") - 2 * F.col("p_sab")) / F.col("p_n") + (F.col("n_saa") + F.col("n_sbb") - 2 * F.col("n_sab")) / F.col("n_n")
    z = (F.col("p_ma") - F.col("p_mb")) / F.sqrt(var)
    return r.select(F.round("p_ma", 6).alias("auc_a"), F.round("p_mb", 6).alias("auc_b"), F.round(z, 6).alias("z"),
                    F.round(2 * normal_sf(F.abs(z)), 6).alias("p_value"))
