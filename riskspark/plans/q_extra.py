"""Remaining inventory rows: split panel and gap (EVAL-12/17), rank-order check (DRIFT-09),
per-feature PSI thresholds (DRIFT-06), domains and fingerprints (DQ-02/03), governance
verdict (POL-13 / DRIFT-10), five-gate promotion (POL-09), gate ladder (POL-17),
model-based drift (DRIFT-17) and curve calibration (FN-03)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import drift as dr
from riskspark.operators import metrics as mx
from riskspark.operators import models as md
from riskspark.operators import split as sp
from riskspark.plans import q_audit, q_drift, q_joins, q_more  # noqa: F401  (their oracle texts are reused here)
from riskspark.plans.catalog import ORACLE, register
from riskspark.plans.frames import SCORED_SQL, model_scores, scored, split_unit_sql
from riskspark.plans.q_drift import PSI_HEAD, long_frames
from riskspark.session import cut_lineage
from riskspark.sources.io import table
from riskspark.operators.quantiles import exact_quantiles

ROW_SPLIT = f"CASE WHEN {split_unit_sql('id')} < 0.2 THEN 'test' WHEN {split_unit_sql('id')} < 0.4 THEN 'val' ELSE 'train' END"
PANEL_SQL = f"""
x AS (SELECT *, {ROW_SPLIT} AS split FROM ({SCORED_SQL})),
d AS (SELECT split, p AS sc, sum(y) AS pos, sum(1 - y) AS neg FROM x GROUP BY split, p),
c AS (SELECT split, sc, pos, neg,
        sum(pos) OVER (PARTITION BY split ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
        sum(neg) OVER (PARTITION BY split ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
        sum(pos) OVER (PARTITION BY split) AS TP, sum(neg) OVER (PARTITION BY split) AS TN FROM d),
rk AS (SELECT split, CAST(sum(pos + neg) AS BIGINT) AS n, CAST(max(TP) AS BIGINT) AS n_pos,
        round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc,
        round(sum(pos * (TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)) / max(TP), 6) AS ap,
        round(sum(pos * ((TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)
              + CASE WHEN TP - cpos + TN - cneg = 0 THEN 1.0 ELSE (TP - cpos) / (TP - cpos + TN - cneg) END) / 2.0) / max(TP), 6) AS pr_auc,
        round(max(abs(cpos / TP - cneg / TN)), 6) AS ks FROM c GROUP BY split),
eb AS (SELECT split, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM x GROUP BY split, bin),
ec AS (SELECT split, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM eb JOIN (SELECT split, sum(nb) AS tot FROM eb GROUP BY split) USING (split) GROUP BY split),
br AS (SELECT split, round(avg((p - y) * (p - y)), 6) AS brier, round(avg(y), 6) AS rate FROM x GROUP BY split),
panel AS (SELECT split, n, n_pos, auc, ap, pr_auc, ks, brier, ece, rate FROM rk JOIN br USING (split) JOIN ec USING (split))"""


def split_panel(spark, sf):
    s = sp.row_split(scored(spark, sf, with_group=False), "id")
    return mx.metric_panel(s, "split", "p", "y")


@register("eval17_split_panel", f"WITH {PANEL_SQL} SELECT * FROM panel")
def q_eval17(spark, sf):
    """EVAL-17 / EVAL-16: AUC, AP, PR-AUC, KS, Brier, ECE and base rate per split in one table."""
    return split_panel(spark, sf)


@register("eval12_generalisation_gap", f"""
WITH {PANEL_SQL}, l AS (SELECT split, 'auc' AS metric, CAST(auc AS DOUBLE) AS v FROM panel UNION ALL SELECT split, 'ks', ks FROM panel
  UNION ALL SELECT split, 'brier', brier FROM panel UNION ALL SELECT split, 'ece', ece FROM panel)
SELECT a.metric, a.v AS base_value, b.v AS other_value, round(a.v - b.v, 6) AS gap FROM l a JOIN l b ON a.metric = b.metric
WHERE a.split = 'train' AND b.split = 'test'""")
def q_eval12(spark, sf):
    """EVAL-12: train − test gap of each metric (pivot of the per-split panel)."""
    return mx.generalisation_gap(split_panel(spark, sf), "split", "train", "test")


@register("drift09_rank_order", f"""
WITH s AS ({SCORED_SQL}), x AS (SELECT *, year(ts) AS period FROM s),
e AS (SELECT period, quantile_cont(p_raw, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM x GROUP BY period),
d AS (SELECT x.period, CAST(len(list_filter(edges, lambda q: q < p_raw)) AS INTEGER) + 1 AS decile, avg(y) AS rate FROM x JOIN e USING (period) GROUP BY x.period, decile),
i AS (SELECT period, CASE WHEN rate < lag(rate) OVER (PARTITION BY period ORDER BY decile) THEN 1 ELSE 0 END AS inv FROM d)
SELECT CAST(period AS INTEGER) AS period, CAST(sum(inv) AS BIGINT) AS inversions, CAST(sum(inv) = 0 AS INTEGER) AS rank_ordered FROM i GROUP BY period""")
def q_drift09(spark, sf):
    """DRIFT-09: per period, observed default rate by score decile must not fall from one decile to the next."""
    s = scored(spark, sf, with_group=False).withColumn("period", F.year("ts"))
    e = exact_quantiles(s, "p_raw", [i / 10 for i in range(1, 10)], ["period"], "edges")
    d = s.join(e, "period").withColumn("decile", F.size(F.filter("edges", lambda q: q < F.col("p_raw"))) + 1) \
         .groupBy("period", "decile").agg(F.avg("y").alias("rate"))
    w = Window.partitionBy("period").orderBy("decile")  # ten rows per period
    i = d.withColumn("inv", F.when(F.col("rate") < F.lag("rate").over(w), 1).otherwise(0))
    return i.groupBy(F.col("period").cast("int").alias("period")).agg(F.sum("inv").cast("long").alias("inversions"),
                                                                     (F.sum("inv") == 0).cast("int").alias("rank_ordered"))


# PSI status cut-offs per feature group (warn, alert).
FEATURE_THRESHOLDS = [("f_value", 0.10, 0.25), ("f_k", 0.10, 0.20), ("f_hour", 0.15, 0.30)]


@register("drift06_feature_thresholds", f"""{PSI_HEAD},
th AS (SELECT * FROM (VALUES {", ".join(f"('{f}', {w}, {a})" for f, w, a in FEATURE_THRESHOLDS)}) t(feature, warn, alert))
SELECT batch_day, feature, round(psi, 6) AS psi, CASE WHEN psi > alert THEN 'ALERT' WHEN psi > warn THEN 'WARN' ELSE 'OK' END AS status
FROM psi JOIN th USING (feature)""")
def q_drift06(spark, sf):
    """DRIFT-06: PSI status with cut-offs looked up per feature from a threshold table."""
    ref, act = long_frames(spark, sf)
    th = spark.createDataFrame(FEATURE_THRESHOLDS, "feature string, warn double, alert double")
    p = dr.psi(ref, act, "batch_day").join(th, "feature")
    return p.select("batch_day", "feature", F.round("psi", 6).alias("psi"), dr.psi_status(F.col("psi"), F.col("warn"), F.col("alert")).alias("status"))


@register("dq03_domains_fingerprints", """
WITH a AS (SELECT count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS bad_flag, count(*) FILTER (WHERE l_linestatus NOT IN ('O', 'F')) AS bad_status,
  count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS bad_qty, avg(l_quantity) AS mq, min(l_quantity) AS lo, max(l_quantity) AS hi,
  count(*) - count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS dup_keys FROM lineitem)
SELECT 'returnflag_domain' AS "check", CASE WHEN bad_flag = 0 THEN 'PASS' ELSE 'FAIL' END AS result, printf('%d outside', bad_flag) AS detail FROM a
UNION ALL SELECT 'linestatus_domain', CASE WHEN bad_status = 0 THEN 'PASS' ELSE 'FAIL' END, printf('%d outside', bad_status) FROM a
UNION ALL SELECT 'quantity_range', CASE WHEN bad_qty = 0 THEN 'PASS' ELSE 'FAIL' END, printf('%d outside 1..50', bad_qty) FROM a
UNION ALL SELECT 'quantity_fingerprint', 'INFO', printf('mean=%.6f min=%.1f max=%.1f', mq, lo, hi) FROM a
UNION ALL SELECT 'line_key_unique', CASE WHEN dup_keys = 0 THEN 'PASS' ELSE 'FAIL' END, printf('%d duplicate keys', dup_keys) FROM a""")
def q_dq03(spark, sf):
    """DQ-02/03: value domains, a range check, mean/min/max fingerprint and key uniqueness in one aggregation."""
    li = table(spark, sf, "lineitem")
    a = li.agg(F.count_if(~F.col("l_returnflag").isin("A", "N", "R")).alias("bad_flag"),
               F.count_if(~F.col("l_linestatus").isin("O", "F")).alias("bad_status"),
               F.count_if((F.col("l_quantity") < 1) | (F.col("l_quantity") > 50)).alias("bad_qty"),
               F.avg("l_quantity").alias("mq"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"),
               (F.count(F.lit(1)) - F.count_distinct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")).alias("dup_keys"))
    st = F.stack(F.lit(5),
                 F.lit("returnflag_domain"), F.when(F.col("bad_flag") == 0, "PASS").otherwise("FAIL"), F.format_string("%d outside", "bad_flag"),
                 F.lit("linestatus_domain"), F.when(F.col("bad_status") == 0, "PASS").otherwise("FAIL"), F.format_string("%d outside", "bad_status"),
                 F.lit("quantity_range"), F.when(F.col("bad_qty") == 0, "PASS").otherwise("FAIL"), F.format_string("%d outside 1..50", "bad_qty"),
                 F.lit("quantity_fingerprint"), F.lit("INFO"), F.format_string("mean=%.6f min=%.1f max=%.1f", "mq", "lo", "hi"),
                 F.lit("line_key_unique"), F.when(F.col("dup_keys") == 0, "PASS").otherwise("FAIL"), F.format_string("%d duplicate keys", "dup_keys"))
    return a.select(st.alias("check", "result", "detail"))


def _inner(sql: str) -> str:
    return sql.strip()


@register("pol13_governance_verdict")
def q_pol13(spark, sf):
    """POL-13 / DRIFT-10: per period the most severe monitor signal decides APPROVE / MONITOR / CHALLENGE / RETIRE."""
    e = q_drift.q_drift08(spark, sf).select("period", F.col("status").alias("ece_status"))
    g = q_drift.q_drift19(spark, sf).select("period", "gini_drop")
    d = q_drift.q_drift11(spark, sf).select("period", "approve_pp_change")
    j = e.join(g, "period").join(d, "period")
    sev = F.greatest(
        F.when(F.col("gini_drop") > 0.10, 3).when(F.col("gini_drop") > 0.03, 2).otherwise(0),
        F.when(F.col("ece_status") == "ALERT", 2).when(F.col("ece_status") == "WARN", 1).otherwise(0),
        F.when(F.abs(F.coalesce(F.col("approve_pp_change"), F.lit(0.0))) > 5, 1).otherwise(0))
    verdict = F.element_at(F.array(*[F.lit(v) for v in ("APPROVE", "MONITOR", "CHALLENGE", "RETIRE")]), sev + 1)
    return j.select("period", "ece_status", "gini_drop", "approve_pp_change", sev.alias("severity"), verdict.alias("verdict"))


ORACLE["pol13_governance_verdict"] = f"""
WITH e AS ({_inner(ORACLE['drift08_ece_by_period'])}), g AS ({_inner(ORACLE['drift19_concept_drift'])}), d AS ({_inner(ORACLE['drift11_decision_monitor'])}),
j AS (SELECT e.period, e.status AS ece_status, g.gini_drop, d.approve_pp_change FROM e JOIN g USING (period) JOIN d USING (period)),
v AS (SELECT *, greatest(CASE WHEN gini_drop > 0.1 THEN 3 WHEN gini_drop > 0.03 THEN 2 ELSE 0 END,
                          CASE WHEN ece_status = 'ALERT' THEN 2 WHEN ece_status = 'WARN' THEN 1 ELSE 0 END,
                          CASE WHEN abs(coalesce(approve_pp_change, 0.0)) > 5 THEN 1 ELSE 0 END) AS severity FROM j)
SELECT period, ece_status, gini_drop, approve_pp_change, severity,
  (['APPROVE', 'MONITOR', 'CHALLENGE', 'RETIRE'])[severity + 1] AS verdict FROM v"""


# Gate order and thresholds of the promotion ladder.
GATES = [("leakage", 1), ("discrimination", 2), ("calibration", 3), ("significance", 4), ("fairness", 5), ("drift", 6), ("labels", 7)]


@register("pol17_gate_ladder")
def q_pol17(spark, sf):
    """POL-17: per model, gate rows (leakage, discrimination, calibration, significance, fairness,
    drift, labels) and the first failing gate with its action."""
    from riskspark.plans import q_audit, q_joins
    ms = model_scores(spark, sf)
    pan = mx.ranking_metrics(ms, "p", "y", ["model"]).join(mx.ece(ms, "p", "y", ["model"]), "model")
    appr = ms.groupBy("model", "grp").agg(F.avg((F.col("p") < 0.2).cast("int")).alias("a"))
    di = appr.groupBy("model").agg(F.try_divide(F.min("a"), F.max("a")).alias("di"))
    leak = q_audit.q_leak06(spark, sf).select(F.lit(1).alias("_k"), (F.col("status") == "PASS").alias("leak_ok"))
    drift = q_drift.q_drift05(spark, sf).agg(F.max("severity").alias("ds")).select(F.lit(1).alias("_k"), (F.col("ds") < 2).alias("drift_ok"))
    labels = q_joins.q_join09(spark, sf).agg(F.avg(F.col("label").isNotNull().cast("int")).alias("cov")).select(F.lit(1).alias("_k"), (F.col("cov") >= 0.5).alias("labels_ok"))
    j = pan.join(di, "model").withColumn("_k", F.lit(1)).join(leak, "_k").join(drift, "_k").join(labels, "_k")
    def gate(order, name, ok, action):
        return F.struct(F.lit(order).alias("ord"), F.lit(name).alias("gate"), ok.alias("ok"), F.lit(action).alias("action"))

    gates = F.array(
        gate(1, "leakage", F.col("leak_ok"), "block: fix features"),
        gate(2, "discrimination", F.col("auc") >= 0.6, "reject model"),
        gate(3, "calibration", F.col("ece") <= 0.05, "recalibrate"),
        gate(4, "significance", F.col("n_pos") >= 100, "collect more labels"),
        gate(5, "fairness", (F.col("di") >= 0.8) & (F.col("di") <= 1.25), "fairness review"),
        gate(6, "drift", F.col("drift_ok"), "investigate drift"),
        gate(7, "labels", F.col("labels_ok"), "wait for outcomes"))
    g = j.select("model", F.explode(gates).alias("g")).select("model", "g.*")
    first = g.where(~F.col("ok")).groupBy("model").agg(F.min_by("gate", "ord").alias("first_failed"), F.min_by("action", "ord").alias("action"))
    return g.groupBy("model").agg(F.count_if(F.col("ok")).alias("gates_passed")).join(first, "model", "left") \
            .withColumn("verdict", F.when(F.col("first_failed").isNull(), "PROMOTE").otherwise("HOLD"))


@register("pol09_five_gate_promotion")
def q_pol09(spark, sf):
    """POL-09: four gates plus calibration-curve divergence (max |Δ observed| per decile bin ≤ 0.05),
    a DeLong significance gate (p < 0.05) and an ECE ratio limit of 1.10 vs the champion."""
    s = scored(spark, sf, with_group=False).withColumn(
        "p_chal", F.round(F.lit(0.8) * F.col("p_raw") + F.lit(0.2) * X.stable_unit("id", ":chal"), 6))
    long = s.select("id", "y", F.explode(F.array(F.struct(F.lit("champion").alias("model"), F.col("p_raw").alias("p")),
                                                 F.struct(F.lit("challenger").alias("model"), F.col("p_chal").alias("p")))).alias("m")).select("id", "y", "m.*")
    pan = mx.ranking_metrics(long, "p", "y", ["model"]).join(mx.ece(long, "p", "y", ["model"]), "model").join(mx.brier(long, "p", "y", ["model"]), "model")
    cur = mx.calibration_curve(long, "p", "y", ["model"])
    div = cur.groupBy("bin").pivot("model", ["champion", "challenger"]).agg(F.first("frac_pos")) \
             .agg(F.max(F.abs(F.col("champion") - F.col("challenger"))).alias("curve_div"))
    dl = mx.delong(s, "id", "p_chal", "p_raw").select("p_value")
    c = pan.where(F.col("model") == "champion").select(*[F.col(x).alias(f"c_{x}") for x in ("auc", "pr_auc", "ece", "brier")])
    h = pan.where(F.col("model") == "challenger")
    j = h.withColumn("_k", F.lit(1)).join(c.withColumn("_k", F.lit(1)), "_k").join(div.withColumn("_k", F.lit(1)), "_k").join(dl.withColumn("_k", F.lit(1)), "_k")
    gates = {"pr_auc": F.col("pr_auc") - F.col("c_pr_auc") >= 0.001, "auc": F.col("auc") - F.col("c_auc") >= 0.001,
             "ece_ratio": F.col("ece") <= 1.10 * F.col("c_ece"), "brier": F.col("brier") - F.col("c_brier") <= 0.003,
             "curve": F.col("curve_div") <= 0.05, "delong": F.col("p_value") < 0.05}
    out = j.select(*[g.cast("int").alias(f"gate_{k}") for k, g in gates.items()], F.round("curve_div", 6).alias("curve_div"), F.round("p_value", 6).alias("p_value"))
    allp = F.lit(1)
    for k in gates:
        allp = allp * F.col(f"gate_{k}")
    return out.withColumn("decision", F.when(F.col("gate_ece_ratio") == 0, "REJECT").when(allp == 1, "PROMOTE").otherwise("HOLD"))


@register("drift17_model_based_drift")
def q_drift17(spark, sf):
    """DRIFT-17: AUC, on a held-out half, of a logistic classifier telling the reference (days 1-6) from all
    later days, for the days after each shift: 0.5 means no joint shift is detectable."""
    d = q_drift.monitored(spark, sf).withColumn("side", (F.col("batch_day") > q_drift.REF_LAST_DAY).cast("int")) \
               .withColumn("half", (X.stable_unit("event_id", ":half") < 0.5).cast("int"))
    d = cut_lineage(d.where(F.col("batch_day").isNotNull()))
    model = md.logistic(q_drift.FEATS, label="side", weight=None, C=1.0, n=d.count()).fit(d.where("half = 1"))
    starts = [day for day, _ in q_drift.SHIFT]
    period = F.aggregate(F.array(*[F.lit(s) for s in starts]), F.lit(starts[0]), lambda a, s: F.when(F.col("batch_day") >= s, s).otherwise(a))
    pr = md.prob1(model.transform(d.where("half = 0")))
    # reference rows stand on the other side of every period
    pr = pr.withColumn("from_day", F.explode(F.when(F.col("side") == 0, F.array(*[F.lit(s) for s in starts])).otherwise(F.array(period))))
    return mx.ranking_metrics(pr, "p_model", "side", ["from_day"]).select("from_day", "n", "auc")


@register("fn03_curve_calibration")
def q_fn03(spark, sf):
    """FN-03: a served calibration curve (EVAL-07 points fitted on train, ≤ 10 knots) applied to
    every row with piecewise-linear interpolation clamped at both ends; ECE before and after."""
    s = sp.row_split(scored(spark, sf, with_group=False), "id")
    pts = mx.calibration_curve(s.where(F.col("split") == "train"), "p_raw", "y").orderBy("mean_pred").collect()  # ≤ n_bins rows
    xs, ys = [r.mean_pred for r in pts], [r.frac_pos for r in pts]
    c = s.withColumn("p_curve", X.interp("p_raw", xs, ys))
    test = c.where(F.col("split") == "test")
    long = test.select("y", F.explode(F.array(F.struct(F.lit("raw").alias("score"), F.col("p_raw").alias("p")),
                                               F.struct(F.lit("curve").alias("score"), F.col("p_curve").alias("p")))).alias("u")).select("y", "u.*")
    return mx.ece(long, "p", "y", ["score"])


@register("drift18_pca_reconstruction")
def q_drift18_pca(spark, sf):
    """DRIFT-18 (PCA part): principal components fitted on standardised reference batches; the mean
    squared reconstruction error of each batch from the first two components, and its ratio to the
    reference's — joint shifts that move no single marginal still raise it."""
    from pyspark.ml.feature import PCA
    from riskspark.operators import prep as pr
    m = q_drift.monitored(spark, sf)
    ref = m.where(F.col("batch_day") <= q_drift.REF_LAST_DAY)
    st = pr.fit_scaler(ref, q_drift.FEATS)
    z = pr.apply_scaler(m, st, q_drift.FEATS)
    zc = [f"{c}_z" for c in q_drift.FEATS]
    pca = PCA(k=2, inputCol="features", outputCol="pc").fit(md.assemble(zc).transform(z.where(F.col("batch_day") <= q_drift.REF_LAST_DAY)))
    comp = pca.pc.toArray().tolist()  # features x k loadings (bounded by the feature count)
    proj = [sum(F.col(c) * F.lit(comp[i][j]) for i, c in enumerate(zc)) for j in range(2)]
    recon = [sum(proj[j] * F.lit(comp[i][j]) for j in range(2)) for i in range(len(zc))]
    err = sum((F.col(c) - recon[i]) * (F.col(c) - recon[i]) for i, c in enumerate(zc))
    e = z.groupBy("batch_day").agg(F.avg(err).alias("recon_mse"))
    base = e.where(F.col("batch_day") <= q_drift.REF_LAST_DAY).agg(F.avg("recon_mse").alias("ref_mse")).withColumn("_k", F.lit(1))
    return e.withColumn("_k", F.lit(1)).join(base, "_k").select(
        "batch_day", F.round("recon_mse", 6).alias("recon_mse"), F.round(F.col("recon_mse") / F.col("ref_mse"), 6).alias("ratio_to_ref"))


def _pol17_sql() -> str:
    from riskspark.plans.frames import MODELS_SQL
    from riskspark.plans.q_eval import cdf_sql
    return f"""
WITH ms AS ({MODELS_SQL}), {cdf_sql('p', 'model', 'ms')},
rk AS (SELECT model, round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc, max(TP) AS n_pos FROM c GROUP BY model),
eb AS (SELECT model, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM ms GROUP BY model, bin),
ec AS (SELECT model, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM eb JOIN (SELECT model, sum(nb) AS tot FROM eb GROUP BY model) USING (model) GROUP BY model),
ap AS (SELECT model, grp, avg(CAST(p < 0.2 AS INTEGER)) AS a FROM ms GROUP BY model, grp),
di AS (SELECT model, min(a) / max(a) AS di FROM ap GROUP BY model),
lk AS (SELECT status = 'PASS' AS leak_ok FROM ({ORACLE['leak06_temporal_leak'].strip()})),
dr AS (SELECT max(severity) < 2 AS drift_ok FROM ({ORACLE['drift05_monitor'].strip()})),
lb AS (SELECT avg(CAST(label IS NOT NULL AS INTEGER)) >= 0.5 AS labels_ok FROM ({ORACLE['join09_delayed_labels'].strip()})),
j AS (SELECT * FROM rk JOIN ec USING (model) JOIN di USING (model), lk, dr, lb),
g AS (SELECT model, 1 AS ord, 'leakage' AS gate, leak_ok AS ok, 'block: fix features' AS action FROM j
  UNION ALL SELECT model, 2, 'discrimination', auc >= 0.6, 'reject model' FROM j
  UNION ALL SELECT model, 3, 'calibration', ece <= 0.05, 'recalibrate' FROM j
  UNION ALL SELECT model, 4, 'significance', n_pos >= 100, 'collect more labels' FROM j
  UNION ALL SELECT model, 5, 'fairness', di >= 0.8 AND di <= 1.25, 'fairness review' FROM j
  UNION ALL SELECT model, 6, 'drift', drift_ok, 'investigate drift' FROM j
  UNION ALL SELECT model, 7, 'labels', labels_ok, 'wait for outcomes' FROM j),
f AS (SELECT model, arg_min(gate, ord) AS first_failed, arg_min(action, ord) AS action FROM g WHERE NOT ok GROUP BY model),
p AS (SELECT model, count(*) FILTER (WHERE ok) AS gates_passed FROM g GROUP BY model)
SELECT p.model, p.gates_passed, f.first_failed, f.action, CASE WHEN f.first_failed IS NULL THEN 'PROMOTE' ELSE 'HOLD' END AS verdict
FROM p LEFT JOIN f USING (model)"""


ORACLE["pol17_gate_ladder"] = _pol17_sql()


def _pol09_sql() -> str:
    chal = ("round(0.8 * p_raw + 0.2 * CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':chal'), 1, 8) AS BIGINT) AS DOUBLE) "
            "/ 4294967296.0, 6)")
    return f"""
WITH s AS ({SCORED_SQL}), lg AS (SELECT 'champion' AS model, id, y, p_raw AS p FROM s UNION ALL SELECT 'challenger', id, y, {chal} FROM s),
d AS (SELECT model, p AS sc, sum(y) AS pos, sum(1 - y) AS neg FROM lg GROUP BY model, p),
c AS (SELECT model, pos, neg, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg, sum(pos) OVER (PARTITION BY model) AS TP,
        sum(neg) OVER (PARTITION BY model) AS TN FROM d WINDOW w AS (PARTITION BY model ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rk AS (SELECT model, round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc,
        round(sum(pos * ((TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)
              + CASE WHEN TP - cpos + TN - cneg = 0 THEN 1.0 ELSE (TP - cpos) / (TP - cpos + TN - cneg) END) / 2.0) / max(TP), 6) AS pr_auc FROM c GROUP BY model),
eb AS (SELECT model, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM lg GROUP BY model, bin),
ec AS (SELECT model, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM eb JOIN (SELECT model, sum(nb) AS tot FROM eb GROUP BY model) USING (model) GROUP BY model),
br AS (SELECT model, round(avg((p - y) * (p - y)), 6) AS brier FROM lg GROUP BY model),
pan AS (SELECT * FROM rk JOIN ec USING (model) JOIN br USING (model)),
cur AS (SELECT model, bin, round(acc, 6) AS frac_pos FROM eb),
dv AS (SELECT max(abs(a.frac_pos - b.frac_pos)) AS curve_div FROM cur a JOIN cur b ON a.bin = b.bin AND a.model = 'champion' AND b.model = 'challenger'),
dl AS (SELECT p_value FROM ({ORACLE['eval14_delong'].strip()})),
j AS (SELECT h.*, c.auc AS c_auc, c.pr_auc AS c_pr_auc, c.ece AS c_ece, c.brier AS c_brier, dv.curve_div, dl.p_value
      FROM pan h, pan c, dv, dl WHERE h.model = 'challenger' AND c.model = 'champion'),
g AS (SELECT CAST(pr_auc - c_pr_auc >= 0.001 AS INTEGER) AS gate_pr_auc, CAST(auc - c_auc >= 0.001 AS INTEGER) AS gate_auc,
        CAST(ece <= 1.1 * c_ece AS INTEGER) AS gate_ece_ratio, CAST(brier - c_brier <= 0.003 AS INTEGER) AS gate_brier,
        CAST(curve_div <= 0.05 AS INTEGER) AS gate_curve, CAST(p_value < 0.05 AS INTEGER) AS gate_delong,
        round(curve_div, 6) AS curve_div, round(p_value, 6) AS p_value FROM j)
SELECT *, CASE WHEN gate_ece_ratio = 0 THEN 'REJECT'
               WHEN gate_pr_auc * gate_auc * gate_ece_ratio * gate_brier * gate_curve * gate_delong = 1 THEN 'PROMOTE' ELSE 'HOLD' END AS decision FROM g"""


ORACLE["pol09_five_gate_promotion"] = _pol09_sql()


ORACLE["fn03_curve_calibration"] = f"""
WITH s AS (SELECT *, {ROW_SPLIT} AS split FROM ({SCORED_SQL})),
pts AS (SELECT round(avg(p_raw), 6) AS mx, round(avg(y), 6) AS my FROM s WHERE split = 'train' GROUP BY least(CAST(floor(p_raw * 10) AS INTEGER), 9)),
cv AS (SELECT list(mx ORDER BY mx) AS xs, list(my ORDER BY mx) AS ys, count(*) AS n FROM pts),
t AS (SELECT s.y, s.p_raw, cv.xs, cv.ys, cv.n, CAST(len(list_filter(cv.xs, lambda e: e <= s.p_raw)) AS INTEGER) AS k FROM s, cv WHERE s.split = 'test'),
i AS (SELECT y, p_raw, CASE WHEN k <= 0 THEN ys[1] WHEN k >= n THEN ys[n]
        ELSE coalesce(ys[k] + (ys[k + 1] - ys[k]) * (CASE WHEN xs[k + 1] - xs[k] = 0 THEN NULL ELSE (p_raw - xs[k]) / (xs[k + 1] - xs[k]) END), ys[k]) END AS p_curve FROM t),
l AS (SELECT 'raw' AS score, p_raw AS p, y FROM i UNION ALL SELECT 'curve', p_curve, y FROM i),
b AS (SELECT score, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM l GROUP BY score, bin)
SELECT score, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM b JOIN (SELECT score, sum(nb) AS tot FROM b GROUP BY score) USING (score) GROUP BY score"""
