"""Policy and fairness queries (POL-*, FAIR-*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import fairness as fa
from riskspark.operators import metrics as mx
from riskspark.operators import policy as po
from riskspark.plans.catalog import register
from riskspark.plans.frames import MODELS_SQL, model_scores, scored
from riskspark.plans.q_eval import S, SWEEP_SQL, cdf_sql

THETA = round(1 / 11, 6)


@register("pol01_cost_sensitivity", f"""
WITH sw AS ({SWEEP_SQL}), r AS (SELECT unnest([2.0, 5.0, 10.0, 20.0]) AS cost_ratio),
l AS (SELECT cost_ratio, threshold, (cost_ratio * fn + fp) / (tp + fp + tn + fn) AS loss, (tn + fn) / (tp + fp + tn + fn) AS appr FROM sw, r),
b AS (SELECT cost_ratio, first(threshold ORDER BY loss, threshold) AS best_threshold, min(loss) AS loss, first(appr ORDER BY loss, threshold) AS appr FROM l GROUP BY cost_ratio),
{S}, z AS (SELECT count(*) AS n, count(*) FILTER (WHERE p < 0.2 AND y = 1) AS bad_ap, count(*) FILTER (WHERE p >= 0.4 AND y = 0) AS good_rj,
  count(*) FILTER (WHERE p >= 0.2 AND p < 0.4) AS n_rv, count(*) FILTER (WHERE p >= 0.2 AND p < 0.4 AND y = 1) AS bad_rv FROM s),
e AS (SELECT b.*, (cost_ratio * (bad_ap + floor(bad_rv * 0.5)) + good_rj + floor((n_rv - bad_rv) * 0.5) + 0.3 * n_rv) / n AS el3 FROM b, z)
SELECT cost_ratio, round(1.0 / (cost_ratio + 1.0), 6) AS theta_star, best_threshold, round(loss, 6) AS best_loss,
  round(appr, 6) AS approval_rate, round(el3, 6) AS three_zone_loss, round(el3 - loss, 6) AS three_zone_overhead FROM e""")
def q_pol01(spark, sf):
    """POL-01/06: Bayes threshold, empirical best threshold with its approval rate, and the three-zone overhead per cost ratio."""
    sw = mx.threshold_sweep(scored(spark, sf, with_group=False), "p", "y")
    return po.cost_sensitivity(sw, [2.0, 5.0, 10.0, 20.0])


@register("pol02_expected_loss_single", f"""
WITH {S} SELECT grp, round((10.0 * count(*) FILTER (WHERE p < {THETA} AND y = 1) + 1.0 * count(*) FILTER (WHERE p >= {THETA} AND y = 0)) / count(*), 6) AS expected_loss
FROM s GROUP BY grp""")
def q_pol02(spark, sf):
    return po.expected_loss(scored(spark, sf), THETA, "p", "y", ["grp"])


def zone_sql(review_split: bool, src: str = "s", keys: str = "grp", lo: str = "0.2", hi: str = "0.4", score: str = "p", pre: str = "") -> str:
    fn_rv = "floor(bad_rv * 0.5)" if review_split else "0"
    fp_rv = "floor((n_rv - bad_rv) * 0.5)" if review_split else "0"
    return f"""
WITH {S}{pre}, a AS (SELECT {keys},
  count(*) FILTER (WHERE {score} < {lo}) AS n_ap, count(*) FILTER (WHERE {score} < {lo} AND y = 1) AS bad_ap,
  count(*) FILTER (WHERE {score} >= {lo} AND {score} < {hi}) AS n_rv, count(*) FILTER (WHERE {score} >= {lo} AND {score} < {hi} AND y = 1) AS bad_rv,
  count(*) FILTER (WHERE {score} >= {hi}) AS n_rj, count(*) FILTER (WHERE {score} >= {hi} AND y = 1) AS bad_rj
  FROM {src} GROUP BY {keys})
SELECT {keys}, n_ap, n_rv, n_rj, round(n_ap / (n_ap + n_rv + n_rj), 6) AS approve_rate, round(n_rv / (n_ap + n_rv + n_rj), 6) AS review_rate,
  round(n_rj / (n_ap + n_rv + n_rj), 6) AS reject_rate,
  round(CASE WHEN n_ap = 0 THEN NULL ELSE bad_ap / n_ap END, 6) AS bad_rate_ap,
  round(CASE WHEN n_rv = 0 THEN NULL ELSE bad_rv / n_rv END, 6) AS bad_rate_rv,
  round(CASE WHEN n_rj = 0 THEN NULL ELSE bad_rj / n_rj END, 6) AS bad_rate_rj,
  bad_ap AS fn_approve, n_rj - bad_rj AS fp_reject, CAST({fn_rv} AS BIGINT) AS fn_review, CAST({fp_rv} AS BIGINT) AS fp_review,
  round((10.0 * (bad_ap + {fn_rv}) + 1.0 * (n_rj - bad_rj + {fp_rv}) + 0.3 * n_rv) / (n_ap + n_rv + n_rj), 6) AS expected_loss
FROM a"""


@register("pol03_three_zone_loss", zone_sql(True))
def q_pol03(spark, sf):
    return po.three_zone_loss(scored(spark, sf), 0.2, 0.4, "p", "y", ["grp"])


@register("pol04_three_zone_no_review_split", zone_sql(False))
def q_pol04(spark, sf):
    return po.three_zone_loss(scored(spark, sf), 0.2, 0.4, "p", "y", ["grp"], review_split=False)


SCEN = [("S1", 0.05, 0.28), ("S2", 0.06, 0.28), ("S3", 0.10, 0.30), ("S4", 0.20, 0.40)]
SCEN_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {lo}, {hi})" for n, lo, hi in SCEN) + ") t(scenario, lo, hi)"


@register("pol05_scenario_comparison", zone_sql(True, src="x", keys="scenario", lo="lo", hi="hi", score="p",
                                                pre=f", sc AS ({SCEN_SQL}), x AS (SELECT sc.*, s.p, s.y FROM s, sc)"))
def q_pol05(spark, sf):
    return po.scenario_comparison(scored(spark, sf, with_group=False), SCEN)


@register("pol07_raw_vs_calibrated_loss", f"""
WITH {S}, l AS (SELECT 'p' AS score_kind, p AS v, y FROM s UNION ALL SELECT 'p_raw', p_raw, y FROM s),
t AS (SELECT unnest([{THETA}, 0.2, 0.4]) AS threshold)
SELECT score_kind, threshold, count(*) FILTER (WHERE v < threshold AND y = 1) AS fn, count(*) FILTER (WHERE v >= threshold AND y = 0) AS fp,
  round((10.0 * count(*) FILTER (WHERE v < threshold AND y = 1) + 1.0 * count(*) FILTER (WHERE v >= threshold AND y = 0)) / count(*), 6) AS expected_loss
FROM l, t GROUP BY score_kind, threshold""")
def q_pol07(spark, sf):
    return po.losses_at_thresholds(scored(spark, sf, with_group=False), [THETA, 0.2, 0.4], ["p", "p_raw"])


def panel_sql() -> str:
    return f"""
ms AS ({MODELS_SQL}), {cdf_sql('p', 'model', 'ms')},
rk AS (SELECT model, round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc,
        round(sum(pos * ((TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)
              + CASE WHEN TP - cpos + TN - cneg = 0 THEN 1.0 ELSE (TP - cpos) / (TP - cpos + TN - cneg) END) / 2.0) / max(TP), 6) AS pr_auc,
        round(max(abs(cpos / TP - cneg / TN)), 6) AS ks FROM c GROUP BY model),
eb AS (SELECT model, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM ms GROUP BY model, bin),
ec AS (SELECT model, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM eb JOIN (SELECT model, sum(nb) AS tot FROM eb GROUP BY model) USING (model) GROUP BY model),
br AS (SELECT model, round(avg((p - y) * (p - y)), 6) AS brier, round(regr_slope(y, p), 6) AS calib_slope FROM ms GROUP BY model),
panel AS (SELECT * FROM rk JOIN ec USING (model) JOIN br USING (model))"""


def model_panel(spark, sf):
    ms = model_scores(spark, sf)
    r = mx.ranking_metrics(ms, "p", "y", ["model"]).select("model", "auc", "pr_auc", "ks")
    e = mx.ece(ms, "p", "y", ["model"])
    b = mx.brier(ms, "p", "y", ["model"])
    slope = ms.groupBy("model").agg(F.round(F.regr_slope("y", "p"), 6).alias("calib_slope"))
    return r.join(e, "model").join(b, "model").join(slope, "model")


@register("pol08_promotion_decision", f"""
WITH {panel_sql()}, ch AS (SELECT * FROM panel WHERE model = 'calibrated')
SELECT o.model AS challenger, round(o.pr_auc - ch.pr_auc, 6) AS pr_auc_delta, round(o.auc - ch.auc, 6) AS auc_delta,
  round(o.ece - ch.ece, 6) AS ece_delta, round(o.brier - ch.brier, 6) AS brier_delta,
  CAST((o.pr_auc - ch.pr_auc >= 0.001) AS INTEGER) + CAST((o.auc - ch.auc >= 0.001) AS INTEGER)
    + CAST((o.ece - ch.ece <= 0.005) AS INTEGER) + CAST((o.brier - ch.brier <= 0.003) AS INTEGER) AS gates_passed,
  CASE WHEN NOT (o.ece - ch.ece <= 0.005) THEN 'REJECT'
       WHEN o.pr_auc - ch.pr_auc >= 0.001 AND o.auc - ch.auc >= 0.001 AND o.brier - ch.brier <= 0.003 THEN 'PROMOTE'
       ELSE 'HOLD' END AS decision
FROM panel o, ch WHERE o.model <> 'calibrated'""")
def q_pol08(spark, sf):
    return po.promotion_decision(model_panel(spark, sf), "model", "calibrated")


# Composite leaderboard weights, and the facts of each model that no table holds
# (latency in ms, explainability, adverse-reason readiness, monotone constraint).
LEADER_WEIGHTS = {"auc": 0.25, "pr_auc": 0.15, "ks": 0.15, "brier": 0.1, "ece": 0.1, "calib_slope": 0.05, "latency": 0.05,
                  "explainability": 0.1, "adverse_ready": 0.05}
MODEL_FACTS = [("calibrated", 120.0, 1.0, 1.0, True), ("raw", 80.0, 0.5, 1.0, True), ("blend", 300.0, 0.5, 0.0, False)]

LEADER_SQL = f"""
WITH {panel_sql()}, facts AS (SELECT * FROM (VALUES {", ".join(f"('{m}', {ms}, {ex}, {ad}, {mono})" for m, ms, ex, ad, mono in MODEL_FACTS)}) t(model, ms, explainability, adverse_ready, constrained)),
sc AS (SELECT model, constrained, round(0.25 * auc + 0.15 * pr_auc + 0.15 * ks + 0.1 * (1 - brier) + 0.1 * (1 - ece) + 0.05 * (1 - abs(calib_slope - 1))
  + 0.05 * greatest(least((500.0 - ms) / 400.0, 1.0), 0.0) + 0.1 * explainability + 0.05 * adverse_ready, 6) AS composite FROM panel JOIN facts USING (model))"""


def leader_scores(spark, sf):
    facts = spark.createDataFrame(MODEL_FACTS, "model string, ms double, explainability double, adverse_ready double, constrained boolean")
    p = model_panel(spark, sf).join(facts, "model").withColumn("latency", po.latency_score("ms"))
    return p.select("model", "constrained", F.round(po.composite_score(LEADER_WEIGHTS), 6).alias("composite"))


@register("pol10_composite_leaderboard", f"""{LEADER_SQL}
SELECT model, composite, CAST(row_number() OVER (ORDER BY composite DESC, model) AS INTEGER) AS rank FROM sc""")
def q_pol10(spark, sf):
    """POL-10 / WIN-09: nine-weight composite and rank (window over a one-row-per-model table)."""
    w = Window.partitionBy(F.lit(1)).orderBy(F.col("composite").desc(), "model")
    return leader_scores(spark, sf).select("model", "composite").withColumn("rank", F.row_number().over(w))


@register("pol18_leaderboard_tie_break", f"""{LEADER_SQL},
t AS (SELECT *, CAST(constrained AND round(max(composite) OVER () - composite, 6) <= 0.005 AS INTEGER) AS tie_break FROM sc)
SELECT model, composite, tie_break, CAST(row_number() OVER (ORDER BY tie_break DESC, composite DESC, model) AS INTEGER) AS rank FROM t""")
def q_pol18(spark, sf):
    """POL-18: within 0.005 of the top composite a constrained model goes first."""
    return po.leaderboard(leader_scores(spark, sf), "model", "composite", "constrained").select("model", "composite", "tie_break", "rank")


@register("pol11_promote_if_gain", f"""
WITH {panel_sql()}, ch AS (SELECT auc AS champ_auc FROM panel WHERE model = 'calibrated')
SELECT model, round(auc - champ_auc, 6) AS auc_delta, CASE WHEN auc - champ_auc > 0 THEN 'PROMOTE' ELSE 'KEEP' END AS decision
FROM panel, ch WHERE model <> 'calibrated'""")
def q_pol11(spark, sf):
    j = po.against_row(model_panel(spark, sf), "model", "calibrated", ("auc",), "champ_")
    d = F.col("auc") - F.col("champ_auc")
    return j.select("model", F.round(d, 6).alias("auc_delta"), F.when(d > 0, "PROMOTE").otherwise("KEEP").alias("decision"))


FAIR01_SQL = f"""
WITH {S}, g AS (SELECT grp, count(*) AS n, round(avg(y), 6) AS default_rate, round(avg(p), 6) AS mean_score,
   round(median(p), 6) AS median_score, round(stddev_pop(p), 6) AS std_score,
   round(avg(CAST(p < 0.2 AS INTEGER)), 6) AS approve_rate_zone, round(avg(CAST(p >= 0.2 AND p < 0.4 AS INTEGER)), 6) AS review_rate,
   round(avg(CAST(p >= 0.4 AS INTEGER)), 6) AS reject_rate, round(avg(CAST(NOT (p >= 0.2) AS INTEGER)), 6) AS approval_rate,
   round(count(*) FILTER (WHERE p >= 0.2 AND y = 1) / count(*) FILTER (WHERE y = 1), 6) AS tpr,
   round(count(*) FILTER (WHERE p >= 0.2 AND y = 1) / count(*) FILTER (WHERE p >= 0.2), 6) AS ppv
  FROM s GROUP BY grp),
{cdf_sql('p', 'grp')},
r AS (SELECT grp, round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc FROM c GROUP BY grp),
eb AS (SELECT grp, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p) AS conf FROM s GROUP BY grp, bin),
e AS (SELECT grp, round(sum(nb / tot * abs(acc - conf)), 6) AS ece FROM eb JOIN (SELECT grp, sum(nb) AS tot FROM eb GROUP BY grp) USING (grp) GROUP BY grp),
fm AS (SELECT g.*, round(n / (SELECT count(*) FROM s), 6) AS share, r.auc, e.ece FROM g JOIN r USING (grp) JOIN e USING (grp))"""


@register("fair01_group_metrics", FAIR01_SQL + " SELECT * FROM fm")
def q_fair01(spark, sf):
    return fa.group_metrics(scored(spark, sf), "grp")


def _gap_status(name: str, c: str) -> str:
    g = f"round(fm.{c} - ref.{c}, 6)"
    return f"""{g} AS {name}_gap, CASE WHEN abs({g}) >= 0.1 THEN 'FAIL' WHEN abs({g}) >= 0.05 THEN 'WARN' ELSE 'PASS' END AS {name}_status"""


@register("fair02_gap_table", FAIR01_SQL + f""",
ref AS (SELECT * FROM fm WHERE grp = 'AUTOMOBILE')
SELECT fm.grp, 'AUTOMOBILE' AS reference, round(fm.approval_rate / ref.approval_rate, 6) AS disparate_impact,
  CASE WHEN fm.approval_rate / ref.approval_rate < 0.8 THEN 'FAIL' WHEN fm.approval_rate / ref.approval_rate > 1.25 THEN 'WARN' ELSE 'PASS' END AS di_status,
  {_gap_status('eq_opp', 'tpr')}, {_gap_status('pred_parity', 'ppv')}, {_gap_status('auc', 'auc')}, {_gap_status('ece', 'ece')}
FROM fm, ref WHERE fm.grp <> 'AUTOMOBILE'""")
def q_fair02(spark, sf):
    return fa.gap_table(fa.group_metrics(scored(spark, sf), "grp"), "grp", "AUTOMOBILE")


@register("fair04_cohort_audit", f"""
WITH {S}, u AS (SELECT 'grp' AS cohort, CAST(grp AS VARCHAR) AS level, p, y FROM s UNION ALL
  SELECT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR), p, y FROM s UNION ALL
  SELECT 'nation', CAST(nation AS VARCHAR), p, y FROM s)
SELECT cohort, level, count(*) AS n, round(avg(y), 6) AS default_rate, round(avg(p), 6) AS mean_score,
  round(avg(CAST(p < 0.2 AS INTEGER)), 6) AS approval_rate FROM u GROUP BY cohort, level""")
def q_fair04(spark, sf):
    return fa.cohort_audit(scored(spark, sf), ["grp", "o_orderpriority", "nation"])


@register("fair05_intersectional", f"""
WITH {S} SELECT * FROM (SELECT grp, o_orderpriority, CAST(GROUPING(grp, o_orderpriority) AS BIGINT) AS gid, count(*) AS n,
  round(avg(y), 6) AS default_rate, round(avg(CAST(p < 0.2 AS INTEGER)), 6) AS approval_rate
  FROM s GROUP BY CUBE (grp, o_orderpriority)) WHERE n >= 50""")
def q_fair05(spark, sf):
    return fa.intersectional(scored(spark, sf), ["grp", "o_orderpriority"], 50)
