"""Evaluation queries on the scored frame (EVAL-*)."""

from __future__ import annotations


from riskspark.operators import metrics as mx
from riskspark.plans.catalog import register
from riskspark.plans.frames import SCORED_SQL, scored

S = f"s AS ({SCORED_SQL})"


def cdf_sql(score: str = "p", group: str | None = "grp", src: str = "s") -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
d AS (SELECT {g}{score} AS sc, sum(y) AS pos, sum(1 - y) AS neg FROM {src} WHERE {score} IS NOT NULL GROUP BY {g}{score}),
c AS (SELECT {g}sc, pos, neg,
        sum(pos) OVER ({part}ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
        sum(neg) OVER ({part}ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
        sum(pos) OVER ({part.strip()}) AS TP, sum(neg) OVER ({part.strip()}) AS TN
      FROM d)"""


def ranking_sql(score: str = "p", group: str | None = "grp", src_cte: str = S, src: str = "s") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    j = f"USING ({group})" if group else "ON TRUE"
    return f"""
WITH {src_cte}, {cdf_sql(score, group, src)},
m AS (SELECT {g}CAST(sum(pos + neg) AS BIGINT) AS n, CAST(max(TP) AS BIGINT) AS n_pos,
        round(sum(pos * (cneg - neg + neg / 2.0)) / (max(TP) * max(TN)), 6) AS auc,
        round(sum(pos * (TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)) / max(TP), 6) AS ap,
        round(sum(pos * ((TP - cpos + pos) / (TP - cpos + pos + TN - cneg + neg)
              + CASE WHEN TP - cpos + TN - cneg = 0 THEN 1.0 ELSE (TP - cpos) / (TP - cpos + TN - cneg) END) / 2.0) / max(TP), 6) AS pr_auc,
        max(abs(cpos / TP - cneg / TN)) AS ksraw
      FROM c {gb}),
k AS (SELECT {g}min(sc) AS ks_threshold FROM c JOIN m {j} WHERE abs(cpos / TP - cneg / TN) = m.ksraw {gb})
SELECT {g}n, n_pos, auc, ap, pr_auc, round(ksraw, 6) AS ks, ks_threshold FROM m JOIN k {j}
"""


@register("eval01_ranking_by_group", ranking_sql("p", "grp"))
def q_rank_grp(spark, sf):
    """EVAL-01/02/03/06 per market segment: AUC, AP, PR-AUC, KS, KS threshold."""
    return mx.ranking_metrics(scored(spark, sf), "p", "y", ["grp"])


@register("eval01_ranking_overall_raw", ranking_sql("p_raw", None))
def q_rank_all(spark, sf):
    """EVAL-01 etc. on the uncalibrated score over the whole frame."""
    return mx.ranking_metrics(scored(spark, sf), "p_raw", "y")


@register("eval04_brier_by_group", f"WITH {S} SELECT grp, round(avg((p - y) * (p - y)), 6) AS brier FROM s GROUP BY grp")
def q_brier(spark, sf):
    return mx.brier(scored(spark, sf), "p", "y", ["grp"])


def ece_sql(variant: str, score: str = "p") -> str:
    b = f"least(CAST(floor({score} * 10) AS INTEGER), 9)" if variant == "L" else f"CAST(floor({score} * 10) AS INTEGER)"
    return f"""
WITH {S}, b AS (SELECT grp, {b} AS bin, count(*) AS n, avg(y) AS acc, avg({score}) AS conf FROM s GROUP BY grp, bin),
t AS (SELECT grp, sum(n) AS ntot FROM b GROUP BY grp)
SELECT grp, round(sum(CASE WHEN bin BETWEEN 0 AND 9 THEN n / ntot * abs(acc - conf) ELSE 0 END), 6) AS ece
FROM b JOIN t USING (grp) GROUP BY grp
"""


@register("eval05_ece_last_closed", ece_sql("L"))
def q_ece_l(spark, sf):
    return mx.ece(scored(spark, sf), "p", "y", ["grp"], variant="L")


@register("eval05_ece_right_open_raw", ece_sql("O", "p_raw"))
def q_ece_o(spark, sf):
    return mx.ece(scored(spark, sf), "p_raw", "y", ["grp"], variant="O")


@register("eval07_calibration_curve", f"""
WITH {S} SELECT least(CAST(floor(p_raw * 10) AS INTEGER), 9) AS bin, round(avg(p_raw), 6) AS mean_pred,
  round(avg(y), 6) AS frac_pos, count(*) AS n FROM s GROUP BY bin""")
def q_curve(spark, sf):
    return mx.calibration_curve(scored(spark, sf), "p_raw", "y")


@register("eval08_roc_points", f"""
WITH {S}, {cdf_sql('p', None)}
SELECT sc AS threshold, round((TN - cneg + neg) / TN, 6) AS fpr, round((TP - cpos + pos) / TP, 6) AS tpr FROM c""")
def q_roc(spark, sf):
    return mx.roc_points(scored(spark, sf), "p", "y")


CONF_COLS = """
  round(coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0), 6) AS precision,
  round(coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0), 6) AS recall,
  round(coalesce(CASE WHEN fp + tn = 0 THEN NULL ELSE fp / (fp + tn) END, 0.0), 6) AS fpr,
  round(coalesce(CASE WHEN coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0) + coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0) = 0 THEN NULL
     ELSE 2 * coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0) * coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0)
        / (coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0) + coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0)) END, 0.0), 6) AS f1,
  round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
  round(coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0) - coalesce(CASE WHEN fp + tn = 0 THEN NULL ELSE fp / (fp + tn) END, 0.0), 6) AS youden_j,
  round((tn + fn) / (tp + fp + tn + fn), 6) AS approval_rate,
  round((tp + fp) / (tp + fp + tn + fn), 6) AS rejection_rate"""


@register("eval09_confusion_at_threshold", f"""
WITH {S}, a AS (SELECT grp, count(*) FILTER (WHERE p >= 0.2 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.2 AND y = 0) AS fp,
  count(*) FILTER (WHERE p < 0.2 AND y = 0) AS tn, count(*) FILTER (WHERE p < 0.2 AND y = 1) AS fn FROM s GROUP BY grp)
SELECT grp, tp, fp, tn, fn, {CONF_COLS} FROM a""")
def q_conf(spark, sf):
    return mx.confusion_at(scored(spark, sf), 0.2, "p", "y", ["grp"])


SWEEP_SQL = f"""
WITH {S}, g AS (SELECT range AS step FROM range(0, 75)),
a AS (SELECT step, round((50000 + step * 10000) / 1000000.0, 6) AS threshold,
   count(*) FILTER (WHERE CAST(round(p * 1000000) AS BIGINT) >= 50000 + step * 10000 AND y = 1) AS tp,
   count(*) FILTER (WHERE CAST(round(p * 1000000) AS BIGINT) >= 50000 + step * 10000 AND y = 0) AS fp,
   count(*) FILTER (WHERE CAST(round(p * 1000000) AS BIGINT) < 50000 + step * 10000 AND y = 0) AS tn,
   count(*) FILTER (WHERE CAST(round(p * 1000000) AS BIGINT) < 50000 + step * 10000 AND y = 1) AS fn
  FROM g, s GROUP BY step)
SELECT CAST(step AS INTEGER) AS step, threshold, tp, fp, tn, fn, {CONF_COLS},
  round((10.0 * fn + 1.0 * fp) / (tp + fp + tn + fn), 6) AS expected_loss FROM a"""


@register("eval10_threshold_sweep", SWEEP_SQL)
def q_sweep(spark, sf):
    return mx.threshold_sweep(scored(spark, sf, with_group=False), "p", "y")


@register("eval11_score_histogram", f"""
WITH {S} SELECT y, grp, least(CAST(floor(p * 20) AS INTEGER), 19) AS bin, count(*) AS n FROM s GROUP BY y, grp, bin""")
def q_hist(spark, sf):
    return mx.score_histogram(scored(spark, sf), "p", ["y", "grp"], 20)


@register("eval18_local_calibration", f"""
WITH {S}, cuts AS (SELECT unnest([0.06, 0.2, 0.28, 0.4]) AS cut)
SELECT cut, count(*) AS n, round(avg(p), 6) AS mean_pred, round(avg(y), 6) AS observed, round(avg(y) - avg(p), 6) AS gap
FROM cuts JOIN s ON abs(s.p - cuts.cut) <= 0.02 GROUP BY cut""")
def q_localcal(spark, sf):
    return mx.local_calibration(scored(spark, sf), [0.06, 0.2, 0.28, 0.4], 0.02)
