"""Fairness operators (FAIR-01..05).

Group metrics are one ``groupBy(group)`` for counts/means plus the grouped
ranking/ECE operators; gap tables join the (tiny, one-row-per-group) metric
table with the reference group's row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators import metrics as mx
from riskspark.operators.policy import against_row
from riskspark.operators.quantiles import exact_quantiles

# Disparate-impact band and gap statuses (5 pp / 10 pp).
DI_LOW, DI_HIGH = 0.80, 1.25
GAP_WARN, GAP_FAIL = 0.05, 0.10


def group_metrics(df: DataFrame, group: str, score: str = "p", label: str = "y", lo: float = 0.20, hi: float = 0.40,
                  threshold: float = 0.20, with_ranking: bool = True) -> DataFrame:
    """FAIR-01: n, share, base rate, score mean/median/population std, zone
    rates, TPR and PPV at ``score >= threshold`` (positive = predicted default),
    approval rate (score < threshold), AUC and ECE per group."""
    s, y = F.col(score), F.col(label)
    pred = s >= F.lit(threshold)
    g = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(y), 6).alias("default_rate"),
        F.round(F.avg(s), 6).alias("mean_score"),
        F.round(F.stddev_pop(s), 6).alias("std_score"),
        F.round(F.avg((s < lo).cast("int")), 6).alias("approve_rate_zone"),
        F.round(F.avg(((s >= lo) & (s < hi)).cast("int")), 6).alias("review_rate"),
        F.round(F.avg((s >= hi).cast("int")), 6).alias("reject_rate"),
        F.round(F.avg((~pred).cast("int")), 6).alias("approval_rate"),
        F.round(F.try_divide(F.count_if(pred & (y == 1)), F.count_if(y == 1)), 6).alias("tpr"),
        F.round(F.try_divide(F.count_if(pred & (y == 1)), F.count_if(pred)), 6).alias("ppv"),
    )
    med = exact_quantiles(df, score, [0.5], [group]).select(group, F.round(F.col("q")[0], 6).alias("median_score"))
    g = g.join(med, group, "left")
    # grand total from the group-sized table itself (no second scan of the rows)
    g = g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))
    if with_ranking:
        r = mx.ranking_metrics(df, score, label, [group]).select(group, "auc")
        e = mx.ece(df, score, label, [group])
        g = g.join(r, group, "left").join(e, group, "left")
    return g


def gap_table(gm: DataFrame, group: str, reference: str) -> DataFrame:
    """FAIR-02/03: every group against the reference group: disparate impact
    (approval ratio; under 0.80 fails, over 1.25 warns), equal-opportunity (TPR),
    predictive-parity (PPV), AUC and ECE gaps, each with its 5 pp / 10 pp status."""
    j = against_row(gm, group, reference, ("approval_rate", "tpr", "ppv", "auc", "ece"), "ref_")
    di = F.try_divide(F.col("approval_rate"), F.col("ref_approval_rate"))

    def gap(c):
        return F.round(F.col(c) - F.col(f"ref_{c}"), 6)

    def status(g):
        return F.when(F.abs(g) >= GAP_FAIL, "FAIL").when(F.abs(g) >= GAP_WARN, "WARN").otherwise("PASS")

    gaps = {"eq_opp": gap("tpr"), "pred_parity": gap("ppv"), "auc": gap("auc"), "ece": gap("ece")}
    return j.select(
        F.col(group), F.lit(reference).alias("reference"), F.round(di, 6).alias("disparate_impact"),
        F.when(di < DI_LOW, "FAIL").when(di > DI_HIGH, "WARN").otherwise("PASS").alias("di_status"),
        *[x for k, g in gaps.items() for x in (g.alias(f"{k}_gap"), status(g).alias(f"{k}_status"))])


def cohort_audit(df: DataFrame, cohorts: list[str], score: str = "p", label: str = "y", threshold: float = 0.20) -> DataFrame:
    """FAIR-04: several cohort columns unpivoted, one groupBy(cohort, level)."""
    u = df.select(score, label, F.explode(F.array(*[F.struct(F.lit(c).alias("cohort"), F.col(c).cast("string").alias("level")) for c in cohorts])).alias("u")) \
          .select(score, label, "u.cohort", "u.level")
    return u.groupBy("cohort", "level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 6).alias("default_rate"),
        F.round(F.avg(score), 6).alias("mean_score"),
        F.round(F.avg((F.col(score) < F.lit(threshold)).cast("int")), 6).alias("approval_rate"))


def intersectional(df: DataFrame, attrs: list[str], min_n: int, score: str = "p", label: str = "y", threshold: float = 0.20) -> DataFrame:
    """FAIR-05: cube over the attributes (every subset crossed), groups under ``min_n`` removed."""
    c = df.cube(*attrs).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 6).alias("default_rate"),
        F.round(F.avg((F.col(score) < F.lit(threshold)).cast("int")), 6).alias("approval_rate"))
    return c.where(F.col("n") >= min_n)
