"""Decision policy operators (POL-*, JOIN-08, PRJ-19..23).

Loss and zone metrics are single conditional aggregations; multi-scenario
comparisons first collapse the frame to one row per distinct score (partial
aggregation), and only that table is expanded by the (small, literal)
scenario list, so work never scales with rows × scenarios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import cut_lineage

# Default costs (missed default, wrongly rejected good, manual review).
C_BAD, C_REJECT, C_REVIEW = 10.0, 1.0, 0.3


def bayes_threshold(c_bad: float | Column, c_reject: float | Column) -> Column:
    """POL-01: θ* = c_reject / (c_bad + c_reject)."""
    cb = F.lit(c_bad) if not isinstance(c_bad, Column) else c_bad
    cr = F.lit(c_reject) if not isinstance(c_reject, Column) else c_reject
    return cr / (cb + cr)


def expected_loss(df: DataFrame, threshold: float, score: str = "p", label: str = "y", groups=(),
                  c_bad: float = C_BAD, c_reject: float = C_REJECT) -> DataFrame:
    """POL-02: (c_bad·FN + c_reject·FP) / n at ``score >= threshold``."""
    pred = F.col(score) >= F.lit(threshold)
    return df.groupBy(*groups).agg(
        F.round((F.lit(c_bad) * F.count_if(~pred & (F.col(label) == 1)) + F.lit(c_reject) * F.count_if(pred & (F.col(label) == 0)))
                / F.count(F.lit(1)), 6).alias("expected_loss"))


def zone(score: str | Column, lo, hi) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(s < lo, "APPROVE").when(s < hi, "REVIEW").otherwise("REJECT")


def zone_metrics_from_counts(agg: DataFrame, keys, c_bad=C_BAD, c_reject=C_REJECT, c_review=C_REVIEW,
                             review_split: bool = True) -> DataFrame:
    """POL-03/04 arithmetic on per-zone counts (n_ap, bad_ap, n_rv, bad_rv, n_rj, bad_rj).

    The 50/50 review term truncates both halves to integers; with
    ``review_split=False`` the review zone costs only ``c_review``."""
    n = F.col("n_ap") + F.col("n_rv") + F.col("n_rj")
    fn_ap, fp_rj = F.col("bad_ap"), F.col("n_rj") - F.col("bad_rj")
    fn_rv = F.floor(F.col("bad_rv") * 0.5) if review_split else F.lit(0)
    fp_rv = F.floor((F.col("n_rv") - F.col("bad_rv")) * 0.5) if review_split else F.lit(0)
    el = (F.lit(c_bad) * (fn_ap + fn_rv) + F.lit(c_reject) * (fp_rj + fp_rv) + F.lit(c_review) * F.col("n_rv")) / n
    return agg.select(
        *keys, "n_ap", "n_rv", "n_rj",
        F.round(F.col("n_ap") / n, 6).alias("approve_rate"), F.round(F.col("n_rv") / n, 6).alias("review_rate"),
        F.round(F.col("n_rj") / n, 6).alias("reject_rate"),
        F.round(F.try_divide(F.col("bad_ap"), F.col("n_ap")), 6).alias("bad_rate_ap"),
        F.round(F.try_divide(F.col("bad_rv"), F.col("n_rv")), 6).alias("bad_rate_rv"),
        F.round(F.try_divide(F.col("bad_rj"), F.col("n_rj")), 6).alias("bad_rate_rj"),
        fn_ap.alias("fn_approve"), fp_rj.alias("fp_reject"), fn_rv.cast("long").alias("fn_review"),
        fp_rv.cast("long").alias("fp_review"), F.round(el, 6).alias("expected_loss"))


def zone_counts(df: DataFrame, lo, hi, score: str = "p", label: str = "y", groups=()) -> DataFrame:
    z = zone(score, lo, hi)
    y = F.col(label) == 1
    return df.groupBy(*groups).agg(
        F.count_if(z == "APPROVE").alias("n_ap"), F.count_if((z == "APPROVE") & y).alias("bad_ap"),
        F.count_if(z == "REVIEW").alias("n_rv"), F.count_if((z == "REVIEW") & y).alias("bad_rv"),
        F.count_if(z == "REJECT").alias("n_rj"), F.count_if((z == "REJECT") & y).alias("bad_rj"))


def three_zone_loss(df: DataFrame, lo: float, hi: float, score: str = "p", label: str = "y", groups=(),
                    review_split: bool = True, **costs) -> DataFrame:
    """POL-03 (review_split=True) / POL-04 (False)."""
    return zone_metrics_from_counts(zone_counts(df, lo, hi, score, label, groups), list(groups), review_split=review_split, **costs)


def per_score_counts(df: DataFrame, score: str = "p", label: str = "y", groups=()) -> DataFrame:
    """Collapse to one row per distinct score (partial aggregation; ties merge)."""
    return df.groupBy(*groups, F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))


def scenario_comparison(df: DataFrame, scenarios: list[tuple[str, float, float]], score: str = "p", label: str = "y",
                        **costs) -> DataFrame:
    """POL-05: zone n, share, observed rate and loss per (name, lo, hi) scenario."""
    sc = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for n, lo, hi in scenarios])
    c = per_score_counts(df, score, label).withColumn("sc", F.explode(sc)).select("s", "n", "bad", "sc.*")
    z = zone("s", F.col("lo"), F.col("hi"))
    agg = c.groupBy("scenario").agg(
        F.sum(F.when(z == "APPROVE", F.col("n")).otherwise(0)).alias("n_ap"), F.sum(F.when(z == "APPROVE", F.col("bad")).otherwise(0)).alias("bad_ap"),
        F.sum(F.when(z == "REVIEW", F.col("n")).otherwise(0)).alias("n_rv"), F.sum(F.when(z == "REVIEW", F.col("bad")).otherwise(0)).alias("bad_rv"),
        F.sum(F.when(z == "REJECT", F.col("n")).otherwise(0)).alias("n_rj"), F.sum(F.when(z == "REJECT", F.col("bad")).otherwise(0)).alias("bad_rj"))
    return zone_metrics_from_counts(agg, ["scenario"], **costs)


def losses_at_thresholds(df: DataFrame, thresholds: list[float], scores: list[str], label: str = "y",
                         c_bad: float = C_BAD, c_reject: float = C_REJECT) -> DataFrame:
    """POL-07: single-threshold loss for several score columns (raw vs calibrated)
    at a list of key thresholds; scores are unpivoted, then collapsed per distinct value."""
    long = df.select(label, F.explode(F.array(*[F.struct(F.lit(s).alias("score_kind"), F.col(s).alias("v")) for s in scores])).alias("u")) \
             .select(label, "u.score_kind", "u.v")
    c = long.groupBy("score_kind", "v").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))
    th = F.array(*[F.lit(float(t)) for t in thresholds])
    c = c.withColumn("threshold", F.explode(th))
    pred = F.col("v") >= F.col("threshold")
    agg = c.groupBy("score_kind", "threshold").agg(
        F.sum(F.when(~pred, F.col("bad")).otherwise(0)).alias("fn"),
        F.sum(F.when(pred, F.col("n") - F.col("bad")).otherwise(0)).alias("fp"),
        F.sum("n").alias("n"))
    return agg.select("score_kind", "threshold", "fn", "fp",
                      F.round((F.lit(c_bad) * F.col("fn") + F.lit(c_reject) * F.col("fp")) / F.col("n"), 6).alias("expected_loss"))


def cost_sensitivity(sweep: DataFrame, ratios: list[float], c_review: float = C_REVIEW, lo: float = 0.20, hi: float = 0.40) -> DataFrame:
    """POL-06: for each cost ratio r (c_bad = r, c_reject = 1): θ* = 1/(1+r), the
    empirical best grid threshold, its loss and approval rate, and the loss and
    overhead of the three-zone policy (lo, hi: grid thresholds), all from the
    sweep's confusion counts (≤ 75 rows) expanded by the handful of ratios only."""
    r = F.explode(F.array(*[F.lit(float(x)) for x in ratios])).alias("cost_ratio")
    s = sweep.select("threshold", "tp", "fp", "tn", "fn", r)
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    s = s.withColumn("loss", (F.col("cost_ratio") * F.col("fn") + F.col("fp")) / n)
    at_lo, at_hi = F.col("threshold") == F.lit(lo), F.col("threshold") == F.lit(hi)
    best = s.groupBy("cost_ratio").agg(
        F.min_by("threshold", F.struct("loss", "threshold")).alias("best_threshold"), F.min("loss").alias("loss"),
        F.min_by((F.col("tn") + F.col("fn")) / n, F.struct("loss", "threshold")).alias("approval"),
        F.max(n).alias("n"), F.max(F.col("tp") + F.col("fn")).alias("bad"),
        F.max(F.when(at_lo, F.col("tn") + F.col("fn"))).alias("n_ap"), F.max(F.when(at_lo, F.col("fn"))).alias("bad_ap"),
        F.max(F.when(at_hi, F.col("tp") + F.col("fp"))).alias("n_rj"), F.max(F.when(at_hi, F.col("tp"))).alias("bad_rj"))
    n_rv, bad_rv = F.col("n") - F.col("n_ap") - F.col("n_rj"), F.col("bad") - F.col("bad_ap") - F.col("bad_rj")
    zones = (F.col("cost_ratio") * (F.col("bad_ap") + F.floor(bad_rv * 0.5)) + F.col("n_rj") - F.col("bad_rj")
             + F.floor((n_rv - bad_rv) * 0.5) + F.lit(c_review) * n_rv) / F.col("n")
    return best.select("cost_ratio", F.round(bayes_threshold(F.col("cost_ratio"), F.lit(1.0)), 6).alias("theta_star"),
                       "best_threshold", F.round("loss", 6).alias("best_loss"), F.round("approval", 6).alias("approval_rate"),
                       F.round(zones, 6).alias("three_zone_loss"), F.round(zones - F.col("loss"), 6).alias("three_zone_overhead"))


# Promotion gates (delta thresholds).
GATE_PR_AUC, GATE_AUC, GATE_ECE, GATE_BRIER = 0.001, 0.001, 0.005, 0.003


def against_row(panel: DataFrame, key: str, reference: str, cols, prefix: str) -> DataFrame:
    """The rows of a small panel (one row per model or group) with the reference row's
    ``cols`` beside them; the reference row itself goes, and so does everything if it is
    missing.  One pass over the panel: a window, not a join of the panel with itself."""
    w = Window.partitionBy(F.lit(1))
    is_ref = F.col(key) == reference
    j = panel.withColumn("_ref", F.max(is_ref).over(w))
    for c in cols:
        j = j.withColumn(f"{prefix}{c}", F.max(F.when(is_ref, F.col(c))).over(w))
    return j.where(F.col("_ref") & (F.col(key) != reference)).drop("_ref")


def sha(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``|``."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def chain(log: DataFrame, contents: dict[str, str], group: str, key: str, width: int = 65536) -> DataFrame:
    """POL-15: for each content hash (``contents``: its column, the new column's name) a column that links every
    row to the hash of its predecessor (by ``key``) in its group.  Rows without a key are in no chain.

    A group is split into ranges of ``width`` keys, ordered like the keys: inside a range the predecessor
    comes from a window; only a range's first row is joined to the last of the range before.  All contents are
    chained in one pass, and rows are shuffled and written once: give ``log`` with the columns that are wanted."""
    w = Window.partitionBy(group, "_range").orderBy(key)
    r = log.where(F.col(key).isNotNull()).withColumn("_range", F.floor(F.col(key) / F.lit(width)))
    r = cut_lineage(r.withColumns({f"_prev_{c}": F.lag(c).over(w) for c in contents} | {"_first": F.row_number().over(w) == 1, "_last": F.lead(F.lit(1)).over(w).isNull()}))
    ranges = Window.partitionBy(group).orderBy("_range")
    ends = r.where("_last").select(F.col(group).alias("_g"), F.col("_range").alias("_r"), *[F.lag(c).over(ranges).alias(f"_before_{c}") for c in contents])
    first = r.where("_first").drop(*[f"_prev_{c}" for c in contents]).join(ends, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    first = first.withColumnsRenamed({f"_before_{c}": f"_prev_{c}" for c in contents}).drop("_g", "_r")
    links = {name: F.sha2(F.concat(F.col(c), F.coalesce(f"_prev_{c}", F.lit(""))), 256) for c, name in contents.items()}
    return r.where("not _first").unionByName(first).withColumns(links).drop("_range", "_first", "_last", *[f"_prev_{c}" for c in contents])


def composite_score(weights: dict[str, float]) -> Column:
    """POL-10: weighted sum; losses (brier, ece) enter as 1 - x, the calibration slope as 1 - |slope - 1|."""
    form = {"brier": 1 - F.col("brier"), "ece": 1 - F.col("ece"), "calib_slope": 1 - F.abs(F.col("calib_slope") - 1)}
    return sum(F.lit(w) * form.get(c, F.col(c)) for c, w in weights.items())


def latency_score(ms: str | Column, full: float = 100.0, none: float = 500.0) -> Column:
    """POL-18: 1 up to ``full`` milliseconds, 0 from ``none`` on, linear between."""
    x = F.col(ms) if isinstance(ms, str) else ms
    return F.greatest(F.least((F.lit(none) - x) / F.lit(none - full), F.lit(1.0)), F.lit(0.0))


def leaderboard(panel: DataFrame, model_col: str, score: str, constrained: str, within: float = 0.005) -> DataFrame:
    """POL-18: rank by score; models within ``within`` of the top come first if constrained
    (one row per model, so one window partition)."""
    top = F.max(score).over(Window.partitionBy(F.lit(1)))
    j = panel.withColumn("tie_break", (F.col(constrained) & (F.round(top - F.col(score), 6) <= within)).cast("int"))
    w = Window.partitionBy(F.lit(1)).orderBy(F.col("tie_break").desc(), F.col(score).desc(), F.col(model_col))
    return j.withColumn("rank", F.row_number().over(w))


def promotion_decision(panel: DataFrame, model_col: str, champion: str, legacy: bool = False) -> DataFrame:
    """POL-08: four gates of each challenger against the champion row of a metric
    panel (model, pr_auc, auc, ece, brier).  REJECT if the ECE gate fails;
    PROMOTE if all gates pass (legacy: Brier ignored); HOLD otherwise."""
    j = against_row(panel, model_col, champion, ("pr_auc", "auc", "ece", "brier"), "champ_")
    g1 = F.col("pr_auc") - F.col("champ_pr_auc")
    g2 = F.col("auc") - F.col("champ_auc")
    g3 = F.col("ece") - F.col("champ_ece")
    g4 = F.col("brier") - F.col("champ_brier")
    p1, p2, p3, p4 = g1 >= GATE_PR_AUC, g2 >= GATE_AUC, g3 <= GATE_ECE, g4 <= GATE_BRIER
    all_pass = (p1 & p2) if legacy else (p1 & p2 & p4)
    dec = F.when(~p3, "REJECT").when(all_pass, "PROMOTE").otherwise("HOLD")
    return j.select(F.col(model_col).alias("challenger"), F.round(g1, 6).alias("pr_auc_delta"), F.round(g2, 6).alias("auc_delta"),
                    F.round(g3, 6).alias("ece_delta"), F.round(g4, 6).alias("brier_delta"),
                    (p1.cast("int") + p2.cast("int") + p3.cast("int") + p4.cast("int")).alias("gates_passed"),
                    dec.alias("decision"))
