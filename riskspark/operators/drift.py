"""Drift monitoring operators (DRIFT-01..19, WIN-10, WIN-17, JOIN-07).

Inputs are long frames ``(batch, feature, v)`` built by one unpivot; every
operator then aggregates all batches and features in one job.  Reference
edges are exact quantiles from running counts (an array per feature,
joined by feature name — the "reference-bin join" needs no theta join: a
value's bin is the number of inner edges at or below it).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.prefix import cumulate
from riskspark.operators.quantiles import exact_quantiles
from riskspark.session import cut_lineage

# PSI smoothing and status cut-offs.
PSI_EPS = 1e-8
PSI_WARN, PSI_ALERT = 0.10, 0.20
PSI_FIXED_FLOOR = 1e-6
MIN_ROWS = 10


def unpivot(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Long form (keys..., feature, v) in one pass."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])
    return df.select(*keys, F.explode(arr).alias("u")).select(*keys, "u.feature", "u.v")


def reference_edges(ref: DataFrame, n_bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """(by..., feature, edges): reference quantile edges, outer edges widened by 1e-8."""
    by = by or []
    q = [i / n_bins for i in range(n_bins + 1)]
    e = exact_quantiles(ref, "v", q, [*by, "feature"], "_q")
    edges = F.concat(F.array(F.col("_q")[0] - F.lit(1e-8)), F.slice("_q", 2, n_bins - 1), F.array(F.col("_q")[n_bins] + F.lit(1e-8)))
    return e.select(*by, "feature", edges.alias("edges"))


def bin_of(v: Column, edges: Column, n_bins: int, outside: str = "drop") -> Column:
    """JOIN-07: [e_i, e_{i+1}) bins, last closed; values outside the reference
    range are dropped (NULL bin) or clamped to the end bins."""
    inner = F.slice(edges, 2, n_bins - 1)
    b = F.size(F.filter(inner, lambda e: e <= v))
    if outside == "clamp":
        return F.when(v.isNotNull(), b)
    ok = (v >= edges[0]) & (v <= edges[n_bins])
    return F.when(ok, b)


def psi_bins(ref: DataFrame, act: DataFrame, batch: str, n_bins: int = 10, outside: str = "drop", by: list[str] | None = None) -> DataFrame:
    """DRIFT-03: per (batch, by, feature, bin): edges, reference and actual shares, bin PSI."""
    by = by or []
    edges = reference_edges(ref, n_bins, by)
    rb = ref.join(edges, by + ["feature"]).select(*by, "feature", bin_of(F.col("v"), F.col("edges"), n_bins, outside).alias("bin"))
    rc = rb.where(F.col("bin").isNotNull()).groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("rn"))
    ab = act.join(edges, by + ["feature"]).select(batch, *by, "feature", bin_of(F.col("v"), F.col("edges"), n_bins, outside).alias("bin"))
    ac = ab.where(F.col("bin").isNotNull()).groupBy(batch, *by, "feature", "bin").agg(F.count(F.lit(1)).alias("an"))
    cells = act.select(batch, *by, "feature").distinct().join(edges, by + ["feature"]).select(
        batch, *by, "feature", "edges", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    g = cells.join(rc, by + ["feature", "bin"], "left").join(ac, [batch] + by + ["feature", "bin"], "left").fillna(0, ["rn", "an"])
    w = Window.partitionBy(batch, *by, "feature")
    g = g.withColumn("rt", F.sum("rn").over(w)).withColumn("at", F.sum("an").over(w))
    rp = (F.col("rn") + F.lit(PSI_EPS)) / (F.col("rt") + F.lit(PSI_EPS * n_bins))
    ap = (F.col("an") + F.lit(PSI_EPS)) / (F.col("at") + F.lit(PSI_EPS * n_bins))
    return g.select(batch, *by, "feature", (F.col("bin") + 1).alias("bin"),
                    F.col("edges")[F.col("bin")].alias("lower"), F.col("edges")[F.col("bin") + 1].alias("upper"),
                    rp.alias("ref_pct"), ap.alias("act_pct"), ((ap - rp) * F.log(ap / rp)).alias("bin_psi"), "an")


def psi_status(psi: Column, warn: float | Column = PSI_WARN, alert: float | Column = PSI_ALERT) -> Column:
    w = warn if isinstance(warn, Column) else F.lit(warn)
    a = alert if isinstance(alert, Column) else F.lit(alert)
    return F.when(psi > a, "ALERT").when(psi > w, "WARN").otherwise("OK")


def psi(ref: DataFrame, act: DataFrame, batch: str, n_bins: int = 10, outside: str = "drop", by: list[str] | None = None) -> DataFrame:
    """DRIFT-01: PSI per (batch, feature) with reference-quantile bins."""
    by = by or []
    b = psi_bins(ref, act, batch, n_bins, outside, by)
    return b.groupBy(batch, *by, "feature").agg(F.sum("bin_psi").alias("psi"), F.sum("an").alias("n_binned"))


def psi_fixed(ref: DataFrame, act: DataFrame, batch: str, n_bins: int = 10) -> DataFrame:
    """DRIFT-02: equal-width bins on [0,1] (last closed), zero shares floored at 1e-6.

    A value outside [0,1] is in no bin, but in the number of rows that shares are taken of."""
    b = F.when(F.col("v").between(0.0, 1.0), F.least(F.floor(F.col("v") * n_bins).cast("int"), F.lit(n_bins - 1))).otherwise(-1)
    rc = ref.where(F.col("v").isNotNull()).groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("rn"))
    ac = act.where(F.col("v").isNotNull()).groupBy(batch, "feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("an"))
    cells = act.select(batch, "feature").distinct().select(batch, "feature", F.explode(F.sequence(F.lit(-1), F.lit(n_bins - 1))).alias("bin"))
    g = cells.join(rc, ["feature", "bin"], "left").join(ac, [batch, "feature", "bin"], "left").fillna(0, ["rn", "an"])
    w = Window.partitionBy(batch, "feature")
    rp = F.col("rn") / F.sum("rn").over(w)
    ap = F.col("an") / F.sum("an").over(w)
    g = g.select(batch, "feature", "bin", rp.alias("rp"), ap.alias("ap")).where(F.col("bin") >= 0)
    rp, ap = F.col("rp"), F.col("ap")
    g = g.select(batch, "feature", F.when(rp == 0, PSI_FIXED_FLOOR).otherwise(rp).alias("r"), F.when(ap == 0, PSI_FIXED_FLOOR).otherwise(ap).alias("a"))
    return g.groupBy(batch, "feature").agg(F.sum((F.col("a") - F.col("r")) * F.log(F.col("a") / F.col("r"))).alias("psi"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov p-value with the Stephens correction.

    The alternating series does not converge for a small statistic; there its
    theta-function twin does, and for identical samples the value is 1."""
    en = F.sqrt(n * m / (n + m))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * d
    s = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                    lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * lam * lam))
    small = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0.0),
                        lambda acc, j: acc + F.exp(-(F.lit(2.0) * j - 1) * (F.lit(2.0) * j - 1) * F.lit(math.pi ** 2) / (F.lit(8.0) * lam * lam)))
    p = F.when(lam < 0.04, F.lit(1.0)).when(lam < 1.18, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small).otherwise(F.lit(2.0) * s)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ks(ref: DataFrame, act: DataFrame, batch: str) -> DataFrame:
    """DRIFT-04: two-sample KS statistic and asymptotic p-value per (batch, feature).

    The reference's running counts are made once, over its own and all batches' values; each batch
    looks them up at its own values.  Between two of those its share stands still, so the largest
    difference is at a value of the batch or just before one: the work grows with the rows, not with
    reference values times batches."""
    rc = ref.where(F.col("v").isNotNull()).groupBy("feature", F.col("v").alias("s")).agg(F.count(F.lit(1)).alias("neg"))
    ac = act.where(F.col("v").isNotNull()).groupBy(batch, "feature", F.col("v").alias("s")).agg(F.count(F.lit(1)).alias("pos"))
    knots = rc.unionByName(ac.select("feature", "s", F.lit(0).cast("long").alias("neg"))).groupBy("feature", "s").agg(F.sum("neg").alias("neg"))
    c = cumulate(ac, [batch, "feature"], cols=("pos",)).join(cumulate(knots, ["feature"], cols=("neg",)), ["feature", "s"])
    at = F.abs(F.col("cpos") / F.col("Tpos") - F.try_divide(F.col("cneg"), F.col("Tneg")))
    before = F.abs((F.col("cpos") - F.col("pos")) / F.col("Tpos") - F.try_divide(F.col("cneg") - F.col("neg"), F.col("Tneg")))
    g = c.groupBy(batch, "feature").agg(F.max(F.greatest(at, before)).alias("ks"), F.max("Tpos").alias("n_act"), F.max("Tneg").alias("n_ref"))
    return g.withColumn("p_value", ks_pvalue(F.col("ks"), F.col("n_act").cast("double"), F.col("n_ref").cast("double")))


def wasserstein(ref: DataFrame, act: DataFrame, batch: str, n_buckets: int = 1024) -> DataFrame:
    """DRIFT-16: 1-D Wasserstein distance, the area between the two distribution functions.

    The area under the reference's function up to x, (x * count - sum of values) / rows, is made once for
    all batches.  Between two neighbouring values of a batch its own function stands still, so the area
    between the two there follows from the reference's area at both ends and at the place where it crosses
    the batch's share, which is the reference value of that rank.  Everything is as long as the reference
    and the batches, and no window holds a whole (batch, feature).  A feature without reference rows has no row."""
    rc = ref.where(F.col("v").isNotNull()).groupBy("feature", F.col("v").alias("s")).agg(F.count(F.lit(1)).alias("neg"))
    ac = act.where(F.col("v").isNotNull()).groupBy(batch, "feature", F.col("v").alias("s")).agg(F.count(F.lit(1)).alias("pos"))
    knots = rc.unionByName(ac.select("feature", "s", F.lit(0).cast("long").alias("neg"))).groupBy("feature", "s").agg(F.sum("neg").alias("neg"))
    knots = knots.withColumn("val", F.col("neg") * F.col("s"))
    r = cumulate(knots, ["feature"], n_buckets, cols=("neg", "val")).where(F.col("Tneg") > 0) \
        .withColumn("area", (F.col("s") * F.col("cneg") - F.col("cval")) / F.col("Tneg"))
    r = cut_lineage(r)  # read four times below
    top = r.where(F.col("neg") > 0).groupBy("feature").agg(F.max("s").alias("top"))
    looked = r.select("feature", "s", "area", "cneg", "Tneg", (F.col("Tval") / F.col("Tneg")).alias("mean"))
    c = cumulate(ac.join(looked, ["feature", "s"]), [batch, "feature"], n_buckets, cols=("pos",), following=("s", "area")).join(top, "feature")
    # after a batch's last value its share is 1, and the areas part up to the reference's largest value
    end = F.greatest("s", "top")
    c = c.withColumn("b", F.coalesce("next.s", end)).withColumn("area_b", F.coalesce("next.area", end - F.col("mean")))
    c = c.withColumn("share", F.col("cpos") / F.col("Tpos")).withColumn("gap", F.col("b") - F.col("s")).withColumn("under", F.col("area_b") - F.col("area"))
    # the rank whose reference value is the first with a share of at least the batch's
    rank = F.expr("(cast(cpos as decimal(19,0)) * cast(Tneg as decimal(19,0)) + Tpos - 1) div Tpos")
    c = cut_lineage(c.withColumn("rank", rank))  # asks for ranks and gets their values
    asked = c.where(F.col("cneg") < F.col("rank")).select("feature", "rank", "Tneg").distinct()
    steps = r.where(F.col("neg") > 0).select("feature", (F.col("cneg") - F.col("neg") + 1).alias("rank"), "Tneg", F.struct("s", "area").alias("at"))
    u = steps.unionByName(asked.withColumn("at", F.lit(None).cast("struct<s:double,area:double>"))) \
             .withColumn("_b", F.expr(f"cast((rank - 1) * double({n_buckets}) / Tneg as int)"))
    # values rise with ranks, so the value in force at a rank is the largest so far: in the bucket, or in those before it
    inside = Window.partitionBy("feature", "_b").orderBy("rank")
    carried = u.groupBy("feature", "_b").agg(F.max("at").alias("_m")).withColumn(
        "_carry", F.max("_m").over(Window.partitionBy("feature").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    found = u.withColumn("in_force", F.max("at").over(inside)).where(F.col("at").isNull()).join(carried, ["feature", "_b"]) \
             .select("feature", "rank", F.coalesce("in_force", "_carry").alias("cross"))
    c = c.join(found, ["feature", "rank"], "left")
    t = F.col("cross.s")
    between = F.when(F.col("cneg") >= F.col("rank"), F.col("under") - F.col("share") * F.col("gap")) \
               .when(t >= F.col("b"), F.col("share") * F.col("gap") - F.col("under")) \
               .otherwise(F.col("share") * (2 * t - F.col("s") - F.col("b")) - 2 * F.col("cross.area") + F.col("area") + F.col("area_b"))
    before = F.min(F.struct("s", "area"))["area"]  # up to a batch's first value its share is 0
    return c.groupBy(batch, "feature").agg((F.sum(F.greatest(between, F.lit(0.0))) + before).alias("wasserstein"))


def monitor(psi_df: DataFrame, counts: DataFrame, batch: str, warn: float = PSI_WARN, alert: float = PSI_ALERT, min_rows: int = MIN_ROWS) -> DataFrame:
    """DRIFT-05/06/10: per batch: max PSI, sorted ALERT / WARN feature lists,
    skipped features (< min_rows non-null) and the overall status (most severe)."""
    j = psi_df.join(counts, [batch, "feature"], "left")
    st = F.when(F.col("n_nonnull") < min_rows, "SKIPPED").otherwise(psi_status(F.col("psi"), warn, alert))
    j = j.withColumn("status", st)
    sev = F.when(F.col("status") == "ALERT", 2).when(F.col("status") == "WARN", 1).otherwise(0)
    g = j.groupBy(batch).agg(
        F.max(F.when(F.col("status") != "SKIPPED", F.col("psi"))).alias("max_psi"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == "ALERT", F.col("feature")))), ",").alias("alerts"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == "WARN", F.col("feature")))), ",").alias("warnings"),
        F.count_if(F.col("status") == "SKIPPED").alias("n_skipped"), F.max(sev).alias("severity"))
    return g.withColumn("overall", F.when(F.col("severity") == 2, "ALERT").when(F.col("severity") == 1, "WARN").otherwise("OK"))


def alert_runs(status: DataFrame, key: str, order: str, flag: Column, retrain_len: int = 2, retire_len: int = 5,
               retire_col: Column | None = None) -> DataFrame:
    """WIN-10 / DRIFT-12: consecutive-alert runs (gaps and islands via the
    row_number difference) per key, with the day each began (``since``); a run reaching ``retrain_len`` fires RETRAIN
    once, one reaching ``retire_len`` with the extra condition fires RETIRE."""
    w = Window.partitionBy(key).orderBy(order)
    d = status.withColumn("_f", flag.cast("int")).withColumn("_rn", F.row_number().over(w))
    d = d.withColumn("_rf", F.row_number().over(Window.partitionBy(key, "_f").orderBy(order)))
    d = d.withColumn("_island", F.col("_rn") - F.col("_rf"))
    wr = Window.partitionBy(key, "_f", "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("consecutive", F.when(F.col("_f") == 1, F.count(F.lit(1)).over(wr)).otherwise(0))
    d = d.withColumn("since", F.when(F.col("_f") == 1, F.min(order).over(wr)))
    extra = retire_col if retire_col is not None else F.lit(True)
    d = d.withColumn("action", F.when((F.col("consecutive") == retire_len) & extra, "RETIRE")
                     .when(F.col("consecutive") == retrain_len, "RETRAIN"))
    return d.drop("_f", "_rn", "_rf", "_island")


def top_k_per_batch(psi_df: DataFrame, batch: str, k: int) -> DataFrame:
    """WIN-17: top-k drifted features per batch (PSI desc, feature asc)."""
    w = Window.partitionBy(batch).orderBy(F.col("psi").desc(), "feature")
    return psi_df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def categorical_drift(ref: DataFrame, act: DataFrame, batch: str, col: str, eps: float = 1e-6) -> DataFrame:
    """DRIFT-15: chi-squared (expected from reference shares), total variation
    and Jensen-Shannon divergence (natural log) of level shares per batch."""
    r = ref.groupBy(col).agg(F.count(F.lit(1)).alias("rn"))
    r = r.withColumn("rp", F.col("rn") / F.sum("rn").over(Window.partitionBy()))  # one row per level
    a = act.groupBy(batch, col).agg(F.count(F.lit(1)).alias("an"))
    a = a.withColumn("at", F.sum("an").over(Window.partitionBy(batch))).withColumn("ap", F.col("an") / F.col("at"))
    cells = a.select(batch, "at").distinct().withColumn("_k", F.lit(1)).join(r.select(col, "rp").withColumn("_k", F.lit(1)), "_k")
    full = cells.join(a.select(batch, col, "ap", "an"), [batch, col], "full_outer")
    full = full.fillna(0.0, ["rp", "ap"]).fillna(0, ["an"])
    m = (F.col("ap") + F.col("rp")) / 2
    kl = lambda p: F.when(p > 0, p * F.log(p / m)).otherwise(0.0)
    exp_n = F.greatest(F.col("rp"), F.lit(eps)) * F.col("at")
    return full.groupBy(batch).agg(
        F.sum((F.col("an") - exp_n) * (F.col("an") - exp_n) / exp_n).alias("chi2"),
        F.sum(F.abs(F.col("ap") - F.col("rp"))).alias("tv2"),
        F.sum(0.5 * kl(F.col("ap")) + 0.5 * kl(F.col("rp"))).alias("js")).select(batch, "chi2", (F.col("tv2") / 2).alias("tv"), "js")


def corr_shift(ref: DataFrame, act: DataFrame, batch: str, features: list[str]) -> DataFrame:
    """DRIFT-18: all pairwise correlations per batch in one aggregation; max |Δ| vs reference."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    aggs = [F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs]
    rc = ref.agg(*aggs).withColumn("_k", F.lit(1))
    ac = act.groupBy(batch).agg(*aggs)
    j = ac.withColumn("_k", F.lit(1)).join(rc.select("_k", *[F.col(f"{a}__{b}").alias(f"r_{a}__{b}") for a, b in pairs]), "_k")
    diffs = [F.abs(F.col(f"{a}__{b}") - F.col(f"r_{a}__{b}")) for a, b in pairs]
    return j.select(batch, F.greatest(*diffs).alias("max_corr_diff") if len(diffs) > 1 else diffs[0].alias("max_corr_diff"))
