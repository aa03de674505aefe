"""Drift queries over the 30 daily event batches and the scored frame (DRIFT-*, WIN-10, WIN-17)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import drift as dr
from riskspark.operators import metrics as mx
from riskspark.operators import split as sp
from riskspark.plans.catalog import register
from riskspark.plans.frames import BATCHES_SQL, SCORED_SQL, daily_batches, scored, split_unit_sql
from riskspark.operators.quantiles import exact_quantiles

FEATS = ["f_value", "f_k", "f_hour"]
SHIFT = [(7, -0.07), (14, -0.12)]
REF_LAST_DAY = 6
Q = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
EPS_N = repr(dr.PSI_EPS * 10)


def monitored(spark, sf):
    """Daily batches with the stress shift applied to f_value (PRJ-17)."""
    b = daily_batches(spark, sf)
    return b.withColumn("f_value", X.clip(F.col("f_value") + X.regime_shift("batch_day", SHIFT), 0.0, 1.0))


def long_frames(spark, sf, feats=FEATS):
    lg = dr.unpivot(monitored(spark, sf), ["batch_day"], feats)
    return lg.where(F.col("batch_day") <= REF_LAST_DAY), lg


MON = f"""mon AS (SELECT batch_day, event_id, event_type,
  least(greatest(f_value + CASE WHEN batch_day >= 14 THEN -0.12 WHEN batch_day >= 7 THEN -0.07 ELSE 0.0 END, 0.0), 1.0) AS f_value, f_k, f_hour
  FROM ({BATCHES_SQL}))"""
LG = "lg AS (" + " UNION ALL ".join(f"SELECT batch_day, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM mon" for f in FEATS) + f"), ref AS (SELECT * FROM lg WHERE batch_day <= {REF_LAST_DAY})"
BIN = "CASE WHEN v >= edges[1] AND v <= edges[11] THEN CAST(len(list_filter(edges[2:10], lambda x: x <= v)) AS INTEGER) END"
PSI_BINS = f"""
q AS (SELECT feature, quantile_cont(v, {Q}) AS qq FROM ref WHERE v IS NOT NULL GROUP BY feature),
e AS (SELECT feature, list_concat([qq[1] - 1e-8], qq[2:10], [qq[11] + 1e-8]) AS edges FROM q),
rc AS (SELECT feature, bin, count(*) AS rn FROM (SELECT ref.feature, {BIN} AS bin FROM ref JOIN e USING (feature)) WHERE bin IS NOT NULL GROUP BY feature, bin),
ac AS (SELECT batch_day, feature, bin, count(*) AS an FROM (SELECT lg.batch_day, lg.feature, {BIN} AS bin FROM lg JOIN e USING (feature)) WHERE bin IS NOT NULL GROUP BY batch_day, feature, bin),
grid AS (SELECT c.batch_day, c.feature, e.edges, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM (SELECT DISTINCT batch_day, feature FROM lg) c JOIN e USING (feature)),
g AS (SELECT grid.*, coalesce(rn, 0) AS rn, coalesce(an, 0) AS an FROM grid LEFT JOIN rc USING (feature, bin) LEFT JOIN ac USING (batch_day, feature, bin)),
t AS (SELECT *, sum(rn) OVER (PARTITION BY batch_day, feature) AS rt, sum(an) OVER (PARTITION BY batch_day, feature) AS att FROM g),
pb AS (SELECT batch_day, feature, bin + 1 AS bin, edges[bin + 1] AS lower, edges[bin + 2] AS upper,
  (rn + 1e-8) / (rt + {EPS_N}) AS rp, (an + 1e-8) / (att + {EPS_N}) AS ap, an FROM t),
psi AS (SELECT batch_day, feature, sum((ap - rp) * ln(ap / rp)) AS psi, sum(an) AS n_binned FROM pb GROUP BY batch_day, feature)"""
PSI_HEAD = f"WITH {MON}, {LG}, {PSI_BINS}"
STATUS = "CASE WHEN psi > 0.2 THEN 'ALERT' WHEN psi > 0.1 THEN 'WARN' ELSE 'OK' END"


@register("drift01_psi", f"""{PSI_HEAD}
SELECT batch_day, feature, round(psi, 6) AS psi, CAST(n_binned AS BIGINT) AS n_binned, {STATUS} AS status FROM psi""")
def q_drift01(spark, sf):
    """DRIFT-01/06 + JOIN-07: PSI per day and feature against reference-quantile bins (days 1-6)."""
    ref, act = long_frames(spark, sf)
    p = dr.psi(ref, act, "batch_day")
    return p.select("batch_day", "feature", F.round("psi", 6).alias("psi"), "n_binned", dr.psi_status(F.col("psi")).alias("status"))


@register("drift02_psi_fixed_width", f"""
WITH {MON}, {LG}, f AS (SELECT * FROM lg WHERE feature = 'f_value'), bins AS (SELECT CAST(unnest(range(-1, 10)) AS INTEGER) AS bin), fb AS (SELECT batch_day, CASE WHEN v BETWEEN 0 AND 1 THEN least(CAST(floor(v * 10) AS INTEGER), 9) ELSE -1 END AS bin FROM f WHERE v IS NOT NULL),
rc AS (SELECT bin, count(*) AS rn FROM fb WHERE batch_day <= {REF_LAST_DAY} GROUP BY bin),
ac AS (SELECT batch_day, bin, count(*) AS an FROM fb GROUP BY batch_day, bin),
g AS (SELECT d.batch_day, bins.bin, coalesce(rn, 0) AS rn, coalesce(an, 0) AS an FROM (SELECT DISTINCT batch_day FROM f) d CROSS JOIN bins LEFT JOIN rc USING (bin) LEFT JOIN ac USING (batch_day, bin)),
p AS (SELECT batch_day, bin, rn / sum(rn) OVER (PARTITION BY batch_day) AS r0, an / sum(an) OVER (PARTITION BY batch_day) AS a0 FROM g),
p2 AS (SELECT batch_day, CASE WHEN r0 = 0 THEN 1e-6 ELSE r0 END AS r, CASE WHEN a0 = 0 THEN 1e-6 ELSE a0 END AS a FROM p WHERE bin >= 0)
SELECT batch_day, 'f_value' AS feature, round(sum((a - r) * ln(a / r)), 6) AS psi FROM p2 GROUP BY batch_day""")
def q_drift02(spark, sf):
    """DRIFT-02: PSI with equal-width [0,1] bins and a 1e-6 floor."""
    ref, act = long_frames(spark, sf, ["f_value"])
    return dr.psi_fixed(ref, act, "batch_day").select("batch_day", "feature", F.round("psi", 6).alias("psi"))


@register("drift03_bin_details", f"""{PSI_HEAD}
SELECT batch_day, feature, bin, round(lower, 6) AS lower, round(upper, 6) AS upper, round(rp, 6) AS ref_pct, round(ap, 6) AS act_pct,
  round((ap - rp) * ln(ap / rp), 6) AS bin_psi FROM pb""")
def q_drift03(spark, sf):
    """DRIFT-03: bin by bin, every feature and day."""
    ref, act = long_frames(spark, sf)
    b = dr.psi_bins(ref, act, "batch_day")
    return b.select("batch_day", "feature", "bin", *[F.round(c, 6).alias(c) for c in ("lower", "upper", "ref_pct", "act_pct", "bin_psi")])


CDF2 = f"""
rcnt AS (SELECT feature, v AS s, count(*) AS neg FROM ref WHERE v IS NOT NULL GROUP BY feature, v),
u AS (SELECT b.batch_day, b.feature, r.s, 0 AS pos, r.neg FROM (SELECT DISTINCT batch_day, feature FROM lg) b JOIN rcnt r USING (feature)
      UNION ALL SELECT batch_day, feature, v, count(*), 0 FROM lg WHERE v IS NOT NULL GROUP BY batch_day, feature, v),
d AS (SELECT batch_day, feature, s, sum(pos) AS pos, sum(neg) AS neg FROM u GROUP BY batch_day, feature, s),
c AS (SELECT batch_day, feature, s,
  sum(pos) OVER (PARTITION BY batch_day, feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
  sum(neg) OVER (PARTITION BY batch_day, feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
  sum(pos) OVER (PARTITION BY batch_day, feature) AS tp, sum(neg) OVER (PARTITION BY batch_day, feature) AS tn,
  lead(s) OVER (PARTITION BY batch_day, feature ORDER BY s) AS nxt FROM d)"""


@register("drift04_ks", f"""
WITH {MON}, {LG}, {CDF2}, k AS (SELECT batch_day, feature, max(abs(cpos / tp - cneg / tn)) AS ks, max(tp) AS n_act, max(tn) AS n_ref FROM c GROUP BY batch_day, feature),
l AS (SELECT *, (sqrt(n_act * n_ref / (n_act + n_ref)) + 0.12 + 0.11 / sqrt(n_act * n_ref / (n_act + n_ref))) * ks AS lam FROM k)
SELECT batch_day, feature, round(ks, 6) AS ks, CAST(n_act AS BIGINT) AS n_act, CAST(n_ref AS BIGINT) AS n_ref,
  round(least(greatest(CASE WHEN lam < 0.04 THEN 1.0
    WHEN lam < 1.18 THEN 1.0 - sqrt(2.0 * pi()) / lam * list_sum(list_transform(range(1, 21), lambda j: exp(-(2.0 * j - 1) * (2.0 * j - 1) * pi() * pi() / (8.0 * lam * lam))))
    ELSE 2.0 * list_sum(list_transform(range(1, 101), lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))) END, 0.0), 1.0), 6) AS p_value FROM l""")
def q_drift04(spark, sf):
    """DRIFT-04: two-sample KS (exact statistic) with the asymptotic p-value."""
    ref, act = long_frames(spark, sf)
    k = dr.ks(ref, act, "batch_day")
    return k.select("batch_day", "feature", F.round("ks", 6).alias("ks"), "n_act", "n_ref", F.round("p_value", 6).alias("p_value"))


@register("drift16_wasserstein", f"""
WITH {MON}, {LG}, {CDF2}
SELECT batch_day, feature, round(sum(coalesce(abs(cpos / tp - cneg / tn) * (nxt - s), 0.0)), 6) AS wasserstein FROM c GROUP BY batch_day, feature""")
def q_drift16(spark, sf):
    ref, act = long_frames(spark, sf)
    return dr.wasserstein(ref, act, "batch_day").select("batch_day", "feature", F.round("wasserstein", 6).alias("wasserstein"))


@register("drift05_monitor", f"""{PSI_HEAD},
nn AS (SELECT batch_day, feature, count(v) AS n_nonnull FROM lg GROUP BY batch_day, feature),
st AS (SELECT psi.*, CASE WHEN n_nonnull < 10 THEN 'SKIPPED' ELSE {STATUS} END AS status FROM psi LEFT JOIN nn USING (batch_day, feature)),
{CDF2},
ks AS (SELECT batch_day, max(k) AS max_ks FROM (SELECT batch_day, feature, max(abs(cpos / tp - cneg / tn)) AS k, max(tp) AS n_act FROM c GROUP BY batch_day, feature) WHERE n_act >= 10 GROUP BY batch_day)
SELECT batch_day, round(max(CASE WHEN status <> 'SKIPPED' THEN psi END), 6) AS max_psi, round(any_value(max_ks), 6) AS max_ks,
  coalesce(string_agg(CASE WHEN status = 'ALERT' THEN feature END, ',' ORDER BY feature), '') AS alerts,
  coalesce(string_agg(CASE WHEN status = 'WARN' THEN feature END, ',' ORDER BY feature), '') AS warnings,
  count(*) FILTER (WHERE status = 'SKIPPED') AS n_skipped,
  max(CASE WHEN status = 'ALERT' THEN 2 WHEN status = 'WARN' THEN 1 ELSE 0 END) AS severity,
  CASE max(CASE WHEN status = 'ALERT' THEN 2 WHEN status = 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARN' ELSE 'OK' END AS overall
FROM st LEFT JOIN ks USING (batch_day) GROUP BY batch_day""")
def q_drift05(spark, sf):
    """DRIFT-05/06/10: day-level monitor: max PSI and KS, alert and warning lists, overall severity."""
    ref, act = long_frames(spark, sf)
    p = dr.psi(ref, act, "batch_day")
    nn = act.groupBy("batch_day", "feature").agg(F.count("v").alias("n_nonnull"))
    k = dr.ks(ref, act, "batch_day").where(F.col("n_act") >= dr.MIN_ROWS).groupBy("batch_day").agg(F.max("ks").alias("max_ks"))
    m = dr.monitor(p, nn, "batch_day").join(k, "batch_day", "left")
    return m.select("batch_day", F.round("max_psi", 6).alias("max_psi"), F.round("max_ks", 6).alias("max_ks"), "alerts", "warnings", "n_skipped", "severity", "overall")


@register("win17_topk_drifted", f"""{PSI_HEAD}
SELECT batch_day, feature, round(psi, 6) AS psi, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY batch_day ORDER BY psi DESC, feature) AS rank FROM psi) WHERE rank <= 2""")
def q_win17(spark, sf):
    ref, act = long_frames(spark, sf)
    t = dr.top_k_per_batch(dr.psi(ref, act, "batch_day"), "batch_day", 2)
    return t.select("batch_day", "feature", F.round("psi", 6).alias("psi"), "rank")


@register("win10_consecutive_alerts", f"""{PSI_HEAD},
f AS (SELECT feature, batch_day, psi, CAST(psi > 0.1 AS INTEGER) AS fl FROM psi),
i AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY batch_day) - row_number() OVER (PARTITION BY feature, fl ORDER BY batch_day) AS isl FROM f),
r AS (SELECT *, CASE WHEN fl = 1 THEN count(*) OVER (PARTITION BY feature, fl, isl ORDER BY batch_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END AS consecutive FROM i)
SELECT feature, batch_day, round(psi, 6) AS psi, consecutive,
  CASE WHEN consecutive = 5 AND psi > 0.3 THEN 'RETIRE' WHEN consecutive = 2 THEN 'RETRAIN' END AS action FROM r""")
def q_win10(spark, sf):
    """WIN-10 / ST-05 batch twin: consecutive non-OK days per feature; RETRAIN at 2, RETIRE at 5 with PSI > 0.30."""
    ref, act = long_frames(spark, sf)
    p = dr.psi(ref, act, "batch_day")
    r = dr.alert_runs(p, "feature", "batch_day", F.col("psi") > 0.1, retire_col=F.col("psi") > 0.3)
    return r.select("feature", "batch_day", F.round("psi", 6).alias("psi"), "consecutive", "action")


@register("drift12_mean_shift", f"""
WITH {MON}, {LG}, rm AS (SELECT feature, avg(v) AS ref_mean FROM ref GROUP BY feature),
am AS (SELECT batch_day, feature, avg(v) AS mean FROM lg GROUP BY batch_day, feature)
SELECT batch_day, feature, round(mean - ref_mean, 6) AS mean_shift FROM am JOIN rm USING (feature)""")
def q_drift12(spark, sf):
    """DRIFT-12: per-feature mean shift of each batch against the reference."""
    ref, act = long_frames(spark, sf)
    rm = ref.groupBy("feature").agg(F.avg("v").alias("ref_mean"))
    am = act.groupBy("batch_day", "feature").agg(F.avg("v").alias("mean"))
    return am.join(rm, "feature").select("batch_day", "feature", F.round(F.col("mean") - F.col("ref_mean"), 6).alias("mean_shift"))


@register("drift12_alert_records", f"""{PSI_HEAD},
rm AS (SELECT feature, avg(v) AS ref_mean, stddev_pop(v) AS ref_std FROM ref GROUP BY feature),
am AS (SELECT batch_day, feature, avg(v) AS mean FROM lg GROUP BY batch_day, feature),
st AS (SELECT feature, batch_day, psi, mean - ref_mean AS sh, (mean - ref_mean) / ref_std AS z, {STATUS} AS status, CAST(psi > 0.1 AS INTEGER) AS fl FROM psi JOIN am USING (batch_day, feature) JOIN rm USING (feature)),
i AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY batch_day) - row_number() OVER (PARTITION BY feature, fl ORDER BY batch_day) AS isl FROM st),
r AS (SELECT *, count(*) OVER (PARTITION BY feature, fl, isl ORDER BY batch_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS consecutive,
  min(batch_day) OVER (PARTITION BY feature, fl, isl ORDER BY batch_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM i)
SELECT feature, batch_day, status, round(psi, 6) AS psi, round(sh, 6) AS mean_shift, round(z, 6) AS shift_in_std, since, consecutive,
  CASE WHEN consecutive = 5 AND psi > 0.3 THEN 'RETIRE' WHEN consecutive = 2 THEN 'RETRAIN' END AS action FROM r WHERE fl = 1""")
def q_drift12_alerts(spark, sf):
    """DRIFT-12: one record for each alert of a feature and day: status, PSI, shift of the mean (also in
    standard deviations of the reference), the day its run began, and how many days in a row it has lasted."""
    ref, act = long_frames(spark, sf)
    rm = ref.groupBy("feature").agg(F.avg("v").alias("rm"), F.stddev_pop("v").alias("rs"))
    am = act.groupBy("batch_day", "feature").agg(F.avg("v").alias("m")).join(rm, "feature") \
            .select("batch_day", "feature", (F.col("m") - F.col("rm")).alias("sh"), F.try_divide(F.col("m") - F.col("rm"), F.col("rs")).alias("z"))
    r = dr.alert_runs(dr.psi(ref, act, "batch_day"), "feature", "batch_day", F.col("psi") > dr.PSI_WARN, retire_col=F.col("psi") > 0.3)
    r = r.where(F.col("consecutive") > 0).join(am, ["batch_day", "feature"])
    return r.select("feature", "batch_day", dr.psi_status(F.col("psi")).alias("status"), F.round("psi", 6).alias("psi"), F.round("sh", 6).alias("mean_shift"),
                    F.round("z", 6).alias("shift_in_std"), "since", "consecutive", "action")


PCTS = [0.01, 0.1, 0.9, 0.99]


@register("drift13_percentile_snapshots", f"""
WITH {MON}, {LG}, rp AS (SELECT feature, quantile_cont(v, {PCTS}) AS r FROM ref GROUP BY feature),
ap AS (SELECT batch_day, feature, quantile_cont(v, {PCTS}) AS a FROM lg GROUP BY batch_day, feature)
SELECT batch_day, feature, round(a[1], 6) AS p01, round(a[2], 6) AS p10, round(a[3], 6) AS p90, round(a[4], 6) AS p99,
  round(a[1] - r[1], 6) AS d01, round(a[4] - r[4], 6) AS d99 FROM ap JOIN rp USING (feature)""")
def q_drift13(spark, sf):
    """DRIFT-13: tail percentile snapshots per batch next to the reference (one percentile agg each)."""
    ref, act = long_frames(spark, sf)
    rp = exact_quantiles(ref, "v", PCTS, ["feature"], "r")
    ap = exact_quantiles(act, "v", PCTS, ["batch_day", "feature"], "a")
    j = ap.join(rp, "feature")
    return j.select("batch_day", "feature", *[F.round(F.col("a")[i], 6).alias(n) for i, n in enumerate(["p01", "p10", "p90", "p99"])],
                    F.round(F.col("a")[0] - F.col("r")[0], 6).alias("d01"), F.round(F.col("a")[3] - F.col("r")[3], 6).alias("d99"))


@register("drift14_subpopulation_psi", f"""
WITH {MON}, lg AS ({" UNION ALL ".join(f"SELECT batch_day, event_type, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM mon" for f in FEATS)}), ref AS (SELECT * FROM lg WHERE batch_day <= {REF_LAST_DAY}),
q AS (SELECT event_type, feature, quantile_cont(v, {Q}) AS qq FROM ref WHERE v IS NOT NULL GROUP BY event_type, feature),
e AS (SELECT event_type, feature, list_concat([qq[1] - 1e-8], qq[2:10], [qq[11] + 1e-8]) AS edges FROM q),
rc AS (SELECT event_type, feature, bin, count(*) AS rn FROM (SELECT ref.event_type, ref.feature, {BIN} AS bin FROM ref JOIN e USING (event_type, feature)) WHERE bin IS NOT NULL GROUP BY ALL),
ac AS (SELECT batch_day, event_type, feature, bin, count(*) AS an FROM (SELECT lg.batch_day, lg.event_type, lg.feature, {BIN} AS bin FROM lg JOIN e USING (event_type, feature)) WHERE bin IS NOT NULL GROUP BY ALL),
grid AS (SELECT c.batch_day, c.event_type, c.feature, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM (SELECT DISTINCT batch_day, event_type, feature FROM lg) c JOIN e USING (event_type, feature)),
g AS (SELECT grid.*, coalesce(rn, 0) AS rn, coalesce(an, 0) AS an FROM grid LEFT JOIN rc USING (event_type, feature, bin) LEFT JOIN ac USING (batch_day, event_type, feature, bin)),
t AS (SELECT *, sum(rn) OVER (PARTITION BY batch_day, event_type, feature) AS rt, sum(an) OVER (PARTITION BY batch_day, event_type, feature) AS att FROM g),
pb AS (SELECT batch_day, event_type, feature, (rn + 1e-8) / (rt + {EPS_N}) AS rp, (an + 1e-8) / (att + {EPS_N}) AS ap FROM t)
SELECT batch_day, event_type, feature, round(sum((ap - rp) * ln(ap / rp)), 6) AS psi FROM pb GROUP BY ALL""")
def q_drift14(spark, sf):
    """DRIFT-14: PSI inside slices (event type) — the slice is just another grouping key."""
    lg = dr.unpivot(monitored(spark, sf), ["batch_day", "event_type"], FEATS)
    ref = lg.where(F.col("batch_day") <= REF_LAST_DAY)
    p = dr.psi(ref, lg, "batch_day", by=["event_type"])
    return p.select("batch_day", "event_type", "feature", F.round("psi", 6).alias("psi"))


@register("drift15_categorical", f"""
WITH {MON}, r AS (SELECT event_type, count(*) AS rn FROM mon WHERE batch_day <= {REF_LAST_DAY} GROUP BY event_type),
r2 AS (SELECT event_type, rn / sum(rn) OVER () AS rp FROM r),
a AS (SELECT batch_day, event_type, count(*) AS an FROM mon GROUP BY batch_day, event_type),
a2 AS (SELECT batch_day, event_type, an, sum(an) OVER (PARTITION BY batch_day) AS att, an / sum(an) OVER (PARTITION BY batch_day) AS ap FROM a),
cells AS (SELECT d.batch_day, d.att, r2.event_type, r2.rp FROM (SELECT DISTINCT batch_day, att FROM a2) d CROSS JOIN r2),
f AS (SELECT coalesce(cells.batch_day, a2.batch_day) AS batch_day, coalesce(cells.att, a2.att) AS att, coalesce(rp, 0.0) AS rp, coalesce(ap, 0.0) AS ap, coalesce(an, 0) AS an
      FROM cells FULL OUTER JOIN a2 ON cells.batch_day = a2.batch_day AND cells.event_type = a2.event_type)
SELECT batch_day, round(sum((an - greatest(rp, 1e-6) * att) * (an - greatest(rp, 1e-6) * att) / (greatest(rp, 1e-6) * att)), 6) AS chi2,
  round(sum(abs(ap - rp)) / 2, 6) AS tv,
  round(sum(0.5 * CASE WHEN ap > 0 THEN ap * ln(ap / ((ap + rp) / 2)) ELSE 0.0 END + 0.5 * CASE WHEN rp > 0 THEN rp * ln(rp / ((ap + rp) / 2)) ELSE 0.0 END), 6) AS js
FROM f GROUP BY batch_day""")
def q_drift15(spark, sf):
    """DRIFT-15: categorical drift of the event-type mix: chi-squared, total variation, Jensen-Shannon."""
    m = monitored(spark, sf)
    c = dr.categorical_drift(m.where(F.col("batch_day") <= REF_LAST_DAY), m, "batch_day", "event_type")
    return c.select("batch_day", *[F.round(x, 6).alias(x) for x in ("chi2", "tv", "js")])


@register("drift18_corr_shift", f"""
WITH {MON}, r AS (SELECT corr(f_value, f_k) AS a, corr(f_value, f_hour) AS b, corr(f_k, f_hour) AS c FROM mon WHERE batch_day <= {REF_LAST_DAY}),
d AS (SELECT batch_day, corr(f_value, f_k) AS a, corr(f_value, f_hour) AS b, corr(f_k, f_hour) AS c FROM mon GROUP BY batch_day)
SELECT batch_day, round(greatest(abs(d.a - r.a), abs(d.b - r.b), abs(d.c - r.c)), 6) AS max_corr_diff FROM d, r""")
def q_drift18(spark, sf):
    """DRIFT-18: joint-shift proxy: max |Δ| of all pairwise correlations per batch."""
    m = monitored(spark, sf)
    c = dr.corr_shift(m.where(F.col("batch_day") <= REF_LAST_DAY), m, "batch_day", FEATS)
    return c.select("batch_day", F.round("max_corr_diff", 6).alias("max_corr_diff"))


S = f"s AS ({SCORED_SQL})"
ROW_SPLIT = f"CASE WHEN {split_unit_sql('id')} < 0.2 THEN 'test' WHEN {split_unit_sql('id')} < 0.4 THEN 'val' ELSE 'train' END"


@register("drift07_band_mix_by_split", f"""
WITH {S}, b AS (SELECT {ROW_SPLIT} AS split, CASE WHEN p < 0.2 THEN 'GREEN' WHEN p < 0.4 THEN 'AMBER' ELSE 'RED' END AS band FROM s)
SELECT split, band, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM b GROUP BY split, band""")
def q_drift07(spark, sf):
    """DRIFT-07: score band mix per split (score drift between splits)."""
    s = sp.row_split(scored(spark, sf, with_group=False), "id").withColumn("band", X.band("p", X.THREE_CUTS, X.THREE_BANDS))
    g = s.groupBy("split", "band").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("split")), 6))


@register("drift07_score_shift", f"""
WITH {S}, lg AS (SELECT {ROW_SPLIT} AS batch_day, 'p' AS feature, p AS v FROM s), ref AS (SELECT * FROM lg WHERE batch_day = 'train'), {CDF2},
k AS (SELECT batch_day, max(abs(cpos / tp - cneg / tn)) AS ks FROM c GROUP BY batch_day),
m AS (SELECT batch_day, avg(v) - (SELECT avg(v) FROM ref) AS sh FROM lg GROUP BY batch_day)
SELECT batch_day AS split, round(ks, 6) AS ks, round(sh, 6) AS mean_shift,
  CASE WHEN ks > 0.10 OR abs(sh) > 0.10 THEN 'ALERT' WHEN ks > 0.05 OR abs(sh) > 0.05 THEN 'WARN' ELSE 'OK' END AS status FROM k JOIN m USING (batch_day)""")
def q_drift07_shift(spark, sf):
    """DRIFT-07: score drift of each split against train: KS and mean shift, warned over 0.05, alerted over 0.10."""
    lg = dr.unpivot(sp.row_split(scored(spark, sf, with_group=False), "id"), ["split"], ["p"])
    ref = lg.where(F.col("split") == "train")
    mean = ref.agg(F.avg("v")).scalar()
    m = lg.groupBy("split").agg(F.avg("v").alias("m")).select("split", (F.col("m") - mean).alias("sh"))
    j = dr.ks(ref, lg, "split").join(m, "split")
    worst = F.greatest(F.col("ks"), F.abs("sh"))
    return j.select("split", F.round("ks", 6).alias("ks"), F.round("sh", 6).alias("mean_shift"),
                    F.when(worst > 0.10, "ALERT").when(worst > 0.05, "WARN").otherwise("OK").alias("status"))


@register("drift08_ece_by_period", f"""
WITH {S}, b AS (SELECT year(ts) AS period, least(CAST(floor(p_raw * 10) AS INTEGER), 9) AS bin, count(*) AS nb, avg(y) AS acc, avg(p_raw) AS conf FROM s GROUP BY period, bin),
e AS (SELECT period, sum(nb) AS n, sum(nb / tot * abs(acc - conf)) AS ece FROM b JOIN (SELECT period, sum(nb) AS tot FROM b GROUP BY period) USING (period) GROUP BY period)
SELECT CAST(period AS INTEGER) AS period, CAST(n AS BIGINT) AS n, round(ece, 6) AS ece,
  CASE WHEN n < 1000 THEN 'INSUFFICIENT' WHEN ece > 0.1 THEN 'ALERT' WHEN ece > 0.05 THEN 'WARN' ELSE 'OK' END AS status FROM e""")
def q_drift08(spark, sf):
    """DRIFT-08: ECE per period on resolved labels with a minimum-size guard."""
    s = scored(spark, sf, with_group=False).withColumn("period", F.year("ts"))
    e = mx.ece(s, "p_raw", "y", ["period"])
    n = s.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    j = e.join(n, "period")
    st = F.when(F.col("n") < 1000, "INSUFFICIENT").when(F.col("ece") > 0.1, "ALERT").when(F.col("ece") > 0.05, "WARN").otherwise("OK")
    return j.select(F.col("period").cast("int").alias("period"), "n", "ece", st.alias("status"))


@register("drift11_decision_monitor", f"""
WITH {S}, d AS (SELECT year(ts) AS period, avg(CAST(p < 0.2 AS INTEGER)) AS approve, avg(CAST(p >= 0.2 AND p < 0.4 AS INTEGER)) AS review,
  avg(CAST(p >= 0.4 AS INTEGER)) AS reject FROM s GROUP BY period)
SELECT CAST(period AS INTEGER) AS period, round(approve, 6) AS approve_rate, round(review, 6) AS review_rate, round(reject, 6) AS reject_rate,
  round(100 * (approve - lag(approve) OVER (ORDER BY period)), 6) AS approve_pp_change FROM d""")
def q_drift11(spark, sf):
    """DRIFT-11: decision-layer monitor: zone rates per period and pp change (lag over a period-sized table)."""
    s = scored(spark, sf, with_group=False)
    d = s.groupBy(F.year("ts").cast("int").alias("period")).agg(
        F.avg((F.col("p") < 0.2).cast("int")).alias("a"), F.avg(((F.col("p") >= 0.2) & (F.col("p") < 0.4)).cast("int")).alias("r"),
        F.avg((F.col("p") >= 0.4).cast("int")).alias("j"))
    w = Window.partitionBy(F.lit(1)).orderBy("period")
    return d.select("period", F.round("a", 6).alias("approve_rate"), F.round("r", 6).alias("review_rate"), F.round("j", 6).alias("reject_rate"),
                    F.round(100 * (F.col("a") - F.lag("a").over(w)), 6).alias("approve_pp_change"))


@register("drift11_daily_decisions", f"""
WITH {S}, d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, avg(CAST(p < 0.2 AS INTEGER)) AS a, avg(CAST(p >= 0.2 AND p < 0.4 AS INTEGER)) AS r,
  avg(CAST(p >= 0.4 AS INTEGER)) AS j FROM s GROUP BY day),
c AS (SELECT *, round(100 * (a - lag(a) OVER w), 6) AS da, round(100 * (r - lag(r) OVER w), 6) AS dr, round(100 * (j - lag(j) OVER w), 6) AS dj FROM d WINDOW w AS (ORDER BY day))
SELECT strftime(day, '%Y-%m-%d') AS day, n, round(a, 6) AS approve_rate, round(r, 6) AS review_rate, round(j, 6) AS reject_rate,
  da AS approve_pp, dr AS review_pp, dj AS reject_pp, CASE WHEN abs(da) > 15 THEN 'FREEZE' WHEN abs(da) > 10 THEN 'ALERT'
  WHEN abs(da) > 5 OR abs(dr) > 5 OR abs(dj) > 5 THEN 'WARN' ELSE 'OK' END AS status FROM c""")
def q_drift11_daily(spark, sf):
    """DRIFT-10/11: daily decision rates and their change in percentage points: warned over 5, approvals
    alerted over 10, frozen over 15 (the windows run over the table of days)."""
    p = F.col("p")
    d = scored(spark, sf, with_group=False).groupBy(F.col("ts").cast("date").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.avg((p < 0.2).cast("int")).alias("approve"),
        F.avg(((p >= 0.2) & (p < 0.4)).cast("int")).alias("review"), F.avg((p >= 0.4).cast("int")).alias("reject"))
    w = Window.partitionBy(F.lit(1)).orderBy("d")
    for c in ("approve", "review", "reject"):
        d = d.withColumn(f"{c}_pp", F.round(100 * (F.col(c) - F.lag(c).over(w)), 6))
    a, r, j = (F.abs(f"{c}_pp") for c in ("approve", "review", "reject"))
    st = F.when(a > 15, "FREEZE").when(a > 10, "ALERT").when((a > 5) | (r > 5) | (j > 5), "WARN").otherwise("OK")
    return d.select(F.date_format("d", "yyyy-MM-dd").alias("day"), "n", *[F.round(c, 6).alias(f"{c}_rate") for c in ("approve", "review", "reject")],
                    "approve_pp", "review_pp", "reject_pp", st.alias("status"))


@register("drift19_concept_drift", f"""
WITH {S}, x AS (SELECT *, year(ts) AS period FROM s),
d AS (SELECT period, p_raw AS sc, sum(y) AS pos, sum(1 - y) AS neg FROM x GROUP BY period, p_raw),
c AS (SELECT period, pos, neg, sum(neg) OVER (PARTITION BY period ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
  sum(pos) OVER (PARTITION BY period) AS tp, sum(neg) OVER (PARTITION BY period) AS tn FROM d),
a AS (SELECT period, round(sum(pos * (cneg - neg + neg / 2.0)) / (max(tp) * max(tn)), 6) AS auc FROM c GROUP BY period),
o AS (SELECT period, avg(y) - avg(p_raw) AS gap FROM x GROUP BY period),
j AS (SELECT period, gap, 2 * auc - 1 AS gini FROM a JOIN o USING (period))
SELECT CAST(period AS INTEGER) AS period, round(gap, 6) AS obs_minus_exp, round(gini, 6) AS gini,
  round(first_value(gini) OVER (ORDER BY period) - gini, 6) AS gini_drop,
  CAST(first_value(gini) OVER (ORDER BY period) - gini > 0.03 AS INTEGER) AS review FROM j""")
def q_drift19(spark, sf):
    """DRIFT-19 / DRIFT-09: per-period observed-minus-expected rate and Gini drop vs the first period."""
    s = scored(spark, sf, with_group=False).withColumn("period", F.year("ts"))
    r = mx.ranking_metrics(s, "p_raw", "y", ["period"]).select("period", "auc")
    o = s.groupBy("period").agg((F.avg("y") - F.avg("p_raw")).alias("gap"))
    j = r.join(o, "period").withColumn("gini", 2 * F.col("auc") - 1)
    w = Window.partitionBy(F.lit(1)).orderBy("period")
    drop = F.first("gini").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("gini")
    return j.select(F.col("period").cast("int").alias("period"), F.round("gap", 6).alias("obs_minus_exp"), F.round("gini", 6).alias("gini"),
                    F.round(drop, 6).alias("gini_drop"), (drop > 0.03).cast("int").alias("review"))
