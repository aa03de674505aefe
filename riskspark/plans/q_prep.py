"""Feature preparation, scorecard explanation queries (FE-01..04, AGG-07, EXP, WIN-03..05, TXT-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import explain as ex
from riskspark.operators import features as fx
from riskspark.operators import prep as pr
from riskspark.operators import split as sp
from riskspark.plans.catalog import register
from riskspark.plans.frames import SCORED_SQL, scored, split_unit_sql
from riskspark.plans.q_features import fe05_sql
from riskspark.sources.io import table
from riskspark.streaming import stream as st

S = f"s AS ({SCORED_SQL})"
TRAIN_LI = f"{split_unit_sql('l_orderkey')} >= 0.4"
TRAIN_S = f"{split_unit_sql('id')} >= 0.4"


@register("agg07_factory_variant_a", fe05_sql(1.0))
def q_agg07(spark, sf):
    """AGG-07 / FE-05 variant switch: ratios as count/(n+1) instead of means of flags."""
    return fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders"),
                                 fx.FactoryParams(ratio_smoothing=1.0))


@register("fe01_impute_encode", f"""
WITH li AS (SELECT *, nullif(l_discount, 0.0) AS disc_n, nullif(l_tax, 0.0) AS tax_n FROM lineitem),
m AS (SELECT median(disc_n) AS md, median(tax_n) AS mt FROM li WHERE {TRAIN_LI}),
lv AS (SELECT 'l_returnflag' AS feature, l_returnflag AS level FROM li WHERE {TRAIN_LI} UNION ALL SELECT 'l_linestatus', l_linestatus FROM li WHERE {TRAIN_LI}),
codes AS (SELECT feature, level, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY level) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT feature, level FROM lv))
SELECT l_orderkey, l_linenumber, round(coalesce(disc_n, md), 6) AS disc_n, round(coalesce(tax_n, mt), 6) AS tax_n,
  coalesce(a.code, -1) AS l_returnflag_code, coalesce(b.code, -1) AS l_linestatus_code
FROM li, m LEFT JOIN codes a ON a.feature = 'l_returnflag' AND a.level = li.l_returnflag LEFT JOIN codes b ON b.feature = 'l_linestatus' AND b.level = li.l_linestatus""")
def q_fe01(spark, sf):
    """FE-01: median impute + most-frequent fill + ordinal codes, all fitted on train rows only."""
    li = table(spark, sf, "lineitem").withColumn("disc_n", F.nullif("l_discount", F.lit(0.0))).withColumn("tax_n", F.nullif("l_tax", F.lit(0.0)))
    li = sp.row_split(li, "l_orderkey")
    train = li.where(F.col("split") == "train")
    out = pr.apply_medians(li, pr.fit_medians(train, ["disc_n", "tax_n"]), ["disc_n", "tax_n"])
    cats = ["l_returnflag", "l_linestatus"]
    out = pr.apply_levels(out, pr.fit_levels(train, cats), cats)
    return out.select("l_orderkey", "l_linenumber", F.round("disc_n", 6).alias("disc_n"), F.round("tax_n", 6).alias("tax_n"),
                      "l_returnflag_code", "l_linestatus_code")


@register("fe02_standard_scaling", f"""
WITH {S}, st AS (SELECT avg(p_raw) AS m1, stddev_pop(p_raw) AS s1, avg(nation) AS m2, stddev_pop(nation) AS s2 FROM s WHERE {TRAIN_S})
SELECT id, round((p_raw - m1) / s1, 6) AS p_raw_z, round((nation - m2) / s2, 6) AS nation_z FROM s, st""")
def q_fe02(spark, sf):
    """FE-02: standardisation with population std fitted on train rows."""
    s = sp.row_split(scored(spark, sf), "id")
    st = pr.fit_scaler(s.where(F.col("split") == "train"), ["p_raw", "nation"])
    z = pr.apply_scaler(s, st, ["p_raw", "nation"])
    return z.select("id", F.round("p_raw_z", 6).alias("p_raw_z"), F.round("nation_z", 6).alias("nation_z"))


@register("fe02_one_hot", f"""
WITH {S}, x AS (SELECT id, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS prio, {TRAIN_S} AS tr FROM s),
lv AS (SELECT list_sort(list(DISTINCT o_orderstatus)) AS ls, list_sort(list(DISTINCT prio) FILTER (WHERE prio IS NOT NULL)) AS lp FROM x WHERE tr AND prio <> '1-URGENT')
SELECT id, list_transform(ls, lambda v: CAST(coalesce(o_orderstatus = v, false) AS INTEGER)) AS status_hot, list_transform(lp, lambda v: CAST(coalesce(prio = v, false) AS INTEGER)) AS prio_hot FROM x, lv""")
def q_fe02_hot(spark, sf):
    """FE-02: one-hot arrays with the levels of train; here train lacks one priority and another is null, both all zeros."""
    s = sp.row_split(scored(spark, sf), "id").withColumn("prio", F.nullif("o_orderpriority", F.lit("5-LOW")))
    levels = pr.fit_one_hot(s.where((F.col("split") == "train") & (F.col("prio") != "1-URGENT")), ["o_orderstatus", "prio"])
    return pr.apply_one_hot(s, levels, ["o_orderstatus", "prio"]).select("id", F.col("o_orderstatus_hot").alias("status_hot"), "prio_hot")


WOE_FEATS = ["p_raw", "nation", "noise"]
WOE_SQL = f"""
WITH {S}, tr AS (SELECT *, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':noise'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS noise FROM s WHERE {TRAIN_S}),
lg AS (SELECT y, 'p_raw' AS feature, CAST(p_raw AS DOUBLE) AS v FROM tr UNION ALL SELECT y, 'nation', CAST(nation AS DOUBLE) FROM tr UNION ALL SELECT y, 'noise', noise FROM tr),
e AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM lg WHERE v IS NOT NULL GROUP BY feature),
b AS (SELECT lg.feature, y, CASE WHEN v IS NULL THEN -1 ELSE CAST(len(list_filter(edges, lambda x: x < v)) AS INTEGER) END AS bin FROM lg JOIN e USING (feature)),
g AS (SELECT feature, bin, count(*) AS n, sum(y) AS bad FROM b GROUP BY feature, bin),
d AS (SELECT *, (n - bad + 0.5) / sum(n - bad + 0.5) OVER (PARTITION BY feature) AS dg, (bad + 0.5) / sum(bad + 0.5) OVER (PARTITION BY feature) AS db FROM g),
w AS (SELECT feature, bin, n, bad, ln(dg / db) AS woe, sum((dg - db) * ln(dg / db)) OVER (PARTITION BY feature) AS iv FROM d)"""


def woe_table(spark, sf):
    s = sp.row_split(scored(spark, sf), "id").withColumn("noise", X.stable_unit("id", ":noise"))
    return pr.fit_woe(s.where(F.col("split") == "train"), WOE_FEATS)


@register("fe03_woe_iv", WOE_SQL + " SELECT feature, bin, n, CAST(bad AS BIGINT) AS bad, round(woe, 6) AS woe, round(iv, 6) AS iv FROM w")
def q_fe03(spark, sf):
    """FE-03: equal-frequency WOE bins and information value per feature (train rows)."""
    w = woe_table(spark, sf)
    return w.select("feature", "bin", "n", "bad", F.round("woe", 6).alias("woe"), F.round("iv", 6).alias("iv"))


@register("fe04_top_iv", WOE_SQL + " SELECT feature, round(max(iv), 6) AS iv FROM w GROUP BY feature ORDER BY iv DESC, feature LIMIT 2")
def q_fe04(spark, sf):
    """FE-04: top features by IV (the limit is the feature)."""
    w = woe_table(spark, sf).groupBy("feature").agg(F.round(F.max("iv"), 6).alias("iv"))
    return pr.top_by(w, "iv", 2)


# Scorecard weights over the applicant features, and reason code table.
SCORECARD = {"acc_overdue_ratio": 2.0, "acc_past_due_mean": 1.5, "acc_open_ratio": -0.8, "bal_neg": 0.6}
REASONS = [("acc_overdue_ratio", "R01", "Share of accounts with past-due months"),
           ("acc_past_due_mean", "R02", "Average past-due month rate"),
           ("acc_open_ratio", "R03", "Share of open accounts"),
           ("bal_neg", "R04", "Negative account balance")]
FEATS = list(SCORECARD)


def scorecard_frame(spark, sf):
    f = fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    means = f.agg(*[F.avg(c).alias(c) for c in FEATS])
    return ex.contributions(f, SCORECARD, means)


CONTRIB_SQL = f"""
WITH f AS ({fe05_sql(0.0)}), mu AS (SELECT {", ".join(f"avg({c}) AS mu_{c}" for c in FEATS)} FROM f),
c AS (SELECT f.applicant_id, f.band, {", ".join(f"{w} * (coalesce({c}, mu_{c}) - mu_{c}) AS c_{c}" for c, w in SCORECARD.items())} FROM f, mu),
u AS ({" UNION ALL ".join(f"SELECT applicant_id, band, '{c}' AS feature, c_{c} AS contrib FROM c" for c in FEATS)})"""


@register("win03_top_reasons", CONTRIB_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY abs(contrib) DESC, feature) AS rk FROM u)
SELECT applicant_id, string_agg(feature, ',' ORDER BY rk) AS top3 FROM r WHERE rk <= 3 GROUP BY applicant_id""")
def q_win03(spark, sf):
    """WIN-03 / EXP-01: per-row top 3 features by |contribution| from the row's own array."""
    c = scorecard_frame(spark, sf)
    return c.select("applicant_id", F.array_join(F.transform(ex.top_k_contribs("contribs", 3), lambda x: x["feature"]), ",").alias("top3"))


@register("exp02_reason_codes", CONTRIB_SQL + """,
codes AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}', '{c}', '{t}')" for f, c, t in REASONS) + """) t(feature, code, text)),
r AS (SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY abs(contrib) DESC, feature) - 1 AS reason_rank FROM u WHERE contrib > 0)
SELECT CAST(reason_rank AS INTEGER) AS reason_rank, code, count(*) AS n FROM r JOIN codes USING (feature) WHERE reason_rank < 2 GROUP BY reason_rank, code""")
def q_exp02(spark, sf):
    """EXP-02: top 2 positive contributions per applicant mapped to reason codes."""
    codes = spark.createDataFrame(REASONS, "feature string, code string, text string")
    r = ex.reason_codes(scorecard_frame(spark, sf), 2, codes)
    return r.groupBy("reason_rank", "code").agg(F.count(F.lit(1)).alias("n"))


REASON_SQL = CONTRIB_SQL + """,
codes AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}', '{c}', '{'increasing' if SCORECARD[f] > 0 else 'decreasing'}')" for f, c, _ in REASONS) + """) t(feature, code, constr)),
r AS (SELECT u.*, code, constr, CASE WHEN contrib > 1e-9 THEN 'raises' WHEN contrib < -1e-9 THEN 'lowers' ELSE 'none' END AS direction,
  row_number() OVER (PARTITION BY applicant_id ORDER BY abs(contrib) DESC, feature) AS rk FROM u JOIN codes USING (feature))"""
SIGNS = {f: 1 if w > 0 else -1 for f, w in SCORECARD.items()}


@register("exp02_reason_rows", REASON_SQL + """
SELECT applicant_id, CAST(rk AS INTEGER) AS reason_rank, feature, code, direction, constr AS "constraint", round(contrib, 6) AS contrib FROM r WHERE rk <= 3""")
def q_exp02_rows(spark, sf):
    """EXP-02: three reasons an applicant, strongest first, with direction and the sign the feature is held to."""
    r = scorecard_frame(spark, sf).select("applicant_id", F.posexplode(ex.reason_list("contribs", 3, REASONS, SIGNS)).alias("i", "r"))
    return r.select("applicant_id", (F.col("i") + 1).alias("reason_rank"), "r.feature", "r.code", "r.direction", "r.constraint", F.round("r.contrib", 6).alias("contrib"))


@register("st03_streaming_reasons", REASON_SQL + """,
s AS (SELECT applicant_id, sum(contrib) AS score FROM u GROUP BY applicant_id)
SELECT applicant_id, any_value(band) AS band, round(any_value(score), 6) AS score, string_agg(CASE WHEN rk <= 3 THEN code || ' ' || direction END, '; ' ORDER BY rk) AS reasons
FROM r JOIN s USING (applicant_id) GROUP BY applicant_id""")
def q_st03_reasons(spark, sf):
    """ST-03: scorecard points, band and reasons of each applicant inside a stream; the means are a one-row table."""
    f = fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    src = st.scratch(spark, "st03-reasons-src")
    f.select("applicant_id", "band", *FEATS).write.parquet(src)
    means = spark.read.parquet(src).agg(*[F.avg(c).alias(c) for c in FEATS])
    s = ex.contributions(st.file_stream(spark, src), SCORECARD, means)
    score = F.aggregate("contribs", F.lit(0.0), lambda a, x: a + x["contrib"])
    reasons = F.array_join(F.transform(ex.reason_list("contribs", 3, REASONS, SIGNS), lambda r: F.concat_ws(" ", r["code"], r["direction"])), "; ")
    out = st.run_to_table(s.select("applicant_id", "band", score.alias("score"), reasons.alias("reasons")), "st03-reasons", mode="append")
    return out.withColumn("score", F.round("score", 6))


@register("txt08_adverse_action_draft", CONTRIB_SQL + """,
codes AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}', '{c}', '{t}')" for f, c, t in REASONS) + """) t(feature, code, text)),
r AS (SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY abs(contrib) DESC, feature) - 1 AS reason_rank FROM u WHERE contrib > 0)
SELECT applicant_id, '[DRAFT - requires human review]' || chr(10) || 'Principal reasons:' || chr(10) || string_agg('- ' || text, chr(10) ORDER BY reason_rank) AS letter
FROM r JOIN codes USING (feature) WHERE reason_rank < 2 GROUP BY applicant_id""")
def q_txt08(spark, sf):
    """TXT-08: templated adverse-action draft from the reason texts (always tagged as draft)."""
    codes = spark.createDataFrame(REASONS, "feature string, code string, text string")
    return ex.adverse_action_draft(ex.reason_codes(scorecard_frame(spark, sf), 2, codes), "applicant_id")


@register("win04_global_importance", CONTRIB_SQL + """
SELECT feature, round(avg(abs(contrib)), 6) AS mean_abs, CAST(row_number() OVER (ORDER BY avg(abs(contrib)) DESC, feature) AS INTEGER) AS rank
FROM u GROUP BY feature QUALIFY rank <= 3""")
def q_win04(spark, sf):
    g = ex.global_importance(scorecard_frame(spark, sf), 3)
    return g.select("feature", F.round("mean_abs", 6).alias("mean_abs"), "rank")


@register("win05_feature_rank", CONTRIB_SQL + """
SELECT feature, CAST(rank() OVER (ORDER BY avg(abs(contrib)) DESC) AS INTEGER) AS rank,
  CASE WHEN rank() OVER (ORDER BY avg(abs(contrib)) DESC) <= 5 THEN 'WARN' ELSE 'PASS' END AS proxy_status
FROM u GROUP BY feature QUALIFY feature = 'bal_neg'""")
def q_win05(spark, sf):
    """WIN-05 / FAIR-03 proxy check: rank of a named (possibly sensitive) feature in the importance list; a place in the first five warns."""
    from pyspark.sql import Window
    e = scorecard_frame(spark, sf).select(F.explode("contribs").alias("c")).select("c.feature", F.abs("c.contrib").alias("a"))
    g = e.groupBy("feature").agg(F.avg("a").alias("m"))
    r = g.withColumn("rank", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.col("m").desc())))  # feature-sized table
    return r.where(F.col("feature") == "bal_neg").select("feature", "rank", F.when(F.col("rank") <= 5, "WARN").otherwise("PASS").alias("proxy_status"))


@register("exp04_importance_by_band", CONTRIB_SQL + " SELECT band, feature, round(avg(abs(contrib)), 6) AS mean_abs FROM u GROUP BY band, feature")
def q_exp04(spark, sf):
    return ex.importance_by_band(scorecard_frame(spark, sf), "band").select("band", "feature", F.round("mean_abs", 6).alias("mean_abs"))


@register("exp05_monotonicity_audit", f"""
WITH {S}, lg AS (SELECT p, 'p_raw' AS feature, CAST(p_raw AS DOUBLE) AS v FROM s UNION ALL SELECT p, 'nation', CAST(nation AS DOUBLE) FROM s),
e AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM lg GROUP BY feature),
g AS (SELECT lg.feature, CAST(len(list_filter(edges, lambda x: x < v)) AS INTEGER) AS bin, avg(p) AS ms FROM lg JOIN e USING (feature) GROUP BY lg.feature, bin),
d AS (SELECT feature, ms - lag(ms) OVER (PARTITION BY feature ORDER BY bin) AS dd FROM g)
SELECT feature, count(*) AS n_bins, count(*) FILTER (WHERE dd * 1 < 0) AS violations FROM d GROUP BY feature""")
def q_exp05(spark, sf):
    """EXP-05 (re-aim of monotone constraints): decile means of the score must follow the declared sign."""
    return ex.monotonicity_audit(scored(spark, sf), {"p_raw": 1, "nation": 1}, "p")
