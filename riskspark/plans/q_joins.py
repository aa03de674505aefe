"""Join and window queries (JOIN-03..14, WIN-01..14, AGG-20)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import features as fx
from riskspark.operators import joins as jn
from riskspark.operators import metrics as mx
from riskspark.plans.catalog import register
from riskspark.plans.frames import MODELS_SQL, SCORED_SQL, model_scores, scored
from riskspark.plans.q_eval import SWEEP_SQL
from riskspark.plans.q_features import fe05_sql
from riskspark.sources.io import table
from riskspark.operators.quantiles import exact_quantiles

S = f"s AS ({SCORED_SQL})"
N = 50
LAST_SQL = f"""r AS (SELECT user_id, event_id, ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"""


def last_events(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    return jn.top_n_per_key(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], N, tiebreak=["event_id"])


@register("win01_last_n_per_entity", f"WITH {LAST_SQL} SELECT user_id, event_id, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= {N}")
def q_win01(spark, sf):
    """WIN-01: last 50 events per user (salted two-stage top-N)."""
    return last_events(spark, sf).select("user_id", "event_id", "rn")


def seq_digest(col):
    return F.array_join(F.transform(col, lambda x: F.format_string("%.2f:%.0f", x["value"], x["k"])), "|")


SEQ_SQL = f"""
WITH {LAST_SQL}, t AS (SELECT user_id, count(*) AS n, string_agg(printf('%.2f:%.0f', value, k), '|' ORDER BY rn DESC) AS body FROM r WHERE rn <= {N} GROUP BY user_id)
SELECT user_id, CAST(n AS INTEGER) AS n_real, CASE WHEN n < {N} THEN repeat('0.00:0|', CAST({N} - n AS INTEGER)) ELSE '' END || body AS seq_digest FROM t"""


@register("win02_fixed_sequence", SEQ_SQL)
def q_win02(spark, sf):
    """WIN-02 / FN-10: oldest-first, left-padded 50-step sequence per user (digest of the array)."""
    s = jn.fixed_sequence(last_events(spark, sf), "user_id", "rn", ["value", "k"], N)
    return s.select("user_id", "n_real", seq_digest(F.col("seq")).alias("seq_digest"))


@register("agg20_sequence_channel_stats", f"""
WITH {LAST_SQL}, real AS (SELECT user_id, value, k FROM r WHERE rn <= {N}),
cnt AS (SELECT user_id, count(*) AS n FROM real GROUP BY user_id),
pads AS (SELECT user_id, 0.0 AS value, 0.0 AS k FROM cnt, range(0, {N}) t(i) WHERE i < {N} - n),
a AS (SELECT * FROM real UNION ALL SELECT * FROM pads)
SELECT round(avg(value), 6) AS value_mean, round(stddev_pop(value), 6) AS value_std, round(avg(k), 6) AS k_mean, round(stddev_pop(k), 6) AS k_std FROM a""")
def q_agg20(spark, sf):
    """AGG-20: per-channel mean and population std over the flattened padded sequences."""
    s = jn.fixed_sequence(last_events(spark, sf), "user_id", "rn", ["value", "k"], N)
    x = s.select(F.explode("seq").alias("x")).select("x.value", "x.k")
    return x.agg(F.round(F.avg("value"), 6).alias("value_mean"), F.round(F.stddev_pop("value"), 6).alias("value_std"),
                 F.round(F.avg("k"), 6).alias("k_mean"), F.round(F.stddev_pop("k"), 6).alias("k_std"))


@register("join03_sequence_lookup", f"""
WITH {LAST_SQL}, t AS (SELECT user_id, count(*) AS n FROM r WHERE rn <= {N} GROUP BY user_id)
SELECT c.c_custkey, CAST(coalesce(t.n, 0) AS INTEGER) AS n_real, {N} AS seq_len FROM customer c LEFT JOIN t ON t.user_id = c.c_custkey""")
def q_join03(spark, sf):
    """JOIN-03: applicants without events get the all-zero sequence."""
    seqs = jn.fixed_sequence(last_events(spark, sf), "user_id", "rn", ["value", "k"], N).withColumnRenamed("user_id", "c_custkey")
    zero = F.array_repeat(F.struct(F.lit(0.0).alias("value"), F.lit(0.0).alias("k")), N)
    c = table(spark, sf, "customer").select("c_custkey")
    j = jn.lookup_with_default(c, seqs, "c_custkey", "seq", zero)
    return j.select("c_custkey", F.coalesce("n_real", F.lit(0)).alias("n_real"), F.size("seq").alias("seq_len"))


DIMS = 64


@register("join04_embedding_augment", "SELECT c.c_custkey, c.c_mktsegment, " + ", ".join(
    f"round(CAST(e.embedding[{i + 1}] AS DOUBLE), 6) AS emb_{i}" for i in range(DIMS)) +
    " FROM customer c JOIN embeddings e ON e.vec_id = c.c_custkey")
def q_join04(spark, sf):
    """JOIN-04: 1:1 inner join with the embedding table, vector expanded to columns."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("c_custkey"), "embedding")
    out = jn.augment_vectors(c, e, "c_custkey", "embedding", DIMS)
    return out.select("c_custkey", "c_mktsegment", *[F.round(f"emb_{i}", 6).alias(f"emb_{i}") for i in range(DIMS)])


@register("join05_semi_join", """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o.o_custkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R')""")
def q_join05(spark, sf):
    """JOIN-05: applicants with at least one past-due month (left semi join)."""
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(li, "o_orderkey", "left_semi")
    return table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left_semi")


@register("join06_anti_join", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_join06(spark, sf):
    """JOIN-06: accounts without any month rows (left anti join)."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(li, "o_orderkey", "left_anti")


@register("join08_policy_asof", f"""
WITH {S}, v AS (SELECT * FROM (VALUES ('v1.0', TIMESTAMP '1995-01-01 00:00:00', 0.06, 0.28), ('v1.1', TIMESTAMP '1998-01-01 00:00:00', 0.05, 0.28)) t(version, effective_ts, approve_lt, reject_ge)),
r AS (SELECT version, effective_ts, approve_lt, reject_ge, lead(effective_ts) OVER (ORDER BY effective_ts) AS to_ts FROM v),
d AS (SELECT s.*, r.version, CASE WHEN s.p < r.approve_lt THEN 'APPROVE' WHEN s.p < r.reject_ge THEN 'REVIEW' ELSE 'REJECT' END AS decision
      FROM s LEFT JOIN r ON s.ts >= r.effective_ts AND (r.to_ts IS NULL OR s.ts < r.to_ts))
SELECT version, decision, count(*) AS n FROM d GROUP BY version, decision""")
def q_join08(spark, sf):
    """JOIN-08: policy version in force at each decision time, then its zone cuts."""
    v = spark.createDataFrame([("v1.0", "1995-01-01 00:00:00", 0.06, 0.28), ("v1.1", "1998-01-01 00:00:00", 0.05, 0.28)],
                              "version string, effective_ts string, approve_lt double, reject_ge double") \
             .withColumn("effective_ts", F.to_timestamp("effective_ts").cast("timestamp_ntz"))
    d = jn.policy_asof(scored(spark, sf, with_group=False), v, "ts")
    dec = F.when(F.col("p") < F.col("approve_lt"), "APPROVE").when(F.col("p") < F.col("reject_ge"), "REVIEW").otherwise("REJECT")
    return d.groupBy("version", dec.alias("decision")).agg(F.count(F.lit(1)).alias("n"))


@register("join09_delayed_labels", f"""
WITH {S}, o AS (SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R'), e AS (SELECT max(l_shipdate) AS data_end FROM lineitem),
x AS (SELECT s.id, s.ts, (SELECT min(o.l_shipdate) FROM o WHERE o.l_orderkey = s.id AND o.l_shipdate >= s.ts) AS nxt FROM s)
SELECT id, CASE WHEN nxt IS NOT NULL AND nxt <= ts + INTERVAL 120 DAY THEN 1 WHEN ts + INTERVAL 120 DAY <= data_end THEN 0 END AS label,
  CAST(date_diff('day', CAST(ts AS DATE), CAST(nxt AS DATE)) AS INTEGER) AS days_to_outcome FROM x, e""")
def q_join09(spark, sf):
    """JOIN-09: delayed outcome join with a 120-day horizon; unresolved labels stay NULL."""
    s = scored(spark, sf, with_group=False).select("id", "ts")
    li = table(spark, sf, "lineitem")
    end = li.agg(F.max("l_shipdate")).first()[0]  # one bounded scalar
    o = li.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id"), "l_shipdate")
    d = jn.delayed_labels(s, o, "id", "ts", "l_shipdate", 120, str(end))
    return d.select("id", "label", F.datediff(F.col("next_outcome_ts").cast("date"), F.col("ts").cast("date")).alias("days_to_outcome"))


@register("join10_champion_challenger", f"""
WITH ms AS ({MODELS_SQL}), a AS (SELECT id, grp, CASE WHEN p < 0.2 THEN 'GREEN' WHEN p < 0.4 THEN 'AMBER' ELSE 'RED' END AS b FROM ms WHERE model = 'calibrated'),
b AS (SELECT id, CASE WHEN p < 0.2 THEN 'GREEN' WHEN p < 0.4 THEN 'AMBER' ELSE 'RED' END AS b FROM ms WHERE model = 'raw')
SELECT a.grp, count(*) AS n, round(avg(CAST(a.b = b.b AS INTEGER)), 6) AS agreement FROM a JOIN b USING (id) GROUP BY a.grp""")
def q_join10(spark, sf):
    """JOIN-10: champion vs challenger decision per row joined on id, agreement rate."""
    ms = model_scores(spark, sf)
    bnd = F.when(F.col("p") < 0.2, "GREEN").when(F.col("p") < 0.4, "AMBER").otherwise("RED")
    a = ms.where(F.col("model") == "calibrated").select("id", "grp", bnd.alias("ba"))
    b = ms.where(F.col("model") == "raw").select("id", bnd.alias("bb"))
    return a.join(b, "id").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("ba") == F.col("bb")).cast("int")), 6).alias("agreement"))


PARITY_COLS = ["acc_overdue_ratio", "acc_open_ratio", "composite"]


@register("join11_train_serve_parity", f"""
WITH a AS ({fe05_sql(0.0)}), b AS ({fe05_sql(1.0)}),
u AS (SELECT '{PARITY_COLS[0]}' AS feature, a.{PARITY_COLS[0]} AS va, b.{PARITY_COLS[0]} AS vb FROM a JOIN b USING (applicant_id)
  UNION ALL SELECT '{PARITY_COLS[1]}', a.{PARITY_COLS[1]}, b.{PARITY_COLS[1]} FROM a JOIN b USING (applicant_id)
  UNION ALL SELECT '{PARITY_COLS[2]}', a.{PARITY_COLS[2]}, b.{PARITY_COLS[2]} FROM a JOIN b USING (applicant_id))
SELECT feature, round(max(abs(va - vb)), 6) AS max_abs_diff,
  round(avg(CAST(coalesce(abs(va - vb) > 1e-6, false) OR ((va IS NULL) <> (vb IS NULL)) AS INTEGER)), 6) AS mismatch_rate FROM u GROUP BY feature""")
def q_join11(spark, sf):
    """JOIN-11: the same features computed two ways (mean-of-flag vs count/(n+1)), joined and diffed."""
    c, li, o = table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders")
    a = fx.applicant_features(c, li, o, fx.FactoryParams(ratio_smoothing=0.0))
    b = fx.applicant_features(c, li, o, fx.FactoryParams(ratio_smoothing=1.0))
    return jn.parity(a, b, "applicant_id", PARITY_COLS)


@register("join13_point_in_time", """
WITH f AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'), d AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')
SELECT d.event_id, d.user_id, (SELECT arg_max(f.value, (f.ts, f.value)) FROM f WHERE f.user_id = d.user_id AND f.ts <= d.ts) AS asof_value FROM d""")
def q_join13(spark, sf):
    """JOIN-13: latest 'view' value known at each 'purchase' (point-in-time, no theta join)."""
    e = table(spark, sf, "events")
    f = e.where(F.col("event_type") == "view").select("user_id", "ts", "value")
    d = e.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    return jn.asof_fill(f, d, "user_id", "ts", "value").select("event_id", "user_id", "asof_value")


@register("join14_blocklist", """
SELECT CASE WHEN c.c_custkey IS NULL THEN 0 ELSE 1 END AS blocked, count(*) AS n
FROM orders o LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal < 0) c ON c.c_custkey = o.o_custkey GROUP BY blocked""")
def q_join14(spark, sf):
    """JOIN-14: orders of blocklisted applicants (negative balance) flagged via a NULL-safe left join."""
    bl = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    j = jn.blocklist_flag(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), bl, "o_custkey")
    return j.groupBy("blocked").agg(F.count(F.lit(1)).alias("n"))


@register("win06_decile_table", f"""
WITH {S}, q AS (SELECT quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM s),
d AS (SELECT CAST(len(list_filter(e, lambda x: x < p)) AS INTEGER) + 1 AS decile, p, y FROM s, q)
SELECT decile, count(*) AS n, round(avg(p), 6) AS mean_pred, round(avg(y), 6) AS observed FROM d GROUP BY decile""")
def q_win06(spark, sf):
    """WIN-06/07: exact decile edges, decile column (p in (lo, hi]), observed vs predicted."""
    s = scored(spark, sf, with_group=False)
    e = exact_quantiles(s, "p", [i / 10 for i in range(1, 10)], name="e").withColumn("_k", F.lit(1))
    d = s.withColumn("_k", F.lit(1)).join(e, "_k").withColumn("decile", F.size(F.filter("e", lambda x: x < F.col("p"))) + 1)
    return d.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("mean_pred"), F.round(F.avg("y"), 6).alias("observed"))


@register("win08_sweep_optima", f"""
WITH sw AS ({SWEEP_SQL})
SELECT first(threshold ORDER BY expected_loss, threshold) AS min_loss_threshold, round(min(expected_loss), 6) AS min_loss,
  first(threshold ORDER BY youden_j DESC, threshold) AS max_youden_threshold, first(threshold ORDER BY f1 DESC, threshold) AS max_f1_threshold FROM sw""")
def q_win08(spark, sf):
    """WIN-08: argmin / argmax rows of the sweep, first (lowest threshold) on ties."""
    sw = mx.threshold_sweep(scored(spark, sf, with_group=False), "p", "y")
    return sw.agg(F.min_by("threshold", F.struct("expected_loss", "threshold")).alias("min_loss_threshold"),
                  F.round(F.min("expected_loss"), 6).alias("min_loss"),
                  F.min_by("threshold", F.struct(-F.col("youden_j"), F.col("threshold"))).alias("max_youden_threshold"),
                  F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("max_f1_threshold"))


MONTHLY_SQL = f"m AS (SELECT grp, strftime(date_trunc('month', ts), '%Y-%m') AS month, count(*) AS n, avg(y) AS rate FROM s GROUP BY grp, month)"


def monthly(spark, sf):
    s = scored(spark, sf)
    return s.groupBy("grp", F.date_format(F.col("ts"), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate"))


@register("win11_month_over_month", f"""
WITH {S}, {MONTHLY_SQL}
SELECT grp, month, round(rate, 6) AS rate, round(rate - lag(rate) OVER (PARTITION BY grp ORDER BY month), 6) AS change FROM m""")
def q_win11(spark, sf):
    """WIN-11: month-over-month change of the observed rate per segment (lag on the monthly pre-aggregate)."""
    w = Window.partitionBy("grp").orderBy("month")
    return monthly(spark, sf).select("grp", "month", F.round("rate", 6).alias("rate"), F.round(F.col("rate") - F.lag("rate").over(w), 6).alias("change"))


@register("win12_rolling_90d", f"""
WITH {S}, d AS (SELECT grp, CAST(ts AS DATE) AS day, count(*) AS n, sum(y) AS pos FROM s GROUP BY grp, day),
r AS (SELECT grp, day, sum(pos) OVER w AS pos90, sum(n) OVER w AS n90 FROM d
      WINDOW w AS (PARTITION BY grp ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW))
SELECT grp, strftime(day, '%Y-%m-%d') AS day, CAST(n90 AS BIGINT) AS n90, round(pos90 / n90, 6) AS rate90 FROM r""")
def q_win12(spark, sf):
    """WIN-12: rolling 90-day observed rate from a daily pre-aggregate (range frame on day numbers)."""
    s = scored(spark, sf)
    d = s.groupBy("grp", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    dn = F.datediff(F.col("day"), F.to_date(F.lit("1970-01-01")))
    w = Window.partitionBy("grp").orderBy(dn).rangeBetween(-89, 0)
    r = d.select("grp", "day", F.sum("pos").over(w).alias("pos90"), F.sum("n").over(w).alias("n90"))
    return r.select("grp", F.date_format("day", "yyyy-MM-dd").alias("day"), "n90", F.round(F.col("pos90") / F.col("n90"), 6).alias("rate90"))


@register("win13_sustained_k", f"""
WITH {S}, {MONTHLY_SQL}, f AS (SELECT grp, month, CASE WHEN rate > 0.3 THEN 1 ELSE 0 END AS flag FROM m)
SELECT grp, month, flag, CASE WHEN count(*) OVER w = 3 THEN min(flag) OVER w ELSE 0 END AS sustained FROM f
WINDOW w AS (PARTITION BY grp ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def q_win13(spark, sf):
    """WIN-13: flag sustained for k = 3 consecutive periods (min over a 3-row frame)."""
    m = monthly(spark, sf).withColumn("flag", F.when(F.col("rate") > 0.3, 1).otherwise(0))
    w = Window.partitionBy("grp").orderBy("month").rowsBetween(-2, 0)
    return m.select("grp", "month", "flag", F.when(F.count(F.lit(1)).over(w) == 3, F.min("flag").over(w)).otherwise(0).alias("sustained"))


@register("win14_reviewer_concentration", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY user_id, day),
t AS (SELECT day, sum(n) AS tn FROM d GROUP BY day),
r AS (SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS n30 FROM d),
tt AS (SELECT day, sum(tn) OVER (ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS t30 FROM t)
SELECT user_id, strftime(r.day, '%Y-%m-%d') AS day, round(n30 / t30, 6) AS share30, CAST(n30 / t30 > 0.4 AS INTEGER) AS concentrated FROM r JOIN tt USING (day)""")
def q_win14(spark, sf):
    """WIN-14: each reviewer's share of decisions in a trailing 30-day window (> 40 % flagged)."""
    e = table(spark, sf, "events")
    d = e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    dn = F.datediff(F.col("day"), F.to_date(F.lit("1970-01-01")))
    r = d.select("user_id", "day", F.sum("n").over(Window.partitionBy("user_id").orderBy(dn).rangeBetween(-29, 0)).alias("n30"))
    t = d.groupBy("day").agg(F.sum("n").alias("tn"))
    tt = t.select("day", F.sum("tn").over(Window.partitionBy(F.lit(1)).orderBy(dn).rangeBetween(-29, 0)).alias("t30"))  # one row per calendar day
    j = r.join(tt, "day")
    share = F.col("n30") / F.col("t30")
    return j.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round(share, 6).alias("share30"), (share > 0.4).cast("int").alias("concentrated"))
