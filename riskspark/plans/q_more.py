"""Bootstrap, DeLong, decision rows, audit chain, spine and MI queries
(EVAL-13/14, WIN-16, POL-12/14/15, PRJ-19..23, DQ-05, LEAK-11)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import joins as jn
from riskspark.operators import metrics as mx
from riskspark.operators import policy as po
from riskspark.plans.catalog import register
from riskspark.plans.frames import LEAK_SQL, SCORED_SQL, leak_frame, scored
from riskspark.plans.q_prep import CONTRIB_SQL, scorecard_frame
from riskspark.sources.io import TABLES, table
from riskspark.operators.quantiles import exact_quantiles

S = f"s AS ({SCORED_SQL})"
CDF_LIT = "[" + ", ".join(repr(c) for c in mx.POISSON1_CDF) + "]"
B = 50


def pw_sql(key: str, b: str) -> str:
    return (f"CAST(len(list_filter({CDF_LIT}, lambda c: c <= CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':boot:' || CAST({b} AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0)) AS INTEGER)")


@register("eval13_bootstrap_auc", f"""
WITH {S}, rep AS (SELECT id, p, y, b, {pw_sql('id', 'b')} AS w FROM s, range(1, {B + 1}) t(b)),
d AS (SELECT b, p AS sc, sum(y * w) AS pos, sum((1 - y) * w) AS neg FROM rep WHERE w > 0 GROUP BY b, p),
c AS (SELECT b, pos, neg, sum(neg) OVER (PARTITION BY b ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
  sum(pos) OVER (PARTITION BY b) AS tp, sum(neg) OVER (PARTITION BY b) AS tn FROM d),
a AS (SELECT b, sum(pos * (cneg - neg + neg / 2.0)) / (max(tp) * max(tn)) AS auc FROM c GROUP BY b)
SELECT round(quantile_cont(auc, 0.025), 6) AS auc_lo, round(quantile_cont(auc, 0.5), 6) AS auc_mid, round(quantile_cont(auc, 0.975), 6) AS auc_hi,
  count(*) AS replicates FROM a""")
def q_eval13(spark, sf):
    """EVAL-13: Poisson-bootstrap 95 % interval of the AUC (50 replicates, deterministic weights)."""
    return mx.bootstrap_auc(scored(spark, sf, with_group=False), "id", "p", "y", B)


CHAL = "round(0.8 * p_raw + 0.2 * CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':chal'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0, 6)"


def place_sql(score: str, name: str) -> str:
    return f"""
d_{name} AS (SELECT {score} AS sc, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY sc),
c_{name} AS (SELECT sc, (sum(neg) OVER w - neg + neg / 2.0) / sum(neg) OVER () AS v10,
  (sum(pos) OVER () - sum(pos) OVER w + pos / 2.0) / sum(pos) OVER () AS v01 FROM d_{name}
  WINDOW w AS (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
v_{name} AS (SELECT t.id, t.y, CASE WHEN t.y = 1 THEN v10 ELSE v01 END AS v FROM t JOIN c_{name} ON c_{name}.sc = t.{score})"""


ERFC = ("(1.0 / (1.0 + 0.3275911 * x)) * (0.254829592 + (1.0 / (1.0 + 0.3275911 * x)) * (-0.284496736 + (1.0 / (1.0 + 0.3275911 * x)) * "
        "(1.421413741 + (1.0 / (1.0 + 0.3275911 * x)) * (-1.453152027 + (1.0 / (1.0 + 0.3275911 * x)) * 1.061405429)))) * exp(-x * x)")


@register("eval14_delong", f"""
WITH {S}, t AS (SELECT id, y, p_raw, {CHAL} AS p_chal FROM s), {place_sql('p_raw', 'a')}, {place_sql('p_chal', 'b')},
j AS (SELECT v_a.y, v_a.v AS va, v_b.v AS vb FROM v_a JOIN v_b USING (id)),
g AS (SELECT y, count(*) AS n, avg(va) AS ma, avg(vb) AS mb, var_samp(va) AS saa, var_samp(vb) AS sbb, covar_samp(va, vb) AS sab FROM j GROUP BY y),
r AS (SELECT p.ma, p.mb, (p.saa + p.sbb - 2 * p.sab) / p.n + (q.saa + q.sbb - 2 * q.sab) / q.n AS var FROM g p, g q WHERE p.y = 1 AND q.y = 0),
z AS (SELECT ma, mb, (ma - mb) / sqrt(var) AS z FROM r), zx AS (SELECT *, abs(abs(z)) / sqrt(2.0) AS x FROM z)
SELECT round(ma, 6) AS auc_a, round(mb, 6) AS auc_b, round(z, 6) AS z, round(2 * ({ERFC}) / 2, 6) AS p_value FROM zx""")
def q_eval14(spark, sf):
    """EVAL-14: DeLong test between the raw score and a noisier challenger on the same rows."""
    s = scored(spark, sf, with_group=False).withColumn(
        "p_chal", F.round(F.lit(0.8) * F.col("p_raw") + F.lit(0.2) * X.stable_unit("id", ":chal"), 6))
    return mx.delong(s, "id", "p_raw", "p_chal")


@register("win16_bootstrap_topk_stability", CONTRIB_SQL + f""",
rep AS (SELECT u.*, b, {pw_sql('applicant_id', 'b')} AS w FROM u, range(1, 31) t(b)),
m AS (SELECT b, feature, sum(w * abs(contrib)) / sum(w) AS m FROM rep WHERE w > 0 GROUP BY b, feature),
r AS (SELECT b, feature, row_number() OVER (PARTITION BY b ORDER BY m DESC, feature) AS rk FROM m)
SELECT feature, round(avg(CAST(rk <= 2 AS INTEGER)), 6) AS top2_presence FROM r GROUP BY feature""")
def q_win16(spark, sf):
    """WIN-16: presence rate of each feature in the top 2 by mean |contribution| over 30 bootstrap replicates."""
    m = mx.bootstrap_means(scorecard_frame(spark, sf), "applicant_id", F.transform("contribs", lambda c: F.struct(c["feature"].alias("feature"), F.abs(c["contrib"]).alias("v"))), 30)
    r = m.withColumn("rk", F.row_number().over(Window.partitionBy("b").orderBy(F.col("m").desc(), "feature")))  # features-sized per replicate
    return r.groupBy("feature").agg(F.round(F.avg((F.col("rk") <= 2).cast("int")), 6).alias("top2_presence"))


VERSIONS_SQL = """v AS (SELECT * FROM (VALUES ('v1.0', TIMESTAMP '1995-01-01 00:00:00', 0.06, 0.28), ('v1.1', TIMESTAMP '1998-01-01 00:00:00', 0.05, 0.28)) t(version, effective_ts, approve_lt, reject_ge)),
r AS (SELECT version, effective_ts, approve_lt, reject_ge, lead(effective_ts) OVER (ORDER BY effective_ts) AS to_ts FROM v)"""


def versions(spark):
    return spark.createDataFrame([("v1.0", "1995-01-01 00:00:00", 0.06, 0.28), ("v1.1", "1998-01-01 00:00:00", 0.05, 0.28)],
                                 "version string, effective_ts string, approve_lt double, reject_ge double") \
                .withColumn("effective_ts", F.to_timestamp("effective_ts").cast("timestamp_ntz"))


@register("pol12_approval_decomposition", f"""
WITH {S}, {VERSIONS_SQL},
d AS (SELECT year(s.ts) AS period, CAST(s.p < r.approve_lt AS INTEGER) AS appr, CAST(s.p < 0.06 AS INTEGER) AS appr_cf
      FROM s LEFT JOIN r ON s.ts >= r.effective_ts AND (r.to_ts IS NULL OR s.ts < r.to_ts)),
a AS (SELECT period, avg(appr) AS actual, avg(appr_cf) AS cf FROM d GROUP BY period)
SELECT CAST(period AS INTEGER) AS period, round(actual, 6) AS approval_actual, round(cf, 6) AS approval_counterfactual,
  round(actual - cf, 6) AS policy_effect, round(cf - first_value(cf) OVER (ORDER BY period), 6) AS model_effect FROM a""")
def q_pol12(spark, sf):
    """POL-12: approval change split into policy effect (version in force vs v1.0 cuts) and model/population effect."""
    d = jn.policy_asof(scored(spark, sf, with_group=False), versions(spark), "ts")
    a = d.groupBy(F.year("ts").cast("int").alias("period")).agg(
        F.avg((F.col("p") < F.col("approve_lt")).cast("int")).alias("actual"), F.avg((F.col("p") < 0.06).cast("int")).alias("cf"))
    w = Window.partitionBy(F.lit(1)).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # period-sized table
    return a.select("period", F.round("actual", 6).alias("approval_actual"), F.round("cf", 6).alias("approval_counterfactual"),
                    F.round(F.col("actual") - F.col("cf"), 6).alias("policy_effect"),
                    F.round(F.col("cf") - F.first("cf").over(w), 6).alias("model_effect"))


# The ordered rules (name, Spark predicate, SQL predicate); the last one only forces review.
RULES = [("R1_NO_INCOME", lambda: F.col("c_acctbal") <= 0, "c_acctbal <= 0"),
         ("R2_AFFORDABILITY", lambda: F.col("foir") > 60, "foir > 60"),
         ("R3_DELINQUENCY", lambda: F.col("n_pd") > 2, "n_pd > 2"),
         ("R4_LOAN_TO_VALUE", lambda: F.col("ltv") > 6, "ltv > 6"),
         ("R5_EXPOSURE", lambda: F.col("o_totalprice") > 450000, "o_totalprice > 450000"),
         ("R6_MANUAL_REVIEW", lambda: F.col("o_orderpriority") == "1-URGENT", "o_orderpriority = '1-URGENT'")]
FLAGS = {"R1_NO_INCOME": "income", "R2_AFFORDABILITY": "foir", "R3_DELINQUENCY": "delinquency", "R4_LOAN_TO_VALUE": "ltv",
         "R5_EXPOSURE": "exposure", "R6_MANUAL_REVIEW": "review"}
# Adverse-action scorecard (code, weight, input, reference point).
ADVERSE = [("AFFORDABILITY", 0.02, "foir", 20.0), ("DELINQUENCY", 0.4, "n_pd", 1.0), ("EXPOSURE", 0.000004, "o_totalprice", 150000.0), ("LOAN_TO_VALUE", 0.1, "ltv", 1.5)]
ADVERSE_SQL = ", ".join(f"{{'neg': -round({w} * ({c} - {m}), 6), 'code': '{n}'}}" for n, w, c, m in ADVERSE)

DEC_SQL = f"""
WITH {S}, {VERSIONS_SQL},
cust AS (SELECT c_custkey, c_acctbal FROM customer),
tot AS (SELECT o_custkey, sum(o_totalprice) AS amt_sum FROM orders GROUP BY o_custkey),
pd AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n_pd, sum(l_extendedprice) AS goods FROM lineitem GROUP BY l_orderkey),
x AS (SELECT s.id, s.p, {CHAL} AS p_chal, s.ts, s.o_orderpriority, o.o_totalprice, c.c_acctbal, tot.amt_sum, coalesce(pd.n_pd, 0) AS n_pd,
        CASE WHEN pd.goods > 0 THEN o.o_totalprice / pd.goods END AS ltv, r.version, r.approve_lt, r.reject_ge,
        CASE WHEN c.c_acctbal = 0 THEN NULL ELSE ((tot.amt_sum - o.o_totalprice) / 120.0 + o.o_totalprice / 36.0) / c.c_acctbal END AS foir
      FROM s JOIN orders o ON o.o_orderkey = s.id LEFT JOIN cust c ON c.c_custkey = s.entity LEFT JOIN tot ON tot.o_custkey = s.entity
      LEFT JOIN pd ON pd.l_orderkey = s.id LEFT JOIN r ON s.ts >= r.effective_ts AND (r.to_ts IS NULL OR s.ts < r.to_ts)),
y AS (SELECT *, CASE {" ".join(f"WHEN coalesce({q}, false) THEN '{n}'" for n, _, q in RULES)} END AS reason FROM x),
z AS (SELECT *, coalesce(reason <> 'R6_MANUAL_REVIEW', false) AS hard_reject, CASE WHEN reason IS NOT NULL AND reason <> 'R6_MANUAL_REVIEW' THEN 'HARD_REJECT'
        WHEN p IS NULL THEN CASE WHEN o_totalprice >= 50000 AND n_pd = 0 THEN 'APPROVE' ELSE 'REVIEW' END
        WHEN p < approve_lt AND reason IS NULL THEN 'APPROVE' WHEN p < reject_ge THEN 'REVIEW' ELSE 'REJECT' END AS decision FROM y),
full_rows AS (SELECT id, round(foir, 6) AS foir, 'DERIVED' AS obligations_source,
  {", ".join(f"CAST(coalesce({q}, false) AS INTEGER) AS rule_{FLAGS[n]}" for n, _, q in RULES)},
  CAST(hard_reject AS INTEGER) AS hard_reject, CASE WHEN hard_reject THEN reason END AS hard_reject_reason, reason,
  CASE WHEN NOT hard_reject THEN p END AS pd_champion, CASE WHEN NOT hard_reject THEN p_chal END AS pd_challenger, decision, version,
  CASE WHEN decision IN ('REVIEW', 'REJECT') THEN list_sort(list_filter([{ADVERSE_SQL}], lambda x: x.neg < 0)) END AS adv,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS decision_timestamp, printf('B%02d', date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 30) AS batch_id,
  CAST(ts AS DATE) AS day, o_totalprice, n_pd, amt_sum, c_acctbal, round(ltv, 6) AS ltv, p FROM z)"""


def decision_rows(spark, sf):
    """The decision rows of the contract, with the inputs the audit log hashes."""
    s = scored(spark, sf, with_group=False).withColumn("p_chal", F.round(F.lit(0.8) * F.col("p_raw") + F.lit(0.2) * X.stable_unit("id", ":chal"), 6))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), "c_acctbal")
    tot = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(F.sum("o_totalprice").alias("amt_sum"))
    pd_ = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count_if(F.col("l_returnflag") == "R").alias("n_pd"), F.sum("l_extendedprice").alias("goods"))
    x = s.join(o, "id").join(c, "entity", "left").join(tot, "entity", "left").join(pd_, "id", "left").fillna(0, ["n_pd"])
    x = jn.policy_asof(x, versions(spark), "ts")
    obligations = (F.col("amt_sum") - F.col("o_totalprice")) / 120.0
    x = x.withColumn("foir", X.foir(obligations, F.col("o_totalprice") / 36.0, "c_acctbal")) \
         .withColumn("ltv", F.when(F.col("goods") > 0, F.col("o_totalprice") / F.col("goods")))
    x = x.withColumn("reason", X.first_hit([(n, rule()) for n, rule, _ in RULES]))
    hard = F.coalesce(F.col("reason") != RULES[-1][0], F.lit(False))
    fallback = F.when((F.col("o_totalprice") >= 50000) & (F.col("n_pd") == 0), "APPROVE").otherwise("REVIEW")
    dec = F.when(hard, "HARD_REJECT").when(F.col("p").isNull(), fallback) \
           .when((F.col("p") < F.col("approve_lt")) & F.col("reason").isNull(), "APPROVE") \
           .when(F.col("p") < F.col("reject_ge"), "REVIEW").otherwise("REJECT")
    x = x.withColumn("decision", dec)
    adverse = F.array(*[F.struct((-F.round(F.lit(w) * (F.col(c) - F.lit(m)), 6)).alias("neg"), F.lit(n).alias("code")) for n, w, c, m in ADVERSE])
    adverse = F.when(F.col("decision").isin("REVIEW", "REJECT"), F.sort_array(F.filter(adverse, lambda a: a["neg"] < 0)))
    batch = F.pmod(F.datediff(F.col("ts").cast("date"), F.to_date(F.lit("1970-01-01"))), F.lit(30))
    return x.select(
        "id", F.round("foir", 6).alias("foir"), F.lit("DERIVED").alias("obligations_source"),
        *[X.flag(rule()).alias(f"rule_{FLAGS[n]}") for n, rule, _ in RULES],
        hard.cast("int").alias("hard_reject"), F.when(hard, F.col("reason")).alias("hard_reject_reason"), "reason",
        F.when(~hard, F.col("p")).alias("pd_champion"), F.when(~hard, F.col("p_chal")).alias("pd_challenger"), "decision", "version",
        adverse.alias("adv"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("decision_timestamp"),
        F.format_string("B%02d", batch).alias("batch_id"), F.col("ts").cast("date").alias("day"),
        "o_totalprice", "n_pd", "amt_sum", "c_acctbal", F.round("ltv", 6).alias("ltv"), "p")


CONTRACT = ["id", "foir", "obligations_source", *[f"rule_{f}" for f in FLAGS.values()], "hard_reject", "hard_reject_reason",
            "pd_champion", "pd_challenger", "decision", "version"]


@register("pol14_decision_rows", DEC_SQL + f"""
SELECT {", ".join(CONTRACT)}, reason, decision_timestamp, batch_id,
  {", ".join(f"adv[{i}].code AS adverse_code_{i}, -adv[{i}].neg AS adverse_value_{i}" for i in (1, 2, 3))},
  round(CASE WHEN amt_sum > 0 THEN o_totalprice / amt_sum END, 6) AS utilisation,
  round(CASE WHEN c_acctbal > 0 THEN o_totalprice / c_acctbal END, 6) AS pay_to_balance,
  array_to_string(list_filter([CASE WHEN coalesce(p >= 0.35, false) THEN 'senior_review' END,
                               CASE WHEN coalesce(n_pd > 3, false) THEN 'collections' END,
                               CASE WHEN coalesce(foir > 40, false) THEN 'affordability_desk' END], lambda x: x IS NOT NULL), ',') AS escalations
FROM full_rows""")
def q_pol14(spark, sf):
    """POL-14 + PRJ-19..23 + JOIN-08: the decision row of the contract (affordability ratio, six ordered rule
    flags, the first hit as reason, the last rule forcing review only, scores, version in force, three adverse
    codes with their contributions, timestamp, batch) with reviewer ratios (PRJ-21) and escalations (PRJ-22)."""
    d = decision_rows(spark, sf)
    esc = X.hits([("senior_review", F.col("p") >= 0.35), ("collections", F.col("n_pd") > 3),
                  ("affordability_desk", F.col("foir") > 40)])
    adverse = [x for i in (1, 2, 3) for x in (F.get("adv", F.lit(i - 1))["code"].alias(f"adverse_code_{i}"), (-F.get("adv", F.lit(i - 1))["neg"]).alias(f"adverse_value_{i}"))]
    return d.select(*CONTRACT, "reason", "decision_timestamp", "batch_id", *adverse,
                    F.round(F.when(F.col("amt_sum") > 0, F.col("o_totalprice") / F.col("amt_sum")), 6).alias("utilisation"),
                    F.round(F.when(F.col("c_acctbal") > 0, F.col("o_totalprice") / F.col("c_acctbal")), 6).alias("pay_to_balance"),
                    F.array_join(esc, ",").alias("escalations"))


def num_sql(c: str, fmt: str = "%.6f") -> str:
    return f"coalesce(printf('{fmt}', {c}), '')"


AUDIT_SQL = DEC_SQL + f""",
h AS (SELECT id, day, decision,
  sha256(concat_ws('|', CAST(id AS VARCHAR), batch_id, {num_sql('foir')}, CAST(n_pd AS VARCHAR), {num_sql('o_totalprice', '%.2f')}, {num_sql('ltv')})) AS input_hash,
  sha256(concat_ws('|', decision, {num_sql('pd_champion')}, decision_timestamp)) AS output_hash FROM full_rows),
t AS (SELECT *, sha256(concat_ws('|', input_hash, output_hash)) AS tamper_check FROM h),
c AS (SELECT *, lag(tamper_check) OVER (PARTITION BY day ORDER BY id) AS prev FROM t)"""


def number(c: str, fmt: str = "%.6f"):
    return F.coalesce(F.when(F.col(c).isNotNull(), F.format_string(fmt, c)), F.lit(""))


def hashes(d):
    """input_hash, output_hash and tamper_check of rows that carry the logged fields."""
    inp = po.sha(F.col("id").cast("string"), F.col("batch_id"), number("foir"), F.col("n_pd").cast("string"), number("o_totalprice", "%.2f"), number("ltv"))
    out = po.sha(F.col("decision"), number("pd_champion"), F.col("decision_timestamp"))
    return inp, out, po.sha(inp, out)


def audit_log(spark, sf):
    """The decision rows with their hashes, not yet chained."""
    d = decision_rows(spark, sf)
    inp, out, tamper = hashes(d)
    return d.withColumn("input_hash", inp).withColumn("output_hash", out).withColumn("tamper_check", tamper)


@register("pol15_audit_hash_chain", AUDIT_SQL + """
SELECT id, strftime(day, '%Y-%m-%d') AS day, input_hash, output_hash, tamper_check, sha256(tamper_check || coalesce(prev, '')) AS chain_hash FROM c""")
def q_pol15(spark, sf):
    """POL-15: tamper-evident log: input, output and combined hash of each decision, and a chain hash that
    links it to its predecessor's combined hash inside its day."""
    log = audit_log(spark, sf).select("id", "day", "input_hash", "output_hash", "tamper_check")
    log = po.chain(log, {"tamper_check": "chain_hash"}, "day", "id")
    return log.select("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "input_hash", "output_hash", "tamper_check", "chain_hash")


@register("pol15_verify_log", AUDIT_SQL + """,
p AS (SELECT id, day, decision = 'REVIEW' AND substr(md5(CAST(id AS VARCHAR) || ':edit'), 1, 1) = '0' AS edited FROM full_rows),
b AS (SELECT day, edited, lag(edited) OVER (PARTITION BY day ORDER BY id) AS edited_before FROM p)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (WHERE edited) AS content_mismatches,
  count(*) FILTER (WHERE edited OR coalesce(edited_before, false)) AS chain_mismatches FROM b GROUP BY day""")
def q_pol15v(spark, sf):
    """POL-15 verifier: reviews of some ids are turned into approvals after logging; hashes made anew from
    the stored fields find each edited row, the chain finds it and its successor."""
    log = audit_log(spark, sf)
    edit = (F.col("decision") == "REVIEW") & (F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(":edit"))), 1, 1) == "0")
    stored = log.withColumn("decision", F.when(edit, "APPROVE").otherwise(F.col("decision")))
    _, _, tamper = hashes(stored)
    both = stored.select("id", "day", "tamper_check", tamper.alias("fresh"))
    v = po.chain(both, {"tamper_check": "stored_chain", "fresh": "chain_hash"}, "day", "id")
    return v.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fresh") != F.col("tamper_check")).alias("content_mismatches"),
        F.count_if(F.col("chain_hash") != F.col("stored_chain")).alias("chain_mismatches"))


@register("dq05_spine_validation", " UNION ALL ".join(
    f"SELECT 'table_present_{t}' AS \"check\", CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS result, CAST(count(*) AS VARCHAR) AS detail FROM {t}"
    for t in TABLES))
def q_dq05(spark, sf):
    """DQ-05: every driver table present and non-empty, with its row count (one job over all scans)."""
    parts = [table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"table_present_{t}").alias("check"), F.when(F.col("n") > 0, "PASS").otherwise("FAIL").alias("result"),
        F.col("n").cast("string").alias("detail")) for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("leak11_mutual_information", f"""
WITH l AS ({LEAK_SQL}), e AS (SELECT quantile_cont(p_raw, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM l),
u AS (SELECT 'p_raw' AS feature, CAST(len(list_filter(edges, lambda x: x < p_raw)) AS VARCHAR) AS v, y FROM l, e
      UNION ALL SELECT 'grp', grp, y FROM l UNION ALL SELECT 'nation', CAST(nation AS VARCHAR), y FROM l),
j AS (SELECT feature, v, y, count(*) AS n FROM u GROUP BY feature, v, y),
t AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS tot, sum(n) OVER (PARTITION BY feature, v) AS nv, sum(n) OVER (PARTITION BY feature, y) AS ny FROM j)
SELECT feature, round(sum(n / tot * ln(n * tot / (nv * ny))), 6) AS mutual_information FROM t GROUP BY feature""")
def q_leak11(spark, sf):
    """LEAK-11: binned mutual information of each feature with the target (one unpivot, one groupBy)."""
    lf = leak_frame(spark, sf)
    e = exact_quantiles(lf, "p_raw", [i / 10 for i in range(1, 10)], name="edges").withColumn("_k", F.lit(1))
    lf = lf.withColumn("_k", F.lit(1)).join(e, "_k").withColumn("p_bin", F.size(F.filter("edges", lambda x: x < F.col("p_raw"))).cast("string"))
    u = lf.select("y", F.explode(F.array(F.struct(F.lit("p_raw").alias("feature"), F.col("p_bin").alias("v")),
                                         F.struct(F.lit("grp").alias("feature"), F.col("grp").alias("v")),
                                         F.struct(F.lit("nation").alias("feature"), F.col("nation").cast("string").alias("v")))).alias("u")).select("y", "u.*")
    j = u.groupBy("feature", "v", "y").agg(F.count(F.lit(1)).alias("n"))
    t = j.withColumn("tot", F.sum("n").over(Window.partitionBy("feature"))).withColumn("nv", F.sum("n").over(Window.partitionBy("feature", "v"))) \
         .withColumn("ny", F.sum("n").over(Window.partitionBy("feature", "y")))
    return t.groupBy("feature").agg(F.round(F.sum(F.col("n") / F.col("tot") * F.log(F.col("n") * F.col("tot") / (F.col("nv") * F.col("ny")))), 6).alias("mutual_information"))


@register("leak11_walk_forward_folds", f"""
WITH {S}, y AS (SELECT year(ts) AS yr, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM s GROUP BY yr),
f AS (SELECT yr AS fold, n AS n_val, lo AS val_start,
        sum(n) OVER (ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_train,
        max(hi) OVER (ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS train_end FROM y)
SELECT CAST(fold AS INTEGER) AS fold, CAST(n_train AS BIGINT) AS n_train, n_val,
  CASE WHEN train_end < val_start THEN 'PASS' ELSE 'FAIL' END AS status FROM f WHERE n_train IS NOT NULL""")
def q_leak11wf(spark, sf):
    """LEAK-11 walk-forward validator: expanding-window folds by year; every training row must
    predate every validation row of its fold (per-year summary, window over the year table)."""
    s = scored(spark, sf, with_group=False)
    y = s.groupBy(F.year("ts").alias("yr")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    w = Window.partitionBy(F.lit(1)).orderBy("yr").rowsBetween(Window.unboundedPreceding, -1)  # one row per year
    f = y.select(F.col("yr").cast("int").alias("fold"), F.col("n").alias("n_val"), "lo",
                 F.sum("n").over(w).alias("n_train"), F.max("hi").over(w).alias("train_end"))
    return f.where(F.col("n_train").isNotNull()).select(
        "fold", F.col("n_train").cast("long").alias("n_train"), "n_val",
        F.when(F.col("train_end") < F.col("lo"), "PASS").otherwise("FAIL").alias("status"))
