"""Queries for the feature factory stages (PRJ, AGG, JOIN, FE-05)."""

from __future__ import annotations

from riskspark.operators import features as fx
from riskspark.plans.catalog import register
from riskspark.sources.io import table

FE05_TEMPLATE = """
WITH m AS (
  SELECT l_orderkey AS account_id, count(*) AS m_n, sum(l_quantity) AS m_qty_sum,
         avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS m_past_due_mean,
         count(*) FILTER (WHERE l_returnflag = 'A') AS m_n_closed,
         count(*) FILTER (WHERE l_linestatus = 'O') AS m_n_open,
         avg(l_discount) AS m_disc_mean
  FROM lineitem GROUP BY l_orderkey
), acc AS (
  SELECT o.o_orderkey AS account_id, o.o_custkey AS applicant_id, o.o_orderstatus, o.o_totalprice,
         m.m_n, m.m_past_due_mean,
         CASE WHEN m.m_past_due_mean > 0 THEN 1 ELSE 0 END AS overdue,
         CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open
  FROM orders o LEFT JOIN m ON m.account_id = o.o_orderkey
), app AS (
  SELECT applicant_id, count(*) AS acc_n, CAST(sum(is_open) AS BIGINT) AS acc_open_n,
         sum(o_totalprice) AS acc_amt_sum, avg(o_totalprice) AS acc_amt_mean, max(o_totalprice) AS acc_amt_max,
         CAST(sum(overdue) AS BIGINT) AS acc_overdue_n, CAST(coalesce(sum(m_n), 0) AS BIGINT) AS acc_lines,
         avg(m_past_due_mean) AS acc_past_due_mean,
         sum(overdue) / (count(*) + SMOOTH) AS acc_overdue_ratio, sum(is_open) / (count(*) + SMOOTH) AS acc_open_ratio
  FROM acc GROUP BY applicant_id
), f AS (
  SELECT c.c_custkey AS applicant_id, c.c_acctbal, c.c_mktsegment, app.acc_n, app.acc_open_n, app.acc_amt_sum,
         app.acc_amt_mean, app.acc_amt_max, app.acc_overdue_n, app.acc_lines, app.acc_past_due_mean,
         app.acc_overdue_ratio, app.acc_open_ratio,
         CASE WHEN c.c_acctbal + 1 = 0 THEN NULL ELSE app.acc_amt_sum / (c.c_acctbal + 1) END AS amt_to_bal,
         CASE WHEN c.c_acctbal < 0 THEN 1.0 ELSE 0.0 END AS bal_neg
  FROM customer c LEFT JOIN app ON app.applicant_id = c.c_custkey
), g AS (
  SELECT *, coalesce(acc_overdue_ratio, 0) * 0.4 + coalesce(acc_past_due_mean, 0) * 0.3
            + coalesce(acc_open_ratio, 0) * 0.2 + coalesce(bal_neg, 0) * 0.1 AS composite
  FROM f
)
SELECT applicant_id, round(c_acctbal, 6) AS c_acctbal, c_mktsegment, acc_n, acc_open_n,
       round(acc_amt_sum, 6) AS acc_amt_sum, round(acc_amt_mean, 6) AS acc_amt_mean, round(acc_amt_max, 6) AS acc_amt_max,
       acc_overdue_n, acc_lines, round(acc_past_due_mean, 6) AS acc_past_due_mean,
       round(acc_overdue_ratio, 6) AS acc_overdue_ratio, round(acc_open_ratio, 6) AS acc_open_ratio,
       round(amt_to_bal, 6) AS amt_to_bal, round(bal_neg, 6) AS bal_neg, round(composite, 6) AS composite,
       CASE WHEN composite < 0.20 THEN 'GREEN' WHEN composite < 0.40 THEN 'AMBER' ELSE 'RED' END AS band
FROM g
"""




def fe05_sql(smoothing: float = 0.0) -> str:
    return FE05_TEMPLATE.replace("SMOOTH", repr(float(smoothing)))


FE05_SQL = fe05_sql(0.0)


@register("fe05_applicant_features", FE05_SQL)
def fe05(spark, sf):
    return fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders"))
