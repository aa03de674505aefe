"""Queries of the full feature factory (AGG-02..06, FE-05) and its variants."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from riskspark.operators import factory as fy
from riskspark.plans.catalog import register
from riskspark.sources.io import table

AS_OF = "2002-01-01"
PLACES = {"inst_shortfall_mean": 9}


def rounded(df):
    """Doubles to six decimals, as in the oracle texts; nine where means of cents end on a half in the seventh."""
    return df.select(*[F.round(c, PLACES.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def day(c: str) -> str:
    return f"date_diff('day', DATE '{AS_OF}', CAST({c} AS DATE))"


def gr(a: str, b: str) -> str:
    return f"CASE WHEN {b} + 1 = 0 THEN NULL ELSE {a} / ({b} + 1) END"


def fl(p: str) -> str:
    return f"CASE WHEN {p} THEN 1 ELSE 0 END"


ACC_SQL = f"""
m AS (SELECT l_orderkey, count(*) AS bb_n, avg({fl("l_returnflag = 'R'")}) AS bb_dpd, count(*) FILTER (WHERE l_returnflag = 'R') AS bb_past_due,
  sum(l_extendedprice) AS goods, avg(l_discount) AS rate_down, avg(l_tax) AS rate_interest,
  sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0.0 END) AS debt, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END) AS overdue_amt,
  max({day('l_shipdate')}) AS last_due, min({day('l_shipdate')}) AS first_due FROM lineitem GROUP BY l_orderkey),
a AS (SELECT o_custkey AS applicant_id, o_orderstatus, o_orderpriority, o_totalprice AS amt, {day('o_orderdate')} AS days, m.*,
  {gr('o_totalprice', 'goods')} AS credit_ratio, o_totalprice * rate_down AS down FROM orders LEFT JOIN m ON m.l_orderkey = orders.o_orderkey)"""

BUREAU = f"""count(*) AS acc_n, count(*) FILTER (WHERE o_orderstatus = 'O') AS acc_active_n, count(*) FILTER (WHERE o_orderstatus = 'F') AS acc_closed_n,
  count(*) FILTER (WHERE bb_dpd > 0) AS acc_overdue_n, avg(days) AS acc_days_mean, CAST(max(days) AS INTEGER) AS acc_days_max, avg(last_due) AS acc_end_days_mean,
  CAST(sum(CAST(amt AS DECIMAL(28, 8))) AS DOUBLE) / count(amt) AS acc_amt_mean, max(amt) AS acc_amt_max, CAST(sum(CAST(debt AS DECIMAL(28, 8))) AS DOUBLE) / count(debt) AS acc_debt_mean, CAST(sum(CAST(overdue_amt AS DECIMAL(28, 8))) AS DOUBLE) / count(overdue_amt) AS acc_overdue_amt_mean,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS acc_type1_n, count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS acc_type2_n,
  count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS acc_type3_n, avg(bb_n) AS acc_months_mean, CAST(sum(CAST(bb_dpd AS DECIMAL(28, 8))) AS DOUBLE) / count(bb_dpd) AS acc_dpd_mean,
  max(bb_dpd) AS acc_dpd_max, CAST(sum(bb_past_due) AS BIGINT) AS acc_past_due_sum"""
PREVIOUS = """count(*) AS prev_n, count(*) FILTER (WHERE o_orderstatus = 'F') AS prev_approved_n, count(*) FILTER (WHERE o_orderstatus = 'P') AS prev_refused_n,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS prev_cancelled_n, CAST(sum(CAST(amt AS DECIMAL(28, 8))) AS DOUBLE) / count(amt) AS prev_amt_mean, max(amt) AS prev_amt_max, CAST(sum(CAST(goods AS DECIMAL(28, 8))) AS DOUBLE) / count(goods) AS prev_asked_mean,
  CAST(sum(CAST(credit_ratio AS DECIMAL(28, 8))) AS DOUBLE) / count(credit_ratio) AS prev_credit_ratio_mean, avg(days) AS prev_days_mean, CAST(min(days) AS INTEGER) AS prev_days_min, CAST(sum(CAST(down AS DECIMAL(28, 8))) AS DOUBLE) / count(down) AS prev_down_mean,
  CAST(sum(CAST(rate_down AS DECIMAL(28, 8))) AS DOUBLE) / count(rate_down) AS prev_rate_down_mean, CAST(sum(CAST(rate_interest AS DECIMAL(28, 8))) AS DOUBLE) / count(rate_interest) AS prev_rate_interest_mean, avg(bb_n) AS prev_payments_mean,
  avg(first_due - last_due) AS prev_due_diff_mean"""


def bureau_ratios(s: float) -> str:
    return f"acc_active_n / (acc_n + {s}) AS acc_active_ratio, acc_overdue_n / (acc_n + {s}) AS acc_overdue_ratio, {gr('acc_debt_mean', 'acc_amt_mean')} AS acc_debt_to_amt"


def previous_ratios(s: float) -> str:
    return f"prev_approved_n / (prev_n + {s}) AS prev_approval_rate, prev_refused_n / (prev_n + {s}) AS prev_refusal_rate"


def inst_sql(late_days: int) -> str:
    late = fl(f"delay < {-late_days}")
    return f"""
i AS (SELECT o_custkey AS applicant_id, l_extendedprice AS due, l_extendedprice * (1.0 - l_discount) AS paid,
  date_diff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS delay FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
i2 AS (SELECT *, {gr('paid', 'due')} AS pr, due - paid AS sf FROM i),
inst AS (SELECT applicant_id, count(*) AS inst_n, avg(delay) AS inst_delay_mean, CAST(max(delay) AS INTEGER) AS inst_delay_max, stddev_samp(delay) AS inst_delay_std,
  CAST(sum(CAST(pr AS DECIMAL(28, 8))) AS DOUBLE) / count(pr) AS inst_paid_ratio_mean, min(pr) AS inst_paid_ratio_min, CAST(sum({late}) AS BIGINT) AS inst_late_n, avg({late}) AS inst_late_ratio,
  avg({fl('pr < 0.99')}) AS inst_underpaid_ratio, CAST(sum(CAST(sf AS DECIMAL(28, 8))) AS DOUBLE) / count(sf) AS inst_shortfall_mean, max(sf) AS inst_shortfall_max FROM i2 GROUP BY applicant_id)"""


BAL_SQL = f"""
e AS (SELECT user_id AS applicant_id, value AS balance, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type AS status, {day('ts')} AS age,
  CASE WHEN event_type = 'error' THEN hour(ts) ELSE 0 END AS dpd, CASE WHEN event_type = 'view' THEN value END AS atm,
  CASE WHEN event_type = 'click' THEN value END AS pos, CASE WHEN event_type = 'purchase' THEN value END AS payment FROM events),
b AS (SELECT *, k * 10.0 AS lim, {gr('balance', 'k * 10.0')} AS util, {gr('pos', 'k * 10.0')} AS draw, {gr('payment', 'k')} AS pay FROM e)"""
CARD = f"""count(*) AS cc_n, CAST(sum(CAST(balance AS DECIMAL(28, 8))) AS DOUBLE) / count(balance) AS cc_balance_mean, max(balance) AS cc_balance_max, CAST(sum(CAST(lim AS DECIMAL(28, 8))) AS DOUBLE) / count(lim) AS cc_limit_mean, CAST(sum(CAST(util AS DECIMAL(28, 8))) AS DOUBLE) / count(util) AS cc_util_mean,
  max(util) AS cc_util_max, CAST(sum(CAST(draw AS DECIMAL(28, 8))) AS DOUBLE) / count(draw) AS cc_draw_ratio_mean, CAST(sum(CAST(pay AS DECIMAL(28, 8))) AS DOUBLE) / count(pay) AS cc_payment_ratio_mean, CAST(sum({fl('dpd > 0')}) AS BIGINT) AS cc_dpd_n,
  avg({fl('dpd > 0')}) AS cc_dpd_ratio, CAST(sum(CAST(atm AS DECIMAL(28, 8))) AS DOUBLE) / count(atm) AS cc_atm_mean, CAST(sum(CAST(pos AS DECIMAL(28, 8))) AS DOUBLE) / count(pos) AS cc_pos_mean"""
POS = f"""count(*) AS pos_n, CAST(max(age) AS INTEGER) AS pos_age_max, CAST(sum(CAST(k AS DECIMAL(28, 8))) AS DOUBLE) / count(k) AS pos_inst_mean, CAST(sum(CAST(k / 2.0 AS DECIMAL(28, 8))) AS DOUBLE) / count(k / 2.0) AS pos_future_mean, CAST(sum({fl('dpd > 0')}) AS BIGINT) AS pos_dpd_n,
  avg({fl('dpd > 0')}) AS pos_dpd_ratio, avg({fl('dpd > 12')}) AS pos_dpd_def_ratio, avg(dpd) AS pos_dpd_mean, CAST(max(dpd) AS INTEGER) AS pos_dpd_max,
  avg({fl("status = 'purchase'")}) AS pos_complete_ratio"""


def names(part: str) -> list[str]:
    return [w.strip() for w in re.findall(r" AS ((?:acc|prev|inst|cc|pos)_[a-z0-9_]+)", part)]


def rnd(cols) -> str:
    """Doubles rounded; counts and whole days as they are."""
    whole = ("_n", "_sum", "_days_max", "_days_min", "_delay_max", "_age_max", "pos_dpd_max")
    return ", ".join(c if c.endswith(whole) else f"round({c}, {PLACES.get(c, 6)}) AS {c}" for c in cols)


def family_sql(ctes: str, source: str, aggs: str, ratios: str = "") -> str:
    inner = f"SELECT *{', ' + ratios if ratios else ''} FROM (SELECT applicant_id, {aggs} FROM {source} GROUP BY applicant_id)"
    return f"WITH {ctes} SELECT applicant_id, {rnd(names(aggs) + names(ratios))} FROM ({inner})"


@register("agg02_account_families", family_sql(ACC_SQL, "a", BUREAU, bureau_ratios(0.0)))
def q_agg02(spark, sf):
    """AGG-02: 18 account aggregates and 3 ratios per applicant."""
    acc = fy.account_rows(table(spark, sf, "orders"), table(spark, sf, "lineitem"), AS_OF)
    return rounded(acc.groupBy(fy.KEY).agg(*fy.bureau_aggregates()).withColumns(fy.bureau_ratios(fy.VARIANT_C)))


@register("agg03_previous_full", family_sql(ACC_SQL, "a", PREVIOUS, previous_ratios(1.0)))
def q_agg03(spark, sf):
    """AGG-03: 15 aggregates of previous applications and 2 smoothed ratios (variant A)."""
    acc = fy.account_rows(table(spark, sf, "orders"), table(spark, sf, "lineitem"), AS_OF)
    return rounded(acc.groupBy(fy.KEY).agg(*fy.previous_aggregates()).withColumns(fy.previous_ratios(fy.VARIANT_A)))


@register("agg04_instalments_full", f"WITH {inst_sql(1)} SELECT applicant_id, {rnd(names(inst_sql(1).split('inst AS')[1]))} FROM inst")
def q_agg04(spark, sf):
    """AGG-04: 11 instalment aggregates (variant A: late from the second day on)."""
    return rounded(fy.instalments(table(spark, sf, "lineitem"), table(spark, sf, "orders"), fy.VARIANT_A))


@register("agg05_card_balances", family_sql(BAL_SQL, "b", CARD))
def q_agg05(spark, sf):
    """AGG-05: 12 card-balance aggregates per applicant."""
    return rounded(fy.balance_rows(table(spark, sf, "events"), AS_OF).groupBy(fy.KEY).agg(*fy.card_aggregates()))


@register("agg06_pos_balances", family_sql(BAL_SQL, "b", POS))
def q_agg06(spark, sf):
    """AGG-06: 10 cash-balance aggregates per applicant."""
    return rounded(fy.balance_rows(table(spark, sf, "events"), AS_OF).groupBy(fy.KEY).agg(*fy.pos_aggregates()))


def factory_sql(v: fy.Variant) -> str:
    s = v.ratio_smoothing
    seg = "CASE WHEN segment IS NULL THEN -1 ELSE CAST((SELECT count(DISTINCT c_mktsegment) FROM customer x WHERE x.c_mktsegment < segment) AS INTEGER) END AS segment" if v.encode else "segment"
    cols = names(BUREAU) + names(PREVIOUS) + names(bureau_ratios(s)) + names(previous_ratios(s)) + names(inst_sql(0).split("inst AS")[1]) + names(CARD) + names(POS)
    return f"""
WITH {ACC_SQL}, {inst_sql(v.late_days)}, {BAL_SQL},
acc AS (SELECT *, {bureau_ratios(s)}, {previous_ratios(s)} FROM (SELECT applicant_id, {BUREAU}, {PREVIOUS} FROM a GROUP BY applicant_id)),
bal AS (SELECT applicant_id, {CARD}, {POS} FROM b GROUP BY applicant_id),
f AS (SELECT c_custkey AS applicant_id, c_acctbal AS income, c_mktsegment AS segment, {", ".join(cols)}
  FROM customer LEFT JOIN acc ON acc.applicant_id = c_custkey LEFT JOIN inst ON inst.applicant_id = c_custkey LEFT JOIN bal ON bal.applicant_id = c_custkey)
SELECT applicant_id, round(income, 6) AS income, {seg}, {rnd(cols)}, round({gr('acc_amt_mean', 'income')}, 6) AS credit_to_income,
  round({gr('acc_debt_mean', 'income')}, 6) AS debt_to_income, round(-prev_days_min / {v.year_days}, 6) AS history_years,
  round(coalesce(inst_late_ratio, 0) * 0.4 + coalesce(cc_dpd_ratio, 0) * 0.3 + coalesce(pos_dpd_ratio, 0) * 0.2 + coalesce(acc_overdue_ratio, 0) * 0.1, 6) AS behaviour_score FROM f"""


def factory(spark, sf, v):
    return fy.full_factory(*[table(spark, sf, t) for t in ("customer", "orders", "lineitem", "events")], AS_OF, v)


@register("fe05_full_factory", factory_sql(fy.VARIANT_C))
def q_full(spark, sf):
    """FE-05: all five child families on the applicants (variant C)."""
    return rounded(factory(spark, sf, fy.VARIANT_C))


@register("fe05_full_factory_a", factory_sql(fy.VARIANT_A))
def q_full_a(spark, sf):
    """FE-05 with variant A's switches: late_days, ratio_smoothing, year_days, encode."""
    return rounded(factory(spark, sf, fy.VARIANT_A))


FILLED = ["acc_amt_mean", "inst_delay_mean", "cc_util_mean", "pos_dpd_mean"]


@register("fe05_median_filled", f"""
WITH f AS ({factory_sql(fy.VARIANT_C)}), m AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in FILLED)} FROM f)
SELECT applicant_id, {", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in FILLED)} FROM f, m""")
def q_filled(spark, sf):
    """FE-05, last step: applicants without a family's rows get the exact medians."""
    f = rounded(factory(spark, sf, fy.VARIANT_C)).select(fy.KEY, *FILLED)
    return rounded(fy.fill_with_medians(f, FILLED))
