"""The full feature factory (AGG-02..06, JOIN-02, FE-05): five child families on one applicant key.

Child families are lists of named aggregates, so families that come from the
same table share one ``groupBy`` (one shuffle, map-side combined):

* accounts and previous applications come from the account rows (orders with
  their month summary, which is one ``groupBy`` of the line items);
* instalments come from the line items, which reach their applicant through a
  join on the account key (hot accounts are split by AQE, since the next
  ``groupBy`` has an exchange of its own);
* card and cash balances come from the events.

Each family is then left-joined to the applicants on that key, so the row count
is the applicants'.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import flag, guarded_ratio, weighted_composite
from riskspark.operators.quantiles import exact_quantiles

KEY = "applicant_id"


@dataclass(frozen=True)
class Variant:
    """Switches between the factory variants.

    late_days: an instalment is late when paid more than this many days after it was due.
    ratio_smoothing: derived ratios are count / (n + smoothing); 0 gives plain means of flags.
    year_days: days of a year in ages.
    encode: True replaces the categorical by its rank in the sorted levels (unknown: -1).
    """

    late_days: int = 0
    ratio_smoothing: float = 0.0
    year_days: float = 365.25
    encode: bool = False


# The two variants, and the behaviour weights.
VARIANT_A = Variant(late_days=1, ratio_smoothing=1.0, year_days=365.0, encode=True)
VARIANT_C = Variant()
BEHAVIOUR = {"inst_late_ratio": 0.4, "cc_dpd_ratio": 0.3, "pos_dpd_ratio": 0.2, "acc_overdue_ratio": 0.1}


def ratio(count: Column, n: Column, smoothing: float) -> Column:
    return F.try_divide(count.cast("double"), n + F.lit(float(smoothing)))


def mean(c: str | Column) -> Column:
    """Mean of doubles summed as decimals of 8 places: the same whatever order the rows come in."""
    x = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(x.cast("decimal(28,8)")).cast("double"), F.count(x))


def account_rows(orders: DataFrame, lineitem: DataFrame, as_of: str) -> DataFrame:
    """AGG-01 + JOIN-01: one row per account with its months: past-due share, open and overdue
    amounts, dates as days before ``as_of`` (negative numbers)."""
    def day(c):
        return F.datediff(F.col(c).cast("date"), F.to_date(F.lit(as_of)))

    past_due = F.col("l_returnflag") == "R"
    m = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("bb_n"), F.avg(flag(past_due)).alias("bb_dpd"), F.count_if(past_due).alias("bb_past_due"),
        F.sum("l_extendedprice").alias("goods"), F.avg("l_discount").alias("rate_down"), F.avg("l_tax").alias("rate_interest"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).otherwise(0.0)).alias("debt"),
        F.sum(F.when(past_due, F.col("l_extendedprice")).otherwise(0.0)).alias("overdue_amt"),
        F.max(day("l_shipdate")).alias("last_due"), F.min(day("l_shipdate")).alias("first_due"))
    a = orders.join(m, "o_orderkey", "left").select(
        F.col("o_custkey").alias(KEY), "o_orderstatus", "o_orderpriority", F.col("o_totalprice").alias("amt"), day("o_orderdate").alias("days"),
        "bb_n", "bb_dpd", "bb_past_due", "goods", "rate_down", "rate_interest", "debt", "overdue_amt", "last_due", "first_due")
    return a.withColumn("credit_ratio", guarded_ratio("amt", "goods")).withColumn("down", F.col("amt") * F.col("rate_down"))


def bureau_aggregates() -> list[Column]:
    """AGG-02: 18 aggregates of the accounts."""
    c, count_if = F.col, F.count_if
    return [F.count(F.lit(1)).alias("acc_n"), count_if(c("o_orderstatus") == "O").alias("acc_active_n"),
            count_if(c("o_orderstatus") == "F").alias("acc_closed_n"), count_if(c("bb_dpd") > 0).alias("acc_overdue_n"),
            F.avg("days").alias("acc_days_mean"), F.max("days").alias("acc_days_max"), F.avg("last_due").alias("acc_end_days_mean"),
            mean("amt").alias("acc_amt_mean"), F.max("amt").alias("acc_amt_max"), mean("debt").alias("acc_debt_mean"),
            mean("overdue_amt").alias("acc_overdue_amt_mean"), count_if(c("o_orderpriority") == "1-URGENT").alias("acc_type1_n"),
            count_if(c("o_orderpriority") == "2-HIGH").alias("acc_type2_n"), count_if(c("o_orderpriority") == "3-MEDIUM").alias("acc_type3_n"),
            F.avg("bb_n").alias("acc_months_mean"), mean("bb_dpd").alias("acc_dpd_mean"), F.max("bb_dpd").alias("acc_dpd_max"),
            F.sum("bb_past_due").alias("acc_past_due_sum")]


def bureau_ratios(v: Variant) -> dict[str, Column]:
    return {"acc_active_ratio": ratio(F.col("acc_active_n"), F.col("acc_n"), v.ratio_smoothing),
            "acc_overdue_ratio": ratio(F.col("acc_overdue_n"), F.col("acc_n"), v.ratio_smoothing),
            "acc_debt_to_amt": guarded_ratio("acc_debt_mean", "acc_amt_mean")}


def previous_aggregates() -> list[Column]:
    """AGG-03: 15 aggregates of the previous applications (status F approved, P refused, O cancelled)."""
    st = F.col("o_orderstatus")
    return [F.count(F.lit(1)).alias("prev_n"), F.count_if(st == "F").alias("prev_approved_n"), F.count_if(st == "P").alias("prev_refused_n"),
            F.count_if(st == "O").alias("prev_cancelled_n"), mean("amt").alias("prev_amt_mean"), F.max("amt").alias("prev_amt_max"),
            mean("goods").alias("prev_asked_mean"), mean("credit_ratio").alias("prev_credit_ratio_mean"),
            F.avg("days").alias("prev_days_mean"), F.min("days").alias("prev_days_min"), mean("down").alias("prev_down_mean"),
            mean("rate_down").alias("prev_rate_down_mean"), mean("rate_interest").alias("prev_rate_interest_mean"),
            F.avg("bb_n").alias("prev_payments_mean"), F.avg(F.col("first_due") - F.col("last_due")).alias("prev_due_diff_mean")]


def previous_ratios(v: Variant) -> dict[str, Column]:
    return {"prev_approval_rate": ratio(F.col("prev_approved_n"), F.col("prev_n"), v.ratio_smoothing),
            "prev_refusal_rate": ratio(F.col("prev_refused_n"), F.col("prev_n"), v.ratio_smoothing)}


def instalments(lineitem: DataFrame, orders: DataFrame, v: Variant) -> DataFrame:
    """AGG-04: 11 aggregates per applicant; due date: the account's, payment date: the line's,
    payment: the line's price less its discount."""
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias(KEY), "o_orderdate")
    j = lineitem.select("l_orderkey", "l_extendedprice", "l_discount", "l_shipdate").join(o, "l_orderkey")
    j = j.withColumn("delay", F.datediff(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date"))) \
         .withColumn("paid", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))) \
         .withColumn("paid_ratio", guarded_ratio("paid", "l_extendedprice")) \
         .withColumn("shortfall", F.col("l_extendedprice") - F.col("paid"))
    late = flag(F.col("delay") < -v.late_days)
    return j.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("inst_n"), F.avg("delay").alias("inst_delay_mean"), F.max("delay").alias("inst_delay_max"),
        F.stddev_samp("delay").alias("inst_delay_std"), mean("paid_ratio").alias("inst_paid_ratio_mean"),
        F.min("paid_ratio").alias("inst_paid_ratio_min"), F.sum(late).alias("inst_late_n"), F.avg(late).alias("inst_late_ratio"),
        F.avg(flag(F.col("paid_ratio") < 0.99)).alias("inst_underpaid_ratio"), mean("shortfall").alias("inst_shortfall_mean"),
        F.max("shortfall").alias("inst_shortfall_max"))


def balance_rows(events: DataFrame, as_of: str) -> DataFrame:
    """Balance rows of the applicants: amount, limit (10 k), draws, payments, days past due (the hour of an error event)."""
    k, v, et = F.get_json_object("props", "$.k").cast("double"), F.col("value"), F.col("event_type")
    e = events.select(F.col("user_id").alias(KEY), v.alias("balance"), (k * 10.0).alias("limit"), et.alias("status"), k.alias("k"),
                      F.datediff(F.col("ts").cast("date"), F.to_date(F.lit(as_of))).alias("age"),
                      F.when(et == "error", F.hour("ts")).otherwise(0).alias("dpd"),
                      F.when(et == "view", v).alias("atm"), F.when(et == "click", v).alias("pos"),
                      F.when(et == "purchase", v).alias("payment"))
    return e.withColumn("utilisation", guarded_ratio("balance", "limit")).withColumn("draw_ratio", guarded_ratio("pos", "limit")) \
            .withColumn("payment_ratio", guarded_ratio("payment", "k"))


def card_aggregates() -> list[Column]:
    """AGG-05: 12 aggregates of the card balances."""
    dpd = flag(F.col("dpd") > 0)
    return [F.count(F.lit(1)).alias("cc_n"), mean("balance").alias("cc_balance_mean"), F.max("balance").alias("cc_balance_max"),
            mean("limit").alias("cc_limit_mean"), mean("utilisation").alias("cc_util_mean"), F.max("utilisation").alias("cc_util_max"),
            mean("draw_ratio").alias("cc_draw_ratio_mean"), mean("payment_ratio").alias("cc_payment_ratio_mean"),
            F.sum(dpd).alias("cc_dpd_n"), F.avg(dpd).alias("cc_dpd_ratio"), mean("atm").alias("cc_atm_mean"), mean("pos").alias("cc_pos_mean")]


def pos_aggregates() -> list[Column]:
    """AGG-06: 10 aggregates of the cash balances, among them the share of a status."""
    dpd = flag(F.col("dpd") > 0)
    return [F.count(F.lit(1)).alias("pos_n"), F.max("age").alias("pos_age_max"), mean("k").alias("pos_inst_mean"),
            mean(F.col("k") / 2.0).alias("pos_future_mean"), F.sum(dpd).alias("pos_dpd_n"), F.avg(dpd).alias("pos_dpd_ratio"),
            F.avg(flag(F.col("dpd") > 12)).alias("pos_dpd_def_ratio"), F.avg("dpd").alias("pos_dpd_mean"), F.max("dpd").alias("pos_dpd_max"),
            F.avg(flag(F.col("status") == "purchase")).alias("pos_complete_ratio")]


def full_factory(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, events: DataFrame, as_of: str, v: Variant = VARIANT_C) -> DataFrame:
    """FE-05: the applicants with all five families, cross-family features, ages in years and the
    behaviour score.  Applicants without rows of a family keep nulls (``fill_with_medians`` fills them)."""
    acc = account_rows(orders, lineitem, as_of).groupBy(KEY).agg(*bureau_aggregates(), *previous_aggregates())
    acc = acc.withColumns(bureau_ratios(v)).withColumns(previous_ratios(v))
    bal = balance_rows(events, as_of).groupBy(KEY).agg(*card_aggregates(), *pos_aggregates())
    base = customer.select(F.col("c_custkey").alias(KEY), F.col("c_acctbal").alias("income"), F.col("c_mktsegment").alias("segment"))
    out = base.join(acc, KEY, "left").join(instalments(lineitem, orders, v), KEY, "left").join(bal, KEY, "left")
    out = out.withColumn("credit_to_income", guarded_ratio("acc_amt_mean", "income")).withColumn("debt_to_income", guarded_ratio("acc_debt_mean", "income")) \
             .withColumn("history_years", -F.col("prev_days_min") / F.lit(v.year_days)).withColumn("behaviour_score", weighted_composite(BEHAVIOUR))
    if v.encode:
        # one sorted array of the distinct levels: as many entries as the categorical has values
        levels = customer.agg(F.sort_array(F.collect_set("c_mktsegment"))).scalar()
        rank = F.nullif(F.array_position(levels, F.col("segment")), F.lit(0)) - 1
        out = out.withColumn("segment", F.coalesce(rank, F.lit(-1)).cast("int"))
    return out


def fill_with_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls of ``cols`` become the column's exact median (one unpivot, one bucketed count for all columns)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("u")).select("u.*")
    med = exact_quantiles(long, "v", [0.5], ["feature"], "_m")
    row = med.agg(*[F.max(F.when(F.col("feature") == c, F.col("_m")[0])).alias(f"_med_{c}") for c in cols])  # one row
    return df.join(row).select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])
