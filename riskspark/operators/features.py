"""Feature factory operators (AGG-01..20, JOIN-01..06, WIN-01/02, FE-05).

Aggregate-before-join everywhere: each child table is reduced to one row per
parent key by a ``groupBy`` (partial aggregation on the map side, so a hot key
costs one partial row per task, not one task), then left-joined to its parent.
Both join sides are hash-partitioned on the key by their own aggregation, so
the join adds no second shuffle of the aggregated side; AQE turns it into a
broadcast at run time when the aggregated side is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import flag, guarded_ratio, r6, weighted_composite


@dataclass(frozen=True)
class FactoryParams:
    """Variant switches between the three factory versions (C is the default).

    ratio_smoothing: 0 -> ratios are means of flags (C); 1 -> count/(n+1) (A/B).
    """

    ratio_smoothing: float = 0.0


def flag_ratio(count: Column, n: Column, smoothing: float) -> Column:
    if smoothing == 0:
        return F.try_divide(count.cast("double"), n.cast("double"))
    return count / (n + F.lit(smoothing))


def month_to_account(lineitem: DataFrame) -> DataFrame:
    """AGG-01: month rows -> one row per account (past-due = 'R', closed = 'A')."""
    return lineitem.groupBy(F.col("l_orderkey").alias("account_id")).agg(
        F.count(F.lit(1)).alias("m_n"),
        F.sum("l_quantity").alias("m_qty_sum"),
        F.avg(flag(F.col("l_returnflag") == "R")).alias("m_past_due_mean"),
        F.count_if(F.col("l_returnflag") == "A").alias("m_n_closed"),
        F.count_if(F.col("l_linestatus") == "O").alias("m_n_open"),
        F.avg("l_discount").alias("m_disc_mean"),
    )


def account_with_months(orders: DataFrame, month_agg: DataFrame) -> DataFrame:
    """JOIN-01: accounts left-joined to their month aggregate; account flags."""
    acc = orders.select(
        F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("applicant_id"),
        "o_orderstatus", "o_totalprice",
    )
    j = acc.join(month_agg, "account_id", "left")
    return j.withColumn("overdue", flag(F.col("m_past_due_mean") > 0)).withColumn(
        "is_open", flag(F.col("o_orderstatus") == "O")
    )


def account_to_applicant(acc: DataFrame, params: FactoryParams = FactoryParams()) -> DataFrame:
    """AGG-02: accounts -> one row per applicant, named aggregates + derived ratios."""
    g = acc.groupBy("applicant_id").agg(
        F.count(F.lit(1)).alias("acc_n"),
        F.sum("is_open").alias("acc_open_n"),
        F.sum("o_totalprice").alias("acc_amt_sum"),
        F.avg("o_totalprice").alias("acc_amt_mean"),
        F.max("o_totalprice").alias("acc_amt_max"),
        F.sum("overdue").alias("acc_overdue_n"),
        F.coalesce(F.sum("m_n"), F.lit(0)).alias("acc_lines"),
        F.avg("m_past_due_mean").alias("acc_past_due_mean"),
    )
    return g.withColumn("acc_overdue_ratio", flag_ratio(F.col("acc_overdue_n"), F.col("acc_n"), params.ratio_smoothing)) \
            .withColumn("acc_open_ratio", flag_ratio(F.col("acc_open_n"), F.col("acc_n"), params.ratio_smoothing))


# Composite weights of the risk composite (PRJ-11).
COMPOSITE_WEIGHTS = {"acc_overdue_ratio": 0.4, "acc_past_due_mean": 0.3, "acc_open_ratio": 0.2, "bal_neg": 0.1}


def applicant_features(customer: DataFrame, lineitem: DataFrame, orders: DataFrame,
                       params: FactoryParams = FactoryParams()) -> DataFrame:
    """FE-05 slice: month -> account -> applicant, ratios, composite and band.

    Row count equals ``customer`` (left joins onto the base grain).
    """
    m = month_to_account(lineitem.select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "l_discount"))
    acc = account_with_months(orders, m)
    app = account_to_applicant(acc, params)
    base = customer.select(F.col("c_custkey").alias("applicant_id"), "c_acctbal", "c_mktsegment")
    out = base.join(app, "applicant_id", "left")
    out = out.withColumn("amt_to_bal", guarded_ratio("acc_amt_sum", "c_acctbal")) \
             .withColumn("bal_neg", flag(F.col("c_acctbal") < 0).cast("double"))
    out = out.withColumn("composite", weighted_composite(COMPOSITE_WEIGHTS))
    out = out.withColumn(
        "band",
        F.when(F.col("composite") < 0.20, "GREEN").when(F.col("composite") < 0.40, "AMBER").otherwise("RED"),
    )
    dbl = [c for c, t in out.dtypes if t == "double"]
    return out.select(*[r6(c).alias(c) if c in dbl else F.col(c) for c in out.columns])


def distinct_levels(df: DataFrame, c: str, max_levels: int = 1000) -> list:
    """Sorted distinct levels of a categorical, for one-hot column generation.

    The result is bounded: if the column has more than ``max_levels`` levels
    this raises instead of pulling an unbounded set to the driver.
    """
    rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{c} has more than {max_levels} levels; use ml.feature.OneHotEncoder")
    return sorted(r[0] for r in rows)
