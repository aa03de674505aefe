"""Projection, aggregation, join and window queries (PRJ, AGG, JOIN, WIN)."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import features as fx
from riskspark.operators import split as sp
from riskspark.plans.catalog import register
from riskspark.plans.frames import BATCHES_SQL, SCORED_SQL, daily_batches, scored, split_unit_sql
from riskspark.sources.io import table
from riskspark.operators import prep as pp
from riskspark.operators.quantiles import exact_quantiles

S = f"s AS ({SCORED_SQL})"


def li_nulls(spark, sf):
    """lineitem with realistic missing columns (zero discount / tax -> NULL)."""
    li = table(spark, sf, "lineitem")
    return li.withColumn("disc_n", F.nullif("l_discount", F.lit(0.0))).withColumn("tax_n", F.nullif("l_tax", F.lit(0.0)))


LIN = "li AS (SELECT *, nullif(l_discount, 0.0) AS disc_n, nullif(l_tax, 0.0) AS tax_n FROM lineitem)"


@register("prj01_13_row_features", f"""
WITH {LIN}, a AS (SELECT *, [disc_n, tax_n, l_quantity / 50.0] AS arr, list_filter([disc_n, tax_n, l_quantity / 50.0], lambda x: x IS NOT NULL) AS pr FROM li)
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity = 50.0 THEN 1 ELSE 0 END AS qty_sentinel, nullif(l_quantity, 50.0) AS qty_clean,
  round(CASE WHEN tax_n + 1.0 = 0 THEN NULL ELSE disc_n / (tax_n + 1.0) END, 6) AS disc_per_tax,
  round(-date_diff('day', DATE '2002-01-01', CAST(l_shipdate AS DATE)) / 365.25, 6) AS years_before,
  round(CASE WHEN len(pr) > 0 THEN list_sum(pr) / len(pr) END, 6) AS row_mean,
  round(coalesce(list_product(pr), 1.0), 6) AS row_product,
  round(CASE WHEN len(pr) >= 2 THEN sqrt(list_sum(list_transform(pr, lambda x: (x - list_sum(pr) / len(pr)) * (x - list_sum(pr) / len(pr)))) / (len(pr) - 1)) END, 6) AS row_std,
  CAST(len(pr) AS INTEGER) AS row_count,
  CAST(disc_n IS NULL AS INTEGER) AS disc_missing, CAST(disc_n IS NULL AS INTEGER) + CAST(tax_n IS NULL AS INTEGER) AS n_missing,
  coalesce(CAST(l_returnflag = 'R' AS INTEGER), 0) AS is_returned, coalesce(CAST(l_quantity > 25 AS INTEGER), 0) AS big_qty,
  coalesce(CAST(l_linestatus IN ('O') AS INTEGER), 0) AS is_open,
  round(coalesce(least(greatest(disc_n, 0.02), 0.08), 0.05), 6) AS disc_clip_fill,
  round(ln(1 + greatest(l_extendedprice / 1000.0 - 20.0, 0.0)), 6) AS log_excess
FROM a""")
def q_prj01(spark, sf):
    """PRJ-01..07, 12, 13 and FN-01/04/05: sentinel flag/null, guarded ratio,
    day->years, row-wise mean/product/std/count, missing flags, predicate flags,
    clip+fill, log1p of the positive part."""
    li = li_nulls(spark, sf)
    parts = ["disc_n", "tax_n", F.col("l_quantity") / 50.0]
    days = F.datediff(F.col("l_shipdate").cast("date"), F.to_date(F.lit("2002-01-01")))
    return li.select(
        "l_orderkey", "l_linenumber",
        X.sentinel_flag("l_quantity", 50.0).alias("qty_sentinel"), X.sentinel_to_null("l_quantity", 50.0).alias("qty_clean"),
        F.round(X.guarded_ratio("disc_n", "tax_n"), 6).alias("disc_per_tax"),
        F.round(X.days_to_years(days, 365.25), 6).alias("years_before"),
        F.round(X.row_mean(parts), 6).alias("row_mean"), F.round(X.row_product(parts), 6).alias("row_product"),
        F.round(X.row_std(parts), 6).alias("row_std"), X.row_count(parts).alias("row_count"),
        X.missing_flag("disc_n").alias("disc_missing"), X.missing_count(["disc_n", "tax_n"]).alias("n_missing"),
        X.flag(F.col("l_returnflag") == "R").alias("is_returned"), X.flag(F.col("l_quantity") > 25).alias("big_qty"),
        X.flag(F.col("l_linestatus").isin("O")).alias("is_open"),
        F.round(X.clip_fill("disc_n", 0.02, 0.08, 0.05), 6).alias("disc_clip_fill"),
        F.round(X.log1p_pos(F.col("l_extendedprice") / 1000.0 - 20.0), 6).alias("log_excess"))


def _safe(v: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", v).strip("_")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("prj08_one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS prio_{_safe(v)}" for v in PRIORITIES[1:]) + " FROM orders")
def q_prj08(spark, sf):
    """PRJ-08: one-hot with the first level dropped; levels are the (bounded) distinct values."""
    o = table(spark, sf, "orders")
    levels = fx.distinct_levels(o, "o_orderpriority")
    cols = [X.flag(F.col("o_orderpriority") == F.lit(v)).alias(f"prio_{_safe(v)}") for v in sorted(levels)[1:]]
    return o.select("o_orderkey", *cols)


@register("prj09_10_numeric_projection", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def q_prj09(spark, sf):
    """PRJ-09/10: drop ids (ignoring absent names) and keep numeric feature columns, chosen from the schema."""
    li = table(spark, sf, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "not_there")
    keep = [f.name for f in li.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long")]
    return li.select(*keep)


@register("prj15_four_band", f"""
WITH {S} SELECT CASE WHEN p < 0.05 THEN 'LOW' WHEN p < 0.1 THEN 'MEDIUM' WHEN p < 0.2 THEN 'HIGH' ELSE 'VERY_HIGH' END AS band,
  count(*) AS n, round(avg(y), 6) AS rate FROM s GROUP BY band""")
def q_prj15(spark, sf):
    s = scored(spark, sf, with_group=False).withColumn("band", X.band("p", X.FOUR_CUTS, X.FOUR_BANDS))
    return s.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("rate"))


@register("prj16_decode", """
SELECT coalesce(CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'OPEN' END, CAST(o_orderstatus AS VARCHAR)) AS status_label,
  count(*) AS n FROM orders GROUP BY status_label""")
def q_prj16(spark, sf):
    o = table(spark, sf, "orders").select(X.decode("o_orderstatus", {"F": "FULFILLED", "O": "OPEN"}).alias("status_label"))
    return o.groupBy("status_label").agg(F.count(F.lit(1)).alias("n"))


SHIFT = [(7, -0.07), (14, -0.12)]


@register("prj17_regime_shift", f"""
WITH b AS ({BATCHES_SQL})
SELECT batch_day, round(avg(f_value), 6) AS mean_before,
  round(avg(least(greatest(f_value + CASE WHEN batch_day >= 14 THEN -0.12 WHEN batch_day >= 7 THEN -0.07 ELSE 0.0 END, 0.0), 1.0)), 6) AS mean_after
FROM b GROUP BY batch_day""")
def q_prj17(spark, sf):
    """PRJ-17: stress scenario shift of one feature by batch regime, clipped to [0,1]."""
    b = daily_batches(spark, sf)
    shifted = X.clip(F.col("f_value") + X.regime_shift("batch_day", SHIFT), 0.0, 1.0)
    return b.groupBy("batch_day").agg(F.round(F.avg("f_value"), 6).alias("mean_before"), F.round(F.avg(shifted), 6).alias("mean_after"))


@register("prj18_event_time", """
SELECT o_orderkey, strftime(CAST(DATE '2024-01-01' + CAST(floor(CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':app'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 * 30) AS INTEGER) AS DATE), '%Y-%m-%d') AS application_date
FROM orders""")
def q_prj18(spark, sf):
    d = X.event_time("2024-01-01", "o_orderkey", ":app", 30)
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("application_date"))


AGG01_SQL = """
SELECT l_orderkey AS account_id, count(*) AS m_n, round(sum(l_quantity), 6) AS m_qty_sum,
  round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) AS m_past_due_mean,
  count(*) FILTER (WHERE l_returnflag = 'A') AS m_n_closed, count(*) FILTER (WHERE l_linestatus = 'O') AS m_n_open,
  round(avg(l_discount), 6) AS m_disc_mean FROM lineitem GROUP BY l_orderkey"""


@register("agg01_month_to_account", AGG01_SQL)
def q_agg01(spark, sf):
    m = fx.month_to_account(table(spark, sf, "lineitem"))
    return m.select("account_id", "m_n", *[F.round(c, 6).alias(c) for c in ("m_qty_sum", "m_past_due_mean")],
                    "m_n_closed", "m_n_open", F.round("m_disc_mean", 6).alias("m_disc_mean"))


@register("agg03_previous_applications", """
SELECT o_custkey AS applicant_id, count(*) AS prev_n, count(*) FILTER (WHERE o_orderstatus = 'F') AS prev_approved,
  round(avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 6) AS prev_refusal_rate,
  round(count(*) FILTER (WHERE o_orderstatus = 'P') / (count(*) + 1.0), 6) AS prev_refusal_smoothed,
  round(avg(o_totalprice), 6) AS prev_amt_mean, round(max(o_totalprice), 6) AS prev_amt_max, round(min(o_totalprice), 6) AS prev_amt_min,
  CAST(min(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')) AS INTEGER) AS days_since_last,
  count(DISTINCT o_orderpriority) AS prev_n_priorities
FROM orders GROUP BY o_custkey""")
def q_agg03(spark, sf):
    """AGG-03: per-applicant previous-application aggregates (mean-of-flag and count/(n+1) refusal rates)."""
    o = table(spark, sf, "orders")
    refused = X.flag(F.col("o_orderstatus") == "P")
    return o.groupBy(F.col("o_custkey").alias("applicant_id")).agg(
        F.count(F.lit(1)).alias("prev_n"), F.count_if(F.col("o_orderstatus") == "F").alias("prev_approved"),
        F.round(F.avg(refused), 6).alias("prev_refusal_rate"),
        F.round(F.sum(refused) / (F.count(F.lit(1)) + F.lit(1.0)), 6).alias("prev_refusal_smoothed"),
        F.round(F.avg("o_totalprice"), 6).alias("prev_amt_mean"), F.round(F.max("o_totalprice"), 6).alias("prev_amt_max"),
        F.round(F.min("o_totalprice"), 6).alias("prev_amt_min"),
        F.min(F.datediff(F.to_date(F.lit("2002-01-01")), F.col("o_orderdate").cast("date"))).alias("days_since_last"),
        F.count_distinct("o_orderpriority").alias("prev_n_priorities"))


@register("agg04_instalments", """
WITH j AS (SELECT o.o_custkey, l.l_extendedprice, l.l_discount,
  date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS delay FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT o_custkey AS applicant_id, count(*) AS inst_n, round(avg(CASE WHEN delay > 90 THEN 1 ELSE 0 END), 6) AS late_rate,
  round(avg(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END), 6) AS underpaid_rate,
  round(stddev_samp(l_extendedprice), 6) AS amt_std, round(min(l_extendedprice), 6) AS amt_min, round(max(l_extendedprice), 6) AS amt_max,
  round(avg(delay), 6) AS delay_mean, max(delay) AS delay_max
FROM j GROUP BY o_custkey""")
def q_agg04(spark, sf):
    """AGG-04: instalment-style aggregates per applicant (lines joined to their account)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_shipdate")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey").withColumn("delay", F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")))
    return j.groupBy(F.col("o_custkey").alias("applicant_id")).agg(
        F.count(F.lit(1)).alias("inst_n"), F.round(F.avg(X.flag(F.col("delay") > 90)), 6).alias("late_rate"),
        F.round(F.avg(X.flag(F.col("l_discount") > 0.05)), 6).alias("underpaid_rate"),
        F.round(F.stddev_samp("l_extendedprice"), 6).alias("amt_std"), F.round(F.min("l_extendedprice"), 6).alias("amt_min"),
        F.round(F.max("l_extendedprice"), 6).alias("amt_max"), F.round(F.avg("delay"), 6).alias("delay_mean"),
        F.max("delay").alias("delay_max"))


@register("agg05_06_balances", """
SELECT user_id, count(*) AS n, round(CAST(sum(CAST(value AS DECIMAL(20, 2))) AS DOUBLE) / count(*), 6) AS bal_mean, round(max(value), 6) AS bal_max, round(min(value), 6) AS bal_min,
  round(stddev_samp(value), 6) AS bal_std, round(sum(value), 6) AS bal_sum,
  round(avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 6) AS completed_rate,
  count(*) FILTER (WHERE event_type = 'error') AS n_error, count(DISTINCT event_type) AS n_types
FROM events GROUP BY user_id""")
def q_agg05(spark, sf):
    """AGG-05/06: balance-style aggregates and the conditional mean of a status."""
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("decimal(20,2)")).cast("double") / F.count(F.lit(1)), 6).alias("bal_mean"), F.round(F.max("value"), 6).alias("bal_max"),
        F.round(F.min("value"), 6).alias("bal_min"), F.round(F.stddev_samp("value"), 6).alias("bal_std"),
        F.round(F.sum("value"), 6).alias("bal_sum"),
        F.round(F.avg(F.when(F.col("event_type") == "purchase", 1).otherwise(0)), 6).alias("completed_rate"),
        F.count_if(F.col("event_type") == "error").alias("n_error"), F.count_distinct("event_type").alias("n_types"))


ROWSPLIT_LI = f"CASE WHEN {split_unit_sql('l_orderkey')} < 0.2 THEN 'test' WHEN {split_unit_sql('l_orderkey')} < 0.4 THEN 'val' ELSE 'train' END"


@register("agg08_median_fill", f"""
WITH {LIN}, m AS (SELECT median(disc_n) AS md, median(tax_n) AS mt FROM li WHERE {ROWSPLIT_LI} = 'train')
SELECT round(md, 6) AS median_disc, round(mt, 6) AS median_tax, count(*) FILTER (WHERE disc_n IS NULL) AS filled_disc,
  count(*) FILTER (WHERE tax_n IS NULL) AS filled_tax, round(avg(coalesce(disc_n, md)), 6) AS mean_disc_filled,
  round(avg(coalesce(tax_n, mt)), 6) AS mean_tax_filled FROM li, m GROUP BY md, mt""")
def q_agg08(spark, sf):
    """AGG-08 / FE-01: exact medians fitted on train rows only, then coalesce into every row."""
    li = sp.row_split(li_nulls(spark, sf), "l_orderkey")
    med = pp.fit_medians(li.where(F.col("split") == "train"), ["disc_n", "tax_n"]).select(F.col("disc_n").alias("md"), F.col("tax_n").alias("mt"), F.lit(1).alias("_k"))
    j = li.withColumn("_k", F.lit(1)).join(med, "_k")
    return j.groupBy("md", "mt").agg(
        F.count_if(F.col("disc_n").isNull()).alias("filled_disc"), F.count_if(F.col("tax_n").isNull()).alias("filled_tax"),
        F.round(F.avg(F.coalesce("disc_n", "md")), 6).alias("mean_disc_filled"),
        F.round(F.avg(F.coalesce("tax_n", "mt")), 6).alias("mean_tax_filled")).select(
        F.round("md", 6).alias("median_disc"), F.round("mt", 6).alias("median_tax"), "filled_disc", "filled_tax",
        "mean_disc_filled", "mean_tax_filled")


MODE_COLS = ["l_returnflag", "l_linestatus", "l_quantity"]


@register("agg09_mode", """
WITH u AS (SELECT 'l_returnflag' AS feature, CAST(l_returnflag AS VARCHAR) AS v FROM lineitem UNION ALL
  SELECT 'l_linestatus', CAST(l_linestatus AS VARCHAR) FROM lineitem UNION ALL SELECT 'l_quantity', CAST(l_quantity AS VARCHAR) FROM lineitem),
g AS (SELECT feature, v, count(*) AS n FROM u WHERE v IS NOT NULL GROUP BY feature, v),
m AS (SELECT feature, max(n) AS mx FROM g GROUP BY feature)
SELECT g.feature, min(v) AS mode_value, max(mx) AS mode_count FROM g JOIN m ON g.feature = m.feature AND g.n = m.mx GROUP BY g.feature""")
def q_agg09(spark, sf):
    """AGG-09: most frequent value per column (ties -> smallest), one unpivot + groupBy."""
    li = table(spark, sf, "lineitem")
    u = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in MODE_COLS])).alias("u")).select("u.*")
    g = u.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    m = g.groupBy(F.col("feature").alias("mf")).agg(F.max("n").alias("mx"))
    j = g.join(m, (F.col("feature") == F.col("mf")) & (F.col("n") == F.col("mx")))
    return j.groupBy("feature").agg(F.min("v").alias("mode_value"), F.max("mx").alias("mode_count"))


@register("agg10_class_balance", f"""
WITH {S} SELECT y, count(*) AS n, round(count(*) / (SELECT count(*) FROM s), 6) AS share FROM s GROUP BY y""")
def q_agg10(spark, sf):
    s = scored(spark, sf, with_group=False)
    w = Window.partitionBy()
    g = s.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(w), 6))


@register("agg11_null_profile", f"""
WITH {LIN}, a AS (SELECT count(*) AS n, count(*) FILTER (WHERE disc_n IS NULL) AS c0, count(*) FILTER (WHERE tax_n IS NULL) AS c1,
  count(*) FILTER (WHERE l_quantity IS NULL) AS c2 FROM li)
SELECT feature, nulls, round(nulls / n, 6) AS null_share FROM (SELECT 'disc_n' AS feature, c0 AS nulls, n FROM a UNION ALL
  SELECT 'tax_n', c1, n FROM a UNION ALL SELECT 'l_quantity', c2, n FROM a)""")
def q_agg11(spark, sf):
    """AGG-11: per-column null count and share in one pass, then stacked."""
    li = li_nulls(spark, sf)
    cols = ["disc_n", "tax_n", "l_quantity"]
    a = li.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    st = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"c{i}"))]).alias("feature", "nulls")
    return a.select("n", st).select("feature", "nulls", F.round(F.col("nulls") / F.col("n"), 6).alias("null_share"))


PROFILED = ["grp", "nation", "o_orderstatus", "o_orderpriority"]


@register("agg12_group_profile", f"""
WITH {S}, u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, y FROM s" for c in PROFILED)})
SELECT feature, level, count(*) AS n, round(count(*) / (SELECT count(*) FROM s), 6) AS share, round(avg(y), 6) AS target_rate
FROM u GROUP BY feature, level""")
def q_agg12(spark, sf):
    """AGG-12: rows, share and target rate of each level of every categorical."""
    s = scored(spark, sf)
    u = s.select("y", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in PROFILED])).alias("u")).select("y", "u.*")
    g = u.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("target_rate"))
    tot = s.agg(F.count(F.lit(1)).alias("_t")).withColumn("_k", F.lit(1))
    return g.withColumn("_k", F.lit(1)).join(tot, "_k").select("feature", "level", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"), "target_rate")


NUMS = ["l_quantity", "l_extendedprice", "disc_n"]


@register("agg13_numeric_profile", f"""
WITH {LIN}, u AS (SELECT 'l_quantity' AS feature, l_quantity AS v FROM li UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM li
  UNION ALL SELECT 'disc_n', disc_n FROM li)
SELECT feature, round(min(v), 6) AS min_v, round(max(v), 6) AS max_v, round(avg(v), 6) AS mean_v, round(stddev_samp(v), 6) AS std_v,
  count(*) FILTER (WHERE v IS NULL) AS nulls, count(DISTINCT v) AS n_distinct FROM u GROUP BY feature""")
def q_agg13(spark, sf):
    li = li_nulls(spark, sf)
    u = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in NUMS])).alias("u")).select("u.*")
    return u.groupBy("feature").agg(
        F.round(F.min("v"), 6).alias("min_v"), F.round(F.max("v"), 6).alias("max_v"), F.round(F.avg("v"), 6).alias("mean_v"),
        F.round(F.stddev_samp("v"), 6).alias("std_v"), F.count_if(F.col("v").isNull()).alias("nulls"),
        F.count_distinct("v").alias("n_distinct"))


@register("agg14_value_distribution", """
SELECT feature, v, count(*) AS n FROM (SELECT 'l_returnflag' AS feature, l_returnflag AS v FROM lineitem UNION ALL
  SELECT 'l_linestatus', l_linestatus FROM lineitem) GROUP BY feature, v""")
def q_agg14(spark, sf):
    li = table(spark, sf, "lineitem")
    u = li.select(F.explode(F.array(F.struct(F.lit("l_returnflag").alias("feature"), F.col("l_returnflag").alias("v")),
                                    F.struct(F.lit("l_linestatus").alias("feature"), F.col("l_linestatus").alias("v")))).alias("u")).select("u.*")
    return u.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))


# The columns of the profiled tables, for the oracle texts; the queries take them from the schema.
NUMERIC = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
           "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "disc_n": "double", "tax_n": "double"}
ALL_COLS = [*list(NUMERIC)[:8], "l_returnflag", "l_linestatus", "l_shipdate", "disc_n", "tax_n"]
CATEGORICAL = {"orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "customer": ["c_mktsegment"], "events": ["event_type"]}


@register("agg11_null_profile_all", f"""
WITH {LIN} {" UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS nulls, round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_share FROM li" for c in ALL_COLS)}""")
def q_agg11_all(spark, sf):
    """AGG-11: nulls of every column, one pass."""
    li = li_nulls(spark, sf)
    a = li.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(li.columns)])
    st = F.stack(F.lit(len(li.columns)), *[x for i, c in enumerate(li.columns) for x in (F.lit(c), F.col(f"c{i}"))]).alias("feature", "nulls")
    return a.select("n", st).select("feature", "nulls", F.round(F.col("nulls") / F.col("n"), 6).alias("null_share"))


@register("agg13_numeric_profile_all", f"""
WITH {LIN}, u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, '{t}' AS dtype, CAST({c} AS DOUBLE) AS v FROM li" for c, t in NUMERIC.items())})
SELECT feature, dtype, round(min(v), 6) AS min_v, round(max(v), 6) AS max_v, round(avg(v), 6) AS mean_v, round(stddev_samp(v), 4) AS std_v,
  count(*) FILTER (WHERE v IS NULL) AS nulls FROM u GROUP BY feature, dtype""")
def q_agg13_all(spark, sf):
    """AGG-13: type, range, mean, spread and nulls of every numeric column, one unpivot."""
    li = li_nulls(spark, sf)
    u = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(t).alias("dtype"), F.col(c).cast("double").alias("v"))
                                      for c, t in li.dtypes if t in ("int", "bigint", "double")])).alias("u")).select("u.*")
    return u.groupBy("feature", "dtype").agg(
        F.round(F.min("v"), 6).alias("min_v"), F.round(F.max("v"), 6).alias("max_v"), F.round(F.avg("v"), 6).alias("mean_v"),
        F.round(F.stddev_samp("v"), 4).alias("std_v"), F.count_if(F.col("v").isNull()).alias("nulls"))


@register("agg14_value_distribution_all", f"""
WITH u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM {t}" for t, cs in CATEGORICAL.items() for c in cs)}), g AS (SELECT feature, v, count(*) AS n FROM u GROUP BY feature, v)
SELECT feature, v, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS INTEGER) AS rank FROM g""")
def q_agg14_all(spark, sf):
    """AGG-14 / AGG-09: every level of every categorical with its count, share and rank (rank 1: the mode)."""
    parts = [table(spark, sf, t).select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in cs])).alias("u")).select("u.*")
             .groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")) for t, cs in CATEGORICAL.items()]
    g = parts[0]
    for p in parts[1:]:
        g = g.unionByName(p)
    w = Window.partitionBy("feature")  # the levels of one categorical
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(w), 6)).withColumn("rank", F.row_number().over(w.orderBy(F.col("n").desc(), "v")))


AGE_SQL = "CASE WHEN age < 1 THEN '[0,1)' WHEN age < 3 THEN '[1,3)' WHEN age < 5 THEN '[3,5)' ELSE '[5,inf)' END"


@register("agg15_age_bands", f"""
WITH {S}, a AS (SELECT *, date_diff('day', CAST(ts AS DATE), DATE '2002-01-01') / 365.25 AS age FROM s)
SELECT {AGE_SQL} AS age_band, count(*) AS n, round(avg(y), 6) AS rate FROM a GROUP BY age_band""")
def q_agg15(spark, sf):
    s = scored(spark, sf, with_group=False).withColumn("age", F.datediff(F.to_date(F.lit("2002-01-01")), F.col("ts").cast("date")) / 365.25)
    band = F.when(F.col("age") < 1, "[0,1)").when(F.col("age") < 3, "[1,3)").when(F.col("age") < 5, "[3,5)").otherwise("[5,inf)")
    return s.groupBy(band.alias("age_band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("rate"))


@register("agg16_key_uniqueness", """
SELECT 'orders.o_orderkey' AS key_name, count(*) AS n, count(DISTINCT o_orderkey) AS n_distinct, CAST(count(*) = count(DISTINCT o_orderkey) AS INTEGER) AS is_unique FROM orders
UNION ALL SELECT 'lineitem.l_orderkey+l_linenumber', count(*), count(DISTINCT (l_orderkey, l_linenumber)), CAST(count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS INTEGER) FROM lineitem
UNION ALL SELECT 'customer.c_custkey', count(*), count(DISTINCT c_custkey), CAST(count(*) = count(DISTINCT c_custkey) AS INTEGER) FROM customer""")
def q_agg16(spark, sf):
    def one(df, name, cols):
        return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*cols).alias("n_distinct")).select(
            F.lit(name).alias("key_name"), "n", "n_distinct", (F.col("n") == F.col("n_distinct")).cast("int").alias("is_unique"))
    return one(table(spark, sf, "orders"), "orders.o_orderkey", ["o_orderkey"]).unionByName(
        one(table(spark, sf, "lineitem"), "lineitem.l_orderkey+l_linenumber", ["l_orderkey", "l_linenumber"])).unionByName(
        one(table(spark, sf, "customer"), "customer.c_custkey", ["c_custkey"]))


@register("agg17_score_summary", f"""
WITH {S} SELECT grp, round(avg(p), 6) AS mean_p, round(median(p), 6) AS median_p, round(stddev_pop(p), 6) AS std_p FROM s GROUP BY grp""")
def q_agg17(spark, sf):
    s = scored(spark, sf)
    g = s.groupBy("grp").agg(F.round(F.avg("p"), 6).alias("mean_p"), F.round(F.stddev_pop("p"), 6).alias("std_p"))
    return g.join(exact_quantiles(s, "p", [0.5], ["grp"]), "grp", "left").select("grp", "mean_p", F.round(F.col("q")[0], 6).alias("median_p"), "std_p")


@register("agg18_vector_median", """
SELECT CAST(pos AS INTEGER) AS pos, round(median(CAST(v AS DOUBLE)), 6) AS median_v FROM (SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings) GROUP BY pos""")
def q_agg18(spark, sf):
    e = table(spark, sf, "embeddings").select(F.posexplode("embedding").alias("pos", "v"))
    return exact_quantiles(e, "v", [0.5], ["pos"]).select("pos", F.round(F.col("q")[0], 6).alias("median_v"))


@register("agg19_class_weight", f"""
WITH {S} SELECT count(*) FILTER (WHERE y = 0) AS n_neg, count(*) FILTER (WHERE y = 1) AS n_pos,
  round(count(*) FILTER (WHERE y = 0) / count(*) FILTER (WHERE y = 1), 6) AS pos_weight FROM s""")
def q_agg19(spark, sf):
    s = scored(spark, sf, with_group=False)
    return s.agg(F.count_if(F.col("y") == 0).alias("n_neg"), F.count_if(F.col("y") == 1).alias("n_pos")).withColumn(
        "pos_weight", F.round(F.try_divide(F.col("n_neg"), F.col("n_pos")), 6))


@register("agg21_quintile_cohorts", f"""
WITH {S}, q AS (SELECT quantile_cont(p_raw, [0.2, 0.4, 0.6, 0.8]) AS e FROM s),
c AS (SELECT y, CAST(len(list_filter(e, lambda x: x < p_raw)) AS INTEGER) + 1 AS cohort FROM s, q),
r AS (SELECT cohort, count(*) AS n, avg(y) AS rate FROM c GROUP BY cohort)
SELECT cohort, n, round(rate, 6) AS rate, round(max(rate) OVER () - min(rate) OVER (), 6) AS rate_range FROM r""")
def q_agg21(spark, sf):
    """AGG-21: exact quintile cut points, cohort = number of cuts strictly below the score."""
    s = scored(spark, sf, with_group=False)
    e = exact_quantiles(s, "p_raw", [0.2, 0.4, 0.6, 0.8], name="e").withColumn("_k", F.lit(1))
    c = s.withColumn("_k", F.lit(1)).join(e, "_k").select("y", (F.size(F.filter("e", lambda x: x < F.col("p_raw"))) + 1).alias("cohort"))
    r = c.groupBy("cohort").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate"))
    w = Window.partitionBy()
    return r.select("cohort", "n", F.round("rate", 6).alias("rate"), F.round(F.max("rate").over(w) - F.min("rate").over(w), 6).alias("rate_range"))
