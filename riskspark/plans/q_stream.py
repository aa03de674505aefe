"""Streaming queries run to completion (availableNow) and read back from their sinks; each has a
batch twin in SQL where the final result is deterministic (ST-01/02/03/05/06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import drift as dr
from riskspark.plans.catalog import register
from riskspark.plans.q_drift import PSI_HEAD, long_frames
from riskspark.sources.io import table
from riskspark.streaming import stream as st


def events_stream(spark, sf):
    return st.table_stream(spark, sf, "events")


@register("st01_daily_windows", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 6) AS value_sum FROM events GROUP BY ALL""")
def q_st01(spark, sf):
    """ST-01: tumbling daily windows with a watermark (complete result after the last batch)."""
    out = st.run_to_table(st.daily_aggregates(events_stream(spark, sf)), "st01", mode="complete")
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("value_sum", 6).alias("value_sum"))


@register("st02_sliding_30d", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events),
x AS (SELECT day - CAST(k AS INTEGER) AS start, event_type FROM d, range(0, 30) t(k))
SELECT strftime(start, '%Y-%m-%d') AS start, event_type, count(*) AS n FROM x GROUP BY ALL""")
def q_st02(spark, sf):
    """ST-02: sliding 30-day windows advancing by one day."""
    out = st.run_to_table(st.sliding_aggregates(events_stream(spark, sf)), "st02", mode="complete")
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("start"), "event_type", "n")


@register("st03_streaming_scorer", """
WITH s AS (SELECT o_orderstatus, round(round(0.02 + 0.96 * o_totalprice / 500000.0, 6) * round(0.02 + 0.96 * o_totalprice / 500000.0, 6), 6) AS p FROM orders)
SELECT o_orderstatus, CASE WHEN p < 0.2 THEN 'GREEN' WHEN p < 0.4 THEN 'AMBER' ELSE 'RED' END AS band, count(*) AS n FROM s GROUP BY ALL""")
def q_st03(spark, sf):
    """ST-03: the scorer's column expressions on a stream of applications, appended to a Parquet sink."""
    o = st.table_stream(spark, sf, "orders")
    p_raw = F.round(F.lit(0.02) + F.lit(0.96) * F.col("o_totalprice") / F.lit(500000.0), 6)
    s = o.select("o_orderkey", "o_orderstatus", F.round(p_raw * p_raw, 6).alias("p"))
    s = s.withColumn("band", X.band("p", X.THREE_CUTS, X.THREE_BANDS))
    out = st.run_to_table(s, "st03", mode="append")
    return out.groupBy("o_orderstatus", "band").agg(F.count(F.lit(1)).alias("n"))


KINDS = ["click", "purchase"]


def rates_sql(days: int) -> str:
    return f"""
WITH x AS (SELECT CAST(ts AS DATE) - CAST(k AS INTEGER) AS start, event_type FROM events, range(0, {days}) t(k)), top AS (SELECT max(ts) AS m FROM events)
SELECT strftime(start, '%Y-%m-%d') AS start, count(*) AS n, {", ".join(f"round(count(*) FILTER (WHERE event_type = '{k}') / count(*), 6) AS {k}_rate" for k in KINDS)}
FROM x, top GROUP BY start, m HAVING CAST(start AS TIMESTAMP) + INTERVAL {days} DAY <= m - INTERVAL 1 DAY"""


def _rates(spark, sf, days: int):
    out = st.run_to_table(st.closed_rates(events_stream(spark, sf), KINDS, f"{days} days"), f"st02-{days}", mode="append")
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("start"), "n", *[F.round(f"{k}_rate", 6).alias(f"{k}_rate") for k in KINDS])


for _days in (30, 90):
    register(f"st02_closed_rates_{_days}d", rates_sql(_days))(lambda spark, sf, days=_days: _rates(spark, sf, days))


@register("st04_outcomes_closed", """
WITH m AS (SELECT o_orderkey AS id, o_orderdate, count(l_orderkey) AS k FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'
  AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 120 DAY GROUP BY ALL),
w AS (SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R')) - INTERVAL 30 DAY AS mark)
SELECT CASE WHEN k > 0 THEN 'matched' ELSE 'unmatched' END AS status, count(*) AS n, CAST(sum(k) AS BIGINT) AS outcomes, CAST(0 AS BIGINT) AS late
FROM m, w WHERE k > 0 OR o_orderdate + INTERVAL 120 DAY < mark GROUP BY ALL""")
def q_st04_closed(spark, sf):
    """ST-04: matched decisions and those whose 120 days have passed without an outcome, both from the stream itself;
    decisions whose horizon is still open are not given out.  ``late``: outcomes behind the watermark."""
    s = st.table_stream(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("score_ts"))
    o = st.table_stream(spark, sf, "lineitem").where(F.col("l_returnflag") == "R") \
          .select(F.col("l_orderkey").alias("oid"), F.col("l_shipdate").cast("timestamp").alias("outcome_ts"))
    out = st.run_to_table(st.outcome_join(s, o, how="leftOuter").select("id", "oid", "score_ts", "outcome_ts"), "st04-closed", mode="append")
    late = st.mark_late(o, "outcome_ts", "30 days", "st04-late").agg(F.count_if("late")).scalar()
    k = out.groupBy("id").agg(F.count("oid").alias("k"))
    return k.groupBy(F.when(F.col("k") > 0, "matched").otherwise("unmatched").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("outcomes"), late.alias("late"))


@register("st04_delayed_label_join", """
WITH m AS (SELECT o_orderkey AS id, count(l_orderkey) AS k FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'
  AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 120 DAY GROUP BY o_orderkey)
SELECT CAST(k > 0 AS INTEGER) AS matched, count(*) AS n, CAST(sum(k) AS BIGINT) AS outcomes FROM m GROUP BY ALL""")
def q_st04(spark, sf):
    """ST-04: stream-stream join of decisions with returned lines inside 120 days; decisions without
    an outcome are told by the log of decisions, not by waiting for a watermark that the end of the input never brings."""
    s = st.table_stream(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("score_ts"))
    o = st.table_stream(spark, sf, "lineitem").where(F.col("l_returnflag") == "R") \
          .select(F.col("l_orderkey").alias("oid"), F.col("l_shipdate").cast("timestamp").alias("outcome_ts"))
    out = st.run_to_table(st.outcome_join(s, o).select("id", "score_ts", "outcome_ts"), "st04", mode="append")
    k = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).join(out.groupBy("id").agg(F.count(F.lit(1)).alias("k")), "id", "left")
    k = k.withColumn("k", F.coalesce("k", F.lit(0)))
    return k.groupBy((F.col("k") > 0).cast("int").alias("matched")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("outcomes"))


@register("st05_consecutive_alert_state", f"""{PSI_HEAD},
f AS (SELECT feature, batch_day, psi, CAST(psi > 0.1 AS INTEGER) AS fl FROM psi),
i AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY batch_day) - row_number() OVER (PARTITION BY feature, fl ORDER BY batch_day) AS isl FROM f),
r AS (SELECT *, CASE WHEN fl = 1 THEN count(*) OVER (PARTITION BY feature, fl, isl ORDER BY batch_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END AS consecutive FROM i)
SELECT feature, batch_day, round(psi, 6) AS psi, consecutive,
  CASE WHEN consecutive = 5 AND psi > 0.3 THEN 'RETIRE' WHEN consecutive = 2 THEN 'RETRAIN' END AS action FROM r""")
def q_st05(spark, sf):
    """ST-05: daily PSI rows streamed through a per-feature state handler (batch twin WIN-10)."""
    ref, act = long_frames(spark, sf)
    p = dr.psi(ref, act, "batch_day").select("feature", "batch_day", "psi")
    src = st.scratch(spark, "st05-src")
    p.write.parquet(src)
    out = st.run_updates(st.consecutive_alerts(st.file_stream(spark, src)), "st05", ["feature", "batch_day"])
    return out.select("feature", "batch_day", F.round("psi", 6).alias("psi"), "consecutive", "action")


@register("st06_dedupe_decision_log", "SELECT o_orderkey AS id FROM orders")
def q_st06(spark, sf):
    """ST-06: a decision log delivered twice (at-least-once); every id is logged once."""
    src = st.scratch(spark, "st06-src")
    d = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    d.write.parquet(f"{src}/a")
    d.write.parquet(f"{src}/b")
    s = spark.readStream.schema(d.schema).option("recursiveFileLookup", True).parquet(src)
    return st.dedupe_decisions(s, "st06").select("id")
