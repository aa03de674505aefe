"""Driver tables as stand-ins for the credit-risk data model.

applicant = ``customer``; account = ``orders``; month row = ``lineitem``;
daily batches = ``events``; scored frame = ``orders`` with a rational
probability from ``o_totalprice`` and a label drawn from an md5 hash that is
calibrated to it.  The same formulas appear in the SQL oracle texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.exprs import stable_unit
from riskspark.sources.io import table

# Salts of the deterministic hashes shared with the oracle.
LABEL_SALT = ":42"
SPLIT_SALT = ":split42"


def scored(spark: SparkSession, sf_dir: str, with_group: bool = True) -> DataFrame:
    """Scored frame: id, entity, p_raw, p, y, grp (one row per order).

    p_raw = round(0.02 + 0.96 * totalprice / 500000, 6) is uncalibrated,
    p = round(p_raw^2, 6) is calibrated by construction because y = u < p with
    u uniform from md5(id:42).
    """
    o = table(spark, sf_dir, "orders")
    p_raw = F.round(F.lit(0.02) + F.lit(0.96) * F.col("o_totalprice") / F.lit(500000.0), 6)
    df = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("entity"),
        p_raw.alias("p_raw"),
        F.col("o_orderdate").alias("ts"),
        "o_orderstatus", "o_orderpriority",
    ).withColumn("p", F.round(F.col("p_raw") * F.col("p_raw"), 6))
    df = df.withColumn("y", (stable_unit("id", LABEL_SALT) < F.col("p")).cast("int"))
    if with_group:
        c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("grp"),
                                                    F.col("c_nationkey").alias("nation"))
        df = df.join(c, "entity", "left")
    return df


SCORED_SQL = """
  SELECT o.o_orderkey AS id, o.o_custkey AS entity, o.o_orderdate AS ts, o.o_orderstatus, o.o_orderpriority,
         c.c_nationkey AS nation,
         round(0.02 + 0.96 * o.o_totalprice / 500000.0, 6) AS p_raw,
         round(round(0.02 + 0.96 * o.o_totalprice / 500000.0, 6) * round(0.02 + 0.96 * o.o_totalprice / 500000.0, 6), 6) AS p,
         CAST(CAST(CAST('0x' || substr(md5(CAST(o.o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0
              < round(round(0.02 + 0.96 * o.o_totalprice / 500000.0, 6) * round(0.02 + 0.96 * o.o_totalprice / 500000.0, 6), 6) AS INTEGER) AS y,
         c.c_mktsegment AS grp
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""


def split_unit_sql(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '{SPLIT_SALT}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"


def batch_day(ts: str = "ts"):
    """day = datediff(ts, 2024-01-01) + 1 (days 1..30)."""
    return (F.datediff(F.col(ts).cast("date"), F.to_date(F.lit("2024-01-01"))) + F.lit(1)).cast("int")


def daily_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily batch frame from ``events``: one row per event with ``batch_day``,
    three numeric features and the event type as a categorical."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type",
        batch_day("ts").alias("batch_day"),
        (F.col("value") / F.lit(500.0)).alias("f_value"),
        F.get_json_object("props", "$.k").cast("double").alias("f_k"),
        F.hour("ts").cast("double").alias("f_hour"),
    )


BATCHES_SQL = """
  SELECT event_id, ts, user_id, event_type,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS batch_day,
         value / 500.0 AS f_value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS f_k,
         CAST(hour(ts) AS DOUBLE) AS f_hour
  FROM events
"""


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form scores of three "models" on the same rows: calibrated (p),
    raw (p_raw) and blend (mean of the two), as (model, id, entity, grp, p, y)."""
    s = scored(spark, sf_dir)
    blend = F.round((F.col("p") + F.col("p_raw")) / 2.0, 6)
    arr = F.array(
        F.struct(F.lit("calibrated").alias("model"), F.col("p").alias("score")),
        F.struct(F.lit("raw").alias("model"), F.col("p_raw").alias("score")),
        F.struct(F.lit("blend").alias("model"), blend.alias("score")),
    )
    return s.select("id", "entity", "grp", "y", F.explode(arr).alias("m")).select(
        "m.model", "id", "entity", "grp", F.col("m.score").alias("p"), "y")


MODELS_SQL = f"""
  SELECT 'calibrated' AS model, id, entity, grp, p, y FROM ({SCORED_SQL}) UNION ALL
  SELECT 'raw' AS model, id, entity, grp, p_raw AS p, y FROM ({SCORED_SQL}) UNION ALL
  SELECT 'blend' AS model, id, entity, grp, round((p + p_raw) / 2.0, 6) AS p, y FROM ({SCORED_SQL})
"""


def leak_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame for the leakage audit: scored orders with a row-level split, an
    injected outcome proxy (0.9·y + noise), the order's latest ship date as a
    feature timestamp (outcome time = order date) and a few categoricals."""
    s = scored(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_shipdate").alias("feature_ts"))
    u = stable_unit("id", SPLIT_SALT)
    return s.join(li, "id", "left").select(
        "id", "entity", "y", "p_raw", "grp", "nation", "o_orderpriority", "o_orderstatus", F.col("ts").alias("outcome_ts"), "feature_ts",
        F.round(F.lit(0.9) * F.col("y") + F.lit(0.1) * stable_unit("id", ":noise"), 6).alias("outcome_proxy"),
        F.when(u < 0.2, "test").when(u < 0.4, "val").otherwise("train").alias("split"))


LEAK_SQL = f"""
  SELECT s.id, s.entity, s.y, s.p_raw, s.grp, s.nation, s.o_orderpriority, s.o_orderstatus, s.ts AS outcome_ts, li.feature_ts,
         round(0.9 * s.y + 0.1 * CAST(CAST('0x' || substr(md5(CAST(s.id AS VARCHAR) || ':noise'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0, 6) AS outcome_proxy,
         CASE WHEN {split_unit_sql('s.id')} < 0.2 THEN 'test' WHEN {split_unit_sql('s.id')} < 0.4 THEN 'val' ELSE 'train' END AS split
  FROM ({SCORED_SQL}) s LEFT JOIN (SELECT l_orderkey AS id, max(l_shipdate) AS feature_ts FROM lineitem GROUP BY l_orderkey) li ON li.id = s.id
"""
