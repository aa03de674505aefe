"""Join and ordered-window operators that must survive skewed keys
(JOIN-03/04/08/09/11/13/14, WIN-01/02).

* ``top_n_per_key``: last/first N rows per key in two stages — top N inside
  (key, salt) partitions, then top N over the ≤ N·salts survivors per key —
  so a key holding a third of the table is ranked by ``salts`` tasks.
* ``asof_fill``: point-in-time join without a theta join: features and
  decisions are unioned, the last known feature value per key is carried
  forward in (key, day) partitions, and the carry-in from earlier days comes
  from a per-(key, day) summary table, so no window partition spans more than
  one key-day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, key: str, order: list[Column], n: int, salts: int = 16, tiebreak: list[str] | None = None) -> DataFrame:
    """WIN-01: the first ``n`` rows per ``key`` under ``order`` (exact), with ``rn``.

    ``order`` should end in a unique tiebreak so the result is deterministic."""
    tb = tiebreak or []
    salt = F.abs(F.xxhash64(*[F.col(c) for c in tb] or [F.rand(7)])) % F.lit(salts)
    s = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(key, "_salt").orderBy(*order)
    s = s.withColumn("_rn1", F.row_number().over(w1)).where(F.col("_rn1") <= n).drop("_rn1", "_salt")
    w2 = Window.partitionBy(key).orderBy(*order)
    return s.withColumn("rn", F.row_number().over(w2)).where(F.col("rn") <= n)


def fixed_sequence(ranked: DataFrame, key: str, rn: str, fields: list[str], n: int) -> DataFrame:
    """WIN-02: oldest-first array of exactly ``n`` structs per key, left-padded
    with zero structs.  ``ranked`` holds at most ``n`` rows per key (WIN-01),
    so the collected list is bounded by ``n``."""
    st = F.struct(F.col(rn).alias("_k"), *[F.col(f).cast("double").alias(f) for f in fields])
    g = ranked.groupBy(key).agg(F.sort_array(F.collect_list(st), asc=False).alias("_l"))  # rn desc = oldest first
    zero = F.struct(*[F.lit(0.0).alias(f) for f in fields])
    seq = F.transform("_l", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    pad = F.array_repeat(zero, F.greatest(F.lit(n) - F.size("_l"), F.lit(0)))
    return g.select(key, F.concat(pad, seq).alias("seq"), F.size("_l").alias("n_real"))


def lookup_with_default(left: DataFrame, right: DataFrame, key: str, col: str, default: Column) -> DataFrame:
    """JOIN-03: left join, misses get ``default`` (e.g. a zero sequence)."""
    return left.join(right, key, "left").withColumn(col, F.coalesce(F.col(col), default))


def augment_vectors(left: DataFrame, vecs: DataFrame, key: str, vec_col: str, dims: int, prefix: str = "emb_") -> DataFrame:
    """JOIN-04: 1:1 inner join and expansion of ``vec_col[i]`` to columns."""
    j = left.join(vecs, key, "inner")
    return j.select(*[c for c in j.columns if c != vec_col],
                    *[F.col(vec_col)[i].cast("double").alias(f"{prefix}{i}") for i in range(dims)])


def asof_fill(features: DataFrame, events: DataFrame, key: str, ts: str, value: str, direction: str = "backward",
              bucket_micros: int = 86_400_000_000) -> DataFrame:
    """JOIN-13: for each event row, the feature value of the latest feature row
    with feature ts <= event ts (``direction="forward"``: the earliest with
    feature ts >= event ts).  Ties count as known.  ``features``: (key, ts, value).

    No theta join and no per-key window over raw rows: rows are windowed inside
    (key, time bucket) partitions; the value carried into a bucket comes from a
    (key, bucket) summary table windowed per key.
    """
    sign = 1 if direction == "backward" else -1
    t = F.unix_micros(F.col(ts).cast("timestamp")) * F.lit(sign)
    f = features.select(key, t.alias("_t"), F.col(value).cast("double").alias("_v"), F.lit(0).alias("_kind"))
    ev_cols = [c for c in events.columns if c != key]
    e = events.select(key, *ev_cols, t.alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_kind"))
    u = f.unionByName(e, allowMissingColumns=True).withColumn("_bkt", F.floor(F.col("_t") / F.lit(bucket_micros)))
    # (key, bucket) summary: last feature value in the bucket, or NULL for event-only buckets
    ends = u.groupBy(key, "_bkt").agg(F.max_by(F.col("_v"), F.struct(F.col("_v").isNotNull(), "_t", "_v")).alias("_end"))
    wb = Window.partitionBy(key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carry_in", F.last("_end", ignorenulls=True).over(wb)).drop("_end")
    w = Window.partitionBy(key, "_bkt").orderBy("_t", "_kind", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = u.join(ends, [key, "_bkt"], "left").withColumn("_lv", F.last("_v", ignorenulls=True).over(w))
    out = out.withColumn("asof_value", F.coalesce(F.col("_lv"), F.col("_carry_in")))
    return out.where(F.col("_kind") == 1).select(key, *ev_cols, "asof_value")


def delayed_labels(scores: DataFrame, outcomes: DataFrame, key: str, score_ts: str, outcome_ts: str, horizon_days: int,
                   data_end: str) -> DataFrame:
    """JOIN-09: label = 1 if an outcome for the key falls in [score_ts, score_ts + horizon];
    0 if none did and the horizon has fully elapsed by ``data_end``; NULL (unresolved) otherwise.
    The next outcome time comes from a forward as-of lookup (no pairwise join per key)."""
    o = outcomes.select(key, F.col(outcome_ts).alias(score_ts), F.unix_micros(F.col(outcome_ts).cast("timestamp")).cast("double").alias("_ot"))
    nxt = asof_fill(o, scores, key, score_ts, "_ot", direction="forward")
    lim = F.unix_micros((F.col(score_ts) + F.make_interval(days=F.lit(horizon_days))).cast("timestamp"))
    resolved = F.col(score_ts) + F.make_interval(days=F.lit(horizon_days)) <= F.to_timestamp(F.lit(data_end))
    return nxt.withColumn("label", F.when(F.col("asof_value") <= lim, 1).when(resolved, 0)) \
              .withColumn("next_outcome_ts", F.timestamp_micros(F.col("asof_value").cast("long"))).drop("asof_value")


def parity(a: DataFrame, b: DataFrame, key: str, cols: list[str], tol: float = 1e-6) -> DataFrame:
    """JOIN-11: per-feature max |a − b| and mismatch rate between two feature frames."""
    j = a.select(key, *[F.col(c).alias(f"a_{c}") for c in cols]).join(b.select(key, *[F.col(c).alias(f"b_{c}") for c in cols]), key)
    u = j.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a_{c}").cast("double").alias("va"),
                                                   F.col(f"b_{c}").cast("double").alias("vb")) for c in cols])).alias("u")).select(key, "u.*")
    d = F.abs(F.col("va") - F.col("vb"))
    bad = (d > tol) | (F.col("va").isNull() != F.col("vb").isNull())
    return u.groupBy("feature").agg(F.round(F.max(d), 6).alias("max_abs_diff"), F.round(F.avg(bad.cast("int")), 6).alias("mismatch_rate"))


def blocklist_flag(df: DataFrame, blocklist: DataFrame, key: str) -> DataFrame:
    """JOIN-14: NULL-safe blocklist flag via a left join on the distinct blocked keys."""
    bl = blocklist.select(F.col(key).alias("_bk")).where(F.col("_bk").isNotNull()).distinct().withColumn("_blocked", F.lit(1))
    j = df.join(bl, F.col(key).eqNullSafe(F.col("_bk")), "left")
    return j.withColumn("blocked", F.coalesce(F.col("_blocked"), F.lit(0))).drop("_bk", "_blocked")


def policy_asof(decisions: DataFrame, versions: DataFrame, ts: str) -> DataFrame:
    """JOIN-08: policy version in force at each decision.  ``versions``
    (version, effective_ts, ...) is a change log with a handful of rows; it becomes
    [from, to) ranges with ``lead`` and is range-joined.  The log is small by
    nature (one row per policy release); AQE broadcasts it."""
    w = Window.orderBy("effective_ts")
    v = versions.withColumn("_to", F.lead("effective_ts").over(w))
    cond = (F.col(ts) >= F.col("effective_ts")) & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    return decisions.join(v, cond, "left").drop("_to")
