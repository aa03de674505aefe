"""Distributed prefix sums over a score order, per group.

Exact ranking metrics (AUC, KS, AP, PR curve, ROC points, DeLong placements)
need, for every distinct score, the number of positives and negatives at or
below it.  A global ``Window.orderBy`` would pull every row into one task, so:

1. ``groupBy(groups, score)`` collapses ties (map-side partial aggregation,
   so a hot score costs one partial row per task).
2. Each distinct score gets a bucket from per-group approximate quantiles
   (equal-count buckets, so no bucket is hot even if the scores cluster).
3. Cumulative sums run inside ``(groups, bucket)`` window partitions, in
   parallel.
4. Bucket totals (at most ``n_buckets`` rows per group) are cumulated on the
   small table and joined back as offsets.

The result equals a global running sum; the SQL oracle uses the global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import count_le

GKEY = "_g"


def _groups(df: DataFrame, groups) -> tuple[DataFrame, list[str]]:
    groups = list(groups or [])
    if not groups:
        df = df.withColumn(GKEY, F.lit(0))
        groups = [GKEY]
    return df, groups


def score_counts(df: DataFrame, score: str | Column, label: str | Column, groups=(), weight: str | Column | None = None) -> DataFrame:
    """Level 1: one row per (groups, distinct score) with positive/negative counts."""
    s = F.col(score) if isinstance(score, str) else score
    y = F.col(label) if isinstance(label, str) else label
    w = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    return df.where(s.isNotNull() & y.isNotNull()).groupBy(*groups, s.alias("s")).agg(
        F.sum(y * w).alias("pos"), F.sum((F.lit(1) - y) * w).alias("neg")
    )


def cumulate(counts: DataFrame, groups=(), n_buckets: int = 1024, cols=("pos", "neg"), following=()) -> DataFrame:
    """Levels 2-4: add ``c<col>`` (running sum of <col> over scores <= s) and
    the group totals ``T<col>`` to a (groups, s, cols...) table.  With ``following``
    (columns, ``s`` first) also ``next``, a struct of them in the row after (null in a group's last)."""
    counts, groups = _groups(counts, groups)
    fracs = [i / n_buckets for i in range(1, n_buckets)]
    # per-group equal-count cut points (at most n_buckets-1 values per group)
    cuts = counts.groupBy(*groups).agg(F.array_distinct(F.percentile_approx("s", fracs, 4 * n_buckets)).alias("_cuts"))
    b = counts.join(cuts, groups, "inner").withColumn("_b", count_le("_cuts", "s", n_buckets)).drop("_cuts")
    w_next = Window.partitionBy(*groups, "_b").orderBy("s")
    w_in = w_next.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lead = [F.lead(F.struct(*following)).over(w_next).alias("_in_next")] if following else []
    b = b.select("*", *[F.sum(c).over(w_in).alias(f"_in_{c}") for c in cols], *lead)
    first = [F.min(F.struct(*following)).alias("_first")] if following else []
    tot = b.groupBy(*groups, "_b").agg(*[F.sum(c).alias(f"_b_{c}") for c in cols], *first)
    w_all = Window.partitionBy(*groups)
    w_off = w_all.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    lead = [F.lead("_first").over(w_all.orderBy("_b")).alias("_off_next")] if following else []
    tot = tot.select(*groups, "_b", *[F.coalesce(F.sum(f"_b_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in cols],
                     *[F.sum(f"_b_{c}").over(w_all).alias(f"T{c}") for c in cols], *lead)
    following_row = [F.coalesce("_in_next", "_off_next").alias("next")] if following else []
    return b.join(tot, groups + ["_b"], "inner").select(
        *counts.columns, *[f"T{c}" for c in cols], *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"c{c}") for c in cols], *following_row)


def score_cdf(df: DataFrame, score: str | Column, label: str | Column, groups=(), n_buckets: int = 1024,
              weight: str | Column | None = None) -> DataFrame:
    """(groups, s, pos, neg, cpos, cneg, Tpos, Tneg): cumulative class counts at or below each score."""
    df, groups = _groups(df, groups)
    return cumulate(score_counts(df, score, label, groups, weight), groups, n_buckets)
