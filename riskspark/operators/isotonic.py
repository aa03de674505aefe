"""Isotonic fits by pooling adjacent violators in blocks (CAL-02, ML-02, ML-06).

Ties are summed first.  The distinct scores are dealt into ranges of their
order; each range is pooled by itself, streaming, and then the ranges' pools are
pooled again in order.  Pools that a range has made are never split by its
neighbours, so the result is that of one pass over everything; only pools travel
to the last step, not rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POOL = "low double, high double, total double, weight double"


def _pooled(batches):
    """Pools (group, low, high, total, weight) of sorted rows of the same form; only the open group's pools are held."""
    stack: list[list[float]] = []
    now = None

    def sent():
        cols = list(zip(*stack, strict=True))
        out = pa.RecordBatch.from_arrays([pa.array([now] * len(stack), pa.string()), *[pa.array(c, pa.float64()) for c in cols]],
                                         names=["group", "low", "high", "total", "weight"])
        stack.clear()
        return out

    for b in batches:
        groups, *rows = (b.column(c).to_pylist() for c in ("group", "low", "high", "total", "weight"))
        for group, low, high, total, weight in zip(groups, *rows, strict=True):
            if group != now:
                if stack:
                    yield sent()
                now = group
            pool = [low, high, total, weight]
            # a mean below the one before is pooled with it
            while stack and stack[-1][2] * pool[3] >= pool[2] * stack[-1][3]:
                last = stack.pop()
                pool = [last[0], pool[1], last[2] + pool[2], last[3] + pool[3]]
            stack.append(pool)
    if stack:
        yield sent()


def isotonic_pools(df: DataFrame, group: str, x: str, total: Column, weight: Column, increasing: bool = True) -> DataFrame:
    """(group, low, high, total, weight, value): the pools of the least-squares monotone fit of total / weight over ``x``, by group.

    ``total`` and ``weight`` are per row and summed over equal ``x``.  Rows whose
    group or ``x`` is null are left out; groups are compared as text.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(x).isNotNull()).groupBy(F.col(group).cast("string").alias("group"), F.col(x).cast("double").alias("low"))
    sign = F.lit(1.0 if increasing else -1.0)
    rows = rows.agg((sign * F.sum(total.cast("double"))).alias("total"), F.sum(weight.cast("double")).alias("weight"))
    rows = rows.where("weight > 0").select("group", "low", F.col("low").alias("high"), "total", "weight")
    order = ["group", "low"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pooled, f"group string, {POOL}")
    pools = ranges.repartition("group").sortWithinPartitions(*order).mapInArrow(_pooled, f"group string, {POOL}")
    return pools.select("group", "low", "high", (sign * F.col("total")).alias("total"), "weight", (sign * F.col("total") / F.col("weight")).alias("value"))
