"""Feature preparation fitted on train rows only (FE-01..04).

Fitted state is always a small DataFrame (one row per feature, or per
feature level / bin) joined back to the data, never a driver-side dict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.drift import unpivot
from riskspark.operators.quantiles import exact_quantiles


def fit_medians(train: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-08 / FE-01: one row with the exact median of each column (train rows)."""
    med = exact_quantiles(unpivot(train, [], cols), "v", [0.5], ["feature"])
    # one number per column: a column without any value has a null median
    return med.agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[0])).alias(c) for c in cols])


def apply_medians(df: DataFrame, medians: DataFrame, cols: list[str]) -> DataFrame:
    m = medians.select(F.lit(1).alias("_k"), *[F.col(c).alias(f"_m_{c}") for c in cols])
    j = df.withColumn("_k", F.lit(1)).join(m, "_k")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")))
    return j.drop("_k", *[f"_m_{c}" for c in cols])


def fit_levels(train: DataFrame, cols: list[str]) -> DataFrame:
    """FE-01: (feature, level, code) with codes 0..k-1 in sorted level order, plus the
    most frequent level per feature (ties -> smallest) flagged ``is_mode``."""
    u = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])).alias("u")).select("u.*")
    g = u.where(F.col("level").isNotNull()).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("feature")  # one partition per feature over its distinct levels
    g = g.withColumn("code", (F.dense_rank().over(w.orderBy("level")) - 1).cast("int"))
    g = g.withColumn("is_mode", (F.row_number().over(w.orderBy(F.col("n").desc(), "level")) == 1).cast("int"))
    return g.select("feature", "level", "code", "is_mode")


def apply_levels(df: DataFrame, levels: DataFrame, cols: list[str]) -> DataFrame:
    """Ordinal-encode: NULL -> most frequent level; unseen levels -> -1."""
    out = df
    for c in cols:
        lv = levels.where(F.col("feature") == c)
        mode = lv.where(F.col("is_mode") == 1).select(F.lit(1).alias("_k"), F.col("level").alias(f"_mode_{c}"))
        out = out.withColumn("_k", F.lit(1)).join(mode, "_k", "left").drop("_k")
        filled = F.coalesce(F.col(c).cast("string"), F.col(f"_mode_{c}"))
        out = out.withColumn(f"_lvl_{c}", filled)
        # one row a level: sent to the rows, which would meet in as many tasks as there are levels
        out = out.join(F.broadcast(lv.select(F.col("level").alias(f"_lvl_{c}"), F.col("code").alias(f"{c}_code"))), f"_lvl_{c}", "left")
        out = out.withColumn(f"{c}_code", F.coalesce(F.col(f"{c}_code"), F.lit(-1))).drop(f"_lvl_{c}", f"_mode_{c}")
    return out


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """FE-02: mean and population std per column (one aggregation)."""
    return train.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"))])


def apply_scaler(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    j = df.withColumn("_k", F.lit(1)).join(stats.withColumn("_k", F.lit(1)), "_k")
    for c in cols:
        j = j.withColumn(f"{c}_z", F.try_divide(F.col(c) - F.col(f"{c}__mean"), F.col(f"{c}__std")))
    return j.drop("_k", *[x for c in cols for x in (f"{c}__mean", f"{c}__std")])


def fit_one_hot(train: DataFrame, cols: list[str]) -> DataFrame:
    """FE-02: one row with the sorted levels of each column in train, an array each (nulls are no level).

    The arrays are as long as a column has levels; no level comes to the driver."""
    return train.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"{c}__levels") for c in cols])


def apply_one_hot(df: DataFrame, levels: DataFrame, cols: list[str]) -> DataFrame:
    """FE-02: per column an array of 0/1, one place a level; a null or a level that train lacks is all zeros."""
    j = df.withColumn("_k", F.lit(1)).join(levels.withColumn("_k", F.lit(1)), "_k")
    for c in cols:
        value = F.col(c).cast("string")
        j = j.withColumn(f"{c}_hot", F.transform(f"{c}__levels", lambda v: F.coalesce((value == v).cast("int"), F.lit(0))))
    return j.drop("_k", *[f"{c}__levels" for c in cols])


def fit_woe(train: DataFrame, cols: list[str], label: str = "y", n_bins: int = 10, smooth: float = 0.5) -> DataFrame:
    """FE-03: equal-frequency bins per feature (exact percentiles of train rows),
    per-bin good/bad counts, WOE = ln(dist_good / dist_bad) with ``smooth`` added
    to every count, IV = Σ (dist_good − dist_bad) · WOE.  Returns
    (feature, bin, edges, n, bad, woe, iv) — iv repeated per feature row."""
    lg = unpivot(train, [label], cols)
    q = [i / n_bins for i in range(1, n_bins)]
    e = exact_quantiles(lg, "v", q, ["feature"], "edges")
    b = lg.join(F.broadcast(e), "feature").withColumn("bin", F.when(F.col("v").isNotNull(), F.size(F.filter("edges", lambda x: x < F.col("v")))).otherwise(-1))
    g = b.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))
    w = Window.partitionBy("feature")
    good = F.col("n") - F.col("bad")
    dg = (good + smooth) / F.sum(good + smooth).over(w)
    db = (F.col("bad") + smooth) / F.sum(F.col("bad") + smooth).over(w)
    g = g.withColumn("woe", F.log(dg / db)).withColumn("_ivp", (dg - db) * F.log(dg / db))
    g = g.withColumn("iv", F.sum("_ivp").over(w)).drop("_ivp")
    return g.join(e, "feature")


def apply_woe(df: DataFrame, woe: DataFrame, cols: list[str]) -> DataFrame:
    """Each value replaced by its bin's WOE (bin found with the fitted edges), null where no row of the fit
    had that bin.  The fit is one row of a map a feature, so that no row is shuffled or multiplied."""
    entries = F.collect_list(F.struct("bin", "woe"))
    fit = woe.groupBy("feature").agg(F.first("edges").alias("edges"), F.map_from_entries(entries).alias("woe"))
    fit = fit.agg(*[F.max_by(F.struct("edges", "woe"), F.col("feature") == c).alias(f"_fit_{c}") for c in cols], *[F.max(F.col("feature") == c).alias(f"_has_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(fit))

    def weight(c: str):
        v, f = F.col(c).cast("double"), F.when(F.col(f"_has_{c}"), F.col(f"_fit_{c}"))
        return F.try_element_at(f["woe"], F.when(v.isNotNull(), F.size(F.filter(f["edges"], lambda x: x < v))).otherwise(-1))

    for c in cols:
        j = j.withColumn(c, weight(c))
    return j.drop(*[f"_{x}_{c}" for c in cols for x in ("fit", "has")])


def top_by(df: DataFrame, metric: str, k: int, name: str = "feature") -> DataFrame:
    """FE-04: top k rows by a metric (distributed top-k; the limit is the feature)."""
    return df.orderBy(F.col(metric).desc(), F.col(name)).limit(k)
