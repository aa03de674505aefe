"""Explanations for linear / scorecard models (EXP-01/02/04/05, WIN-03/04/05, TXT-08).

Contributions are ``coef_j · (x_j − mean_j)``: exact for linear models and
computed per row with column expressions (no shuffle).  Reason codes take the
top k positive contributions per row with ``array_sort`` on the row's own
array, so no ranking window ever spans rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from riskspark.operators.quantiles import exact_quantiles


def contributions(df: DataFrame, coefs: dict[str, float], means: DataFrame) -> DataFrame:
    """EXP-01: adds ``contribs`` ARRAY<STRUCT<feature, value, contrib>>.  ``means`` is one row."""
    m = means.select(F.lit(1).alias("_k"), *[F.col(c).alias(f"_mu_{c}") for c in coefs])
    j = df.withColumn("_k", F.lit(1)).join(m, "_k")
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                             (F.lit(w) * (F.coalesce(F.col(c).cast("double"), F.col(f"_mu_{c}")) - F.col(f"_mu_{c}"))).alias("contrib"))
                    for c, w in coefs.items()])
    return j.withColumn("contribs", arr).drop("_k", *[f"_mu_{c}" for c in coefs])


def _by_abs_desc(a, b):
    return F.when(F.abs(a["contrib"]) > F.abs(b["contrib"]), -1).when(F.abs(a["contrib"]) < F.abs(b["contrib"]), 1) \
            .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0)


def top_k_contribs(contribs: str | Column, k: int, positive_only: bool = False) -> Column:
    """WIN-03: the row's k largest |contrib| (ties by name); optionally positive contributions only."""
    c = F.col(contribs) if isinstance(contribs, str) else contribs
    if positive_only:
        c = F.filter(c, lambda x: x["contrib"] > 0)
    return F.slice(F.array_sort(c, _by_abs_desc), 1, k)


def reason_codes(df: DataFrame, k: int, codes: DataFrame) -> DataFrame:
    """EXP-02: top-k positive contributions mapped to (code, text) through a code
    table joined per exploded reason (at most k rows per input row)."""
    r = df.withColumn("_r", top_k_contribs("contribs", k, positive_only=True))
    e = r.select("*", F.posexplode("_r").alias("reason_rank", "_x")).select("*", "_x.feature", F.col("_x.contrib").alias("reason_contrib"))
    return e.join(codes, "feature", "left").drop("_r", "_x")


def reason_list(contribs: str | Column, k: int, codes: list[tuple[str, str, str]], signs: dict[str, int], positive_only: bool = False) -> Column:
    """EXP-02 as one column, ARRAY<STRUCT<feature, code, text, direction, constraint, value, contrib>>: the row's
    k strongest contributions (ties by name), whether each raises or lowers the risk, and the sign that
    the feature's effect is held to.  Row-local, so it runs in a stream as in a batch."""
    def at(pairs):
        return lambda x: F.try_element_at(F.create_map(*[F.lit(v) for p in pairs for v in p]), x["feature"])

    code, text = at([(f, c) for f, c, _ in codes]), at([(f, t) for f, _, t in codes])
    held = at([(f, "increasing" if s > 0 else "decreasing") for f, s in signs.items()])
    direction = lambda x: F.when(x["contrib"] > 1e-9, "raises").when(x["contrib"] < -1e-9, "lowers").otherwise("none")
    return F.transform(top_k_contribs(contribs, k, positive_only), lambda x: F.struct(
        x["feature"].alias("feature"), code(x).alias("code"), text(x).alias("text"), direction(x).alias("direction"),
        F.coalesce(held(x), F.lit("free")).alias("constraint"), x["value"].alias("value"), x["contrib"].alias("contrib")))


def global_importance(df: DataFrame, k: int) -> DataFrame:
    """WIN-04: mean |contribution| per feature, top k (features-sized result)."""
    e = df.select(F.explode("contribs").alias("c")).select("c.feature", F.abs("c.contrib").alias("a"))
    g = e.groupBy("feature").agg(F.avg("a").alias("mean_abs"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("mean_abs").desc(), "feature"))).where(F.col("rank") <= k)


def importance_by_band(df: DataFrame, band: str) -> DataFrame:
    """EXP-04: mean |contribution| per (band, feature)."""
    e = df.select(band, F.explode("contribs").alias("c")).select(band, "c.feature", F.abs("c.contrib").alias("a"))
    return e.groupBy(band, "feature").agg(F.avg("a").alias("mean_abs"))


def monotonicity_audit(df: DataFrame, features: dict[str, int], score: str, n_bins: int = 10) -> DataFrame:
    """EXP-05: per feature, exact decile bins, mean score per bin, and the number of
    adjacent-bin steps that go against the declared sign (+1 / −1)."""
    from riskspark.operators.drift import unpivot
    lg = unpivot(df, [score], list(features))
    q = [i / n_bins for i in range(1, n_bins)]
    e = exact_quantiles(lg, "v", q, ["feature"], "edges")
    b = lg.join(e, "feature").withColumn("bin", F.size(F.filter("edges", lambda x: x < F.col("v"))))
    g = b.groupBy("feature", "bin").agg(F.avg(score).alias("mean_score"))
    sign = F.create_map(*[F.lit(x) for kv in features.items() for x in kv])
    d = g.withColumn("_d", F.col("mean_score") - F.lag("mean_score").over(Window.partitionBy("feature").orderBy("bin")))
    bad = (F.col("_d") * F.element_at(sign, F.col("feature"))) < 0
    return d.groupBy("feature").agg(F.count(F.lit(1)).alias("n_bins"), F.count_if(bad).alias("violations"))


def adverse_action_draft(reasons: DataFrame, key: str) -> DataFrame:
    """TXT-08: a templated adverse-action draft per row from its (≤ k) reason texts, tagged as a draft."""
    g = reasons.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("reason_rank", "text"))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: F.concat(F.lit("- "), x["text"])), "\n")
    return g.select(key, F.concat(F.lit("[DRAFT - requires human review]\nPrincipal reasons:\n"), body).alias("letter"))
