"""Leakage and data-quality operators (LEAK-*, DQ-*, SET-03/04).

Each check is an aggregation over the whole table that yields a small
findings table (check, feature, status, value, detail); several checks are
unioned and rolled up with ``max`` over a severity code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.prefix import score_cdf

# Leakage thresholds.
SUSPICIOUS_NAME = r"(target|label|outcome|default|future|leak|after|result)"
NEAR_UNIQUE = 0.90
HIGH_CORR = 0.85
RATE_GAP = 0.65
RATE_GAP_MAX_UNIQUE = 0.25
SHIFT = 0.35
SEVERITY = {"PASS": 0, "WARN": 1, "FAIL": 2, "INSUFFICIENT_INPUT": 3}


def _finding(check: str, feature: Column | str, status: Column, value: Column, detail: Column | str = "") -> list[Column]:
    f = F.lit(feature) if isinstance(feature, str) else feature
    d = F.lit(detail) if isinstance(detail, str) else detail
    return [F.lit(check).alias("check_name"), f.alias("feature"), status.alias("status"),
            F.round(value.cast("double"), 6).alias("value"), d.alias("detail")]


def suspicious_names(spark: SparkSession, df: DataFrame, pattern: str = SUSPICIOUS_NAME) -> DataFrame:
    """LEAK-01 / FN-11: column names (schema metadata, one row per column) matched with ``rlike``."""
    names = spark.createDataFrame([(c,) for c in df.columns], "feature string")
    hit = F.lower(F.col("feature")).rlike(pattern)
    return names.select(*_finding("suspicious_name", F.col("feature"), F.when(hit, "WARN").otherwise("PASS"), hit.cast("int")))


def near_unique(df: DataFrame, cols: list[str], threshold: float = NEAR_UNIQUE) -> DataFrame:
    """LEAK-02: distinct/rows per column in one aggregation."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_distinct(c).alias(f"_d_{i}") for i, c in enumerate(cols)])
    st = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"_d_{i}") / F.col("_n"))])
    u = agg.select(st.alias("feature", "ratio"))
    return u.select(*_finding("near_unique", F.col("feature"), F.when(F.col("ratio") >= threshold, "WARN").otherwise("PASS"), F.col("ratio")))


def target_correlation(df: DataFrame, cols: list[str], label: str = "y", threshold: float = HIGH_CORR) -> DataFrame:
    """LEAK-03: |Pearson(col, target)| per numeric column in one aggregation."""
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"_c_{i}") for i, c in enumerate(cols)])
    st = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.abs(F.col(f"_c_{i}")))])
    u = agg.select(st.alias("feature", "v"))
    return u.select(*_finding("target_correlation", F.col("feature"), F.when(F.col("v") >= threshold, "FAIL").otherwise("PASS"), F.col("v")))


def target_rate_gap(df: DataFrame, cols: list[str], label: str = "y", threshold: float = RATE_GAP,
                    max_unique: float = RATE_GAP_MAX_UNIQUE, min_support: int = 30) -> DataFrame:
    """LEAK-04: for low-cardinality columns, max − min target rate across values
    with at least ``min_support`` rows (unpivot once, one groupBy).  ``detail`` tells how many
    values are rarer, the rows they hold, and whether a rarer one has a rate beyond the threshold
    from the others': then the check is WARN, not PASS."""
    u = df.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])).alias("u")) \
          .select(label, "u.feature", "u.v")
    g = u.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
    f = g.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"),
        F.max(F.when(F.col("n") >= min_support, F.col("rate"))).alias("hi"),
        F.min(F.when(F.col("n") >= min_support, F.col("rate"))).alias("lo"),
        F.count_if(F.col("n") < min_support).alias("rare"), F.coalesce(F.sum(F.when(F.col("n") < min_support, F.col("n"))), F.lit(0)).alias("rare_rows"),
        (F.max("rate") - F.min("rate")).alias("gap_all"))
    f = f.where(F.col("n_values") / F.col("n_rows") <= max_unique)
    gap = F.coalesce(F.col("hi") - F.col("lo"), F.lit(0.0))
    status = F.when(gap >= threshold, "FAIL").when(F.col("gap_all") >= threshold, "WARN").otherwise("PASS")
    detail = F.when(F.col("rare") > 0, F.format_string(f"%d values under {min_support} rows hold %d rows", "rare", "rare_rows")).otherwise("")
    return f.select(*_finding("target_rate_gap", F.col("feature"), status, gap, detail))


def categorical_shift(df: DataFrame, cols: list[str], split_col: str, a: str, b: str, threshold: float = SHIFT) -> DataFrame:
    """LEAK-05 for categoricals: total variation distance between the level shares of two splits (nulls are a level)."""
    u = df.where(F.col(split_col).isin(a, b)).select((F.col(split_col) == b).cast("int").alias("_side"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])).alias("u")).select("_side", "u.*")
    g = u.groupBy("feature", "v").agg(F.sum("_side").alias("nb"), F.sum(1 - F.col("_side")).alias("na"))
    t = g.groupBy("feature").agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    tv = g.join(t, "feature").groupBy("feature").agg(
        (F.sum(F.abs(F.try_divide(F.col("na"), F.col("ta")) - F.try_divide(F.col("nb"), F.col("tb")))) / 2).alias("tv"))
    return tv.select(*_finding("categorical_shift", F.col("feature"), F.when(F.col("tv") >= threshold, "FAIL").otherwise("PASS"), F.col("tv")))


def split_shift(df: DataFrame, cols: list[str], split_col: str, a: str, b: str, threshold: float = SHIFT) -> DataFrame:
    """LEAK-05: two-sample KS between split ``a`` and ``b`` for each numeric column
    (unpivot, then the distributed prefix sums grouped by feature)."""
    d = df.where(F.col(split_col).isin(a, b))
    u = d.select((F.col(split_col) == b).cast("int").alias("_side"),
                 F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("u")) \
         .select("_side", "u.feature", "u.v")
    c = score_cdf(u, "v", "_side", ["feature"])
    ks = c.groupBy("feature").agg(F.max(F.abs(F.try_divide(F.col("cpos"), F.col("Tpos")) - F.try_divide(F.col("cneg"), F.col("Tneg")))).alias("ks"))
    return ks.select(*_finding("split_shift", F.col("feature"), F.when(F.col("ks") >= threshold, "FAIL").otherwise("PASS"), F.col("ks")))


def temporal_leak(df: DataFrame, feature_ts: str, outcome_ts: str) -> DataFrame:
    """LEAK-06: rows whose feature timestamp is after the outcome timestamp."""
    if feature_ts not in df.columns or outcome_ts not in df.columns:
        return df.sparkSession.range(1).select(*_finding("temporal_leak", feature_ts, F.lit("INSUFFICIENT_INPUT"), F.lit(None)))
    bad = F.count_if(F.col(feature_ts) > F.col(outcome_ts))
    return df.agg(bad.alias("b"), F.count(F.lit(1)).alias("n")).select(
        *_finding("temporal_leak", feature_ts, F.when(F.col("b") > 0, "FAIL").otherwise("PASS"), F.col("b"),
                  F.format_string("%d of %d rows", F.col("b"), F.col("n"))))


def beyond_cutoff(df: DataFrame, ts: str, split_col: str, cutoff: str, train: str = "train") -> DataFrame:
    """LEAK-07: training rows dated beyond the cutoff."""
    bad = F.count_if((F.col(split_col) == train) & (F.col(ts) >= F.to_timestamp(F.lit(cutoff))))
    return df.agg(bad.alias("b")).select(*_finding("beyond_cutoff", ts, F.when(F.col("b") > 0, "FAIL").otherwise("PASS"), F.col("b")))


def rollup(findings: list[DataFrame]) -> DataFrame:
    """LEAK-08: union of findings plus an overall row (worst status wins)."""
    allf = reduce(DataFrame.unionByName, findings)
    sev = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    overall = allf.agg(F.max(F.element_at(sev, F.col("status"))).alias("s"), F.count_if(F.col("status") != "PASS").alias("k")).select(
        F.lit("overall").alias("check_name"), F.lit("*").alias("feature"),
        F.element_at(F.map_from_entries(F.array(*[F.struct(F.lit(v), F.lit(k)) for k, v in SEVERITY.items()])), F.col("s")).alias("status"),
        F.col("k").cast("double").alias("value"), F.lit("").alias("detail"))
    return allf.unionByName(overall)


def entity_contamination(df: DataFrame, entity: str, split_col: str, a: str = "train", b: str = "val",
                         split_name: str = "split", n_examples: int = 10) -> DataFrame:
    """LEAK-09: ids present on both sides (semi-join on distinct ids), their
    share of side-b ids, PASS/FAIL and the smallest ``n_examples`` ids."""
    d = df.where(F.col(split_col).isin(a, b))
    per = d.groupBy(entity).agg(F.max((F.col(split_col) == a).cast("int")).alias("_a"),
                                F.max((F.col(split_col) == b).cast("int")).alias("_b"))
    stats = d.agg(F.count_if(F.col(split_col) == a).alias("n_a"), F.count_if(F.col(split_col) == b).alias("n_b"))
    ids = per.agg(F.sum("_a").alias("uniq_a"), F.sum("_b").alias("uniq_b"), F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("overlap"))
    ex = per.where((F.col("_a") == 1) & (F.col("_b") == 1)).select(entity).orderBy(entity).limit(n_examples) \
            .agg(F.array_join(F.sort_array(F.collect_list(F.col(entity).cast("string"))), ",").alias("examples"))
    one = stats.withColumn("_k", F.lit(1)).join(ids.withColumn("_k", F.lit(1)), "_k").join(ex.withColumn("_k", F.lit(1)), "_k", "left")
    return one.select(
        F.lit(split_name).alias("split_name"), "n_a", "n_b", F.col("uniq_a").cast("long").alias("uniq_a"),
        F.col("uniq_b").cast("long").alias("uniq_b"), "overlap",
        F.when(F.col("overlap") > 0, "FAIL").otherwise("PASS").alias("status"),
        F.round(F.coalesce(F.try_divide(100.0 * F.col("overlap"), F.col("uniq_b")), F.lit(0.0)), 3).alias("contamination_pct"),
        F.coalesce(F.col("examples"), F.lit("")).alias("examples"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """SET-03: number of surplus copies of fully identical rows."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"), F.count(F.lit(1)).alias("distinct_rows"))


def domain_violations(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """SET-04: distinct values outside the allowed set (``except`` on distinct values)."""
    spark = df.sparkSession
    allowed_df = spark.createDataFrame([(v,) for v in allowed], df.select(col).schema)
    return df.select(col).distinct().exceptAll(allowed_df)


def contract_checks(df: DataFrame, key: str, label: str | None, expected_cols: list[str]) -> DataFrame:
    """DQ-01/02/03: named PASS/FAIL checks from one aggregation, stacked into
    (check, result, detail).  Column-name checks come from the schema."""
    cols = df.columns
    missing = sorted(set(expected_cols) - set(cols))
    aggs = [F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("nd"), F.min(key).alias("kmin"), F.max(key).alias("kmax"),
            F.count_if(F.col(key).isNull()).alias("knull"),
            reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols]).alias("nulls")]
    if label:
        aggs += [F.count_if(F.col(label) == 1).alias("pos"), F.count_if(~F.col(label).isin(0, 1)).alias("badlab")]
    a = df.agg(*aggs)
    checks = [
        ("row_count_positive", F.col("n") > 0, F.format_string("%d rows", F.col("n"))),
        ("columns_present", F.lit(not missing), F.lit(",".join(missing) or "all present")),
        ("key_not_null", F.col("knull") == 0, F.format_string("%d null keys", F.col("knull"))),
        ("key_unique", F.col("nd") == F.col("n"), F.format_string("%d distinct of %d", F.col("nd"), F.col("n"))),
        ("key_sequential", (F.col("kmax") - F.col("kmin") + 1 == F.col("n")) & (F.col("nd") == F.col("n")),
         F.format_string("range %d..%d", F.col("kmin"), F.col("kmax"))),
        ("no_nulls", F.col("nulls") == 0, F.format_string("%d null cells", F.col("nulls"))),
    ]
    if label:
        checks += [("label_binary", F.col("badlab") == 0, F.format_string("%d non-binary", F.col("badlab"))),
                   ("label_rate", (F.col("pos") > 0) & (F.col("pos") < F.col("n")), F.format_string("%.6f", F.col("pos") / F.col("n")))]
    st = F.stack(F.lit(len(checks)), *[x for name, ok, det in checks for x in (F.lit(name), F.when(ok, "PASS").otherwise("FAIL"), det)])
    return a.select(st.alias("check", "result", "detail"))


def split_consistency(df: DataFrame, split_col: str, label: str, tol: float = 0.10) -> DataFrame:
    """DQ-04 / AGG-22: size and label rate per split; relative rate drift vs the
    overall rate must stay under ``tol``."""
    g = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
    tot = df.agg(F.avg(label).alias("overall")).withColumn("_k", F.lit(1))
    j = g.withColumn("_k", F.lit(1)).join(tot, "_k")
    drift = F.abs(F.col("rate") - F.col("overall")) / F.col("overall")
    return j.select(split_col, "n", F.round("rate", 6).alias("rate"), F.round(drift, 6).alias("rel_drift"),
                    F.when(drift < tol, "PASS").otherwise("FAIL").alias("status"))


# Fixed value: the modulus of the fingerprint's sums.
FINGERPRINT_MODULUS = 2 ** 61


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row's cells in column order, each with its length in front, a null as ``N``: no two
    different rows have the same text.  Fractions are compared to six decimals."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = c.cast("decimal(38,6)").cast("string") if f.dataType.typeName() in ("double", "float") else c.cast("string")
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.md5(F.concat_ws("|", *cells))


def fingerprint(df: DataFrame) -> DataFrame:
    """DQ-06: fingerprint of a table as a multiset of rows: row count, two lanes of the rows' digests
    summed modulo 2^61, null count of each column in column order, and one SHA-256 of them all.

    Row order and partitions change nothing; one changed cell or one more copy of a row does."""
    lane = lambda at: F.conv(F.substring("_d", at, 15), 16, 10).cast("decimal(20,0)")
    total = lambda c: F.coalesce(F.sum(c) % F.lit(FINGERPRINT_MODULUS).cast("decimal(20,0)"), F.lit(0)).cast("long")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).cast("string") for c in df.columns]
    g = df.withColumn("_d", row_digest(df)).agg(F.count(F.lit(1)).alias("n"), total(lane(1)).alias("lane1"), total(lane(16)).alias("lane2"),
                                                F.concat_ws(",", *nulls).alias("null_counts"))
    return g.withColumn("fingerprint", F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("n", "lane1", "lane2", "null_counts")]), 256))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """DQ-07: failed rule names per row (NULL predicate counts as failed);
    rows with a non-empty list go to quarantine."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules.items()]))
    return df.withColumn("failed_rules", failed).withColumn("quarantined", (F.size("failed_rules") > 0).cast("int"))
