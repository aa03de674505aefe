"""Deterministic splitting (SPL-01..04) and sampling.

All randomness is an md5 of the key and a salt, identical in Spark and in the
SQL oracle.  The exact stratified split ranks rows inside each stratum by
hash without a per-stratum global sort: the first three hex digits of the
hash give 4 096 ordered buckets; bucket counts are cumulated on the small
(stratum, bucket) table, and ``row_number`` runs only inside each
(stratum, bucket) partition.  A stratum holding a third of all rows is spread
over 4 096 tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import stable_unit
from riskspark.plans.frames import SPLIT_SALT


def key_hash(key: str, salt: str = SPLIT_SALT) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))


def rank_within(df: DataFrame, strata: list[str], key: str, salt: str = SPLIT_SALT, hex_digits: int = 3) -> DataFrame:
    """Adds ``_r`` (1-based rank by (hash, key) inside each stratum) and ``_ns`` (stratum size).

    ``hex_digits`` sets the ordered hash buckets per stratum (16^digits): 3 -> 4 096
    (≈ 250 k rows per window partition at 10^9 rows); use 5 (≈ 10^6 buckets) for
    10^12-row inputs."""
    b = df.withColumn("_h", key_hash(key, salt)).withColumn("_bk", F.conv(F.substring("_h", 1, hex_digits), 16, 10).cast("long"))
    cnt = b.groupBy(*strata, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(*strata).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_off", F.coalesce(F.sum("_c").over(w_off), F.lit(0))) \
             .withColumn("_ns", F.sum("_c").over(Window.partitionBy(*strata))).drop("_c")
    b = b.join(cnt, strata + ["_bk"])  # ≤ 4096 rows per stratum; AQE broadcasts it
    w = Window.partitionBy(*strata, "_bk").orderBy("_h", key)
    return b.withColumn("_r", F.col("_off") + F.row_number().over(w)).drop("_off", "_bk")


def allocate(sizes: DataFrame, strata: list[str], n_col: str, num: int, den: int, out: str) -> DataFrame:
    """Largest-remainder allocation of ceil(total·num/den) over strata, integer
    arithmetic only (exact overall size, per-stratum shares within one row).
    ``sizes`` has one row per stratum (a label-sized table)."""
    k = F.col(n_col) * F.lit(num)
    s = sizes.withColumn("_base", F.floor(k / F.lit(den)).cast("long")).withColumn("_rem", (k % F.lit(den)).cast("long"))
    s = s.withColumn("_one", F.lit(1))
    wa = Window.partitionBy("_one")
    s = s.withColumn("_need", F.floor((F.sum(n_col).over(wa) * F.lit(num) + F.lit(den - 1)) / F.lit(den)).cast("long") - F.sum("_base").over(wa))
    s = s.withColumn("_ord", F.row_number().over(Window.partitionBy("_one").orderBy(F.col("_rem").desc(), *strata)))
    return s.withColumn(out, F.col("_base") + (F.col("_ord") <= F.col("_need")).cast("long")).drop("_base", "_rem", "_one", "_need", "_ord")


def stratified_split(df: DataFrame, strata: list[str], key: str, test_frac=(1, 5), val_frac_of_rest=(1, 4),
                     salt: str = SPLIT_SALT, hex_digits: int = 3) -> DataFrame:
    """SPL-01: exact stratified train/val/test split (default 60/20/20):
    test = ceil(n/5) rows overall, val = ceil(rest/4); both allocated to strata
    by largest remainder; inside a stratum the lowest hashes go to test, then val."""
    r = rank_within(df, strata, key, salt, hex_digits)
    sizes = r.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    sizes = allocate(sizes, strata, "_n", test_frac[0], test_frac[1], "_test")
    sizes = sizes.withColumn("_rest", F.col("_n") - F.col("_test"))
    sizes = allocate(sizes, strata, "_rest", val_frac_of_rest[0], val_frac_of_rest[1], "_val").select(*strata, "_test", "_val")
    j = r.join(sizes, strata)  # one row per stratum
    split = F.when(F.col("_r") <= F.col("_test"), "test").when(F.col("_r") <= F.col("_test") + F.col("_val"), "val").otherwise("train")
    return j.withColumn("split", split).drop("_h", "_r", "_ns", "_test", "_val")


def entity_split(df: DataFrame, entity: str, test: float = 0.2, val: float = 0.2, salt: str = SPLIT_SALT) -> DataFrame:
    """SPL-02: every row of an entity on one side (hash of the entity, not the row)."""
    u = stable_unit(entity, salt)
    return df.withColumn("split", F.when(u < test, "test").when(u < test + val, "val").otherwise("train"))


def row_split(df: DataFrame, key: str, test: float = 0.2, val: float = 0.2, salt: str = SPLIT_SALT) -> DataFrame:
    """Row-level hash split (contaminates entities by construction)."""
    return entity_split(df, key, test, val, salt)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """SPL-03: n rows chosen by md5(seed:key) order (distributed top-n, no global sort)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def time_split(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """SPL-04: out-of-time split at a date cutoff."""
    return df.withColumn("split", F.when(F.col(ts) < F.to_timestamp(F.lit(cutoff)), "train").otherwise("test"))
