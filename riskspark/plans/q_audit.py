"""Split, leakage, data-quality and set-operation queries (SPL, LEAK, DQ, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import audit as au
from riskspark.operators import split as sp
from riskspark.plans.catalog import ORACLE, register
from riskspark.plans.frames import LEAK_SQL, SCORED_SQL, leak_frame, scored, split_unit_sql
from riskspark.sources import io
from riskspark.sources.io import table
from riskspark.streaming.stream import scratch

S = f"s AS ({SCORED_SQL})"
L = f"l AS ({LEAK_SQL})"

SPL01_SQL = f"""
WITH {S}, r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR) || ':split42'), id) AS r FROM s),
sz AS (SELECT y, count(*) AS n FROM s GROUP BY y),
a1 AS (SELECT y, n, n // 5 AS base, (sum(n) OVER () + 4) // 5 - sum(n // 5) OVER () AS need,
        row_number() OVER (ORDER BY n % 5 DESC, y) AS ord FROM sz),
t AS (SELECT y, n, base + CASE WHEN ord <= need THEN 1 ELSE 0 END AS test FROM a1),
a2 AS (SELECT y, test, (n - test) // 4 AS base, (sum(n - test) OVER () + 3) // 4 - sum((n - test) // 4) OVER () AS need,
        row_number() OVER (ORDER BY (n - test) % 4 DESC, y) AS ord FROM t),
v AS (SELECT y, test, base + CASE WHEN ord <= need THEN 1 ELSE 0 END AS val FROM a2)
SELECT id, y, CASE WHEN r <= test THEN 'test' WHEN r <= test + val THEN 'val' ELSE 'train' END AS split FROM r JOIN v USING (y)"""


@register("spl01_stratified_split", SPL01_SQL)
def q_spl01(spark, sf):
    s = scored(spark, sf, with_group=False).select("id", "y")
    return sp.stratified_split(s, ["y"], "id").select("id", "y", "split")


@register("spl02_entity_split", f"""
WITH {S} SELECT id, entity, CASE WHEN {split_unit_sql('entity')} < 0.2 THEN 'test' WHEN {split_unit_sql('entity')} < 0.4 THEN 'val' ELSE 'train' END AS split FROM s""")
def q_spl02(spark, sf):
    return sp.entity_split(scored(spark, sf, with_group=False).select("id", "entity"), "entity")


@register("spl03_seeded_sample", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 500""")
def q_spl03(spark, sf):
    """SPL-03: the limit is the feature (a seeded n-row sample)."""
    return sp.seeded_sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500)


@register("spl04_time_split", f"""
WITH {S} SELECT CASE WHEN ts < TIMESTAMP '2000-01-01 00:00:00' THEN 'train' ELSE 'test' END AS split, count(*) AS n, round(avg(y), 6) AS rate
FROM s GROUP BY split""")
def q_spl04(spark, sf):
    s = sp.time_split(scored(spark, sf, with_group=False), "ts", "2000-01-01 00:00:00")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("rate"))


NUM = ["p_raw", "outcome_proxy", "nation"]
CAT = ["grp", "o_orderpriority", "o_orderstatus", "nation"]


@register("leak02_near_unique", f"""
WITH {L}, a AS (SELECT count(*) AS n, count(DISTINCT id) AS d0, count(DISTINCT p_raw) AS d1, count(DISTINCT grp) AS d2, count(DISTINCT outcome_proxy) AS d3 FROM l)
SELECT 'near_unique' AS check_name, feature, CASE WHEN ratio >= 0.9 THEN 'WARN' ELSE 'PASS' END AS status, round(ratio, 6) AS value, '' AS detail
FROM (SELECT 'id' AS feature, d0 / n AS ratio FROM a UNION ALL SELECT 'p_raw', d1 / n FROM a UNION ALL SELECT 'grp', d2 / n FROM a
      UNION ALL SELECT 'outcome_proxy', d3 / n FROM a)""")
def q_leak02(spark, sf):
    return au.near_unique(leak_frame(spark, sf), ["id", "p_raw", "grp", "outcome_proxy"])


@register("leak03_target_correlation", f"""
WITH {L}, a AS (SELECT corr(p_raw, y) AS c0, corr(outcome_proxy, y) AS c1, corr(CAST(nation AS DOUBLE), y) AS c2 FROM l)
SELECT 'target_correlation' AS check_name, feature, CASE WHEN v >= 0.85 THEN 'FAIL' ELSE 'PASS' END AS status, round(v, 6) AS value, '' AS detail
FROM (SELECT 'p_raw' AS feature, abs(c0) AS v FROM a UNION ALL SELECT 'outcome_proxy', abs(c1) FROM a UNION ALL SELECT 'nation', abs(c2) FROM a)""")
def q_leak03(spark, sf):
    return au.target_correlation(leak_frame(spark, sf), NUM)


@register("leak04_target_rate_gap", f"""
WITH {L}, u AS (SELECT 'grp' AS feature, CAST(grp AS VARCHAR) AS v, y FROM l UNION ALL SELECT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR), y FROM l
  UNION ALL SELECT 'o_orderstatus', CAST(o_orderstatus AS VARCHAR), y FROM l UNION ALL SELECT 'nation', CAST(nation AS VARCHAR), y FROM l),
g AS (SELECT feature, v, count(*) AS n, avg(y) AS rate FROM u GROUP BY feature, v),
f AS (SELECT feature, count(*) AS n_values, sum(n) AS n_rows, max(CASE WHEN n >= 30 THEN rate END) AS hi, min(CASE WHEN n >= 30 THEN rate END) AS lo,
  count(*) FILTER (WHERE n < 30) AS rare, coalesce(sum(n) FILTER (WHERE n < 30), 0) AS rare_rows, max(rate) - min(rate) AS gap_all FROM g GROUP BY feature)
SELECT 'target_rate_gap' AS check_name, feature, CASE WHEN coalesce(hi - lo, 0.0) >= 0.65 THEN 'FAIL' WHEN gap_all >= 0.65 THEN 'WARN' ELSE 'PASS' END AS status,
  round(coalesce(hi - lo, 0.0), 6) AS value, CASE WHEN rare > 0 THEN rare || ' values under 30 rows hold ' || CAST(rare_rows AS BIGINT) || ' rows' ELSE '' END AS detail FROM f WHERE n_values / n_rows <= 0.25""")
def q_leak04(spark, sf):
    return au.target_rate_gap(leak_frame(spark, sf), CAT)


@register("leak05_split_shift", f"""
WITH {L}, u AS (SELECT CAST(split = 'test' AS INTEGER) AS side, 'p_raw' AS feature, p_raw AS v FROM l WHERE split IN ('train', 'test')
  UNION ALL SELECT CAST(split = 'test' AS INTEGER), 'outcome_proxy', outcome_proxy FROM l WHERE split IN ('train', 'test')),
d AS (SELECT feature, v, sum(side) AS pos, sum(1 - side) AS neg FROM u GROUP BY feature, v),
c AS (SELECT feature, sum(pos) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(pos) OVER (PARTITION BY feature) AS fa,
             sum(neg) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(neg) OVER (PARTITION BY feature) AS fb FROM d)
SELECT 'split_shift' AS check_name, feature, CASE WHEN max(abs(fa - fb)) >= 0.35 THEN 'FAIL' ELSE 'PASS' END AS status, round(max(abs(fa - fb)), 6) AS value, '' AS detail
FROM c GROUP BY feature""")
def q_leak05(spark, sf):
    return au.split_shift(leak_frame(spark, sf), ["p_raw", "outcome_proxy"], "split", "train", "test")


CATS = ["grp", "o_orderpriority", "o_orderstatus"]


@register("leak05_categorical_shift", f"""
WITH {L}, u AS ({" UNION ALL ".join(f"SELECT split, '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM l WHERE split IN ('train', 'test')" for c in CATS)}),
g AS (SELECT feature, v, count(*) FILTER (WHERE split = 'train') AS na, count(*) FILTER (WHERE split = 'test') AS nb FROM u GROUP BY feature, v),
t AS (SELECT feature, sum(abs(na / ta - nb / tb)) / 2 AS tv FROM (SELECT *, sum(na) OVER (PARTITION BY feature) AS ta, sum(nb) OVER (PARTITION BY feature) AS tb FROM g) GROUP BY feature)
SELECT 'categorical_shift' AS check_name, feature, CASE WHEN tv >= 0.35 THEN 'FAIL' ELSE 'PASS' END AS status, round(tv, 6) AS value, '' AS detail FROM t""")
def q_leak05c(spark, sf):
    """LEAK-05: total variation of the categoricals between train and test."""
    return au.categorical_shift(leak_frame(spark, sf), CATS, "split", "train", "test")


@register("leak06_temporal_leak", f"""
WITH {L} SELECT 'temporal_leak' AS check_name, 'feature_ts' AS feature,
  CASE WHEN count(*) FILTER (WHERE feature_ts > outcome_ts) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  round(CAST(count(*) FILTER (WHERE feature_ts > outcome_ts) AS DOUBLE), 6) AS value,
  printf('%d of %d rows', count(*) FILTER (WHERE feature_ts > outcome_ts), count(*)) AS detail FROM l""")
def q_leak06(spark, sf):
    return au.temporal_leak(leak_frame(spark, sf), "feature_ts", "outcome_ts")


@register("leak07_beyond_cutoff", f"""
WITH {L} SELECT 'beyond_cutoff' AS check_name, 'outcome_ts' AS feature,
  CASE WHEN count(*) FILTER (WHERE split = 'train' AND outcome_ts >= TIMESTAMP '2001-01-01 00:00:00') > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  round(CAST(count(*) FILTER (WHERE split = 'train' AND outcome_ts >= TIMESTAMP '2001-01-01 00:00:00') AS DOUBLE), 6) AS value, '' AS detail FROM l""")
def q_leak07(spark, sf):
    return au.beyond_cutoff(leak_frame(spark, sf), "outcome_ts", "split", "2001-01-01 00:00:00")


@register("leak08_audit_report")
def q_leak08(spark, sf):
    """LEAK-01..08 roll-up: every finding plus the overall (worst) status."""
    lf = leak_frame(spark, sf)
    return au.rollup([
        au.suspicious_names(spark, lf), au.near_unique(lf, ["id", "p_raw", "grp", "outcome_proxy"]),
        au.target_correlation(lf, NUM), au.target_rate_gap(lf, CAT),
        au.split_shift(lf, ["p_raw", "outcome_proxy"], "split", "train", "test"),
        au.temporal_leak(lf, "feature_ts", "outcome_ts"), au.beyond_cutoff(lf, "outcome_ts", "split", "2001-01-01 00:00:00")])


def contamination_sql(split_expr: str, name: str, src: str = "s") -> str:
    return f"""
SELECT '{name}' AS split_name, n_a, n_b, uniq_a, uniq_b, overlap, CASE WHEN overlap > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  round(coalesce(100.0 * overlap / uniq_b, 0.0), 3) AS contamination_pct, coalesce(examples, '') AS examples
FROM (SELECT count(*) FILTER (WHERE sp = 'train') AS n_a, count(*) FILTER (WHERE sp = 'val') AS n_b FROM (SELECT {split_expr} AS sp FROM {src}) WHERE sp IN ('train', 'val')) x,
 (SELECT CAST(sum(a) AS BIGINT) AS uniq_a, CAST(sum(b) AS BIGINT) AS uniq_b, count(*) FILTER (WHERE a = 1 AND b = 1) AS overlap,
         (SELECT string_agg(CAST(entity AS VARCHAR), ',' ORDER BY CAST(entity AS VARCHAR)) FROM (SELECT entity FROM p2 WHERE a = 1 AND b = 1 ORDER BY entity LIMIT 10)) AS examples
  FROM p2) y"""


def _pe(split_expr, src="s"):
    return f"p2 AS (SELECT entity, max(CAST(sp = 'train' AS INTEGER)) AS a, max(CAST(sp = 'val' AS INTEGER)) AS b FROM (SELECT entity, {split_expr} AS sp FROM {src}) WHERE sp IN ('train', 'val') GROUP BY entity)"


ROW_SPLIT = f"CASE WHEN {split_unit_sql('id')} < 0.2 THEN 'test' WHEN {split_unit_sql('id')} < 0.4 THEN 'val' ELSE 'train' END"
ENT_SPLIT = f"CASE WHEN {split_unit_sql('entity')} < 0.2 THEN 'test' WHEN {split_unit_sql('entity')} < 0.4 THEN 'val' ELSE 'train' END"


@register("leak09_entity_contamination", f"""
WITH {S}, {_pe(ROW_SPLIT)} {contamination_sql(ROW_SPLIT, 'row_split')}
UNION ALL
(WITH {S}, {_pe(ENT_SPLIT)} {contamination_sql(ENT_SPLIT, 'entity_split')})""")
def q_leak09(spark, sf):
    s = scored(spark, sf, with_group=False).select("id", "entity")
    a = au.entity_contamination(sp.row_split(s, "id"), "entity", "split", split_name="row_split")
    b = au.entity_contamination(sp.entity_split(s, "entity"), "entity", "split", split_name="entity_split")
    return a.unionByName(b)


@register("leak10_injected_contamination", f"""
WITH {S}, e AS (SELECT id, entity, {ENT_SPLIT} AS sp FROM s),
inj AS (SELECT id, entity, 'val' AS sp FROM (SELECT * FROM e WHERE sp = 'train' ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 500)),
u AS (SELECT * FROM e UNION ALL SELECT * FROM inj), {_pe('sp', 'u')} {contamination_sql('sp', 'injected', 'u')}""")
def q_leak10(spark, sf):
    """LEAK-10 with SPL-03 + SET-01: 500 train rows copied into val must FAIL."""
    s = sp.entity_split(scored(spark, sf, with_group=False).select("id", "entity"), "entity")
    inj = sp.seeded_sample(s.where(F.col("split") == "train"), "id", 500).withColumn("split", F.lit("val"))
    return au.entity_contamination(s.unionByName(inj), "entity", "split", split_name="injected")


@register("dq01_contract_checks", """
WITH a AS (SELECT count(*) AS n, count(DISTINCT c_custkey) AS nd, min(c_custkey) AS kmin, max(c_custkey) AS kmax,
  count(*) FILTER (WHERE c_custkey IS NULL) AS knull,
  count(*) FILTER (WHERE c_custkey IS NULL) + count(*) FILTER (WHERE c_name IS NULL) + count(*) FILTER (WHERE c_nationkey IS NULL)
  + count(*) FILTER (WHERE c_acctbal IS NULL) + count(*) FILTER (WHERE c_mktsegment IS NULL) AS nulls FROM customer)
SELECT 'row_count_positive' AS "check", CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS result, printf('%d rows', n) AS detail FROM a
UNION ALL SELECT 'columns_present', 'PASS', 'all present' FROM a
UNION ALL SELECT 'key_not_null', CASE WHEN knull = 0 THEN 'PASS' ELSE 'FAIL' END, printf('%d null keys', knull) FROM a
UNION ALL SELECT 'key_unique', CASE WHEN nd = n THEN 'PASS' ELSE 'FAIL' END, printf('%d distinct of %d', nd, n) FROM a
UNION ALL SELECT 'key_sequential', CASE WHEN kmax - kmin + 1 = n AND nd = n THEN 'PASS' ELSE 'FAIL' END, printf('range %d..%d', kmin, kmax) FROM a
UNION ALL SELECT 'no_nulls', CASE WHEN nulls = 0 THEN 'PASS' ELSE 'FAIL' END, printf('%d null cells', nulls) FROM a""")
def q_dq01(spark, sf):
    return au.contract_checks(table(spark, sf, "customer"), "c_custkey", None,
                              ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


@register("dq04_split_consistency", f"""
WITH {S}, g AS (SELECT {ROW_SPLIT} AS split, count(*) AS n, avg(y) AS rate FROM s GROUP BY split), o AS (SELECT avg(y) AS overall FROM s)
SELECT split, n, round(rate, 6) AS rate, round(abs(rate - overall) / overall, 6) AS rel_drift,
  CASE WHEN abs(rate - overall) / overall < 0.1 THEN 'PASS' ELSE 'FAIL' END AS status FROM g, o""")
def q_dq04(spark, sf):
    return au.split_consistency(sp.row_split(scored(spark, sf, with_group=False), "id"), "split", "y")


LINEITEM_CELLS = [("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False), ("l_linenumber", False), ("l_quantity", True), ("l_extendedprice", True),
                  ("l_discount", True), ("l_tax", True), ("l_returnflag", False), ("l_linestatus", False), ("l_shipdate", False)]


def _cell_sql(name: str, fraction: bool) -> str:
    text = f"CAST(CAST({name} AS DECIMAL(38, 6)) AS VARCHAR)" if fraction else f"CAST({name} AS VARCHAR)"
    return f"coalesce(length({text}) || ':' || {text}, 'N')"


@register("dq06_fingerprint", f"""
WITH d AS (SELECT *, md5(concat_ws('|', {", ".join(_cell_sql(*c) for c in LINEITEM_CELLS)})) AS d FROM lineitem),
g AS (SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) % {au.FINGERPRINT_MODULUS} AS BIGINT) AS lane1,
  CAST(sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) % {au.FINGERPRINT_MODULUS} AS BIGINT) AS lane2,
  concat_ws(',', {", ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c, _ in LINEITEM_CELLS)}) AS null_counts FROM d)
SELECT *, sha256(concat_ws('|', n, lane1, lane2, null_counts)) AS fingerprint FROM g""")
def q_dq06(spark, sf):
    """DQ-06: fingerprint of all rows and columns of lineitem."""
    return au.fingerprint(table(spark, sf, "lineitem"))


@register("dq07_quarantine", """
WITH q AS (SELECT list_filter([CASE WHEN NOT coalesce(nullif(l_discount, 0) IS NOT NULL, false) THEN 'discount_present' END,
                               CASE WHEN NOT coalesce(nullif(l_tax, 0) IS NOT NULL, false) THEN 'tax_present' END,
                               CASE WHEN NOT coalesce(l_quantity > 0, false) THEN 'quantity_positive' END], lambda x: x IS NOT NULL) AS failed FROM lineitem)
SELECT rule, count(*) AS n FROM (SELECT unnest(failed) AS rule FROM q) GROUP BY rule
UNION ALL SELECT '<none>', count(*) FROM q WHERE len(failed) = 0""")
def q_dq07(spark, sf):
    li = table(spark, sf, "lineitem")
    q = au.quarantine(li, {"discount_present": F.nullif("l_discount", F.lit(0.0)).isNotNull(),
                           "tax_present": F.nullif("l_tax", F.lit(0.0)).isNotNull(),
                           "quantity_positive": F.col("l_quantity") > 0})
    per_rule = q.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    clean = q.where(F.col("quarantined") == 0).agg(F.count(F.lit(1)).alias("n")).select(F.lit("<none>").alias("rule"), "n")
    return per_rule.unionByName(clean)


# Which lines the quarantine query breaks, by the first hex digit of md5(key:line:damage).
DAMAGE = {"0": "short", "1": "long", "2": "mistyped", "3": "open_quote"}
QUARANTINE_SCHEMA = "l_orderkey long, l_linenumber int, l_quantity double, l_tax double, l_shipdate timestamp_ntz"


@register("dq07_reader_quarantine", f"""
WITH d AS (SELECT *, substr(md5(l_orderkey || ':' || l_linenumber || ':damage'), 1, 1) AS h FROM lineitem),
r AS (SELECT l_orderkey, list_filter([CASE h {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DAMAGE.items())} END,
  CASE WHEN h > '3' AND NOT coalesce(l_quantity <= 40, false) THEN 'quantity_in_range' END, CASE WHEN h > '3' AND NOT coalesce(l_tax > 0, false) THEN 'tax_present' END], lambda x: x IS NOT NULL) AS failed FROM d)
SELECT CASE WHEN len(failed) = 0 THEN 'clean' ELSE 'quarantine' END AS status, coalesce(list_aggregate(failed, 'string_agg', ','), '') AS reasons, count(*) AS n, CAST(sum(CASE WHEN len(failed) = 0 THEN l_orderkey END) AS BIGINT) AS keys
FROM (SELECT l_orderkey, failed FROM r) GROUP BY ALL""")
def q_dq07_reader(spark, sf):
    """DQ-07: lineitem as CSV lines, some cut short, too long, mistyped or with an open quote, read
    permissively, tested by two rules and written in one pass to a clean and a quarantine table."""
    li = table(spark, sf, "lineitem")
    cells = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_shipdate"]
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells}
    text["l_shipdate"] = F.coalesce(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    h = F.substring(F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber", F.lit("damage"))), 1, 1)
    whole = F.concat_ws(",", *text.values())
    line = F.when(h == "0", F.concat_ws(",", *list(text.values())[:4])).when(h == "1", F.concat(whole, F.lit(",extra"))) \
            .when(h == "2", F.concat_ws(",", text["l_orderkey"], text["l_linenumber"], F.lit("many"), text["l_tax"], text["l_shipdate"])) \
            .when(h == "3", F.concat_ws(",", text["l_orderkey"], text["l_linenumber"], F.concat(F.lit('"'), text["l_quantity"]), text["l_tax"], text["l_shipdate"])) \
            .otherwise(whole)
    base = scratch(spark, "dq07")
    li.select(line.alias("value")).write.text(f"{base}/lines")
    schema = T.StructType.fromDDL(QUARANTINE_SCHEMA)
    read = io.read_csv_permissive(spark, f"{base}/lines", schema, header=False)
    q = au.quarantine(read, {"quantity_in_range": F.col("l_quantity") <= 40, "tax_present": F.col("l_tax") > 0})
    fault = io.line_fault(len(schema))
    io.write_quarantined(q, F.when(fault.isNotNull(), F.array(fault)).otherwise(F.col("failed_rules")), f"{base}/split")
    out = spark.read.parquet(f"{base}/split")
    return out.groupBy("status", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("status") == "clean", F.col("l_orderkey"))).alias("keys"))


@register("set02_intersect_entities", f"""
WITH {S} SELECT count(*) AS n_shared FROM (SELECT entity FROM s WHERE {ROW_SPLIT} = 'train' INTERSECT SELECT entity FROM s WHERE {ROW_SPLIT} = 'val')""")
def q_set02(spark, sf):
    s = sp.row_split(scored(spark, sf, with_group=False).select("id", "entity"), "id")
    both = s.where(F.col("split") == "train").select("entity").intersect(s.where(F.col("split") == "val").select("entity"))
    return both.agg(F.count(F.lit(1)).alias("n_shared"))


@register("set03_duplicate_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, count(*) AS distinct_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY ALL_COLS_PLACEHOLDER)""".replace(
    "ALL_COLS_PLACEHOLDER", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"))
def q_set03(spark, sf):
    return au.duplicate_rows(table(spark, sf, "lineitem"))


@register("set04_domain_check", "SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')")
def q_set04(spark, sf):
    return au.domain_violations(table(spark, sf, "lineitem"), "l_returnflag", ["A", "N"])


LEAK_COLS = ["id", "entity", "y", "p_raw", "grp", "nation", "o_orderpriority", "o_orderstatus", "outcome_ts", "feature_ts",
             "outcome_proxy", "split"]
_NAMES = ", ".join(f"('{c}')" for c in LEAK_COLS)
_PARTS = [ORACLE[k].strip() for k in ("leak02_near_unique", "leak03_target_correlation", "leak04_target_rate_gap",
                                       "leak05_split_shift", "leak06_temporal_leak", "leak07_beyond_cutoff")]
ORACLE["leak08_audit_report"] = f"""
WITH names AS (SELECT * FROM (VALUES {_NAMES}) t(feature)),
sn AS (SELECT 'suspicious_name' AS check_name, feature, CASE WHEN regexp_matches(lower(feature), '{au.SUSPICIOUS_NAME}') THEN 'WARN' ELSE 'PASS' END AS status,
         round(CAST(regexp_matches(lower(feature), '{au.SUSPICIOUS_NAME}') AS INTEGER), 6) AS value, '' AS detail FROM names),
allf AS (SELECT * FROM sn {" ".join(f"UNION ALL SELECT * FROM ({p})" for p in _PARTS)}),
o AS (SELECT max(CASE status WHEN 'PASS' THEN 0 WHEN 'WARN' THEN 1 WHEN 'FAIL' THEN 2 ELSE 3 END) AS s, count(*) FILTER (WHERE status <> 'PASS') AS k FROM allf)
SELECT * FROM allf UNION ALL
SELECT 'overall', '*', CASE s WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' WHEN 2 THEN 'FAIL' ELSE 'INSUFFICIENT_INPUT' END, CAST(k AS DOUBLE), '' FROM o"""
