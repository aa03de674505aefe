"""Wasserstein areas, fixed-width PSI, table fingerprints, permissive reading and bootstrap weights against brute force."""

import hashlib
import math
import random
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import audit as au
from riskspark.operators import drift as dr
from riskspark.operators import metrics as mx
from riskspark.sources import io


def brute_distance(ref, act):
    points = sorted(set(ref) | set(act))
    share = lambda vs, x: sum(v <= x for v in vs) / len(vs)
    return sum(abs(share(ref, a) - share(act, a)) * (b - a) for a, b in zip(points, points[1:]))


def test_wasserstein_areas(spark):
    rnd = random.Random(5)
    ref = [rnd.choice([0.0, 0.0, 0.0, rnd.random(), rnd.gauss(0, 3)]) for _ in range(300)]
    batches = {
        1: [rnd.random() for _ in range(70)], 2: ref[:], 3: [100.0], 4: [-100.0] * 3, 5: [0.0],
        6: [rnd.choice(ref) for _ in range(90)] + [min(ref), max(ref)], 7: [rnd.gauss(1, 5) for _ in range(200)], 8: [max(ref) + 1.0, min(ref) - 1.0],
    }
    act = [(b, "f", v) for b, vs in batches.items() for v in vs] + [(1, "f", None), (1, "unknown", 1.0)]
    got = dr.wasserstein(spark.createDataFrame([("f", v) for v in ref] + [("f", None)], "feature string, v double"),
                         spark.createDataFrame(act, "batch int, feature string, v double"), "batch", n_buckets=8).collect()
    assert {r.batch for r in got} == set(batches) and all(r.feature == "f" for r in got)
    for r in got:
        assert math.isclose(r.wasserstein, brute_distance(ref, batches[r.batch]), abs_tol=1e-9), r


def test_wasserstein_windows_hold_no_whole_batch(spark):
    d = spark.createDataFrame([("f", float(i % 50)) for i in range(200)], "feature string, v double")
    plan = dr.wasserstein(d, d.withColumn("batch", F.lit(1)), "batch")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in plan


def test_fixed_width_psi_leaves_values_outside_out(spark):
    ref = spark.createDataFrame([("f", 0.05)] * 5 + [("f", 0.95)] * 5, "feature string, v double")
    act = spark.createDataFrame([(1, "f", 0.05)] * 5 + [(1, "f", 7.0)] * 5, "batch int, feature string, v double")
    r, a = [0.5] + [1e-6] * 8 + [0.5], [0.5] + [1e-6] * 9
    want = sum((x - y) * math.log(x / y) for x, y in zip(a, r))
    assert math.isclose(dr.psi_fixed(ref, act, "batch").first().psi, want, rel_tol=1e-9)


def test_fingerprint_is_of_the_multiset(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"t{i}", i / 8) for i in range(40)]
    schema = "k int, t string, x double"
    base = au.fingerprint(spark.createDataFrame(rows, schema)).first()
    assert base == au.fingerprint(spark.createDataFrame(rows[::-1], schema).repartition(5)).first()
    assert base.n == 40 and base.null_counts == "0,8,0"
    changed = [rows[:3] + [(3, "t3", 0.5)] + rows[4:], rows + rows[:1], rows[1:], [(k, "N" if t is None else t, x) for k, t, x in rows]]
    assert len({au.fingerprint(spark.createDataFrame(c, schema)).first().fingerprint for c in changed} | {base.fingerprint}) == 5
    twice = au.fingerprint(spark.createDataFrame([("a|1:b", "c")], "p string, q string")).first()
    assert twice.fingerprint != au.fingerprint(spark.createDataFrame([("a", "b|1:c")], "p string, q string")).first().fingerprint
    empty = au.fingerprint(spark.createDataFrame([], schema)).first()
    assert (empty.n, empty.lane1, empty.lane2, empty.null_counts) == (0, 0, 0, "0,0,0")


def test_permissive_reading_loses_no_line(spark):
    d = tempfile.mkdtemp(prefix="rs-csv-", dir="/tmp")
    lines = ["id,name,x", "1,ann,1.5", '2,"b,""c",2.5', "3,short", "4,long,1.0,9", "5,bad,many", '6,"open,3.0', ",null,", "8,neg,-1"]
    with open(f"{d}/in.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("id int, name string, x double")
    read = io.read_csv_permissive(spark, f"{d}/in.csv", schema)
    q = au.quarantine(read, {"id_present": F.col("id").isNotNull(), "x_positive": F.col("x") > 0})
    fault = io.line_fault(len(schema))
    io.write_quarantined(q, F.when(fault.isNotNull(), F.array(fault)).otherwise(F.col("failed_rules")), f"{d}/out")
    out = spark.read.parquet(f"{d}/out")
    assert out.count() == len(lines) - 1
    reasons = sorted(tuple(r.reasons) for r in out.where("status = 'quarantine'").collect())
    assert reasons == [("id_present", "x_positive"), ("long",), ("mistyped",), ("open_quote",), ("short",), ("x_positive",)]
    clean = sorted((r.id, r.name) for r in spark.read.parquet(f"{d}/out/status=clean").collect())
    assert clean == [(1, "ann"), (2, 'b,"c')]
    # a line is judged by all its cells, whichever columns are read
    assert read.where(F.col(io.CORRUPT).isNotNull()).count() == 4


def test_bootstrap_weights_one_array_a_row(spark):
    rnd = random.Random(3)
    rows = [(i, round(rnd.random(), 1), int(rnd.random() < 0.4)) for i in range(120)]
    got = mx.bootstrap_auc(spark.createDataFrame(rows, "id int, p double, y int"), "id", B=7).first()

    def weight(i, b):
        u = int(hashlib.md5(f"{i}:boot:{b}".encode()).hexdigest()[:8], 16) / 2 ** 32
        return sum(c <= u for c in mx.POISSON1_CDF)

    aucs = []
    for b in range(1, 8):
        w = {i: weight(i, b) for i, _, _ in rows}
        pos = [(p, w[i]) for i, p, y in rows if y]
        neg = [(p, w[i]) for i, p, y in rows if not y]
        won = sum(a * c * ((p > n) + 0.5 * (p == n)) for p, a in pos for n, c in neg)
        aucs.append(won / (sum(a for _, a in pos) * sum(c for _, c in neg)))
    aucs.sort()
    assert got.replicates == 7 and got.auc_mid == round(aucs[3], 6)
    at = 0.025 * 6
    assert math.isclose(got.auc_lo, aucs[0] + (aucs[1] - aucs[0]) * at, abs_tol=1e-6)
