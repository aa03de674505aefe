"""Streams that come in many batches, in any order, and tables that are folders of part files."""

import random

from pyspark.sql import functions as F

from riskspark.operators import drift as dr
from riskspark.operators.metrics import POISSON1_CDF
from riskspark.streaming import stream as st


def test_alert_runs_one_file_at_a_time(spark, tmp_path):
    rng = random.Random(1)
    rows = [("f", d, rng.choice([0.05, 0.2, 0.4])) for d in range(20)] + [("g", d, 0.35) for d in range(7)]
    shuffled = rng.sample(rows, len(rows))
    for k in range(0, len(shuffled), 5):
        spark.createDataFrame(shuffled[k:k + 5], "feature string, batch_day int, psi double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    out = st.run_updates(st.consecutive_alerts(st.file_stream(spark, f"{tmp_path}/src", max_files=1)), "t5", ["feature", "batch_day"])
    want, run = [], {}
    for f, d, p in sorted(rows):
        run[f] = run.get(f, 0) + 1 if p > 0.1 else 0
        want.append((f, d, p, run[f], "RETIRE" if run[f] == 5 and p > 0.3 else "RETRAIN" if run[f] == 2 else None))
    assert sorted(tuple(r) for r in out.collect()) == want


def test_decisions_are_logged_once_in_any_order(spark, tmp_path):
    ids = list(range(60)) * 2
    random.Random(2).shuffle(ids)
    for k in range(0, 120, 30):
        spark.createDataFrame([(i, i * 1000) for i in ids[k:k + 30]], "id long, day long").select("id", F.timestamp_seconds(F.col("day") * 86400).alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    out = st.dedupe_decisions(st.file_stream(spark, f"{tmp_path}/src", max_files=1))
    assert sorted(r["id"] for r in out.collect()) == list(range(60))


def test_table_stream_reads_a_folder_of_parts_and_a_file(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/orders.parquet").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    for root in (str(tmp_path), sf):
        assert st.run_to_table(st.table_stream(spark, root, "orders").select("o_orderkey"), "ts").count() == n


def test_ks_pvalue_of_identical_and_known_samples(spark):
    row = spark.range(1).select(*[dr.ks_pvalue(F.lit(d), F.lit(100.0), F.lit(100.0)).alias(f"p{k}") for k, d in enumerate((0.0, 0.01, 0.1, 0.16, 0.3))]).first()
    assert row[0] == 1.0 and row[1] == 1.0 and 0.6 < row[2] < 0.75 and 0.12 < row[3] < 0.16 and row[4] < 0.0003
    assert all(a >= b for a, b in zip(row, row[1:]))


def test_bootstrap_weights_reach_beyond_eight():
    assert len(POISSON1_CDF) == 13 and 0 < 1 - POISSON1_CDF[-1] < 2 ** -32


DAY = 86400


def feed(spark, path, files, schema):
    """One file a trigger, in this order."""
    for rows in files:
        spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(path)
    return st.file_stream(spark, path, max_files=1)


def test_late_rows_are_counted_against_earlier_batches_only(spark, tmp_path):
    files = [[(1, 10 * DAY), (2, 2 * DAY)], [(3, 8 * DAY), (4, 9 * DAY - 1), (5, 20 * DAY)], [(6, 18 * DAY), (7, 19 * DAY), (8, None)]]
    out = st.mark_late(feed(spark, f"{tmp_path}/src", files, "id long, ts long"), "ts", "1 day", "late-test")
    assert {r.id: r.late for r in out.collect()} == {1: False, 2: False, 3: True, 4: True, 5: False, 6: True, 7: False, 8: False}


def test_windows_are_closed_once_and_for_good(spark, tmp_path):
    files = [[("click", d * DAY + 5), ("view", d * DAY + 7), ("view", d * DAY + 9)] for d in range(12)]
    src = feed(spark, f"{tmp_path}/src", files, "event_type string, ts long")
    out = st.run_to_table(st.closed_rates(src, ["click"], "3 days"), "closed-test").select(F.unix_timestamp("w.start").alias("s"), F.unix_timestamp("w.end").alias("e"), "n", "click_rate").collect()
    top = 11 * DAY + 9 - DAY
    want = {s * DAY: 3 * len([d for d in range(12) if s <= d < s + 3]) for s in range(-2, 12) if (s + 3) * DAY <= top}
    assert {r.s: r.n for r in out} == want and len(out) == len(want) and all(abs(r.click_rate - 1 / 3) < 1e-12 for r in out)


def test_unmatched_decisions_come_out_of_the_stream(spark, tmp_path):
    s = feed(spark, f"{tmp_path}/s", [[(i, (1000 + i) * DAY)] for i in range(0, 60, 5)], "id long, ts long").withColumnRenamed("ts", "score_ts")
    o = feed(spark, f"{tmp_path}/o", [[(i, (1003 + i) * DAY)] for i in range(0, 60, 10)], "oid long, ts long").withColumnRenamed("ts", "outcome_ts")
    out = st.run_to_table(st.outcome_join(s, o, 10, "2 days", "leftOuter").select("id", "oid"), "outer-test").collect()
    got = {r.id: r.oid for r in out}
    mark = min(55, 53) - 2
    assert len(out) == len(got)
    assert {i for i, k in got.items() if k is not None} == set(range(0, 60, 10))
    assert {i for i, k in got.items() if k is None} == {i for i in range(5, 60, 10) if i + 10 < mark}


def test_model_scorer_in_a_stream_equals_the_batch(spark, sf, tmp_path):
    from riskspark.plans import q_models as qm
    d, score = qm.fitted_scorer(spark, sf)
    d.repartition(4).write.parquet(str(tmp_path / "src"))
    streamed = score(st.file_stream(spark, str(tmp_path / "src"), max_files=1)).select(*qm.SCORED_COLUMNS)
    got = {r.id: r for r in st.run_to_table(streamed, "scorer-test").collect()}
    want = {r.id: r for r in score(d).select(*qm.SCORED_COLUMNS).collect()}
    assert got == want and len(want) == d.count()
    assert any(r.reasons for r in want.values()) and all(len(r.reasons) <= 3 for r in want.values())
    assert all("(+" in x for r in want.values() for x in r.reasons)
