"""Sources and sinks (SRC-01..08, SNK-01..06)."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.sources import io


def _dir():
    return tempfile.mkdtemp(prefix="rs-io-", dir="/tmp")


def test_csv_roundtrip_and_strip_names(spark, sf):
    d = _dir()
    o = io.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    io.write_csv(o, f"{d}/o")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])
    back = io.read_csv(spark, f"{d}/o", schema)
    assert back.exceptAll(o).count() == 0
    renamed = io.strip_column_names(back.toDF(" a ", "b "))
    assert renamed.columns == ["a", "b"]


def test_partitioned_batches_prune_days(spark, sf):
    from riskspark.plans.frames import daily_batches
    d = _dir()
    io.write_parquet(daily_batches(spark, sf), f"{d}/b", partition_by=["batch_day"])
    b = io.read_daily_batches(spark, f"{d}/b").where(F.col("batch_day") == 7)
    assert "PartitionFilters: [isnotnull(batch_day" in b._jdf.queryExecution().executedPlan().toString()
    assert b.count() == daily_batches(spark, sf).where("batch_day = 7").count()


def test_json_report_and_audit_log(spark, sf):
    d = _dir()
    r = io.table(spark, sf, "region")
    io.write_json_report(r, f"{d}/rep")
    io.append_audit_log(r, f"{d}/log")
    io.append_audit_log(r, f"{d}/log")
    assert spark.read.json(f"{d}/log").count() == 2 * r.count()
    assert io.to_json_column(r).first()[0].startswith("{")


def test_json_artifact_markdown_and_binary(spark):
    d = _dir()
    with open(f"{d}/medians.json", "w") as fh:
        fh.write('{\n "a": 1.5,\n "b": 2.0\n}\n')
    assert io.read_json_artifact(spark, f"{d}/medians.json").first().a == 1.5
    os.makedirs(f"{d}/docs/sub")
    with open(f"{d}/docs/sub/x.md", "w") as fh:
        fh.write("# Title\n\nBody text.\n")
    with open(f"{d}/docs/y.txt", "w") as fh:
        fh.write("ignored")
    md = io.read_markdown_tree(spark, f"{d}/docs")
    assert md.count() == 1 and "Body text." in md.first().text
    fp = io.file_fingerprints(spark, f"{d}/docs", "*.md").first()
    import hashlib
    assert fp.sha256 == hashlib.sha256(b"# Title\n\nBody text.\n").hexdigest()


def test_markdown_summary_has_every_row(spark):
    s = io.markdown_table(spark.range(120).toDF("n"))
    assert s.count("\n") == 121 and s.endswith("| 119 |")


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert io.nan_to_null(df).where("x IS NULL").count() == 1
