"""Plan assertions: no single-partition exchange over raw rows in the ranking
metrics, no Python evaluation in the relational operators, pruned scans."""

from riskspark.operators import metrics as mx
from riskspark.plans.frames import scored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_metrics_have_no_single_partition_exchange(spark, sf):
    p = plan(mx.ranking_metrics(scored(spark, sf), "p", "y", ["grp"]))
    assert "SinglePartition" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_all_sql_queries_have_no_python_udfs(spark, sf):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    for name in sql:
        if name.startswith("st"):
            continue
        p = plan(qs[name](spark, sf))
        assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_scan_prunes_columns_and_pushes_filters(spark, sf):
    from pyspark.sql import functions as F
    from riskspark.sources.io import table
    df = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in p
