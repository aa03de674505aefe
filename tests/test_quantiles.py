"""Exact quantiles against numpy, and plans without a percentile buffer over rows."""

import random

import numpy as np
import pytest

import __spark_entry__ as E
from riskspark.operators.quantiles import exact_quantiles

NAMED = ["drift01_psi", "drift09_rank_order", "drift13_percentile_snapshots", "fe03_woe_iv", "agg08_median_fill", "agg17_score_summary", "agg18_vector_median",
         "agg21_quintile_cohorts", "win06_decile_table", "leak11_mutual_information", "exp05_monotonicity_audit", "fair01_group_metrics"]


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    rows = [("a", rng.choice([0.0, 1.0, 1.0, 2.5])) for _ in range(101)] + [("b", rng.random()) for _ in range(2000)] + [("c", 7.0), ("d", None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, q in got.items():
        assert np.allclose(q, np.quantile([v for k, v in rows if k == g and v is not None], probs))
    whole = exact_quantiles(df, "v", probs).collect()
    assert len(whole) == 1 and np.allclose(whole[0]["q"], np.quantile([v for _, v in rows if v is not None], probs))
    assert exact_quantiles(df.limit(0), "v", probs, ["g"]).collect() == []
    assert [r["q"] for r in exact_quantiles(df.limit(0), "v", probs).collect()] == [[None] * 6]


@pytest.mark.parametrize("name", NAMED)
def test_no_percentile_buffer(spark, sf, name):
    plan = E.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "median(" not in plan
