"""Registered queries: Spark DataFrame plans over the driver tables and the
equivalent DuckDB SQL used as the correctness oracle.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, sql | None)``.
Column names match between the two; every floating result is rounded to six
decimals in both texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their ``register`` calls run."""
    from riskspark.plans import (  # noqa: F401
        q_audit,
        q_drift,
        q_eval,
        q_policy,
        q_prep,
        q_relational,
        q_stream,
        q_text,
        q_extra,
        q_factory,
        q_features,
        q_models,
        q_more,
        q_retrieval,
        q_joins,
    )
