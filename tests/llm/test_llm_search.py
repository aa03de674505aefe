"""Nearest neighbours: all pairs by hand, the cases of the docstring, and the share of pairs that are reranked."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import ann
from riskspark.llm.ann import Block, encode, inner, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k):
    ok = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    out = []
    for i, q in enumerate(ok):
        if q[0] is None or q[0] % 20:
            continue
        met = []
        for j, v in enumerate(ok):
            if i != j and len(v[1]) == len(q[1]):
                s = 0.0
                for a, b in zip(np.float32(v[1]).tolist(), np.float32(q[1]).tolist()):
                    s += a * b
                met.append((-s, v[0] is None, v[0] or 0, v[0]))
        out += [(q[0], r, m[3], -m[0]) for r, m in enumerate(sorted(met)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, k=20, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, nearest(df, F.col("vec_id") % 20 == 0, k=k, **kw).collect()), key=repr)


def vectors(n, dim, seed):
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32))]


def test_all_pairs_in_blocks_and_chunks(spark):
    rows = vectors(300, 16, 1)
    assert found(spark, rows, 7, block_rows=4, chunk_rows=64) == by_hand(rows, 7)


def test_copies_ties_and_repeated_ids(spark):
    rows = vectors(40, 8, 2)
    rows += [(100 + i, rows[0][1], 0) for i in range(30)] + [rows[0], rows[20], (None, rows[0][1], 0), (None, rows[3][1], 0)]
    for size in (1000, 11):
        assert found(spark, rows, 20, chunk_rows=size) == by_hand(rows, 20)


def test_nulls_zeros_other_lengths_and_huge_values(spark):
    rows = vectors(25, 4, 3)
    rows += [(200, None, 0), (220, [], 0), (240, [0.0] * 4, 0), (260, [1.0, None, 0.0, 0.0], 0), (280, [float("nan"), 1.0, 1.0, 1.0], 0),
             (300, [float("inf"), 1.0, 1.0, 1.0], 0), (320, [1.0, 2.0], 0), (321, [3.0, 1.0], 0), (340, [1.0] * 7, 0),
             (360, [3e38, -3e38, 1e38, 0.0], 0), (361, [1e-40, 0.0, 0.0, 0.0], 0)]
    assert found(spark, rows) == by_hand(rows, 20)


def test_fewer_candidates_empty_tables_and_clashing_names(spark):
    rows = vectors(3, 5, 4)
    assert found(spark, rows) == by_hand(rows, 20)
    assert found(spark, []) == []
    assert found(spark, [(7, [1.0], 0)]) == []
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("row", "block", "chunk", "query", "ident", "v", "code", "score", "rank", "query_id", "vec"):
        df = df.withColumn(c, F.lit("x"))
    assert sorted(map(tuple, nearest(df, F.col("vec_id") % 20 == 0).collect()), key=repr) == by_hand(rows, 20)
    with pytest.raises(TypeError):
        nearest(df.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))


def test_codes_spare_most_pairs_and_errors_stay_within_the_bound(monkeypatch):
    monkeypatch.setattr(ann, "HELD_PAIRS", 1000)
    monkeypatch.setattr(ann, "RERANK_PAIRS", 300)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 64))
    x = centres[np.arange(4000) % 40] + 0.3 * rng.normal(size=(4000, 64))
    q = x[:50]
    bits, size, fit = encode(x, 256)
    seen = []
    monkeypatch.setattr(ann, "inner", lambda *a: (seen.append(len(a[2])), inner(*a))[1])
    block = Block(np.arange(50), q, 20, 256, 4.0)
    for s in range(0, 4000, 1000):
        at = slice(s, s + 1000)
        block.scan(np.arange(4000)[at], np.arange(4000)[at], np.zeros(1000, bool), x[at], bits[at], size[at], fit[at])
    assert sum(seen) < 0.25 * 50 * 4000
    for i in range(50):
        exact = x @ q[i]
        exact[i] = -np.inf
        assert set(block.ident[block.at == i]) == set(np.argsort(-exact)[:20])


def test_recall_against_all_pairs(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    want = {r[:3:2] for r in by_hand(rows, 20)}
    got = {r[:3:2] for r in found(spark, rows)}
    assert len(got & want) >= 0.9 * len(want)
