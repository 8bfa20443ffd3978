import random

import numpy as np
import pytest

from strata.llm import topk
from strata.llm.queries import SQL, op8_topk
from tests.compare import connect, difference


def held(score):
    return max(-(2**63), min(2**63 - 1, score))


def brute(vectors, k, every):
    out = set()
    scaled = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in {(i, tuple(v)) for i, v in scaled if i % every == 0}:
        scores = sorted((-held(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in scaled if j != i and len(v) == len(q))
        out |= {(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], start=1)}
    return out


class SqlQuery:
    sql = SQL["op8_topk"]

    def __call__(self, spark, sf):
        return op8_topk(spark, sf)


def test_equals_sql(spark, sf):
    assert difference(spark, connect(sf), SqlQuery(), sf) is None


@pytest.mark.parametrize("block", [7, 4096])
def test_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    random.seed(2)
    rows = [(i, [random.choice([-1.0, 0.25, 0.5]) for _ in range(3)]) for i in range(40)]  # many ties
    rows += [(i, [0.1 * i, float(i % 3)]) for i in range(40, 52)]  # another length
    rows += [(100, None), (105, [None, 1.0, 2.0]), (110, [float("nan"), 0.0, 0.0]), (115, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(120, []), (125, []), (130, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "1 AS dim", "2 AS v", "3 AS block", "4 AS score", "5 AS rank")
    found = {tuple(r) for r in topk.top_k(df, k=5, every=5).collect()}
    assert found == brute(rows, 5, 5)
    assert topk.top_k(df.limit(0)).count() == 0


def test_large_components(spark):
    rows = [(i, [(-1.0) ** i * 10.0**7 * (i + 1), 3.0e9 + i]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(df, k=3, every=4).collect()} == brute(rows, 3, 4)


def test_repeated_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.1, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"]) for r in topk.top_k(df, k=3, every=50).orderBy("rank").collect()] == [(1, 1), (2, 1), (3, 2)]


def test_bounds_leave_most_candidates():
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 60, (40, 16))
    x = np.floor(centers[rng.integers(0, 40, 4000)] * rng.choice([0.3, 1, 3], (4000, 1)) + rng.normal(0, 2, (4000, 16)))
    ids = np.arange(4000)
    found, evaluated = topk.search_block(x[:80], ids[:80], x, ids, topk.pick_pivots(x), 5)
    scores = (x[:80] @ x.T).astype(int)
    for i in range(80):
        scores[i, i] = -(10**9)
        best = sorted(((-s, j) for j, s in enumerate(scores[i])))[:5]
        assert [(-s, j) for q, j, s in found if q == i] == best
    assert evaluated < 0.5 * 80 * 4000
