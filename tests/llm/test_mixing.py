from fractions import Fraction

import pytest

from strata.llm import mixing

from .data import clashing, odd_documents, rows


def fluid_deviation(order, blocks, weights):
    served, done, worst = [Fraction(0)] * len(blocks), [0] * len(blocks), 0
    for chosen in order:
        left = Fraction(1)
        while left:
            active = [i for i, n in enumerate(blocks) if served[i] < n]
            total = sum(weights[i] for i in active)
            step = min([left, *((blocks[i] - served[i]) * total / weights[i] for i in active)])
            for i in active:
                served[i] += step * weights[i] / total
            left -= step
        done[chosen] += 1
        worst = max(worst, *(abs(d - s) for d, s in zip(done, served, strict=True)))
    return worst


@pytest.mark.parametrize(
    "blocks, weights",
    [([40, 40, 40], [1, 1, 1]), ([200, 30, 1, 0, 77], [5, 3, 1, 9, 40]), ([300, 5], [1, 200]), ([7], [3]), ([900, 100, 50], [300, 70, 13])],
)
def test_schedule_stays_within_a_block(spark, blocks, weights):
    found = sorted(mixing.schedule(blocks, weights, spark).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in found] == list(range(sum(blocks)))
    for i, n in enumerate(blocks):
        assert [r["block"] for r in found if r["class"] == i] == list(range(n))
    assert fluid_deviation([r["class"] for r in found], blocks, weights) < 1


def test_every_document_has_one_place(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = mixing.mixed(docs, {"src0": 5, "src1": 2}, block_rows=3).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert len({r["position"] for r in found}) == len(found)
    groups = {}
    for r in found:
        name = r["source"] if r["source"] in ("src0", "src1") else None
        groups.setdefault((name, r["block"]), set()).add(r["slot"])
    assert all(len(s) == 1 for s in groups.values())


def test_odd_documents(spark):
    docs = odd_documents(spark)
    weights = {"a": 3, "b": 1}
    found = mixing.mixed(docs, weights, block_rows=2)
    assert rows(found) == rows(mixing.mixed(clashing(docs), weights, block_rows=2))
    assert found.count() == docs.distinct().count()
    ordered = mixing.in_mixed_order(docs, weights, block_rows=2)
    assert ordered.columns == docs.columns and rows(ordered) == rows(docs)
    assert mixing.mixed(docs.limit(0), weights).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"a": 0})
    with pytest.raises(ValueError):
        mixing.schedule([1, 1], [mixing.MOST_WEIGHT, 1], spark)


def test_no_python_on_the_way(spark, sf):
    plan = mixing.mixed(spark.read.parquet(f"{sf}/documents.parquet"), {"src0": 2})._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan
