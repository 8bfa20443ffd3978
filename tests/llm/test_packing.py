import random
import zlib

import numpy as np
import pytest

from strata.llm import packing
from strata.llm.tokens import encoder, vocabulary_path

from .data import clashing, odd_documents, rows


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    random.seed(seed)
    capacity = random.choice([16, 100, 512])
    histogram = {}
    for _ in range(random.choice([1, 50, 3000])):
        length = min(capacity, 1 + int(random.expovariate(4 / capacity)))
        histogram[length] = histogram.get(length, 0) + random.choice([1, 1, 40])
    plan = packing.plan(histogram, capacity)
    used = {}
    for pattern, n in plan.patterns:
        assert n > 0 and sum(pattern) <= capacity
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    bound = -(-sum(k * n for k, n in histogram.items()) // capacity)
    assert plan.sequences <= bound * 1.05 + 1


def test_best_fit_equals_one_by_one():
    random.seed(1)
    for _ in range(30):
        lengths = sorted((random.randint(1, 20) for _ in range(60)), reverse=True)
        bins = []
        for x in lengths:
            fits = [b for b in bins if sum(b) + x <= 20]
            if fits:
                max(fits, key=sum).append(x)
            else:
                bins.append([x])
        counts = {x: lengths.count(x) for x in lengths}
        assert sum(n for _, n in packing.best_fit(counts, 20)) == len(bins)


def test_cut():
    assert packing.cut(5, 2) == [(0, 1), (1, 2), (3, 2)]
    assert packing.cut(4, 2) == [(0, 2), (2, 2)]
    assert packing.cut(1, 2) == [(0, 1)]


def check_packed(found, texts, capacity):
    exact = encoder(vocabulary_path()).exact
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in found if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        assert all(r["length"] == capacity for r in pieces[1:])


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_packed(packing.packed(docs, 512).collect(), texts, 512)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = packing.packed(docs, 256)
    drop = ["sequence_id", "offset"]
    assert rows(found.drop(*drop)) == rows(packing.packed(clashing(docs), 256).drop(*drop))
    one_each = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packed(packing.packed(one_each, 256).collect(), {r["doc_id"]: r["text"] for r in one_each.collect()}, 256)
    assert {r["length"] for r in found.where("doc_id in (2, 3)").collect()} == {1}
    assert packing.packed(docs.limit(0), 256).count() == 0


def test_encoder_equals_the_library(sf, spark):
    e = encoder(vocabulary_path())
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["", "a<|endoftext|>b  c", "it's  \n\n x y\u0085z  \x1c漢字 é" * 3, "a" * 3000, " " * 3000, "\U0001f600‍" * 50]
    for text in texts:
        assert e.ids(text).tolist() == e.exact.encode(text, add_special_tokens=False).ids
