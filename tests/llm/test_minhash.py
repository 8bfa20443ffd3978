import math
import random

import numpy as np
import pytest

from strata.llm import minhash, queries

from .data import WORDS, clashing, odd_documents, rows


def plain_components(texts, words=4, percent=80):
    """(n, smallest linked index) of each text by comparing all pairs."""
    sets = []
    for text in texts:
        parts = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        sets.append({b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, groups=12, most=14):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.choice([1, 2, 4, 5, 8, 30, 120]))]
        for _ in range(rng.randint(1, most)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS).upper()
            texts.append("  ".join(copy) + rng.choice(["", "\n", " the end"]))
    rng.shuffle(texts)
    return [None, "", *texts]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_all_pairs(spark, seed):
    texts = near_copies(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [tuple(r) for r in minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert found == [(i, n, c, i == c) for i, (n, c) in enumerate(plain_components(texts))]


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    expected = plain_components([r["text"] for r in docs])
    found = queries.op12_minhash(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(d["doc_id"], n, docs[c]["doc_id"], d["doc_id"] == docs[c]["doc_id"]) for d, (n, c) in zip(docs, expected, strict=True)]
    assert any(not r["kept"] for r in found)


def test_a_crowded_bucket_whose_texts_are_apart(spark):
    """Texts share most shingles but not enough: every pivot fails, and all pairs must be compared."""
    common = [f"w{i}" for i in range(60)]
    texts = [" ".join([*common, *(f"x{i}_{j}" for j in range(9))]) for i in range(40)]
    texts.append(texts[7] + " more")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: c for i, (_, c) in enumerate(plain_components(texts))}
    assert found[40] == 7


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for size, shared in ((5, 4), (40, 20), (3000, 2400)):
        errors = []
        for _ in range(40):
            items = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64)
            one, two = minhash.sketches([items[:size], items[size - shared :]])
            assert (one != minhash.EMPTY).all() and (two != minhash.EMPTY).all()
            errors.append((one == two).mean() - shared / (2 * size - shared))
        assert abs(np.mean(errors)) < 0.03
        assert np.std(errors) <= 1.3 * math.sqrt(0.25 / minhash.SLOTS)


def test_a_single_shingle_fills_all_coordinates():
    (one,) = minhash.sketches([np.array([7], np.uint64)])
    assert (one != minhash.EMPTY).all()
    rounds = one >> np.uint64(52)
    assert rounds.max() < 2 * minhash.SLOTS and (rounds < minhash.SLOTS).any()
    assert (minhash.sketches([np.zeros(0, np.uint64)]) == minhash.EMPTY).all()
    assert minhash.sketches([]).shape == (0, minhash.SLOTS)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = minhash.near_duplicates(docs)
    assert rows(found) == rows(minhash.near_duplicates(clashing(docs)))
    assert found.count() == docs.count()
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[1]["component_id"] == by_id[0]["component_id"] == 0 and not by_id[1]["kept"]
    assert [(by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) for i in (2, 3, 4)] == [(0, i, True) for i in (2, 3, 4)]
    assert by_id[6]["n_shingles"] == 1
    assert sum(r["doc_id"] is None and r["kept"] for r in found.collect()) == 2
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
