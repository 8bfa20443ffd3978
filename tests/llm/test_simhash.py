import random

import numpy as np
import pytest

from strata.llm import simhash

from .data import clashing, odd_documents, rows


def brute_roots(prints, distance):
    roots = list(range(len(prints)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if ((a ^ prints[j]) & (2**64 - 1)).bit_count() <= distance:
                a_root, b_root = find(i), find(j)
                roots[max(a_root, b_root)] = min(a_root, b_root)
    return [find(i) for i in range(len(prints))]


def cluster(seed, n):
    random.seed(seed)
    centers = [random.getrandbits(64) for _ in range(n // 10)]
    out = set()
    while len(out) < n:
        value = random.choice(centers)
        for _ in range(random.randint(0, 6)):
            value ^= 1 << random.randrange(64)
        out.add(value)
    return sorted(simhash._signed(v) for v in out)


@pytest.mark.parametrize("distance", [1, 3, 4])
@pytest.mark.parametrize("heavy", [simhash.HEAVY, 1])
def test_links_keep_components(spark, distance, heavy):
    prints = cluster(distance, 120)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(df, distance, heavy=heavy).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= distance for a, b in edges)
    place = {p: i for i, p in enumerate(prints)}
    found = list(range(len(prints)))
    for _ in prints:
        for a, b in edges:
            found[place[a]] = found[place[b]] = min(found[place[a]], found[place[b]])
    assert found == brute_roots(prints, distance)


def test_any_allocation_finds_every_pair(spark):
    prints = cluster(9, 100)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    bits = [list(range(0, 20)), list(range(20, 44)), list(range(44, 64))]
    expected = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    for thresholds in ([0, 2, 0], [1, 1, 0], [3, -1, 0]):
        probes = [simhash.Probe(sum(1 << b for b in g), t, simhash._flips(g, t)) for g, t in zip(bits, thresholds, strict=True) if t >= 0]
        assert {tuple(r) for r in simhash.links(df, 4, probes).collect()} == expected


def test_allocation_is_cheapest():
    costs = [[0, 5, 50], [0, 1, 2], [0, 9, 9]]
    assert simhash.allocate(costs, 0) == (2, [-1, 1, 0]) or simhash.allocate(costs, 0)[0] == min(
        costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if a + b + c == 0
    )


def test_groups_hold_correlated_bits():
    rng = np.random.default_rng(1)
    half = rng.random((500, 32)) < 0.5
    bits = np.concatenate([half, half], axis=1).astype(float)  # bit b + 32 equals bit b
    groups = simhash.grouped_bits(bits.T @ bits, 500, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert all((b + 32) % 64 in g for g in groups for b in g)


def test_fingerprint_by_hand():
    import xxhash

    text = "The  QUICK\tbrown fox Äb jumps"
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text, 4) == expected
    assert simhash.fingerprint("One two", 4) == xxhash.xxh64_intdigest(b"one two", 42)
    assert simhash.fingerprint(None, 4) == simhash.fingerprint(" \n", 4) == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = simhash.near_duplicates(docs)
    assert rows(found) == rows(simhash.near_duplicates(clashing(docs)))
    assert found.count() == docs.count()
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[1]["component_id"] == by_id[0]["component_id"] == 0
    assert by_id[2]["fingerprint"] == by_id[4]["fingerprint"] == "0" * 16
    assert by_id[4]["component_id"] == 2
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 2, 5, 6, 7]
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0
