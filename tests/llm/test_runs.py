import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import queries, runs

from .data import clashing, odd_documents, rows


def brute(words, least=6, exponent=4):
    """(start, length, period) by comparing the words with themselves at every distance."""
    found = {}
    for period in range(1, len(words) // exponent + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - at + period >= max(least, exponent * period):
                found.setdefault((at, end + period - at), period)
            at = max(end, at + 1)
    return sorted((start, length, period) for (start, length), period in found.items())


def periodic_texts(rng, count):
    texts = []
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 5, 40])
        text = [rng.randrange(letters) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            block = [rng.randrange(letters + 1) for _ in range(rng.randint(1, 60))]
            at = rng.randint(0, len(text))
            text[at:at] = (block * rng.randint(2, 9))[: rng.randint(1, len(block) * 9)]
        texts.append(text)
    return texts


def solved(texts):
    ends = np.cumsum([len(t) for t in texts])
    start, end, period = runs.find_runs(np.array([w for t in texts for w in t], np.int64), ends)
    out, begin = [], 0
    for stop in ends.tolist():
        out.append([(a - begin, b - a, q) for a, b, q in zip(start.tolist(), end.tolist(), period.tolist(), strict=True) if begin <= a < stop])
        begin = stop
    return out


@pytest.mark.parametrize("seed", range(20))
def test_equals_plain_comparison(seed):
    texts = periodic_texts(random.Random(seed), 30)
    assert solved(texts) == [brute(t) for t in texts]


def test_copies_and_shared_rules():
    text = periodic_texts(random.Random(5), 1)[0] + [9, 8, 7] * 5 + [1]
    assert solved([text, text, [], text + text]) == [brute(text), brute(text), [], brute(text + text)]


@pytest.mark.parametrize(
    ("words", "count"),
    [(np.zeros(200_000), 1), (np.arange(200_000) % 1009, 1), (np.tile(np.arange(60_000), 3), 0), (np.tile(np.arange(50_000), 4), 1)],
)
def test_long_texts(words, count):
    assert len(runs.find_runs(words.astype(np.int64), np.array([len(words)]))[0]) == count


def test_hash_errors_are_noticed(monkeypatch):
    texts = periodic_texts(random.Random(3), 20)
    monkeypatch.setattr(runs, "_mixed", lambda a, b: (a + b) & np.uint64(1))  # nearly all blocks look alike
    assert solved(texts) == [brute(t) for t in texts]


def plain_digest(doc_id, text):
    """A row of the query from the definitions alone."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    short = docs.where("length(text) < 8000")
    short.write.parquet(f"{tmp_path}/documents.parquet")
    expected = [plain_digest(r["doc_id"], r["text"]) for r in short.select("doc_id", "text").collect()]
    assert rows(queries.op11_runs(spark, str(tmp_path))) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 5


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = runs.periodic_runs(docs)
    assert rows(found) == rows(runs.periodic_runs(clashing(docs)))
    assert found.count() == docs.count()
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert [(by_id[i]["runs"], by_id[i]["strongest"], by_id[i]["collapsed"]) for i in (2, 3, 4)] == [([], None, "")] * 3
    assert any(r["period"] == 1 and r["length"] >= 2000 for r in by_id[5]["runs"])
    assert by_id[5]["collapsed"].endswith(" x") and not by_id[5]["collapsed"].endswith(" x x")
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="exponent"):
        runs.periodic_runs(docs, exponent=3)


def test_every_strongest_is_the_first_of_equals(spark):
    text = "a b c d e " + "x " * 8 + "k l " + "y z " * 8 + "m " + "w " * 8
    row = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(5, 8, 1), (15, 16, 2), (32, 8, 1)]
    assert row["strongest"] == 0
    assert row["collapsed"] == "a b c d e x k l y z m w"
