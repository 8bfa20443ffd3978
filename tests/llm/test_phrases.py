import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import phrases, queries

from .data import clashing, odd_documents, rows


def plain(docs, least, most=2000):
    """The result from the definitions alone: (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if 2 <= len(p) <= 4 and n >= least}
        around = Counter()
        for p, n in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    around[p[i : i + size]] = max(around[p[i : i + size]], n)
        found = []
        for p, a in candidates.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def results(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_against_plain_counts(spark, sf):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = plain(docs, 30)
    assert results(queries.op13_phrases(spark, sf)) == expected
    assert len(expected) > 30


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("small", [False, True])
def test_small_alphabets(spark, monkeypatch, seed, small):
    """Many ties and nested phrases; with small shards, several pieces of a range, and with common prefixes."""
    rng = random.Random(seed)
    docs = [(rng.choice(["en", "fr", None]), " ".join(rng.choice(["a", "B", "c", "é", "a.", "d,\tc", "x!y", "\n"]) for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    if small:
        monkeypatch.setattr(phrases, "SHARD_WORDS", 500)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert results(phrases.collocations(df, least=5, most=40)) == plain(docs, 5, 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def test_common_prefixes_are_spread(spark):
    rng = random.Random(4)
    docs = [("en", " ".join(f"of the w{rng.randrange(40)} w{rng.randrange(40)}" for _ in range(40))) for _ in range(50)]
    df = spark.createDataFrame(docs, "lang string, text string")
    rows = df.selectExpr("lang", "cast(text as binary) as text")
    assert len(phrases._common_prefixes(rows, 8, 8000)) >= 1
    assert results(phrases.collocations(df, least=3, most=500)) == plain(docs, 3, 500)
    found = {r["phrase"]: r["f"] for r in phrases.phrase_counts(df, least=3, ranges=8).collect()}
    assert found["of the"] == 2000 and found[""] == 8000


def test_automaton_keeps_paths_and_weights():
    rng = np.random.default_rng(1)
    columns = list(np.unique(rng.integers(0, 6, (4, 500)), axis=1))
    weights = rng.integers(1, 3, len(columns[0]))
    automaton = phrases.Automaton.of(columns, weights)
    back, sums = automaton.paths()
    assert all(np.array_equal(a, b) for a, b in zip(back, columns, strict=True)) and np.array_equal(sums, weights)
    tree = sum(len(np.unique(np.stack(columns[:d]), axis=1).T) for d in range(1, 5))
    assert sum(len(labels) for _, labels, _ in automaton.levels) < tree
    known = dict(zip(zip(*(c.tolist() for c in columns), strict=True), weights.tolist(), strict=True))
    asked = rng.integers(0, 8, (4, 300))
    assert automaton.weights(list(asked)).tolist() == [known.get(tuple(p), 0) for p in asked.T.tolist()]
    empty = phrases.Automaton.of([np.zeros(0, np.int64)] * 3, np.zeros(0, np.int64))
    assert len(empty.paths()[1]) == 0 and empty.weights([np.array([1])] * 3).tolist() == [0]


def test_equal_tails_are_one_state():
    columns = [np.array([1, 1, 2, 2, 3]), np.array([5, 6, 5, 6, 6])]
    automaton = phrases.Automaton.of(columns, np.array([7, 8, 7, 8, 8]))
    assert [len(sizes) for sizes, _, _ in automaton.levels] == [1, 2]


def test_odd_documents(spark):
    docs = odd_documents(spark)
    expected = plain([(r["lang"], r["text"]) for r in docs.collect()], 3)
    assert results(phrases.collocations(docs, least=3)) == expected
    assert rows(phrases.collocations(docs, least=3)) == rows(phrases.collocations(clashing(docs), least=3))
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null")).count() == 0


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 40])
def test_rows_are_counted_whatever_their_numbers(top):
    """Narrow numbers go into one sort, wide ones into several."""
    columns = list(np.random.default_rng(1).integers(0, top, (5, 400)) * np.array([1, 0, 1, 1, 1])[:, None])
    columns = [np.append(c, c[:150]) for c in columns]
    weights = np.arange(550)
    expected = {}
    for row, n in zip(zip(*(c.tolist() for c in columns), strict=True), weights.tolist(), strict=True):
        expected[row] = expected.get(row, 0) + n
    found, sums = phrases._counted(columns, weights)
    assert list(zip(zip(*(c.tolist() for c in found), strict=True), sums.tolist(), strict=True)) == sorted(expected.items())


def test_few_pieces_for_many_ranges():
    """A shard sends its words with every piece: so many texts make one shard, not one for each 600,000 words."""
    batch = pa.record_batch({"lang": ["en"] * 100, "text": pa.array([b"a b c d e f g h i j " * 1500] * 100)})
    assert [shard.size > 1_500_000 for shard in phrases._sharded(iter([batch.slice(k * 10, 10) for k in range(10)]))] == [True]
