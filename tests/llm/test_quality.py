import re
from collections import Counter

import numpy as np

from strata.llm import quality
from strata.llm.queries import op7_quality

from .data import clashing, odd_documents, rows


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)]


def test_counts_and_base_rules(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op7_quality(spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        base = plain(texts[r["doc_id"]])
        assert [r[c] for c in quality.BASE] == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["base_failed"] and r["kept"])


def test_labels_are_learned(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.fit(docs.where("doc_id % 2 = 0"), labels)
    held = quality.judge(docs.where("doc_id % 2 = 1"), trees).join(labels, "doc_id").where("not base_failed")
    good, bad = held.where("quality = 1"), held.where("quality = 0")
    assert good.where("kept").count() >= 0.99 * good.count()
    assert bad.where("kept").count() <= 0.1 * bad.count()


def test_trees_are_monotonic():
    rng = np.random.default_rng(3)
    names = list(quality.FEATURES)
    x = rng.random((600, len(names)))
    y = ((np.sin(9 * x[:, 2]) + x[:, 5] + rng.normal(0, 0.5, 600)) > 0.5).astype(float)
    trees = quality.grow(x, y)
    for f, direction in enumerate(quality.FEATURES.values()):
        if direction:
            steps = np.repeat(x[:40, None, :], 50, axis=1)
            steps[:, :, f] = np.linspace(0, 1, 50)
            scores = trees.score(steps.reshape(-1, len(names))).reshape(40, 50)
            assert (direction * np.diff(scores, axis=1) >= -1e-12).all()


def test_flat_arrays_equal_walking():
    rng = np.random.default_rng(5)
    x = rng.random((300, len(quality.FEATURES)))
    trees = quality.grow(x, (x[:, 0] > 0.4).astype(float), trees=5)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.score(x), [walk(r) for r in x])


def test_many_distinct_words():
    text = " ".join(f"w{i}" for i in range(5000)) + " w1 w2 w3"
    assert quality.repeated_words(quality.words_of(text)) == 6
    assert quality.repeated_words(["a", "b", "c"]) == 0 and quality.repeated_words(["a"] * 4) == 4


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (5, 0, 0), (None, 1, 0), (7, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    trees = quality.fit(docs, labels)
    assert rows(quality.judge(docs, trees)) == rows(quality.judge(clashing(docs), trees))
    found = {r["doc_id"]: r for r in quality.judge(docs, trees).collect()}
    assert found[2]["base_failed"] and found[3]["n_words"] == found[4]["n_words"] == 0
    empty = docs.limit(0)
    none = quality.fit(empty, labels.limit(0))
    assert quality.judge(empty, none).count() == 0
    assert quality.judge(docs, none).where("kept = base_failed").count() == 0
