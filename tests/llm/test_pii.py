import random
import re
import warnings

import pytest

from strata.llm import pii
from strata.llm.queries import op6_pii

from .data import clashing, odd_documents, rows

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(int(x) <= 255 for x in match.split("."))
    if kind == 2:
        doubled = (int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m.group())]


def test_base_spans_on_noise():
    random.seed(4)
    for _ in range(4000):
        text = "".join(random.choice("0123456789..@+- ()ab%-_\n25é") for _ in range(50))
        assert pii.base_spans(text) == plain(text)
    assert pii.base_spans("x" * 200000 + "@") == []
    assert pii.base_spans("1" * 200000) == []


def test_counts_and_spans(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op6_pii(spark, sf).collect():
        base = plain(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in range(4)]
        joined = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert set(joined) <= set(filter(None, r["spans"].split(",")))


SAMPLES = [f"{a} {b} and" for a in ("+1 (017) 555-7713", "+1 (974) 555-3436") for b in ("",)] + [
    "a.12@mail3.example.com", "b.7@mail1.example.com,", "10.2.3.44", "192.168.20.1", "4111111111111111", "555-77", "9f3e", "40", "(3)",
]


def model():
    found = [s[a:b] for s in SAMPLES for a, b in pii.stretches(s)]
    return pii.train([(s, pii.base_spans(s)) for s in found])


def test_field_adds_what_patterns_miss():
    m = model()
    assert m.spans("(017) 555-7713") == [(3, 0, 14)]
    assert m.spans("300.2.3.4") == []
    base, spans = m.find("call (017) 555-7713 now, or +1 (017) 555-7713")
    assert (3, 5, 19) in spans and set(base) <= set(spans) and len(base) == 1


def best_by_trying(m, text):
    """Highest score of any segmentation, by recursion over all of them."""
    tokens, segments = pii._spans(text)
    starts = {}
    for i, j, features in segments:
        real = bool(re.search("[0-9@]", text[tokens[i][0] : tokens[j - 1][1]]))
        for label in range(5):
            if label == 0 and j == i + 1 or label and real:
                starts.setdefault(i, []).append((j, label, m.score(features)[label]))

    def best(i, last):
        return max((m.moves[last][k] + s + best(j, k) for j, k, s in starts.get(i, [])), default=-1e30) if i < len(tokens) else 0.0

    return best(0, 0)


def test_dynamic_programme_is_exact():
    m = model()
    for text in ("1.2 a@b", "(3) 4", "+1 2", "9-9"):
        tokens, segments = pii._spans(text)
        loose = pii.SpanModel(m.weights, m.moves, sure=-1e9)
        chosen = {(a, b): k + 1 for k, a, b in loose.spans(text)}
        score, last, i = 0.0, 0, 0
        lookup = {(i, j): f for i, j, f in segments}
        while i < len(tokens):
            j = next((j for j in range(i + 1, len(tokens) + 1) if (tokens[i][0], tokens[j - 1][1]) in chosen), i + 1)
            label = chosen.get((tokens[i][0], tokens[j - 1][1]), 0)
            score += m.moves[last][label] + m.score(lookup[i, j])[label]
            last, i = label, j
        assert abs(score - best_by_trying(m, text)) < 1e-6


def test_redaction():
    m = pii.SpanModel()
    assert pii.redacted("x a@b.c, 1.2.3.4!", m) == "x <EMAIL>, <IP>!"
    assert pii.redacted(None, m) is None and pii.redacted("clean", m) == "clean"


def test_odd_documents(spark):
    docs = odd_documents(spark)
    m = pii.fit(docs)
    assert rows(pii.find(docs, m)) == rows(pii.find(clashing(docs), m))
    by_id = {r["doc_id"]: r for r in pii.find(docs, m).collect()}
    assert by_id[7]["n_email"] == by_id[7]["n_phone"] == by_id[7]["n_ip"] == 1
    assert by_id[2]["spans"] == by_id[3]["spans"] == ""
    out = pii.redact(docs, m)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert "<EMAIL> or <PHONE>, <IP>" in out.where("doc_id = 7").first()["text"]
    empty = docs.limit(0)
    assert pii.fit(empty).weights == {} and pii.find(empty, m).count() == 0


def test_rare_kinds_are_learned(spark):
    """Among many years, prices and code, each of few matches is learned from, also in a long stretch."""
    text = "concat('in ', id, ' for ', id, '.', id % 7, ' ', repeat('x', cast(id % 150 as int)), '-', id, repeat('(', cast(id % 40 as int)), id, ' of')"
    noise = spark.range(1000, 9000).selectExpr("id AS doc_id", f"{text} AS text")
    long = " ".join(["77"] * 90) + " a.b1@mail.example.com " + " ".join(["88"] * 90)
    rare = [(1, "call +1 (017) 555-7713 now"), (2, "from 10.2.3.44 and"), (3, "pay 4111111111111111 by"), (4, f"x {long} y")]
    docs = noise.union(spark.createDataFrame(rare, "doc_id long, text string"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        model = pii.fit(docs)
    assert model.spans("(017) 555-7713") == [(3, 0, 14)]
    for kind, text in enumerate(["c.d2@mail.example.com", "10.2.9.45", "4111111111111111"]):
        assert model.spans(text) == [(kind, 0, len(text))]


def test_kinds_without_a_form_are_warned_of(spark):
    docs = spark.createDataFrame([(1, "ring +1  -  017 555 7713 or 12"), (2, "a.b@c.example.org or")], "doc_id long, text string")
    with pytest.warns(UserWarning, match="learn from: phone"):
        assert pii.fit(docs).weights
