import pytest

from strata.llm import licenses
from strata.llm.queries import op9_licenses
from tests.compare import connect, difference

from .data import clashing, odd_documents, rows, sentence


class SqlQuery:
    sql = licenses.oracle()

    def __call__(self, spark, sf):
        return op9_licenses(spark, sf)


def test_equals_sql(spark, sf):
    sf = sf.replace("0.001", "0.01")
    assert difference(spark, connect(sf), SqlQuery(), sf) is None


def brute(texts):
    import re

    out = {}
    for template in licenses.prepared_templates(licenses.TEMPLATES):
        wanted, half = set(template.shingles), template.window // 2
        for doc, text in texts:
            words = re.findall("[a-z0-9]+", (text or "").lower())
            for k in range(len(words) // half + 1):
                window = words[k * half : k * half + template.window]
                held = {" ".join(window[i : i + 5]) for i in range(len(window) - 4)}
                share = len(wanted & held) / len(wanted)
                if share >= 0.8 - 1e-9:
                    out.setdefault((doc, template.name), {}).setdefault((template.window, k * half), []).append(share)
    return {(d, t, max(map(max, w.values())), len(w), min(p for _, p in w)) for (d, t), w in out.items()}


def test_notices_anywhere(spark):
    texts, i = [], 0
    for name, text in licenses.TEMPLATES.items():
        words = text.split()
        for before in (0, 1, 7, 50):
            texts.append((i, f"{sentence(before, i)} {text.upper()} {sentence(40, i)}"))
            cut = words[: -max(1, len(words) // 12)] if len(words) > 20 else words
            texts.append((i + 1, f"{sentence(before, i)}\n* {' '.join(cut)}\n{sentence(9, i)}"))
            texts.append((i + 2, f"{sentence(before, i)} {' '.join(words[: len(words) // 2])} {sentence(9, i)}"))
            i += 3
    texts += [(i, " ".join(licenses.TEMPLATES.values()) * 3), (i + 1, None), (i + 2, ""), (i + 3, "Released under the MIT")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {tuple(r) for r in licenses.scan(docs).collect()}
    assert found == brute(texts)
    assert {t for _, t, *_ in found} == set(licenses.TEMPLATES)


def test_bands_meet_the_bound():
    templates = licenses.prepared_templates(licenses.TEMPLATES)
    count = licenses.bands(templates, 0.8, 1e-5)
    for t in templates:
        assert (1 - t.similarity(0.8)) ** count <= 1e-5 * 1.001
        assert t.window >= 2 * len(t.words)
    with pytest.raises(ValueError):
        licenses.prepared_templates({"x": "too short"})


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = licenses.scan(docs)
    assert rows(found) == rows(licenses.scan(clashing(docs))) == []
    assert licenses.scan(docs.limit(0)).count() == 0


def test_no_python_on_the_way(spark, sf):
    plan = licenses.scan(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan
