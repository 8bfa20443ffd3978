import pytest

import corpus_pipeline
from strata.llm import langid
from strata.llm.queries import op3_langid

from .data import clashing, odd_documents, rows


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op3_langid(spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(labels)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) < 0.02 * len(found)


def test_held_out_rows_and_labels_are_not_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    changed = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    assert langid.fit(changed).dictionaries == model.dictionaries
    relabelled = docs.selectExpr("doc_id", "text", "'xx' AS lang")
    a = langid.identify(docs, model, ["doc_id"])
    assert rows(a) == rows(langid.identify(relabelled, model, ["doc_id"]))


def test_letters():
    assert not langid.has_letter(None) and not langid.has_letter("12 _ ½ ²!") and langid.has_letter("1 é")
    model = langid.LanguageModel({"a": b"some words here", "b": b"andere worte hier"})
    assert model.predict("12 34", model.encoders()) == ("und", 0.0, True)
    assert model.predict("andere worte", model.encoders())[0] == "b"
    tie = model.predict("q", model.encoders())
    assert tie[0] == "a" and tie[2]
    assert langid.LanguageModel({}).predict("words", []) == ("und", 0.0, True)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    model = langid.fit(docs)
    found = langid.identify(docs, model, ["doc_id"])
    assert rows(found) == rows(langid.identify(clashing(docs).drop("lang_pred", "score", "rejected"), model, ["doc_id"]))
    assert found.count() == docs.count()
    assert {r["lang_pred"] for r in found.where("doc_id in (2, 3, 4, 6)").collect()} == {"und"}
    empty = docs.limit(0)
    assert langid.fit(empty).dictionaries == {} and langid.identify(empty, langid.fit(empty), ["doc_id"]).count() == 0


def test_every_label_is_learned(spark):
    # Words of five letters that no two of the 240 languages share.
    word = "concat_ws(' ', transform(sequence(0, 39), i -> translate(lpad(cast(id % 240 * 40 + i as string), 5, '0'), '0123456789', 'abcdefghij')))"
    docs = spark.range(2400).selectExpr("id AS doc_id", "concat('l', id % 240) AS lang", f"{word} AS text")
    model = langid.fit(docs)
    assert len(model.dictionaries) == 240 and sum(map(len, model.dictionaries.values())) <= 200 * 65536
    encoders = model.encoders()
    found = {r["lang"]: model.predict(r["text"], encoders)[0] for r in docs.where("doc_id < 240 AND doc_id % 16 = 0").collect()}
    assert all(a == b for a, b in found.items())
    small = langid.fit(docs, total=240 * 100, least=100)
    assert len(small.dictionaries) == 240 and max(map(len, small.dictionaries.values())) <= 100
    with pytest.raises(ValueError, match="more than 239 languages"):
        langid.fit(docs, total=239 * 100, least=100)


def test_nothing_learned_is_an_error(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "cast(null as string) AS lang", "source", "n_chars")
    with pytest.raises(ValueError, match="no language"):
        corpus_pipeline.language(spark, docs, sf)
