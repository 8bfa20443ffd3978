import corpus_pipeline
from strata.llm import langid, mixing, pii, simhash

from .data import odd_documents
from .test_packing import check_packed
from .test_simhash import brute_roots


def test_stages_against_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(corpus_pipeline.COLUMNS)
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, sf)
    assert kept.columns == corpus_pipeline.COLUMNS
    model = langid.fit(docs)
    encoders = model.encoders()
    expected = {r["doc_id"]: (p[0], r["text"]) for r in docs.collect() for p in [model.predict(r["text"], encoders)] if not p[2]}
    assert {r["doc_id"]: (r["lang"], r["text"]) for r in kept.collect()} == expected

    rows = sorted(kept.collect(), key=lambda r: r["doc_id"])
    roots = brute_roots([simhash.fingerprint(r["text"], 4) for r in rows], 4)
    once = stages[1](spark, kept, sf)
    assert once.columns == corpus_pipeline.COLUMNS
    assert sorted(r["doc_id"] for r in once.collect()) == sorted({rows[i]["doc_id"] for i in roots})

    clean = stages[2](spark, once, sf)
    m = pii.fit(once)
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {r["doc_id"]: pii.redacted(r["text"], m) for r in once.collect()}

    mixed = stages[3](spark, clean, sf)
    places = {r["doc_id"]: r["position"] for r in mixing.mixed(clean, corpus_pipeline.WEIGHTS).collect()}
    order = [r["doc_id"] for r in mixed.collect()]
    assert order == sorted(places, key=places.get)

    packed = stages[4](spark, mixed, sf)
    check_packed(packed.collect(), {r["doc_id"]: r["text"] for r in mixed.collect()}, 2048)


def test_sequences_follow_the_mixed_order(spark):
    """src0 and src10 have weights 40 and 20: sequences in order hold two of three tokens of src0 until it runs out."""
    docs = [(i, f"{'word ' * (150 + i % 3 * 50)}{i}", "en", "src0" if i < 400 else "src10", 1) for i in range(800)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix(spark, docs, "").localCheckpoint()
    assert mixed.columns == [*corpus_pipeline.COLUMNS, "position"]
    places = {r["doc_id"]: r["position"] for r in mixed.collect()}
    found = corpus_pipeline.pack(spark, mixed, "").collect()
    check_packed(found, {r["doc_id"]: r["text"] for r in mixed.collect()}, 2048)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((places[r["doc_id"]], r["length"], r["doc_id"] < 400))
    assert sorted(sequences) == list(range(len(sequences)))
    means = [sum(p * n for p, n, _ in sequences[k]) // sum(n for _, n, _ in sequences[k]) for k in sorted(sequences)]
    assert means == sorted(means)
    first = [x for k in sorted(sequences)[: len(sequences) * 2 // 3] for x in sequences[k]]
    assert abs(sum(n for _, n, a in first if a) / sum(n for _, n, _ in first) - 2 / 3) < 0.1
    last = [x for k in sorted(sequences)[len(sequences) * 5 // 6 :] for x in sequences[k]]
    assert not sum(n for _, n, a in last if a) > 0.1 * sum(n for _, n, _ in last)


def test_odd_and_empty_tables(spark, tmp_path):
    docs = odd_documents(spark).selectExpr("*", "1 AS extra")
    for k, rows in enumerate((docs, docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert found.count() == 0 if k else found.count() >= 3
