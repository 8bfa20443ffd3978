"""Tables with the odd cases that every operator must take: NULLs, empty and long texts, repeats, clashing columns."""

WORDS = "the quick brown fox jumps over a lazy dog while seven green birds watch from old stone walls near quiet rivers".split()


def sentence(n, seed=0):
    return " ".join(WORDS[(i * 7 + i * i + seed * 13) % len(WORDS)] for i in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    long_text = sentence(30000, 5) + " x" * 2000
    rows = [
        (0, sentence(80, 1), "en", "a"),
        (1, sentence(80, 1), "en", "a"),  # a copy
        (1, sentence(80, 1), "en", "a"),  # a repeated row
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n ", "en", "b"),
        (5, long_text, "en", "b"),
        (6, "12 34 !!", "fr", "b"),
        (None, sentence(60, 3), "fr", "c"),
        (None, None, None, None),
        (7, sentence(90, 4) + " mail a.b@c.example.org or +1 (017) 555-7713, 10.0.0.255", "en", "a"),
    ]
    rows = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """Extra columns with the names that operators use for their own."""
    names = "id fp key rank block slot position class piece start length spans base score kept host path removed edits words hits band w k low text_hash component_id fingerprint rejected lang_pred"
    for name in names.split():
        docs = docs.selectExpr("*", f"'x' as {name}")
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
