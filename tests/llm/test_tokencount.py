import random

import pytest

from strata.llm import tokencount
from strata.llm.queries import cleaning_edits, op4_tokencount
from strata.llm.tokens import encoder, vocabulary_path

from .data import clashing, odd_documents, rows, sentence


def exact(text):
    return len(encoder(vocabulary_path()).exact.encode(text, add_special_tokens=False).ids)


def count(part):
    return len(encoder(vocabulary_path()).ids(part))


def plainly(text, edits):
    out, at = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
        start = min(max(start, at), len(text))
        out += [text[at:start], new]
        at = min(max(end, start), len(text))
    return "".join(out) + text[at:]


def test_any_edits_count_as_from_scratch():
    random.seed(3)
    letters = " \n\tabé's  .,12<|endoftext|>漢  \u0085\x1c"
    texts = [sentence(300, k) for k in range(5)] + ["".join(random.choice(letters) for _ in range(900)) for _ in range(60)] + [""]
    for text in texts:
        tree = tokencount.CountTree.of(text, count)
        for _ in range(5):
            held, edits = tree.text(), []
            for _ in range(random.randint(1, 4)):
                a = random.randint(-2, len(held) + 2)
                edits.append((a, a + random.choice([0, 1, 5, 40, 700]), random.choice(["", " ", "  ", "x", " the", "word\n", " a b " * 60])))
            tree.apply(edits)
            assert tree.text() == plainly(held, edits)
            assert tree.total == exact(tree.text())


ODD = "aZé漢字ひハ한я019٣.,!'\"|<>。，！ \t\n\r\u00a0\u0085\x1c_-$€😀"


def test_cuts_of_any_characters():
    """A text of parts is encoded as the whole, whatever meets at a cut."""
    random.seed(8)
    for _ in range(400):
        text = "".join(random.choice(ODD) * random.choice([1, 1, 2]) for _ in range(40)) + random.choice(["", "<|endoftext|>", "it's we'll 'd"])
        cuts = [m.end() for m in tokencount._CUT.finditer(text)]
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        assert sum(map(count, parts)) == exact(text), text


def million(kind):
    random.seed(2)
    if kind == "lines":
        return "\n".join(random.choice(["word", "list", "of", "names", "item"]) for _ in range(200_000))
    if kind == "no spaces":
        return "".join(random.choice(["key=", "value&", "x", "10", "_id", ";"]) for _ in range(330_000))
    return "".join(random.choice(["今天", "天气", "很好", "我们", "一起", "去", "公园", "，", "。"]) for _ in range(550_000))


@pytest.mark.parametrize("kind", ["lines", "no spaces", "chinese"])
def test_many_edits_of_a_long_text(kind):
    """A million characters, ten thousand edits, in two rounds: about a part is encoded for an edit."""
    text = million(kind)
    tree = tokencount.CountTree.of(text, count)
    for round_ in range(2):
        held = tree.text()
        edits = [(a, a + random.choice([0, 1, 3]), random.choice(["", "x", "\n", "新", " 7"])) for a in random.sample(range(len(held)), 5_000)]
        tree.encoded = 0
        tree.apply(edits)
        assert tree.encoded < 2 * len(edits) * tokencount.PART
        assert tree.text() == plainly(held, edits)
    assert max(map(len, tree.parts)) < 10 * tokencount.PART
    assert tree.total == exact(tree.text())


def test_a_text_without_any_cut_is_encoded_once_for_all_edits():
    tree = tokencount.CountTree.of("x" * 50_000, count)
    tree.apply([(i * 40, i * 40 + 1, "y") for i in range(1000)])
    assert tree.encoded == 50_000 and tree.total == exact(tree.text())


def test_a_small_edit_encodes_little():
    text = sentence(20000)
    tree = tokencount.CountTree.of(text, count)
    tree.edit(5000, 5004, "word")
    assert tree.encoded < 2000 and tree.total == exact(tree.text())


def test_query_counts_from_scratch(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op4_tokencount(spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        edits = cleaning_edits(texts[r["doc_id"]])
        assert r["n_edits"] == len(edits) and r["n_tokens_before"] == exact(texts[r["doc_id"]])
        assert r["n_tokens"] == exact(plainly(texts[r["doc_id"]], edits))


def test_trees_can_be_edited_again(spark):
    docs = spark.createDataFrame([(1, sentence(400)), (2, None), (3, "")], "doc_id long, text string")
    held = tokencount.trees(docs)
    once = tokencount.recount(tokencount.with_edits(held, lambda t: [(3, 9, " new words"), (len(t), len(t), "!")]))
    again = tokencount.recount(tokencount.with_edits(once.select(*held.columns), lambda t: [(0, 2, "")]))
    for r in again.collect():
        assert r["n_tokens"] == exact(r["text"]) == sum(r["part_tokens"]) and sum(r["part_chars"]) == len(r["text"])


def test_odd_documents(spark):
    docs = odd_documents(spark)
    count_all = lambda d: tokencount.recount(tokencount.with_edits(tokencount.trees(d), cleaning_edits))
    assert rows(count_all(docs)) == rows(count_all(clashing(docs)))
    assert count_all(docs).where("doc_id in (2, 3)").agg({"n_tokens": "max"}).first()[0] == 0
    assert count_all(docs.limit(0)).count() == 0
    nulls = tokencount.trees(docs).selectExpr("*", f"cast(null as {tokencount.EDITS}) AS edits")
    assert tokencount.recount(nulls).where("n_tokens <> n_tokens_before or n_encoded > 0").count() == 0
