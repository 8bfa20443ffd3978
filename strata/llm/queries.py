"""One query per operator, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries.base import table
from . import langid, licenses, minhash, mixing, packing, phrases, pii, quality, runs, simhash, site_tree, tokencount, topk
from .shared import prepared


def op1_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(prepared(spark), sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return simhash.near_duplicates(docs, words=4, distance=4).select("doc_id", "fingerprint", "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs), ["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


#: Target weights of the sources: src0 most, each next one less; sources not named share one weight.
WEIGHTS = {f"src{i}": 40 - 2 * i for i in range(20)}


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(prepared(spark), sf_dir, "embeddings"), k=5, every=50)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(prepared(spark), sf_dir, "documents"), containment=0.8)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return mixing.mixed(docs, WEIGHTS, rest=1).select("doc_id", "source", "block", "slot", "position")


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits of a cleaning step: base personal data is masked, and lines that repeat an earlier one are cut."""
    edits = [(a, b, f"<{pii.KINDS[kind].upper()}>") for kind, a, b in pii.base_spans(text)]
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            edits.append((at - 1, at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    return edits


def op4_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = tokencount.trees(table(prepared(spark), sf_dir, "documents"))
    counted = tokencount.recount(tokencount.with_edits(held, cleaning_edits))
    return counted.select("doc_id", "n_tokens_before", "n_edits", "n_encoded", "n_tokens")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(prepared(spark), sf_dir, "documents"), capacity=2048)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, by their id, the words from some place on repeat with some period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(prepared(spark), sf_dir, "documents"), least=6, exponent=4, change=with_repeats)
    best = F.col("runs")[F.col("strongest")]
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * runs[strongest].length div runs[strongest].period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(prepared(spark), sf_dir, "documents"), words=4, percent=80)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(prepared(spark), sf_dir, "documents"), least=30, most=2000)


QUERIES = {
    "op1_site_tree": op1_site_tree,
    "op2_simhash": op2_simhash,
    "op3_langid": op3_langid,
    "op4_tokencount": op4_tokencount,
    "op5_packing": op5_packing,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_topk": op8_topk,
    "op9_licenses": op9_licenses,
    "op10_mixing": op10_mixing,
    "op11_runs": op11_runs,
    "op12_minhash": op12_minhash,
    "op13_phrases": op13_phrases,
}

SQL: dict[str, str] = {
    "op8_topk": """
      WITH vectors AS (
        SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      ),
      scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        WHERE q.vec_id % 50 = 0
      ),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_licenses": licenses.oracle(),
}
