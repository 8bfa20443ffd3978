"""The training-data pipeline over `documents`: what is kept, in what order, in which sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of `documents`, and mixing the position by which packing orders the sequences; run() writes each stage's rows and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid, mixing, packing, pii, simhash
from strata.llm.queries import WEIGHTS
from strata.llm.shared import prepared, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear. `lang` becomes the language found; rejected ones go."""
    docs = docs.select(COLUMNS)
    columns = ["doc_id", "source", "n_chars"]
    model = langid.fit(docs)
    if not model.dictionaries and not docs.isEmpty():
        raise ValueError("no language can be learned: all documents would be rejected")
    found = langid.identify(docs.withColumn("body", F.col("text")), model, [*columns, "body"])
    kept = found.where(~F.col("rejected")).withColumnsRenamed({"body": "text", "lang_pred": "lang"})
    return kept.select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 4 bits of 64, over shingles of 4 words: the smallest doc_id."""
    return simhash.without_near_duplicates(docs.select(COLUMNS), words=4, distance=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by <EMAIL>, <IP>, <CARD> and <PHONE>; every document stays."""
    docs = docs.select(COLUMNS)
    return pii.redact(docs, pii.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources to their target weights, and their position in it."""
    return mixing.in_mixed_order(docs.select(COLUMNS), WEIGHTS, rest=1, place="position")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 2048 tokens, which follow the mixed order."""
    return packing.packed(docs.select(*COLUMNS, "position"), capacity=2048, order="position")


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Compression, fingerprints, spans and tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
