"""License notices in documents: MinHash retrieval of templates, verified by shingle containment.

A text is read in overlapping windows, twice as long as the templates of a length class and half a
window apart, so that a notice lies whole in some window. Single-row bands of MinHashes over word
shingles retrieve templates for a window; how many bands is set from the lowest similarity a match
can have, so that missing one is as unlikely as asked. The retrieved templates are then verified:
the share of a template's shingles that the window holds must reach the containment asked for.

All of it is DataFrame functions. Windows without any shingle of any template can share no MinHash
with one, so only the others are hashed; every shingle of every text is looked at for that.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5

# Public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
}


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    window: int

    @property
    def shingles(self) -> list[str]:
        return list(dict.fromkeys(" ".join(self.words[i : i + WORDS]) for i in range(len(self.words) - WORDS + 1)))

    def similarity(self, containment: float) -> float:
        """Lowest similarity of the template to a window that holds `containment` of its shingles."""
        n = len(self.shingles)
        shared = math.ceil(containment * n - 1e-9)
        return shared / (n + self.window - WORDS + 1 - shared)


def prepared_templates(texts: dict[str, str]) -> list[Template]:
    """Templates with windows of twice their length, lengths rounded up by at most a third: 5, 8, 12, 16, 24, 32 ..."""
    out = []
    for name, text in texts.items():
        words = tuple(re.findall("[a-z0-9]+", text.lower()))
        if len(words) < WORDS:
            raise ValueError(f"template {name}: under {WORDS} words")
        sizes = [5, *(x for k in range(3, 24) for x in (2**k, 2**k + 2 ** (k - 1)))]
        out.append(Template(name, words, 2 * next(s for s in sizes if s >= len(words))))
    return out


def bands(templates: list[Template], containment: float, miss: float) -> int:
    """How many single-row bands leave at most the chance `miss` that a matching window shares none."""
    lowest = min(t.similarity(containment) for t in templates)
    return 1 if lowest >= 1 else math.ceil(math.log(miss) / math.log(1 - lowest))


def _minhashes(shingles: Column, count: int) -> Column:
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


def _shingles(words: Column) -> Column:
    last = F.size(words) - WORDS
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", F.slice(words, i + 1, WORDS)))).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, texts: dict[str, str] = TEMPLATES, containment: float = 0.8, miss: float = 1e-5) -> DataFrame:
    """(doc_id, license, containment, windows, first_word) of every license found in every text.

    containment is the highest share of the template's distinct 5-word shingles in a window, windows
    how many windows reach the share asked for, first_word where the first of them starts. Rows with
    one doc_id, NULL too, are one document: windows at one place are one, the best. NULL, empty and short texts have no licenses. Other columns are not read.
    """
    spark = docs.sparkSession
    templates = prepared_templates(texts)
    count = bands(templates, containment, miss)
    known, wanted = _template_tables(spark, templates, count)
    sizes = sorted({t.window for t in templates})

    split = docs.select("doc_id", F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "[^a-z0-9]+").alias("words"))
    # Nothing stands before the first word, or an empty one.
    words = split.select("doc_id", F.slice("words", F.when(F.get("words", F.lit(0)) == "", 2).otherwise(1), F.size("words")).alias("words"))
    at = lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WORDS)])
    last = F.size("words") - WORDS
    # Words of a shingle that is in a template are in a template: the cheap test goes first.
    used = sorted({w for t in templates for w in t.words})
    word = lambda i, k: F.get(F.col("words"), i + k).isin(used)
    hits = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: (i <= last) & word(i, 0) & word(i, 4) & word(i, 2) & at(i).isin(sorted(set().union(*known.values()))))
    # A window of w words starts every w / 2, so a place is in two; the one before the text's start is none.
    # Windows of a size meet templates of that size only, so only those templates' shingles open one.
    def cut_for(w: int) -> Column:
        half = w // 2
        near = F.flatten(F.transform(F.filter(F.col("hits"), lambda p: at(p).isin(sorted(known[w]))), lambda p: F.array(F.floor(p / half).cast("int") - 1, F.floor(p / half).cast("int"))))
        places = F.array_distinct(F.filter(near, lambda k: k >= 0))
        return F.transform(places, lambda k: F.struct(F.lit(w).alias("w"), k.alias("k"), F.slice(F.col("words"), k * half + 1, w).alias("words")))

    cut = F.flatten(F.array(*[cut_for(w) for w in sizes]))
    found = words.withColumn("hits", hits).select("doc_id", F.explode(cut).alias("x"))
    windows = found.select("doc_id", "x.w", "x.k", _shingles(F.col("x.words")).alias("shingles"))
    hashed = windows.withColumn("bands", _minhashes(F.col("shingles"), count))
    keyed = hashed.select("doc_id", "w", "k", "shingles", F.posexplode("bands").alias("band", "low"))
    met = keyed.join(F.broadcast(wanted), ["w", "band", "low"])  # one row per band of a few templates
    share = F.size(F.array_intersect("shingles", "template")) / F.size("template")
    sure = met.select("doc_id", "w", "k", "license", share.alias("share")).where(F.col("share") >= containment - 1e-9)
    once_each = sure.groupBy("doc_id", "license", "w", "k").agg(F.max("share").alias("share"))
    return once_each.groupBy("doc_id", "license").agg(
        F.max("share").alias("containment"), F.count("*").alias("windows"), F.min(F.expr("cast(k * (w div 2) as long)")).alias("first_word")
    )


def _template_tables(spark: SparkSession, templates: list[Template], count: int) -> tuple[dict[int, set[int]], DataFrame]:
    """Hashes of the templates' shingles by window, and (w, band, low, license, template) of their bands."""
    rows = spark.createDataFrame([(t.name, t.window, t.shingles) for t in templates], "license string, w int, template array<string>")
    hashed = rows.select("w", F.explode("template").alias("s")).select("w", F.xxhash64(*[F.split("s", " ")[k] for k in range(WORDS)]).alias("h"))
    known: dict[int, set[int]] = {t.window: set() for t in templates}
    for r in hashed.collect():
        known[r["w"]].add(r["h"])
    keyed = rows.select("license", "w", "template", F.posexplode(_minhashes(F.col("template"), count)).alias("band", "low"))
    return known, keyed


def oracle(texts: dict[str, str] = TEMPLATES, containment: float = 0.8) -> str:
    """DuckDB SQL for scan() of `documents`: every window against every template of its size."""
    rows = ", ".join(f"('{t.name}', {t.window}, {len(t.shingles)}, '{s}')" for t in prepared_templates(texts) for s in t.shingles)
    return f"""
      WITH templates(license, w, n, shingle) AS (VALUES {rows}),
      texts AS (
        SELECT row_number() OVER () AS r, doc_id,
               list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS words
        FROM documents
      ),
      placed AS (SELECT r, doc_id, words, unnest(range(0, len(words) - {WORDS - 1})) AS p FROM texts),
      hits AS (
        SELECT r, doc_id, p, t.license, t.w, t.n, t.shingle
        FROM placed JOIN templates t ON array_to_string(words[p + 1 : p + {WORDS}], ' ') = t.shingle
      ),
      windows AS (
        SELECT r, doc_id, license, w, n, shingle, p // (w // 2) - d AS k, p
        FROM hits CROSS JOIN (VALUES (0), (1)) AS x(d)
      ),
      shares AS (
        SELECT doc_id, license, w, k, r, count(DISTINCT shingle) / n AS share
        FROM windows WHERE k >= 0 AND p + {WORDS} <= k * (w // 2) + w
        GROUP BY doc_id, license, w, n, k, r
      ),
      best AS (SELECT doc_id, license, w, k, max(share) AS share FROM shares WHERE share >= {containment} - 1e-9 GROUP BY ALL)
      SELECT doc_id, license, max(share) AS containment, count(*) AS windows, CAST(min(k * (w // 2)) AS BIGINT) AS first_word
      FROM best GROUP BY doc_id, license
    """
