"""Document quality: base rules, and gradient-boosted trees over document statistics.

Trees are grown on histograms of the statistics of labelled documents, with monotonic constraints:
more symbols, repeats or duplicate lines never raise a score. The fitted trees are flattened into
numpy arrays of nodes, and whole batches step down all of them together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and the direction in which each may move the score: 1 up, -1 down, 0 free.
FEATURES = {
    "words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "duplicate_lines": -1,
    "repeated_words": -1,
    "distinct_words": 1,
    "upper_share": -1,
    "digit_share": -1,
    "pipes_per_word": -1,
    "short_lines": -1,
    "ends_per_word": 0,
    "exclamations_per_word": -1,
}
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[str]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text."""
    return [w for w in _SPACE.split(text) if w] if text else []


def repeated_words(words: list[str]) -> int:
    """Words that lie in 3-word windows found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    places: dict[str, int] = {}
    at = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, n)
    size = len(places)
    if size < 2_000_000:  # three ids fit a long
        windows = (at[:-2] * size + at[1:-1]) * size + at[2:]
    else:
        pairs = np.unique(at[:-2] * size + at[1:-1], return_inverse=True)[1].astype(np.int64)
        windows = pairs * size + at[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[which] >= 2)
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[twice + k] = True
    return int(marked.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(values of BASE, values of FEATURES) of a whole text; NULL has no words."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0, 0, len(_SYMBOLS.findall(text)) if text else 0, 0, 0], [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    symbols = len(_SYMBOLS.findall(text))
    seen: set[str] = set()
    lines = duplicates = short = 0
    for line in text.split("\n"):
        if _has_word(line):
            lines += 1
            duplicates += line in seen
            seen.add(line)
            short += len(line) < 30
    repeats = repeated_words(words)
    upper = sum(map(str.isupper, words))
    base = [n, chars, symbols, duplicates, repeats]
    features = [
        float(min(n, 5000)), chars / n, symbols / n, duplicates / lines, repeats / n, len(set(words)) / n, upper / n,
        sum(map(str.isdigit, words)) / n, text.count("|") / n, short / lines, text.count(".") / n, text.count("!") / n,
    ]
    return base, features


def _has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\x0b\x0c\r"))


@dataclass(frozen=True)
class Trees:
    """Trees as arrays over all nodes. A leaf points to itself, so that every row takes `depth` steps."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0
    base: float = 0.0
    keep_from: float = -np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for each row of features."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(1) if len(self.roots) else np.full(len(x), self.base)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 2.0) -> Trees:
    """Boosted trees for y in {0, 1}, on histograms of `bins` quantiles; directions from FEATURES.

    A split against a feature's direction is not taken, and the bound between its sides, their middle,
    holds for all nodes below, so a path can't undo it.
    """
    directions = list(FEATURES.values())
    if len(y) == 0 or y.min() == y.max():
        return Trees(base=0.0)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    place = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node(rows: np.ndarray, low: float, high: float, deep: int) -> int:
        me = len(feature)
        g, h = gradient[rows].sum(), weight[rows].sum()
        best = (1e-6, None)
        if deep < depth:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gs = np.cumsum(np.bincount(place[rows, f], gradient[rows], len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(place[rows, f], weight[rows], len(c) + 1))[:-1]
                vl = np.clip(gs / (hs + 1), low, high)
                vr = np.clip((g - gs) / (h - hs + 1), low, high)
                gain = _gain(gs, hs, vl) + _gain(g - gs, h - hs, vr) - _gain(g, h, np.clip(g / (h + 1), low, high))
                gain = np.where((hs < least) | (h - hs < least) | (directions[f] * (vr - vl) < 0), -np.inf, gain)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, vl[k], vr[k]))
        feature.append(0), cut.append(np.inf), left.append(me), right.append(me), value.append(0.0)
        if best[1] is None:
            value[me] = rate * float(np.clip(g / (h + 1), low, high))
            total[rows] += value[me]
            return me
        f, k, vl, vr = best[1]
        middle = (vl + vr) / 2
        goes = place[rows, f] <= k
        limits = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[directions[f]]
        feature[me], cut[me] = f, float(cuts[f][k])
        left[me] = node(rows[goes], *limits[0], deep + 1)
        right[me] = node(rows[~goes], *limits[1], deep + 1)
        return me

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        gradient, weight = y - chance, chance * (1 - chance)
        roots.append(node(np.arange(len(y)), -np.inf, np.inf, 0))
    ints = (np.array(v, np.int32) for v in (feature, left, right, roots))
    feature, left, right, roots = ints
    return Trees(feature, np.array(cut), left, right, np.array(value), roots, depth, base)


def _gain(g, h, v):
    """Drop of the second-order loss when a side with gradient g and weight h gets value v."""
    return g * v - 0.5 * (h + 1) * v * v


def fit(docs: DataFrame, labels: DataFrame, rows: int = 4000, lost: float = 0.002) -> Trees:
    """Trees from about `rows` labelled documents chosen by a hash of the id; the classifier's only sample.

    A document with several labels counts with their mean, rounded up. Trees keep a document whose
    score is at least the `lost` quantile of the good ones' scores in the sample, and at least even.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.ceil(F.avg("quality")).cast("double").alias("y"))
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(1 << 30))
    some = known.where(spread <= int((1 << 30) * min(1.0, rows / max(known.count(), 1))))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(spread <= (1 << 30)).join(F.broadcast(some.limit(2 * rows)), "doc_id")

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            found = [statistics(t)[1] for t in batch.column("text").to_pylist()]
            return pa.table({"doc_id": batch.column("doc_id").cast(pa.int64()), "y": batch.column("y"), "x": pa.array(found, pa.list_(pa.float64()))})

        return each

    sample = by_batch(texts, make, "doc_id long, y double, x array<double>").collect()
    if not sample:
        return Trees()
    sample.sort(key=lambda r: (r["doc_id"], r["y"], r["x"]))
    x, y = np.array([r["x"] for r in sample]), np.array([r["y"] for r in sample])
    grown = grow(x, y)
    good = grown.score(x[y > 0])
    edge = min(0.0, float(np.quantile(good, lost))) if len(good) and len(grown.roots) else -np.inf
    return Trees(**{**grown.__dict__, "keep_from": edge})


def judge(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, BASE counts, base_failed, score, kept) of every row.

    A document fails the base rules with under 50 words, or with over half its words in repeated
    3-word windows. The others are kept if the trees score them high enough; without labels all are.
    NULL and empty texts have no words and fail. Repeated rows are answered alike; other columns are
    not read.
    """

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            base = np.array([f[0] for f in found], np.int64).reshape(len(found), len(BASE))
            score = trees.score(np.array([f[1] for f in found]).reshape(len(found), len(FEATURES)))
            failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
            out = {"doc_id": batch.column("doc_id")} | {c: base[:, k] for k, c in enumerate(BASE)}
            return pa.table(out | {"base_failed": failed, "score": score, "kept": ~failed & (score >= trees.keep_from)})

        return each

    counts = ", ".join(f"{c} long" for c in BASE)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return by_batch(rows, make, f"doc_id long, {counts}, base_failed boolean, score double, kept boolean")
