"""Personal data: base patterns, and a semi-Markov conditional random field for what they miss.

The field labels whole spans. A stretch of words with a digit or an @ is cut into tokens; every span
of up to MOST_TOKENS tokens is scored as a whole (its shape, its numbers, what stands around it),
and a dynamic programme over bounded segments picks boundaries and kinds together. It is trained on
a bounded sample of stretches with each kind, and of those with none, drawn over all documents; their
base matches are the labels, some written the way people also write them. Spans it is sure of, apart from the base matches, are added.
"""

from __future__ import annotations

import functools
import heapq
import re
import warnings
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, stored

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 16
#: Longest stretch to learn from; of a longer one, what stands around its matches.
LONGEST = 160

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive repeats and the look behind only keep long runs from being tried again and again.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    if not text or not _ANCHOR.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """(start, end) of runs of words, one space or tab apart, that each hold a digit or an @."""
    out, pos = [], 0
    while m := _ANCHOR.search(text, pos):
        start = m.start()
        floor = out[-1][1] if out else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, m.end())
        pos = space.start() if space else len(text)
        if out and start == out[-1][1] + 1 and text[start - 1] in " \t":
            out[-1] = (out[-1][0], pos)
        else:
            out.append((start, pos))
    return out


def _class(c: str) -> str:
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


@functools.lru_cache(maxsize=65536)
def _features(span: str, before: str, after: str) -> tuple[str, ...]:
    """What the whole span looks like, and the classes of its neighbours."""
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{len(m.group())}", span))[:48]
    digits = _NOT_DIGIT.sub("", span)
    parts = span.split(".")
    return (
        f"shape {shape}",
        f"form {re.sub('9[0-9]+', '9', shape)}",
        f"digits {min(len(digits), 20)}",
        f"at {min(span.count('@'), 2)} dots {min(span.count('.'), 4)}",
        f"around {before}{after}",
        f"ends {_class(span[0])}{_class(span[-1])}",
        f"luhn {13 <= len(digits) <= 19 and luhn(digits)}",
        f"octets {len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)}",
    )


def _spans(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, tuple[str, ...]]]]:
    """Tokens of a stretch (start, end), and its segments (first token, token after, features): single tokens, then candidates."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    edge = [_class(text[a]) for a, _ in tokens]
    out = []
    for i, (a, _) in enumerate(tokens):
        before = edge[i - 1] if i else "^"
        for j in range(i + 1, min(i + MOST_TOKENS, len(tokens)) + 1):
            end = tokens[j - 1][1]
            after = edge[j] if j < len(tokens) else "$"
            if j == i + 1 or edge[i] in "9a+(._%-" and edge[j - 1] in "9a" and _ANCHOR.search(text, a, end):
                out.append((i, j, _features(text[a:end], before, after)))
    return tokens, out


@dataclass(frozen=True)
class SpanModel:
    """Weights by feature, one per label (none, then KINDS), and between labels of neighbouring segments.

    sure: a span is added only if it beats calling its tokens nothing by this log-odds.
    """

    weights: dict[str, list[float]] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0] * 5 for _ in range(5)])
    sure: float = 3.0

    def score(self, features: tuple[str, ...]) -> list[float]:
        rows = [w for f in features if (w := self.weights.get(f))]
        return [sum(x) for x in zip(*rows, strict=True)] if rows else [0.0] * 5

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Best segmentation of one stretch: (kind, start, end) of the spans it is sure of."""
        if not self.weights:
            return []
        tokens, segments = _spans(text)
        best = [[0.0] + [-1e30] * 4] + [[-1e30] * 5 for _ in tokens]
        back: list[list] = [[None] * 5 for _ in range(len(tokens) + 1)]
        plain = [0.0] * len(tokens)
        for i, j, features in segments:  # in order of i, so best[i] is final
            scores = self.score(features)
            if j == i + 1:
                plain[i] = scores[0]
            for label in range(5):
                if label == 0 and j > i + 1 or label and not _ANCHOR.search(text, tokens[i][0], tokens[j - 1][1]):
                    continue
                value, last = max((best[i][k] + self.moves[k][label], k) for k in range(5))
                if value + scores[label] > best[j][label]:
                    best[j][label], back[j][label] = value + scores[label], (i, last, scores[label])
        out, j = [], len(tokens)
        label = max(range(5), key=lambda k: best[j][k])
        while j:
            i, last, score = back[j][label]
            if label and score - sum(plain[i:j]) >= self.sure:
                out.append((label - 1, tokens[i][0], tokens[j - 1][1]))
            j, label = i, last
        return out

    def find(self, text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base spans, all spans), both by kind, then start. Added spans never touch a base one."""
        base = base_spans(text)
        spans = list(base)
        if text and self.weights:
            taken = sorted((a, b) for _, a, b in base)
            k = 0
            for start, end in stretches(text):
                for kind, a, b in sorted(self.spans(text[start:end]), key=lambda s: s[1]):
                    a, b = a + start, b + start
                    while k < len(taken) and taken[k][1] <= a:
                        k += 1
                    if not any(x < b and a < y for x, y in taken[k : k + 8]):
                        spans.append((kind, a, b))
        return base, sorted(spans)


def variants(text: str) -> list[str]:
    """The stretch, and the ways people also write what it holds."""
    more = [re.sub(r"\+[0-9]{1,2} ", "", text), re.sub(r"\+([0-9])", r"00\1", text)]
    return [text, *[m for m in dict.fromkeys(more) if m != text]]


def counterexamples(text: str, base: list[tuple[int, int, int]]) -> list[str]:
    """The stretch with its one address or card number made invalid: nothing should be found."""
    if len(base) != 1:
        return []
    kind, a, b = base[0]
    if kind == KINDS.index("ip"):
        return [text[:a] + re.sub("^[0-9]+", "999", text[a:b]) + text[b:]]
    if kind == KINDS.index("card"):
        return [text[: b - 1] + str((int(text[b - 1]) + 1) % 10) + text[b:]]
    return []


def _labelled(text: str, original: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
    """Gold segments (first token, token after, label) of a variant; None if spans don't fall on tokens."""
    starts = {a: i for i, (a, _) in enumerate(m.span() for m in _TOKEN.finditer(text))}
    ends = {m.end(): i + 1 for i, m in enumerate(_TOKEN.finditer(text))}
    out, reached = [], 0
    for kind, a, b in sorted(base, key=lambda s: s[1]):
        if text != original:
            if kind != 3 or len(base) > 1:
                return None
            tail = original[b:]
            a, b = len(original[:a]), len(text) - len(tail)
        if a not in starts or b not in ends or a < reached or ends[b] - starts[a] > MOST_TOKENS:
            return None
        out.append((starts[a], ends[b], kind + 1))
        reached = b
    return out


def _forms(samples: list[tuple[str, list[tuple[int, int, int]]]], most: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, gold segments) of distinct forms: at most `most` with each kind, without any, and of counterexamples of each kind."""
    chosen: dict[str, tuple[str, list]] = {}
    counts: dict[tuple[str, int], int] = {}

    def add(form: str, groups: set[tuple[str, int]], text: str, gold: list) -> None:
        if form not in chosen and len(text) <= LONGEST and any(counts.get(g, 0) < most for g in groups):
            chosen[form] = text, gold
            for g in groups:
                counts[g] = counts.get(g, 0) + 1

    for original, base in samples:
        for text in variants(original):
            gold = _labelled(text, original, base) if base or text == original else None
            form = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", text)) + str(gold)
            if gold is not None:
                add(form, {("has", label) for *_, label in gold} or {("has", 0)}, text, gold)
        for text in counterexamples(original, base):
            if not base_spans(text):
                add(re.sub("[0-9]", "9", text) + " none", {("not", base[0][0])}, text, [])
    return list(chosen.values())


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 20, most: int = 120) -> SpanModel:
    """Weights from (stretch, its base spans) by gradients of the log-likelihood, over at most `most` distinct forms of each kind."""
    return _trained(_forms(samples, most), rounds)


def _trained(chosen: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 20) -> SpanModel:
    if not any(gold for _, gold in chosen):
        return SpanModel()
    names: dict[str, int] = {}
    items = []
    for text, gold in chosen:
        tokens, segments = _spans(text)
        ids = np.array([[names.setdefault(f, len(names)) for f in s[2]] for s in segments])
        wanted = {(i, j): label for i, j, label in gold}
        inside = {t for i, j, _ in gold for t in range(i, j)}
        path = np.array([wanted.get((i, j), 0 if j == i + 1 and i not in inside else -1) for i, j, _ in segments])
        real = np.array([bool(_ANCHOR.search(text, tokens[i][0], tokens[j - 1][1])) for i, j, _ in segments])
        items.append((len(tokens), [s[:2] for s in segments], ids, path, real))
    w, moves = np.zeros((len(names), 5)), np.zeros((5, 5))
    seen_w, seen_m = np.full_like(w, 1e-8), np.full_like(moves, 1e-8)
    for _ in range(rounds):
        grad_w, grad_m = -0.02 * w, -0.02 * moves
        for n, spans, ids, path, real in items:
            s = w[ids].sum(1)
            s[~real, 1:] = -1e30
            s[[j > i + 1 for i, j in spans], 0] = -1e30
            ahead, behind = np.full((n + 1, 5), -1e30), np.full((n + 1, 5), -1e30)
            ahead[0, 0], behind[n] = 0.0, 0.0
            into = np.empty((len(spans), 5))
            at_start = -1
            for k, (i, j) in enumerate(spans):
                if i != at_start:
                    at_start, reach = i, np.logaddexp.reduce(ahead[i][:, None] + moves, axis=0)
                into[k] = reach
                ahead[j] = np.logaddexp(ahead[j], reach + s[k])
            for k in range(len(spans) - 1, -1, -1):
                i, j = spans[k]
                behind[i] = np.logaddexp(behind[i], np.logaddexp.reduce(moves + (s[k] + behind[j])[None, :], axis=1))
            total = np.logaddexp.reduce(ahead[n])
            to = np.array([behind[j] for _, j in spans])
            share = np.exp(np.minimum(into + s + to - total, 0.0))
            target = np.zeros_like(share)
            on = path >= 0
            target[on, path[on]] = 1
            np.add.at(grad_w, ids.ravel(), np.repeat(target - share, ids.shape[1], axis=0))
            last = 0
            for k in sorted(np.flatnonzero(on), key=lambda k: spans[k][0]):
                grad_m[last, path[k]] += 1
                last = path[k]
            for k, (i, _) in enumerate(spans):
                both = ahead[i][:, None] + moves + (s[k] + to[k])[None, :] - total
                grad_m -= np.exp(np.minimum(both, 0.0))
        seen_w += grad_w**2
        seen_m += grad_m**2
        w += 0.5 * grad_w / np.sqrt(seen_w)
        moves += 0.5 * grad_m / np.sqrt(seen_m)
    weights = {name: [round(float(x), 4) for x in w[i]] for name, i in names.items() if np.abs(w[i]).max() > 1e-3}
    return SpanModel(weights, moves.round(4).tolist())


def _pieces(text: str) -> Iterator[tuple[int, str | None]]:
    """(kind, stretch) by the base matches in each stretch, kind -1 if it has none; (kind, None) of a match in no stretch."""
    runs = stretches(text)
    starts = [a for a, _ in runs]
    inside: dict[int, list[tuple[int, int, int]]] = {}
    for kind, a, b in base_spans(text):
        k = bisect_right(starts, a) - 1
        if k >= 0 and b <= runs[k][1]:
            inside.setdefault(k, []).append((kind, a, b))
        else:
            yield kind, None
    for k, (start, end) in enumerate(runs):
        base = inside.get(k, ())
        if end - start <= LONGEST:
            for kind in {s[0] for s in base} or {-1}:
                yield kind, text[start:end]
            continue
        for kind, a, b in base:
            room = (LONGEST - (b - a)) // 2
            left, right = max(start, a - room), min(end, b + room)
            while left > start and left < a and not text[left - 1].isspace():
                left += 1
            while right < end and right > b and not text[right].isspace():
                right -= 1
            yield kind, text[left:right]


def fit(docs: DataFrame, samples: int = 400, most: int = 120) -> SpanModel:
    """A model from `samples` distinct stretches with each base kind and `samples` with none, chosen by a hash over all documents.

    `most` distinct forms of each kind, and of stretches with none, are learned, which bounds the time of
    training. A kind that occurs but has no form to learn from is warned of. The classifier alone sees a
    sample; base patterns and the field read every text in full.
    """
    some = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))

    def make():
        # The smallest hashes of each kind in this task so far: others can't be among the smallest of all.
        kept: dict[int, list[int]] = {k: [] for k in range(-1, len(KINDS))}
        seen: dict[int, set[int]] = {k: set() for k in kept}
        apart: set[int] = set()

        def each(batch: pa.RecordBatch) -> pa.Table:
            rows: list[tuple] = []
            for text in batch.column("text").to_pylist():
                for kind, piece in _pieces(text):
                    if piece is None:
                        if kind not in apart:
                            apart.add(kind)
                            rows.append((kind, None, None))
                        continue
                    h = xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass")) - (1 << 63)
                    heap = kept[kind]
                    if h in seen[kind] or len(heap) >= samples and h > -heap[0]:
                        continue
                    rows.append((kind, h, piece))
                    seen[kind].add(h)
                    heapq.heappush(heap, -h)
                    if len(heap) > samples:
                        seen[kind].discard(-heapq.heappop(heap))
            kinds = {"kind": pa.int32(), "hash": pa.int64(), "stretch": pa.string()}
            return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(kinds.items())})

        return each

    rows = stored(by_batch(some, make, "kind int, hash long, stretch string").distinct(), "pii-sample")
    taken = [rows.where((F.col("kind") == k) & F.col("stretch").isNotNull()).orderBy("hash", "stretch").limit(samples) for k in range(-1, len(KINDS))]
    found = {(r["hash"], r["stretch"]) for part in taken for r in part.collect()}
    forms = _forms([(s, base_spans(s)) for _, s in sorted(found)], most)
    learned = {label - 1 for _, gold in forms for *_, label in gold}
    occur = {r["kind"] for r in rows.select("kind").distinct().collect()} - {-1}
    if occur - learned:
        warnings.warn(f"personal data found by base patterns alone, for lack of forms to learn from: {', '.join(KINDS[k] for k in sorted(occur - learned))}")
    return _trained(forms)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: SpanModel) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row; spans as kind:start:end.

    The counts and `base` are of the base patterns, `spans` has all. Offsets are code points of the
    whole text. NULL and empty texts have none; repeated rows are answered alike. Other columns are
    not read.
    """

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            found = [model.find(t) for t in batch.column("text").to_pylist()]
            out = {"doc_id": batch.column("doc_id")}
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"] = pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
            return pa.table(out | {"base": [_joined(b) for b, _ in found], "spans": [_joined(s) for _, s in found]})

        return each

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return by_batch(rows, make, f"doc_id long, {counts}, base string, spans string")


def redacted(text: str | None, model: SpanModel) -> str | None:
    """The text with each span replaced by <KIND>; of spans that overlap, the earliest and longest names the rest."""
    spans = sorted(model.find(text)[1], key=lambda s: (s[1], -s[2])) if text else []
    if not spans:
        return text
    out, at, stop = [], 0, -1
    for kind, a, b in spans:
        if a >= stop:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        stop = at = max(stop, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """`docs`, all columns in their order, with spans replaced in `text` and n_chars, if any, set to the new length."""
    columns = docs.columns

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            old = batch.column("text").to_pylist()
            new = [redacted(t, model) for t in old]
            out = {c: batch.column(c) for c in columns} | {"text": pa.array(new, pa.string())}
            if "n_chars" in columns:
                kept = batch.column("n_chars").to_pylist()
                out["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in zip(kept, old, new, strict=True)], batch.schema.field("n_chars").type)
            return pa.table(out)

        return each

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return by_batch(docs, make, schema)
