"""Packing documents into fixed-length sequences by patterns of lengths.

The histogram of piece lengths is all that is planned on. Patterns of two to four lengths that fill
a sequence exactly get repeat counts by non-negative least squares against the histogram; patterns
are added where the residual asks for them. Counts are rounded down, never beyond what there is,
and what is left over is packed by best fit, lengths in falling order, counts at a time. Pieces are
then numbered within their length and look their place up in the plan.

Where documents have an order, like that of a mixture, the plan is cut into turns with a share of every
pattern each, and pieces are numbered in order: a turn's sequences hold documents of one stretch of the
order, as far as lengths allow. Sequences are then numbered by the mean place of their tokens.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, ranked, stored
from .tokens import encoder, vocabulary_path

END = 0
#: Entries of a plan in turns, about; and places of an order that are numbered together.
TURN_ENTRIES, STRETCH = 1 << 16, 4096


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, before them what is over."""
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def pieces(docs: DataFrame, capacity: int, vocabulary: str, order: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row, and its `place` by `order`; a NULL text is the end id alone."""

    def make():
        encode = encoder(vocabulary).ids

        def each(batch: pa.RecordBatch) -> pa.Table:
            rows: list[list] = [[] for _ in names]
            places = batch.column("place") if order else batch.column("doc_id")
            for doc, text, place in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), places.to_pylist(), strict=True):
                ids = np.append(encode(text), END).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for column, value in zip(rows, (doc, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), place), strict=False):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * (len(names) - 2))
            return pa.table({n: pa.array(v, k) for n, v, k in zip(names, rows, kinds, strict=True)})

        return each

    names = ("doc_id", "piece", "start", "length", "ids_crc32", *(["place"] if order else []))
    rows = docs.select(F.expr("cast(doc_id as long) doc_id"), F.expr("cast(text as string) text"), *([F.col(order).cast("long").alias("place")] if order else []))
    return by_batch(rows, make, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", place long" if order else ""))


@dataclass(frozen=True)
class Plan:
    """Patterns of lengths, each with how many sequences have it."""

    patterns: list[tuple[tuple[int, ...], int]]

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.patterns)

    def in_turns(self) -> Plan:
        """The same sequences in turns, each with its share of every pattern; rare patterns are spread over the turns."""
        turns = max(1, TURN_ENTRIES // max(1, len(self.patterns)))
        late = [i * 40503 % turns for i in range(len(self.patterns))]
        shares = ((p, (n * (k + 1) + d) // turns - (n * k + d) // turns) for k in range(turns) for (p, n), d in zip(self.patterns, late, strict=True))
        return Plan([(pattern, n) for pattern, n in shares if n])

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: ends of rank intervals, and for each the sequence less the rank, and the offset."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        sequence, taken = 0, {}
        for pattern, n in self.patterns:
            offset = 0
            for length in pattern:
                start = taken.get(length, 0)
                found.setdefault(length, []).append((start + n, sequence - start, offset))
                taken[length] = start + n
                offset += length
            sequence += n
        return {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in found.items()}


def _better(residual: np.ndarray, held: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Exactly full patterns of two to four lengths whose residuals sum highest, over each split of the capacity."""
    value = np.where(held, residual, -np.inf)
    pair, low = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    for total in range(2, capacity + 1):
        a = np.arange(max(1, total - capacity + 1), total // 2 + 1)
        both = value[a] + value[total - a]
        if len(a) and np.isfinite(best := both.max()):
            pair[total], low[total] = best, a[int(both.argmax())]
    out = []
    for total in range(1, capacity):
        two = (int(low[total]), int(total - low[total]))
        rest = capacity - total
        if np.isfinite(pair[total]) and pair[total] + value[rest] > 0:
            out.append(tuple(sorted((*two, rest), reverse=True)))
        if total <= rest and np.isfinite(pair[total] + pair[rest]) and pair[total] + pair[rest] > 0:
            out.append(tuple(sorted((*two, int(low[rest]), int(rest - low[rest])), reverse=True)))
    return out


def _repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, start: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative x of least |counts - A x|^2 by accelerated projected gradients, and the residual.

    Columns are scaled by their lengths' counts, so that rare lengths matter as common ones do.
    """
    size = max(map(len, patterns))
    at = np.zeros((len(patterns), size), np.int64)
    for i, pattern in enumerate(patterns):
        at[i, : len(pattern)] = pattern  # length 0 is no length: its weight is zero
    weight = 1 / np.sqrt(np.maximum(counts, 1.0))
    weight[0] = 0
    uses = np.zeros(len(counts))
    np.add.at(uses, at.ravel(), 1.0)
    step = 1 / np.maximum((weight[at] ** 2 * uses[at]).sum(1) * size, 1e-12)  # by row sums, safe for each column
    x, y, t = start.copy(), start.copy(), 1.0

    def residual(z):
        return counts - np.bincount(at.ravel(), np.repeat(z, size), len(counts))

    for _ in range(steps):
        gradient = (weight[at] ** 2 * residual(y)[at]).sum(1)
        new = np.maximum(0, y + step * gradient)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = np.maximum(0, new + (t - 1) / t_new * (new - x))
        x, t = new, t_new
    return x, residual(x) * weight


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: lengths go where least space stays free, as many at a time as alike."""
    spaces: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], n: int) -> None:
        if n:
            spaces.setdefault(capacity - sum(pattern), []).append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = min((s for s in spaces if s >= length), default=None)
            if fits is None:
                pattern, bins, each = (), left, capacity // length
            else:
                pattern, bins = spaces[fits].pop()
                if not spaces[fits]:
                    del spaces[fits]
                each = fits // length
            full = min(bins, left // each)
            put((*pattern, *[length] * each), full)
            left -= full * each
            if full < bins and left:
                put((*pattern, *[length] * left), 1)
                left, full = 0, full + 1
            if pattern:
                put(pattern, bins - full)
    return [x for rows in spaces.values() for x in rows]


def plan(histogram: dict[int, int], capacity: int, rounds: int = 8) -> Plan:
    """Patterns for `histogram` (count by length, 1 to capacity). Its size depends on the lengths alone."""
    counts = np.zeros(capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    out = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    held = counts > 0
    held[0] = False
    patterns = [(capacity - a, a) for a in range(1, capacity // 2 + 1) if held[a] and held[capacity - a]]
    if held.any():
        seen, residual = set(patterns), counts / np.sqrt(np.maximum(counts, 1.0))
        x = np.zeros(len(patterns))
        for k in range(rounds):
            more = [p for p in dict.fromkeys(_better(residual, held, capacity)) if p not in seen]
            seen.update(more)
            patterns, x = patterns + more, np.append(x, np.zeros(len(more)))
            if not patterns or k and not more:
                break
            x, residual = _repeats(patterns, counts, x)
        left = counts.astype(np.int64)
        for i in np.argsort(-x, kind="stable"):
            need: dict[int, int] = {}
            for length in patterns[i]:
                need[length] = need.get(length, 0) + 1
            n = min(int(x[i]), *(int(left[length]) // m for length, m in need.items()))
            if n > 0:
                out.append((patterns[i], n))
                for length, m in need.items():
                    left[length] -= n * m
        out += best_fit({int(a): int(left[a]) for a in np.flatnonzero(left)}, capacity)
    return Plan(out)


def packed(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, order: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    Each row of `docs` is a document of its own, repeated rows and NULL ids too; a NULL or empty text
    is one token, the end id. Only documents over `capacity` tokens are cut. Sequences are gapless
    from offset 0. Other columns are not read; an empty table gives no rows.

    order: a column with each document's place, numbers from 0 up without large gaps and few repeats. As many
    sequences as without it hold documents of about one place, and are numbered 0, 1, 2 ... in that order.
    """
    made = stored(pieces(docs, capacity, vocabulary or vocabulary_path(), order), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    found = plan(histogram, capacity)
    if order:
        places = found.in_turns().places()
        rows = ranked(made, ["length"], ["place", "doc_id", "piece", "ids_crc32"], "rank", part=F.expr(f"place div {STRETCH}"))
    else:
        places = found.places()
        rows = ranked(made, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kept = [*names, *(["place"] if order else [])]

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                ends, shift, places_in = places[int(value)]
                i = np.searchsorted(ends, rank[at], side="right")
                sequence[at], offset[at] = rank[at] + shift[i], places_in[i]
            return pa.table({c: batch.column(c) for c in kept} | {"sequence_id": sequence, "offset": offset})

        return each

    schema = f"doc_id long, piece int, start long, length long, ids_crc32 long, {'place long, ' if order else ''}sequence_id long, offset long"
    placed = by_batch(rows.select(*kept, "rank"), make, schema)
    if not order:
        return placed
    placed = stored(placed, "packing-places")
    mean = placed.groupBy("sequence_id").agg(F.expr("sum(place * length) div sum(length)").alias("mean"))
    numbers = ranked(stored(mean, "packing-means"), [], ["mean", "sequence_id"], "number", part=F.expr(f"mean div {STRETCH}"))
    numbered = placed.join(numbers.select("sequence_id", "number"), "sequence_id")
    return numbered.select(*names, F.col("number").cast("long").alias("sequence_id"), "offset")
