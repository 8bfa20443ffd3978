"""Periodic runs by a Re-Pair grammar.

The words of a batch of texts become numbers, and Re-Pair replaces repeated pairs by rules, most
frequent pairs first, until no pair within a text occurs twice. What is left of a text is put under a
balanced tree of pairs. Every run lies within some node of these trees and crosses the border between
the node's two halves, so each rule is searched once, at one place where it occurs, for the runs across
its border, and what is found holds at every place where the rule was used. Pieces of one run that
several nodes see are merged.

A run of exponent 4 has a square (two periods) that starts or ends at the border, so periods are found by
comparing blocks next to it: all periods below 16 directly, longer ones where a block of 2^k words next to the
border comes back at a distance from 2^k to 2^(k+1). Blocks are compared by 64-bit hashes; every run is
then compared word by word, and a batch where that fails is done again by plain comparisons.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch

#: Periods below 2^DIRECT are compared at every border.
DIRECT = 4
#: Texts are worked on together up to so many words; a longer text alone.
WORDS_AT_ONCE = 150_000

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))


def _mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    x = a * MIX[0] + b
    x ^= x >> np.uint64(32)
    x *= MIX[2]
    x ^= x >> np.uint64(29)
    return x


@dataclass
class Nodes:
    """Spans [low, high) of words with a border inside, and all places where the same span was made by the same rule."""

    low: np.ndarray
    border: np.ndarray
    high: np.ndarray
    #: Node i occurs at starts[first[i]:first[i + 1]]; the first of them is `low`.
    first: np.ndarray
    starts: np.ndarray


def grammar(words: np.ndarray, ends: np.ndarray) -> Nodes:
    """Re-Pair over the texts words[0:ends[0]], words[ends[0]:ends[1]] ..., with a tree over what is left.

    Each round ranks the pairs that occur twice by frequency, and replaces a pair wherever neither
    neighbouring pair ranks higher, so the most frequent pair always goes. A pair that occurs once
    never occurs twice later: only pairs that touch a new symbol, or occurred twice before, are counted.
    """
    symbol = words.astype(np.int64)
    at = np.arange(len(words) + 1, dtype=np.int64)  # where each symbol starts, and the end
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    live = np.zeros(len(symbol), bool)
    live[:-1] = text[:-1] == text[1:]
    fresh = int(symbol.max(initial=-1)) + 1
    low, border, high, first, starts = [], [], [], [], []
    placed = 0
    while True:
        spots = np.flatnonzero(live)
        if not len(spots):
            break
        pairs, which, counts = np.unique(symbol[spots] << 32 | symbol[spots + 1], return_inverse=True, return_counts=True)
        twice = counts > 1
        if not twice.any():
            break
        # Frequency first; equal frequencies in a scattered order, so that each round replaces many pairs.
        order = np.lexsort((_mixed(pairs.astype(np.uint64), MIX[1]), counts))
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(1, len(pairs) + 1)
        score = np.zeros(len(symbol) + 1, np.int64)
        score[spots] = np.where(twice, rank, 0)[which]
        best = (score[:-1] > 0) & (score[:-1] >= score[1:])
        best[1:] &= score[1:-1] >= score[:-2]
        # Overlapping places of one pair (a a a): every other one, from the left.
        chosen = np.flatnonzero(best)
        chain = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
        offset = np.arange(len(chosen)) - np.repeat(chain, np.diff(chain, append=len(chosen)))
        chosen = chosen[offset % 2 == 0]

        rules, of_rule, used = np.unique(score[chosen], return_inverse=True, return_counts=True)
        grouped = np.argsort(of_rule, kind="stable")
        heads = np.cumsum(used) - used
        places = at[chosen][grouped]
        one = chosen[grouped][heads]
        low.append(at[one])
        border.append(at[one + 1])
        high.append(at[one + 2])
        first.append(heads + placed)
        starts.append(places)
        placed += len(places)

        live &= score[:-1] > 0
        live[spots[~twice[which]]] = False
        symbol[chosen] = fresh + of_rule
        fresh += len(rules)
        live[chosen] = True
        live[chosen[chosen > 0] - 1] = True
        keep = np.ones(len(symbol), bool)
        keep[chosen + 1] = False
        symbol, text, live = symbol[keep], text[keep], live[keep]
        at = np.append(at[:-1][keep], at[-1])
        live[:-1] &= text[:-1] == text[1:]
        live[-1:] = False

    # The tree over what is left: blocks of 2, 4, 8 ... symbols of a text.
    edge = np.searchsorted(text, np.arange(len(ends) + 1))
    sizes = np.diff(edge)
    width = 1
    while width < sizes.max(initial=0):
        blocks = -(-sizes // (2 * width))
        mine = np.repeat(np.arange(len(ends)), blocks)
        number = np.arange(len(mine)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = edge[mine] + number * 2 * width
        middle = begin + width
        some = middle < edge[mine + 1]
        begin, middle, mine = begin[some], middle[some], mine[some]
        low.append(at[begin])
        border.append(at[middle])
        high.append(at[np.minimum(middle + width, edge[mine + 1])])
        first.append(np.arange(placed, placed + len(begin)))
        starts.append(at[begin])
        placed += len(begin)
        width *= 2
    parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, border, high, first, starts)]
    parts[3] = np.append(parts[3], placed)
    return Nodes(*parts)


class _Blocks:
    """Hashes of all blocks of 2^k words, by k."""

    def __init__(self, words: np.ndarray, longest: int):
        self.levels = [_mixed(words.astype(np.uint64), MIX[1])]
        while 1 << len(self.levels) <= longest:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_mixed(last[:-half] if half < len(last) else last[:0], last[half:]))

    def same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.levels[k][a] == self.levels[k][b]

    def reach(self, start: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch [x, y) of words equal to those a period on, around `start`, within [low, high - period)."""
        x, y = start.copy(), start.copy()
        last = high - period
        for k in range(len(self.levels) - 1, -1, -1):
            step, bound = 1 << k, len(self.levels[k]) - 1
            while True:  # twice or more only at the top level
                fits = (y + step <= last) & (y + period <= bound)
                fits[fits] = self.same(k, y[fits], (y + period)[fits])
                y[fits] += step
                back = x - step >= low
                back[back] = self.same(k, (x - step)[back], (x - step + period)[back])
                x[back] -= step
                if k < len(self.levels) - 1 or not (fits.any() or back.any()):
                    break
        return x, y


def _squares(nodes: Nodes, chosen: np.ndarray, blocks: _Blocks, words_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, period, start) of squares that start or end at a node's border: start is the square's first word."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    span = nodes.high - nodes.low

    def checked(node: np.ndarray, period: np.ndarray, start: np.ndarray, k: int) -> None:
        """Two blocks of 2^k words cover a period of 2^k to 2^(k+1) - 1."""
        good = blocks.same(k, start, start + period)
        node, period, start = node[good], period[good], start[good]
        tail = start + period - (1 << k)
        good = blocks.same(k, tail, tail + period)
        if good.any():
            out.append((node[good], period[good], start[good]))

    for k in range(min(DIRECT, len(blocks.levels))):
        for period in range(1 << k, 2 << k):
            node = chosen[span[chosen] >= 4 * period]
            if not len(node):
                return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
            right = node[nodes.border[node] + 2 * period <= nodes.high[node]]
            checked(right, np.full(len(right), period), nodes.border[right], k)
            left = node[nodes.border[node] - 2 * period >= nodes.low[node]]
            checked(left, np.full(len(left), period), nodes.border[left] - 2 * period, k)

    if len(blocks.levels) > DIRECT:
        # Only words whose block of 2^DIRECT occurs again in its text can start a longer period.
        base = blocks.levels[DIRECT]
        marks = _mixed(base, words_text[: len(base)].astype(np.uint64) * MIX[1])
        slots = 1 << max(10, int(4 * len(base)).bit_length())
        slot = (marks & np.uint64(slots - 1)).astype(np.int64)
        again = np.flatnonzero(np.bincount(slot, minlength=slots)[slot] > 1)
        for k in range(DIRECT, len(blocks.levels)):
            node = chosen[span[chosen] >= 4 << k]
            again = again[again < len(blocks.levels[k])]
            if not len(node) or not len(again):
                break
            marks = _mixed(blocks.levels[k][again], words_text[again].astype(np.uint64) * MIX[1])
            values, group, counts = np.unique(marks, return_inverse=True, return_counts=True)
            many = counts[group] > 1
            again, group = again[many], group[many]
            if not len(again):
                break
            n = np.int64(len(words_text) + 1)
            listed = np.sort(group * n + again)
            for side in (1, -1):
                anchor = nodes.border[node] if side == 1 else nodes.border[node] - (1 << k)
                inside = (anchor >= nodes.low[node]) & (anchor + (1 << k) <= nodes.high[node])
                mine, anchor = node[inside], anchor[inside]
                spot = np.searchsorted(again, anchor)
                spot[spot == len(again)] = 0
                held = again[spot] == anchor
                mine, anchor, spot = mine[held], anchor[held], spot[held]
                key = group[spot] * n
                if side == 1:
                    most = np.minimum((2 << k) - 1, (nodes.high[mine] - anchor) // 2)
                    lo, hi = np.searchsorted(listed, key + anchor + (1 << k)), np.searchsorted(listed, key + anchor + most, "right")
                else:
                    most = np.minimum((2 << k) - 1, (nodes.border[mine] - nodes.low[mine]) // 2)
                    lo, hi = np.searchsorted(listed, key + anchor - most), np.searchsorted(listed, key + anchor - (1 << k), "right")
                found = np.maximum(hi - lo, 0)
                if not found.any():
                    continue
                mine, anchor = np.repeat(mine, found), np.repeat(anchor, found)
                other = listed[np.repeat(lo, found) + np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)] % n
                period = np.abs(other - anchor)
                checked(mine, period, anchor if side == 1 else nodes.border[mine] - 2 * period, k)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _merged(low: np.ndarray, high: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of one period that share at least a period become one; of equal stretches the smallest period stays."""
    if not len(low):
        return low, high, period
    order = np.lexsort((low, period))
    low, high, period = low[order], high[order], period[order]
    values, group = np.unique(period, return_inverse=True)
    far = np.int64(high.max(initial=0) + 1)
    furthest = np.maximum.accumulate(group * far + high)
    opens = np.ones(len(low), bool)
    opens[1:] = (group[1:] != group[:-1]) | (furthest[:-1] - group[1:] * far - low[1:] < period[1:])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(low)) - 1
    low, period, high = low[first], period[first], furthest[last] - group[last] * far
    order = np.lexsort((period, high, low))
    low, high, period = low[order], high[order], period[order]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[keep], high[keep], period[keep]


def _plain(words: np.ndarray, ends: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same runs by comparing each text with itself at every distance."""
    out = []
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        for period in range(1, (b - a) // exponent + 1):
            same = np.zeros(b - a - period + 2, np.int8)
            same[1:-1] = words[a : b - period] == words[a + period : b]
            turns = np.flatnonzero(np.diff(same))
            for x, y in turns.reshape(-1, 2).tolist():
                if y - x + period >= max(least, exponent * period):
                    out.append((a + x, a + y + period, period))
    return _merged(*(np.array(x, np.int64) for x in zip(*out, strict=True))) if out else (np.zeros(0, np.int64),) * 3


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in the texts words[0:ends[0]], words[ends[0]:ends[1]] ..., by start, then period."""
    nodes = grammar(words, ends)
    chosen = np.flatnonzero(nodes.high - nodes.low >= max(least, exponent))
    if not len(chosen):
        return (np.zeros(0, np.int64),) * 3
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    blocks = _Blocks(words, int((nodes.high - nodes.low)[chosen].max()) // exponent)
    node, period, start = _squares(nodes, chosen, blocks, text)
    if not len(node):
        return (np.zeros(0, np.int64),) * 3
    x, y = blocks.reach(start, period, nodes.low[node], nodes.high[node])
    y += period
    long = y - x >= np.maximum(least, exponent * period)
    node, x, y, period = node[long], x[long], y[long], period[long]
    # A stretch has the multiples of its period too: the smallest stays.
    order = np.lexsort((period, y, x, node))
    node, x, y, period = node[order], x[order], y[order], period[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    node, x, y, period = node[new], x[new], y[new], period[new]
    # Hashes may err: every run is compared in full, and must end where it is said to end.
    for a, b, q, lo, hi in zip(x.tolist(), y.tolist(), period.tolist(), nodes.low[node].tolist(), nodes.high[node].tolist(), strict=True):
        if not np.array_equal(words[a : b - q], words[a + q : b]) or (a > lo and words[a - 1] == words[a - 1 + q]) or (b < hi and words[b] == words[b - q]):
            return _plain(words, ends, least, exponent)
    # What a rule holds, it holds wherever it was used.
    times = nodes.first[node + 1] - nodes.first[node]
    each = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    moved = nodes.starts[np.repeat(nodes.first[node], times) + each] - np.repeat(nodes.low[node], times)
    return _merged(np.repeat(x, times) + moved, np.repeat(y, times) + moved, np.repeat(period, times))


def _strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Place of the run with the largest length / period, compared exactly; the first of equals."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    turns = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    kept = np.cumsum(turns[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def periodic_runs(
    docs: DataFrame,
    least: int = 6,
    exponent: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, runs, strongest, collapsed) of every row of `docs`.

    Words are what stands between ASCII white space, numbered from 0. runs: (start, length, period) of
    every stretch of words of smallest period `period` that is at least `least` words and `exponent`
    periods long and that no neighbouring word extends, by start, then period. strongest: index of the
    run with the largest length / period, the first of equals, NULL without runs. collapsed: the text's
    words but those that a run holds after its first period, joined by one space. `change` (id, words) gives the words
    that count instead. NULL and blank texts have no words, no runs and an empty collapsed text;
    repeated rows and NULL ids are kept; columns besides the two named are not read. An empty table gives no rows.
    """
    if exponent < 4:
        raise ValueError("exponent: runs are found from four periods on")

    def make():
        def solved(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
            number: dict[bytes, int] = {}
            ids = [number.setdefault(w, len(number)) for words in texts for w in words]
            ends = np.cumsum([len(words) for words in texts])
            start, end, period = find_runs(np.array(ids, np.int64), ends, least, exponent)
            edges = np.searchsorted(start, np.append(0, ends))
            for i, words in enumerate(texts):
                mine = slice(edges[i], edges[i + 1])
                begin = int(ends[i]) - len(words)
                runs = list(zip((start[mine] - begin).tolist(), (end - start)[mine].tolist(), period[mine].tolist(), strict=True))
                yield runs, _collapsed(words, runs)

        def each(batch: pa.RecordBatch) -> pa.Table:
            ids = batch.column("id").to_pylist()
            held: list[list[bytes]] = []
            size, found = 0, []
            for key, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                words = (text or b"").split()
                words = change(key, words) if change else words
                if held and size + len(words) > WORDS_AT_ONCE:
                    found += solved(held)
                    held, size = [], 0
                held.append(words)
                size += len(words)
            found += solved(held)
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            return pa.table(
                {
                    "id": batch.column("id"),
                    "runs": pa.array(runs, kind),
                    "strongest": pa.array([_strongest(r) for r, _ in found], pa.int32()),
                    "collapsed": pa.array([c for _, c in found], pa.binary()).cast(pa.string()),
                }
            )

        return each

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = by_batch(rows, make, "id long, runs array<struct<start: long, length: long, period: long>>, strongest int, collapsed string")
    return found.withColumnRenamed("id", id_col)
