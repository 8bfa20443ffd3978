"""Token counts that follow edits: only touched parts of a text are encoded again.

A text is cut where every reading of it starts a new pre-token, told by the two characters at the
cut alone: before white space after anything else, and where letters, digits and punctuation meet. So the
parts are encoded apart and their counts add up. A segment tree over the parts holds characters and tokens
below each node. The edits of a text find their parts by characters; parts that edits touch are put together,
with the neighbour where the cut between them no longer holds, cut again and encoded once, and
the sums on the way up are updated. A text without any such place is one part, encoded once for all its edits.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch
from .tokens import encoder, vocabulary_path

#: Characters after which a part ends at the next place it may.
PART = 256
# Characters whose class no version of Unicode has changed.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
#: Neither the apostrophe, which short forms start with, nor what the strings of special tokens have.
_MARK = "!\"#$%&()*+,\\-./:;=?@\\[\\]^_`{}~\u3001\u3002\u300a-\u300f\uff01\uff0c\uff1a\uff1b\uff1f\u2026\u201c\u201d"
#: The character before a place where a new pre-token starts for sure.
_CUT = re.compile(rf"\S(?=[ \t\n\r])|[{_LETTER}](?=[0-9{_MARK}])|[0-9](?=[{_LETTER}{_MARK}])|[{_MARK}](?=[{_LETTER}0-9])")


Edit = tuple[int, int, str]
EDITS = "array<struct<start:long,end:long,text:string>>"


def _sure(before: str, after: str) -> bool:
    """Whether a new pre-token starts between these texts for sure."""
    return _CUT.match(before[-1] + after[0]) is not None


def parts_of(text: str) -> list[str]:
    out, start = [], 0
    while m := _CUT.search(text, start + PART - 1):  # from the first place that leaves PART characters
        out.append(text[start : m.end()])
        start = m.end()
    return [*out, text[start:]] if start < len(text) else out


class CountTree:
    """Parts of one text with the sums of characters and tokens over them, as a binary tree in two lists."""

    def __init__(self, parts: list[str], tokens: list[int], encode: Callable[[str], int]):
        self.encode, self.encoded = encode, 0
        self._fill(list(parts), list(tokens))

    def _fill(self, parts: list[str], tokens: list[int]) -> None:
        self.parts = parts
        self.width = 1
        while self.width < max(len(parts), 1):
            self.width *= 2
        pad = [0] * (self.width - len(parts))
        self.chars = [0] * self.width + [len(p) for p in parts] + pad
        self.tokens = [0] * self.width + tokens + pad
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    @classmethod
    def of(cls, text: str, encode: Callable[[str], int]) -> CountTree:
        parts = parts_of(text)
        return cls(parts, [encode(p) for p in parts], encode)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.parts)

    def _find(self, place: int) -> tuple[int, int]:
        """The part that holds this character, or the end of the last one, and the place in it."""
        node = 1
        while node < self.width:
            node *= 2
            if place >= self.chars[node] and self.chars[node + 1]:
                place -= self.chars[node]
                node += 1
        return node - self.width, place

    def _set(self, i: int, part: str, tokens: int) -> None:
        self.parts[i] = part
        node = i + self.width
        self.chars[node], self.tokens[node] = len(part), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def _beside(self, i: int, step: int) -> int | None:
        """The next part with any text before or after this one."""
        i += step
        while 0 <= i < len(self.parts) and not self.parts[i]:
            i += step
        return i if 0 <= i < len(self.parts) else None

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces the characters from start to end, both held to the text, and counts what that touches again."""
        self.apply([(start, end, new)])

    def apply(self, edits: list[Edit]) -> None:
        """Edits in places of the text as it was before all of them; where they overlap, the earlier one goes first."""
        length, done = self.chars[1], 0
        if edits and not self.parts:
            self._fill([""], [0])
        groups: list[tuple[int, int, list]] = []  # first and last part touched, and the edits there
        for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
            start = min(max(start, done), length)
            done = min(max(end, start), length)
            (i, a), (j, b) = self._find(start), self._find(done)
            if groups and i <= groups[-1][1]:
                first, last, spots = groups.pop()
                groups.append((first, max(last, j), [*spots, (i, a, j, b, new or "")]))
            else:
                groups.append((i, j, [(i, a, j, b, new or "")]))
        parts, touched, fresh = self.parts, set(), set()
        # From the last to the first, so that what follows a group is final but for their border.
        for g in range(len(groups) - 1, -1, -1):
            low, high, spots = groups[g]
            joined = self._edited(low, high, spots)
            touched.update(range(low, high + 1))
            parts[low : high + 1] = [""] * (high + 1 - low)
            while (i := self._beside(high, 1)) is not None and (not joined or not _sure(joined, parts[i])):
                joined, parts[i], high = joined + parts[i], "", i
                touched.add(i)
            floor = groups[g - 1][1] if g else -1  # the group before sees to its own border with this one
            while joined and (i := self._beside(low, -1)) is not None and i > floor and not _sure(parts[i], joined):
                joined, parts[i], low = parts[i] + joined, "", i
                touched.add(i)
            parts[low] = joined
            fresh.add(low)
        self._count(touched, {i for i in fresh if parts[i]})

    def _edited(self, low: int, high: int, spots: list[tuple[int, int, int, int, str]]) -> str:
        """The text of these parts after edits from (part, place) to (part, place), in order."""
        out, part, place = [], low, 0
        for i, a, j, b, new in spots:
            out += [self.parts[part][place:a]] if i == part else [self.parts[part][place:], *self.parts[part + 1 : i], self.parts[i][:a]]
            out.append(new)
            part, place = j, b
        return "".join([*out, self.parts[part][place:], *self.parts[part + 1 : high + 1]])

    def _count(self, touched: set[int], fresh: set[int]) -> None:
        """Encodes the fresh parts. Those that grew are cut again, which gives another tree; else sums change in place."""
        self.encoded += sum(len(self.parts[i]) for i in fresh)
        if all(len(self.parts[i]) <= 2 * PART for i in fresh):
            for i in sorted(touched):
                self._set(i, self.parts[i], self.encode(self.parts[i]) if i in fresh else 0)
            return
        parts: list[str] = []
        tokens: list[int] = []
        for i, part in enumerate(self.parts):
            if i in fresh:
                pieces = parts_of(part)
                parts += pieces
                tokens += [self.encode(p) for p in pieces]
            elif part:
                parts.append(part)
                tokens.append(self.tokens[self.width + i])
        self._fill(parts, tokens)


def trees(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text, part_chars, part_tokens): the leaves of every row's tree; none for NULL and empty texts."""
    path = vocabulary or vocabulary_path()

    def make():
        ids = encoder(path).ids

        def each(batch: pa.RecordBatch) -> pa.Table:
            chars, tokens = [], []
            for text in batch.column("text").to_pylist():
                parts = parts_of(text or "")
                chars.append([len(p) for p in parts])
                tokens.append([len(ids(p)) for p in parts])
            kept = {c: batch.column(c) for c in batch.schema.names}
            return pa.table(kept | {"part_chars": pa.array(chars, pa.list_(pa.int32())), "part_tokens": pa.array(tokens, pa.list_(pa.int32()))})

        return each

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return by_batch(rows, make, "doc_id long, text string, part_chars array<int>, part_tokens array<int>")


def with_edits(held: DataFrame, find: Callable[[str], list[Edit]]) -> DataFrame:
    """Adds the column `edits` that `find` names for each text."""
    schema = held.schema

    def make():
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))

        def each(batch: pa.RecordBatch) -> pa.Table:
            found = [[dict(zip(("start", "end", "text"), e, strict=True)) for e in find(t or "")] for t in batch.column("text").to_pylist()]
            return pa.table({c: batch.column(c) for c in schema.names} | {"edits": pa.array(found, kind)})

        return each

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return by_batch(held, make, f"{columns}, edits {EDITS}")


def recount(held: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text, part_chars, part_tokens, n_tokens_before, n_tokens, n_edits, n_encoded) after the column `edits`.

    held has the columns of trees() and `edits`; the result's trees can be edited again. Offsets are
    code points of the text held; they are clipped to it, edits that overlap an earlier one lose what
    it took, and NULL edits are none. n_encoded is how many characters were encoded again. A NULL
    text is empty. Repeated rows are answered alike.
    """
    path = vocabulary or vocabulary_path()
    out = ("doc_id", "text", "part_chars", "part_tokens", "n_tokens_before", "n_tokens", "n_edits", "n_encoded")

    def make():
        ids = encoder(path).ids

        def each(batch: pa.RecordBatch) -> pa.Table:
            rows: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "part_chars", "part_tokens", "edits"))
            for doc, text, chars, tokens, edits in zip(*columns, strict=True):
                parts, at = [], 0
                for n in chars or []:
                    parts.append((text or "")[at : at + n])
                    at += n
                tree = CountTree(parts, tokens or [], lambda part: len(ids(part)))
                before = tree.total
                tree.apply([(e["start"], e["end"], e["text"]) for e in edits or []])
                kept = [(len(p), tree.tokens[tree.width + i]) for i, p in enumerate(tree.parts) if p]
                rows.append((doc, tree.text(), [k[0] for k in kept], [k[1] for k in kept], before, tree.total, len(edits or []), tree.encoded))
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4)
            return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(zip(out, kinds, strict=True))})

        return each

    schema = "doc_id long, text string, part_chars array<int>, part_tokens array<int>, n_tokens_before long, n_tokens long, n_edits long, n_encoded long"
    return by_batch(held.select("doc_id", "text", "part_chars", "part_tokens", F.col("edits").cast(EDITS)), make, schema)
