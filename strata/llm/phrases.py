"""Phrase collocations by weighted acyclic automata.

Each task takes shards of its texts and makes their n-grams, sorted, into an automaton: states by
depth, arcs with a word as label, equal tails kept once, and the count of each path at its end. An
automaton is cut by ranges of hashed prefixes (language and two words), and the cuts of all shards
meet by range, where they are united and their weights summed. A prefix that a bounded sample shows to be
common is spread by one more word, or two; the counts of its short phrases are then summed over ranges.

What is frequent goes into automata once more, with which the parts of all phrases are composed
to look up their counts. Scores, containment and ranks are DataFrame operations.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import shipped, stored

#: Words of a phrase at most.
LONGEST = 4
#: A shard is closed at so many words. Each shard sends its words to every range that has some of its n-grams, so few large ones send least.
SHARD_WORDS = 2_000_000
#: Words behind one range, about; there are as many ranges as shuffle partitions at least.
RANGE_WORDS = 1_000_000
#: Words of the sample in which common prefixes are found: so many in all and per range.
SAMPLE_WORDS, SAMPLE_PER_RANGE = 400_000, 2_000

BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * MIX[0] + b
    x = (x ^ (x >> np.uint64(32))) * MIX[1]
    return x ^ (x >> np.uint64(29))


def _small(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


@dataclass
class Automaton:
    """Paths of equal depth over numbers, with a weight each; equal states of a depth are one.

    levels[d] are the arcs of the states at depth d: how many each state has, their labels in order,
    and where they lead: to a state of the next depth, or on the last depth to the path's weight.
    """

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, columns: list[np.ndarray], weights: np.ndarray) -> Automaton:
        """From distinct paths in order: columns[d] has the labels at depth d."""
        n = len(weights)
        change = np.zeros(n, bool)
        change[:1] = True
        opens = [change]
        for column in columns[:-1]:
            change = change.copy()
            change[1:] |= column[1:] != column[:-1]
            opens.append(change)
        levels = []
        rows, leads = np.arange(n), weights.astype(np.int64)
        for depth in range(len(columns) - 1, -1, -1):
            labels = columns[depth][rows].astype(np.int64)
            begins = np.flatnonzero(opens[depth][rows])
            sizes = np.diff(begins, append=len(rows))
            state, sizes, labels, leads = _registered(begins, sizes, labels, leads)
            levels.append((_small(sizes), _small(labels), _small(leads)))
            rows, leads = rows[begins], state
        return cls(levels[::-1])

    def paths(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All paths in order, as columns, and their weights."""
        columns: list[np.ndarray] = []
        state = np.zeros(min(1, len(self.levels[0][0])), np.int64)
        for sizes, labels, leads in self.levels:
            sizes = sizes.astype(np.int64)
            begins = np.cumsum(sizes) - sizes
            width = sizes[state]
            arc = np.repeat(begins[state] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            columns = [np.repeat(c, width) for c in columns]
            columns.append(labels[arc].astype(np.int64))
            state = leads[arc].astype(np.int64)
        return columns, state

    def weights(self, columns: list[np.ndarray]) -> np.ndarray:
        """Composed with these paths: the weight of each, 0 where there is none."""
        state = np.zeros(len(columns[0]), np.int64)
        alive = np.full(len(state), len(self.levels[0][0]) > 0)
        for (sizes, labels, leads), column in zip(self.levels, columns, strict=True):
            width = np.int64(max(int(labels.max(initial=0)), int(column.max(initial=0))) + 1)
            arcs = np.repeat(np.arange(len(sizes)), sizes) * width + labels
            wanted = state * width + column
            place = np.minimum(np.searchsorted(arcs, wanted), max(len(arcs) - 1, 0))
            alive &= (arcs[place] == wanted) if len(arcs) else False
            state = np.where(alive, leads[place].astype(np.int64) if len(arcs) else 0, 0)
        return np.where(alive, state, 0)


def _registered(begins: np.ndarray, sizes: np.ndarray, labels: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each state's number, and the sizes and arcs of the states that differ. States are equal if all their arcs are."""
    if not len(begins):
        return begins, sizes, labels, leads
    place = np.arange(len(labels)) - np.repeat(begins, sizes)
    marks = _mixed(_mixed(labels.astype(np.uint64), leads.astype(np.uint64)), place.astype(np.uint64))
    order, opens = _grouped((np.add.reduceat(marks, begins) >> np.uint64(1)).astype(np.int64))
    first, state = order[opens], _numbered(order, opens)
    model = first[state]
    alike = sizes[model] == sizes
    if alike.all():
        twin = np.repeat(begins[model], sizes) + place
        if np.array_equal(labels[twin], labels) and np.array_equal(leads[twin], leads):
            width = sizes[first]
            arc = np.repeat(begins[first] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            return state, width, labels[arc], leads[arc]
    return np.arange(len(begins)), sizes, labels, leads  # a hash erred: all stay


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts non-negative integers, and where in it each value begins; equal ones come in any order."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)) < 1 << (63 - bits):
        # Sorting values with their places below is faster than sorting places by values.
        both = key << np.int64(bits)
        both |= np.arange(len(key))
        both.sort()
        order, key = both & np.int64((1 << bits) - 1), both >> np.int64(bits)
    else:
        order = np.argsort(key)
        key = key[order]
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] != key[:-1]
    return order, np.flatnonzero(opens)


def _numbered(order: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For every value, the number of its group."""
    opens = np.zeros(len(order), np.int64)
    opens[begins[1:]] = 1
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(opens)
    return out


def _counted(columns: list[np.ndarray], weights: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order and the sum of their weights."""
    n = len(columns[0])
    if not n:
        return list(columns), np.zeros(0, np.int64)
    # As many columns as 63 bits hold are one number; where they are too many, those so far get numbers in order.
    key, limit = columns[0].astype(np.int64), int(columns[0].max()) + 1
    for column in columns[1:]:
        base = int(column.max()) + 1
        if limit * base > 1 << (63 - n.bit_length()):
            key = _numbered(*_grouped(key))
            limit = int(key.max()) + 1
        key = key * np.int64(base) + column
        limit *= base
    order, begins = _grouped(key)
    total = np.diff(begins, append=n) if weights is None else np.add.reduceat(weights[order], begins)
    first = order[begins]
    return [c[first] for c in columns], total


def _numbering() -> defaultdict[bytes, int]:
    """Numbers words as they come; 0 is the end of a piece."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    numbers[b"\n"]
    return numbers


class Shard:
    """Words of texts as numbers, until they are made into n-grams. Number 0 ends a piece; languages have numbers too."""

    def __init__(self) -> None:
        self.numbers = _numbering()
        self.parts: list[tuple[int, np.ndarray]] = []
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        tokens = filter(None, b"\n".join([*texts, b""]).lower().translate(BREAKS).replace(b"\n", b" \n ").split(b" "))
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32)
        self.parts.append((self.numbers[lang.encode()], ids))
        self.size += len(ids)

    def grams(self) -> Grams:
        """All windows of LONGEST words, cut at the piece's end."""
        langs = np.concatenate([np.zeros(0, np.int32), *(np.full(len(ids), lang, np.int32) for lang, ids in self.parts)])
        words = np.concatenate([np.zeros(0, np.int32), *(ids for _, ids in self.parts)])
        words = np.append(words, np.zeros(LONGEST, np.int32))  # every part ends with a break, so none reaches into the next
        at = np.flatnonzero(words[: len(langs)])
        columns = [langs[at], words[at]]
        for i in range(1, LONGEST):
            columns.append(np.where(columns[-1] > 0, words[at + i], np.int32(0)))
        single, counts = _counted(columns[:2], None)
        longer = columns[2] > 0
        windows, weights = _counted([c[longer] for c in columns], None)
        return Grams(list(self.numbers), single, counts, windows, weights)


@dataclass
class Grams:
    """Counted words (language, word) and windows (language, word, word, 0 or word ...), numbers of `words`, in order."""

    words: list[bytes]
    single: list[np.ndarray]
    counts: np.ndarray
    windows: list[np.ndarray]
    weights: np.ndarray

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))

    def prefixes(self, columns: list[np.ndarray], hashes: np.ndarray | None = None) -> list[np.ndarray]:
        """Hashes of the first 2, 3 ... columns of every row, from the words themselves."""
        hashes = self.hashes() if hashes is None else hashes
        out = hashes[columns[0]]
        found = []
        for column in columns[1:]:
            out = _mixed(out, hashes[column])
            found.append(out)
        return found

    def cut(self, ranges: int, common: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(range, piece): what of this lies in each range of hashed prefixes."""
        hashes = self.hashes()
        one = _range_of(self.prefixes(self.single, hashes)[0], ranges)
        many = _range_of(_place(self.prefixes(self.windows, hashes)[1:], common), ranges)
        order_one, order_many = np.argsort(one, kind="stable"), np.argsort(many, kind="stable")
        edges = np.arange(ranges + 1)
        edge_one, edge_many = np.searchsorted(one[order_one], edges), np.searchsorted(many[order_many], edges)
        for r in range(ranges):
            i, j = order_one[edge_one[r] : edge_one[r + 1]], order_many[edge_many[r] : edge_many[r + 1]]
            if len(i) or len(j):
                part = Grams(self.words, [c[i] for c in self.single], self.counts[i], [c[j] for c in self.windows], self.weights[j])
                yield r, part.packed()

    def packed(self) -> bytes:
        """As two automata over the words that occur."""
        held = np.concatenate([*self.single, *self.windows, [0]])
        order, begins = _grouped(held.astype(np.int64))
        used, places = held[order[begins]], _numbered(order, begins)
        cuts = np.cumsum([len(c) for c in (*self.single, *self.windows)])
        columns = np.split(places[:-1], cuts[:-1])
        n = len(self.single)
        held = [self.words[i] for i in used.tolist()]
        return zstandard.compress(pickle.dumps((held, Automaton.of(columns[:n], self.counts).levels, Automaton.of(columns[n:], self.weights).levels)), 3)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _place(prefixes: list[np.ndarray], common: np.ndarray) -> np.ndarray:
    """The prefix of two words, or of one word more as long as the prefix is a common one."""
    out = prefixes[0].copy()
    going = np.isin(out, common)
    for longer in prefixes[1:]:
        out[going] = longer[going]
        going &= np.isin(out, common)
    return out


def united(pieces: list[bytes]) -> Grams:
    """The union of pieces, weights summed, a few pieces at a time."""
    numbers = _numbering()
    held: list[list] = [[], []]
    sizes = [0, 0]

    def summed(kind: int) -> tuple[list[np.ndarray], np.ndarray]:
        if not held[kind]:
            return [np.zeros(0, np.int64)] * (2 + (LONGEST - 1) * kind), np.zeros(0, np.int64)
        columns = [np.concatenate([p[0][d] for p in held[kind]]) for d in range(len(held[kind][0][0]))]
        columns, weights = _counted(columns, np.concatenate([p[1] for p in held[kind]]))
        held[kind], sizes[kind] = [(columns, weights)], 0
        return columns, weights

    for piece in pieces:
        words, *levels = pickle.loads(zstandard.decompress(piece))
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        for kind in (0, 1):
            columns, weights = Automaton(levels[kind]).paths()
            held[kind].append(([own[c] for c in columns], weights))
            sizes[kind] += len(weights)
            if sizes[kind] > max(RANGE_WORDS, 2 * len(held[kind][0][1])):
                summed(kind)
    return Grams(list(numbers), *summed(0), *summed(1))


def frequent(grams: Grams, least: int, common: np.ndarray) -> Iterator[tuple[str, str, int, int]]:
    """(language, phrase, words, count) of one range: whole counts from `least` on, and the share of phrases
    whose prefix is spread over ranges. A phrase without words has the language's count of words."""
    words = grams.words
    langs, first, inverse = np.unique(grams.single[0], return_index=True, return_inverse=True)
    total = np.zeros(len(langs), np.int64)
    np.add.at(total, inverse, grams.counts)
    for lang, n in zip(langs.tolist(), total.tolist(), strict=True):
        yield words[lang].decode(), "", 0, n
    for i in np.flatnonzero(grams.counts >= least).tolist():
        yield words[grams.single[0][i]].decode(), words[grams.single[1][i]].decode(), 1, int(grams.counts[i])
    prefixes = grams.prefixes(grams.windows) if len(common) else []
    spread = np.full(len(grams.weights), len(common) > 0)
    for size in range(2, LONGEST + 1):
        columns = grams.windows[: size + 1]
        if len(common):
            spread &= np.isin(prefixes[size - 1], common)
        real = np.flatnonzero(columns[-1])
        if not len(real):
            return
        # Rows are in order, so a phrase's windows are neighbours.
        opens = np.ones(len(real), bool)
        opens[1:] = np.any([c[real][1:] != c[real][:-1] for c in columns], axis=0)
        begins = np.flatnonzero(opens)
        sums = np.add.reduceat(grams.weights[real], begins)
        rows = real[begins]
        keep = (sums >= least) | spread[rows] if size < LONGEST else sums >= least
        for i, n in zip(rows[keep].tolist(), sums[keep].tolist(), strict=True):
            yield words[columns[0][i]].decode(), b" ".join([words[c[i]] for c in columns[1:]]).decode(), size, n


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    shard = Shard()
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            shard.add(lang, texts)
        if shard.size >= SHARD_WORDS:
            yield shard
            shard = Shard()
    yield shard


def _common_prefixes(rows: DataFrame, ranges: int, words: int) -> np.ndarray:
    """Hashes of prefixes of two and three words that hold over a quarter of a range, by a sample: at most 8 a range."""
    share = max(SAMPLE_WORDS, SAMPLE_PER_RANGE * ranges) / max(words, 1)
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _sharded(batches):
            grams = shard.grams()
            for depth, keys in enumerate(grams.prefixes(grams.windows)[1:3]):
                values, place = np.unique(keys, return_inverse=True)
                sums = np.zeros(len(values), np.int64)
                np.add.at(sums, place, grams.weights)
                yield pa.record_batch({"depth": pa.array([depth] * len(values), pa.int32()), "key": pa.array(values.astype(np.int64)), "n": pa.array(sums)})

    sums = rows.mapInArrow(shipped(run), "depth int, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    sums = stored(sums, "phrases-sample")
    total = sums.where("depth = 0").agg(F.sum("n")).first()[0] or 0
    found = sums.where(F.col("n") > max(1.0, total / (4 * ranges))).select("key").distinct().collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).astype(np.uint64))


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang", ranges: int | None = None) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to 4 words that occur `least` times or more; size 0 has all words of a language."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    rows = docs.where(F.col(text_col).isNotNull()).select(lang, F.col(text_col).cast("string").cast("binary").alias("text"))
    words = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // 6
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // RANGE_WORDS)
    common = _common_prefixes(rows, ranges, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _sharded(batches):
            for r, piece in shard.grams().cut(ranges, common):
                yield pa.record_batch({"range": pa.array([r], pa.int32()), "piece": pa.array([piece], pa.large_binary()).cast(pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        found = list(frequent(united(table.column("piece").to_pylist()), least, common))
        names = ("lang", "phrase", "size", "f")
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        return pa.table({n: pa.array([x[i] for x in found], kind) for i, (n, kind) in enumerate(zip(names, kinds, strict=True))})

    pieces = rows.mapInArrow(shipped(run), "range int, piece binary")
    parts = pieces.groupBy("range").applyInArrow(shipped_table(merge), "lang string, phrase string, size int, f long")
    return parts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where((F.col("size") == 0) | (F.col("f") >= least))


def shipped_table(run):
    """A function of whole tables, in the form that workers without this package's folder can load."""
    once = shipped(lambda tables: (run(t) for t in tables))
    return lambda table: next(once(iter([table])))


def looked_up(counts: DataFrame, wanted: DataFrame, groups: int) -> DataFrame:
    """(lang, phrase, f) of the phrases in `wanted`, from automata built of `counts`, `groups` of them."""
    group = F.pmod(F.xxhash64("lang", "phrase"), F.lit(groups)).cast("int").alias("group")
    left = counts.select(group, "lang", "phrase", "f")
    right = wanted.select("lang", "phrase").distinct().select(group, "lang", "phrase")

    def columns(table: pa.Table, numbers: dict[str, int]) -> list[np.ndarray]:
        paths = [[lang, *phrase.split(" ")] for lang, phrase in zip(table.column("lang").to_pylist(), table.column("phrase").to_pylist(), strict=True)]
        padded = [[numbers.setdefault(w, len(numbers) + 1) for w in p] + [0] * (1 + LONGEST - len(p)) for p in paths]
        return list(np.array(padded, np.int64).reshape(-1, 1 + LONGEST).T)

    def compose(known: pa.Table, asked: pa.Table) -> pa.Table:
        numbers: dict[str, int] = {}
        paths, weights = columns(known, numbers), known.column("f").to_numpy()
        order = np.lexsort(paths[::-1])
        automaton = Automaton.of([p[order] for p in paths], weights[order])
        found = automaton.weights(columns(asked, numbers))
        return pa.table({"lang": asked.column("lang"), "phrase": asked.column("phrase"), "f": pa.array(found, pa.int64())})

    both = shipped(lambda pairs: (compose(*p) for p in pairs))
    return left.groupBy("group").cogroup(right.groupBy("group")).applyInArrow(lambda a, b: next(both(iter([(a, b)]))), "lang string, phrase string, f long")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, scale: int = 2_000_000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the `most` best phrases of each language.

    Texts, A-Z lower-cased, are split at . , ; : ! ? and line ends into pieces and those at spaces and tabs into words.
    A phrase of 2 to 4 words that occurs a >= `least` times within pieces has, for each cut in two, the counts l
    and r of its parts and the score floor(scale * a / (l + r)); its lowest cut counts, the first of equals. A phrase
    goes if a longer one that holds it has 80 hundredths of its count. Order: score, count, then the phrase. n counts
    the language's words. NULL languages are `und`; NULL and blank texts have no words; repeated rows count each.
    Other columns are not read. An empty table gives no rows.
    """
    counts = stored(phrase_counts(docs, least, text_col, lang_col), "phrases-counts")
    words = F.split("phrase", " ")
    longer = counts.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))

    def joined(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = longer.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = stored(cuts, "phrases-cuts")
    wanted = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase"))
    groups = max(1, -(-counts.count() // 200_000), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    parts = stored(looked_up(counts.where("size > 0"), wanted, groups), "phrases-parts")
    scored = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    scored = scored.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # Exact: products may pass 64 bits.
    score = F.expr(f"cast(cast({scale} as decimal(18,0)) * cast(a as decimal(19,0)) div cast(l + r as decimal(20,0)) as long)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")
    scored = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    spots = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(w, s, m), ' '))))"
    )
    inside = longer.where("size > 2").select("lang", F.explode(F.array_distinct(spots)).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(F.expr("around is null or 5 * cast(around as decimal(20,0)) < 4 * cast(a as decimal(20,0))"))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
