"""MinHash near-duplicates with fast similarity sketches.

A sketch has `SLOTS` coordinates that are filled in rounds. In each of the first SLOTS rounds every
shingle is hashed to one coordinate and a value; round SLOTS + i sends all shingles to coordinate i. A
coordinate keeps the smallest value of the earliest round that reached it, and a text is done once
all its coordinates are filled, after 2 * SLOTS rounds at the latest: about SLOTS * ln(SLOTS)
hashes or one a shingle, whichever is more. Two texts agree in a coordinate with probability equal to
the similarity of their sets, and the number of agreements is at least as concentrated as with
independent hashes.

Bands of the sketch give buckets. A pivot of each bucket, first the text that shares the most buckets, is
compared with the others on their full sets. Most texts are linked by that. How the others differ from what
the bucket has in common bounds what any two of them share, and most pairs are ruled out by that bound. Only
what is left goes on with pivots of its own, 256 times as many in each round, until every pair of a bucket is
compared, linked or ruled out. So a crowded bucket takes a few rows per text, not its pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, components, stored

SLOTS = 128
#: Coordinates in a band. A pair at similarity s misses all bands with probability (1 - s^4)^32: 5e-8 at 0.8.
ROWS = 4
#: Hashes of words that a worker keeps.
KNOWN_WORDS = 500_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, so that each seed gives another hash."""
    x = x + np.uint64((seed * int(MIX[0]) + 0x1234567) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def lowered_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def shingle_set(text: bytes | None, words: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of `words` words; with fewer words the whole text as one."""
    parts = lowered_words(text)
    if len(parts) < words:
        return {tuple(parts)} if parts else set()
    return set(zip(*(parts[i:] for i in range(words)), strict=False))


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, from the hashes of its words."""
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    count = len(hashes) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = _mixed(out * MIX[0] + hashes[i : i + count], i)
    return np.unique(out)


def sketches(sets: Sequence[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of `slots` values a set; a set without members has none filled."""
    out = np.full(len(sets) * slots, EMPTY)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets).astype(np.uint64) if len(sets) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - slots.bit_length() + 1)
    for turn in range(2 * slots):
        if not len(items):
            break
        values = _mixed(items, turn)
        place = (values >> shift).astype(np.int64) if turn < slots else np.full(len(items), turn - slots)
        # The round stands before the hash: what an earlier round has put stays.
        values = np.uint64(turn) << np.uint64(52) | values & np.uint64((1 << 52) - 1)
        np.minimum.at(out, owner * slots + place, values)
        full = (out.reshape(-1, slots) != EMPTY).all(axis=1)
        going = ~full[owner]
        if not going.all():
            owner, items = owner[going], items[going]
    return out.reshape(-1, slots)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash a band of `rows` coordinates; bands differ in their keys."""
    bands = sketch.shape[1] // rows
    parts = sketch.reshape(len(sketch), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sketch), bands)).copy()
    for i in range(rows):
        out = _mixed(out * MIX[0] + parts[:, :, i], i)
    return out


def with_sketches(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n, node, keys) of every row; node is a 128-bit digest of the set, NULL without words."""

    def make():
        known: dict[bytes, int] = {}

        def hashed(parts: list[bytes]) -> np.ndarray:
            new = {w for w in parts if w not in known}
            if len(known) + len(new) > KNOWN_WORDS:
                known.clear()
                new = set(parts)
            known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
            return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))

        def each(batch: pa.RecordBatch) -> pa.Table:
            sets = [shingle_hashes(hashed(lowered_words(text)), words) for text in batch.column("text").to_pylist()]
            keys = band_keys(sketches(sets)).astype(np.int64)
            return pa.table(
                {
                    "id": batch.column("id"),
                    "text_hash": batch.column("text_hash"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    "keys": pa.array([k if len(s) else None for s, k in zip(sets, keys, strict=True)], pa.list_(pa.int64())),
                }
            )

        return each

    text = F.col(text_col).cast("string").cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), text)
    return by_batch(rows, make, "id long, text_hash long, n long, node binary, keys array<long>")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked, size, difference) of every pair (a, b, crowd), by its two full sets.

    size is that of a's set; difference, of pairs in a crowd, hashes where b's set differs from it: even for
    what b has more, odd for what it lacks.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "crowd", "text_a", "text_b")

    def make():
        last: list = [None, set()]

        def hashed(shingles: set[tuple[bytes, ...]], lacking: int) -> list[int]:
            return [xxhash.xxh64_intdigest(b" ".join(x)) >> 1 << 1 | lacking for x in shingles]

        def each(batch: pa.RecordBatch) -> pa.Table:
            linked, sizes, differences = [], [], []
            for a, crowd, one, two in zip(*(batch.column(c).to_pylist() for c in ("a", "crowd", "text_a", "text_b")), strict=True):
                if last[0] != a:  # pairs of one pivot come together
                    last[:] = a, shingle_set(one, words)
                mine, other = last[1], shingle_set(two, words)
                common = len(mine & other)
                linked.append(100 * common >= percent * (len(mine) + len(other) - common))
                sizes.append(len(mine))
                differences.append(hashed(other - mine, 0) + hashed(mine - other, 1) if crowd else [])
            found = {"linked": pa.array(linked, pa.bool_()), "size": pa.array(sizes, pa.int64())}
            lists = pa.array([np.array(d, np.uint64).astype(np.int64) for d in differences], pa.list_(pa.int64()))
            return pa.table({c: batch.column(c) for c in ("a", "b")} | found | {"difference": lists})

        return each

    return by_batch(both, make, "a binary, b binary, linked boolean, size long, difference array<long>")


def _reference(compared: DataFrame) -> DataFrame:
    """(pivot, node, core, lacks, gaps, extras) of the pairs compared with a pivot.

    The core is the pivot's set with the differences that most of its group have: what the group has in common.
    core is its size, lacks how much of it the node has not, gaps how much of that another node lacks too, and extras
    how much the node shares with another outside the core. So two nodes have in common at most
    core - lacks - lacks + the smaller gaps + the smaller extras.
    """
    groups = compared.groupBy("a").agg((F.count(F.lit(1)) + 1).alias("g"), F.first("size").alias("size"))
    parts = compared.select("a", "b", F.explode("difference").alias("h"))
    counts = parts.groupBy("a", "h").agg(F.count(F.lit(1)).alias("c")).join(groups, "a")
    most, lacking = 2 * F.col("c") > F.col("g"), F.col("h").bitwiseAND(F.lit(1)) == 1
    # Of a difference that most have, those are odd that do not have it.
    several = F.when(most, F.col("g") - F.col("c") > 1).otherwise(F.col("c") > 1)
    counts = counts.select("a", "h", most.alias("most"), lacking.alias("lacking"), several.alias("several"))
    most, lacking, several = F.col("most"), F.col("lacking"), F.col("several")
    cores = counts.where(most).groupBy("a").agg(
        F.count_if(~lacking).alias("gained"),
        F.count_if(lacking).alias("lost"),
        F.count_if(several & ~lacking).alias("gained_odd"),
        F.count_if(several & lacking).alias("lost_odd"),
    )
    # A node differs from the core where it differs from the pivot without most, and where most do without it.
    own = parts.join(counts, ["a", "h"]).groupBy("a", "b").agg(
        F.count_if(~most & lacking).alias("lacks"),
        F.count_if(~most & lacking & several).alias("gaps"),
        F.count_if(~most & ~lacking & several).alias("extras"),
        F.count_if(most & ~lacking).alias("has"),
        F.count_if(most & ~lacking & several).alias("has_odd"),
        F.count_if(most & lacking & several).alias("left_odd"),
    )
    found = compared.select("a", "b").join(groups, "a").join(cores, "a", "left").join(own, ["a", "b"], "left").na.fill(0)
    return found.select(
        F.col("a").alias("pivot"),
        F.col("b").alias("node"),
        F.expr("size + gained - lost").alias("core"),
        F.expr("lacks + gained - has").alias("lacks"),
        F.expr("gaps + gained_odd - has_odd").alias("gaps"),
        F.expr("extras + lost_odd - left_odd").alias("extras"),
    )


def _linked(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of nodes that a link joins to another, from the buckets (key, node, n, c) of c nodes.

    First every bucket is compared with its node that shares the most buckets. That links most nodes, and shows how
    much any two others can have in common. From then on only pairs that can be linked and are not yet in one
    group are compared, with pivots from outside the bucket's largest group, until none is left to be a pivot.
    """
    popular = members.groupBy("node").agg(F.sum("c").alias("fame"))
    opened = stored(members.join(popular, "node"), "minhash-open")
    first = opened.groupBy("key").agg(F.max_by(F.col("node"), F.struct("fame", "node")).alias("pivot"))
    met = opened.join(first, "key").where(F.col("node") != F.col("pivot"))
    met = stored(met.groupBy("pivot", "node").agg(F.first("n").alias("n"), (F.max("c") > 2).alias("crowd")), "minhash-met")
    pairs = met.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "crowd")
    compared = stored(_confirmed(pairs, texts, words, percent), "minhash-compared")
    seen = compared.select("a", "b", "linked")
    roots = components(seen.where("linked").select("a", "b"), label="minhash-links")
    # From here on, the nodes compared with one pivot stand together: a superset of its buckets.
    met = met.where("crowd").withColumnRenamed("pivot", "key")
    least = met.groupBy("key").agg(F.min("n").alias("least"))
    reference = _reference(compared.join(pairs.where("crowd"), ["a", "b"], "left_semi")).withColumnRenamed("pivot", "key")
    # The smallest partner that a node can have here sets the least overlap of a link.
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    hopeful = (100 + percent) * F.expr("core - lacks + extras") >= percent * (F.col("n") + partner)
    opened = met.join(reference, ["key", "node"]).join(least, "key").where(hopeful).drop("crowd", "least")
    turn = late = 0
    while True:
        placed = opened.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")
        sizes = placed.groupBy("key", "group").agg(F.count(F.lit(1)).alias("c"))
        lead = sizes.groupBy("key").agg(F.max_by("group", F.struct("c", "group")).alias("lead"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
        placed = stored(placed.join(lead.drop("groups"), "key"), "minhash-open")
        if placed.isEmpty():
            return components(seen.where("linked").select("a", "b"), label="minhash-links") if late else roots
        part = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << min(8 * turn, 28)))
        pick = F.max_by(F.struct("node", "n", "lacks", "gaps", "extras", "group"), F.struct(-F.col("lacks"), "node")).alias("p")
        chosen = placed.where(F.col("group") != F.col("lead")).groupBy("key", part.alias("part")).agg(pick)
        pivots = stored(chosen.select("key", "p.*").toDF("key", "pivot", "pn", "plack", "pgaps", "pextras", "pgroup"), "minhash-pivots")
        able = (100 + percent) * F.expr("core - lacks - plack + least(gaps, pgaps) + least(extras, pextras)") >= percent * (F.col("n") + F.col("pn"))
        able &= (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")) & (F.col("group") != F.col("pgroup"))
        pairs = placed.join(pivots, "key").where(able).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti").withColumn("crowd", F.lit(False))
        compared = stored(_confirmed(pairs, texts, words, percent), "minhash-compared").select("a", "b", "linked")
        seen = seen.unionByName(compared)
        links, tried = compared.agg(F.count_if("linked"), F.count(F.lit(1))).first()
        late += links
        if late * 20 > tried:  # few links would join few groups, and cost more than they spare
            roots, late = components(seen.where("linked").select("a", "b"), label="minhash-links"), 0
        opened = placed.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti").drop("group", "lead")
        turn += 1


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of `docs`.

    A text's set is its distinct shingles of `words` words between ASCII white space, A-Z lower-cased;
    with fewer words, the whole text as one. Texts are linked where their sets have at least `percent`
    hundredths of their union in common, confirmed on the full sets. component_id is the smallest id that
    links reach, the own one included; kept says whether it is the row's own. NULL and blank texts have
    no shingles and no links. NULL ids take part but are a component's id only if it has no other; repeated
    rows are kept, and share all values. Other columns are not read. An empty table gives no rows.
    """
    rows = stored(with_sketches(docs, words, id_col, text_col), "minhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep")
    sets = rows.where("n > 0").groupBy("node").agg(first, F.first("n").alias("n"), F.first("keys").alias("keys"))
    sets = stored(sets, "minhash-sets")
    held = sets.select("node", "n", F.explode("keys").alias("key"))
    crowded = held.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = stored(held.join(crowded, "key"), "minhash-members")
    texts = _texts(docs, sets.join(members.select("node").distinct(), "node", "left_semi"), id_col, text_col)
    roots = _linked(members, stored(texts, "minhash-texts"), words, percent)

    placed = sets.select("node", F.col("rep.id").alias("least")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component"))
    placed = stored(placed.join(ids, "root").select("node", "component"), "minhash-placed")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component"))
    found = rows.where("n > 0").join(placed, "node").select("id", "n", "component").unionByName(alone)
    kept: Column = F.col("id").eqNullSafe(F.col("component"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def _texts(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of these sets, each from the row that stands for it."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    reps = sets.select(F.col("node"), F.col("rep.id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    same = F.col("text_hash").eqNullSafe(F.col("rep_hash")) & F.col("id").eqNullSafe(F.col("rep_id"))
    return rows.join(reps, same).select("node", "text").dropDuplicates(["node"])
