"""SimHash near-duplicates by a generalised pigeonhole.

Fingerprints are compared in groups of bits. Bits that go together are put in one group, so that
the groups' values spread. A pair within `distance` bits must be within t_i bits in some group i
whenever the thresholds t_i (-1: skip the group) sum to distance - groups + 1. A dynamic programme
picks them, and the number of groups, for the least number of probes and estimated candidates:
values shared in a group are counted over all fingerprints, and the growth with t follows from the
bits' frequencies. Every fingerprint then probes the values within t_i of its own, and every
candidate is verified by its bit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, components, shipped, stored

BITS = 64
GROUPS = (2, 3, 4, 5)
#: Most flips of one group that are probed; a threshold with more is not considered.
MOST_PROBES = 3000
#: A probe is a row that is written, shuffled and sorted; a candidate is one comparison of two longs.
PROBE_COST = 8
#: Above this many fingerprints with one value, pairs cost more than the points within half the distance.
HEAVY = 4096


def fingerprint(text: str | None, words: int) -> int:
    """Bits set in over half of the XXH64 (seed 42) of all shingles of `words` words; no word: zero."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: -words + 1 or None].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = [digest(line[a:b], 42) for a, b in spans]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 65536):
        block = values[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            prints = [_signed(fingerprint(t, words)) for t in batch.column("text").to_pylist()]
            return pa.table(
                {"id": batch.column("id"), "text_hash": batch.column("text_hash"), "fp": pa.array(prints, pa.int64())}
            )

        return each

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return by_batch(rows, make, "id long, text_hash long, fp long")


def bit_counts(prints: DataFrame) -> np.ndarray:
    """64 x 64 counts of bits set together, over all rows: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False)).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
        at = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(at, pa.int32()), "n": pa.array(total.ravel()[at].astype(np.int64))})

    rows = prints.select("fp").mapInArrow(shipped(run), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for row in rows:
        out[row["at"]] = row["n"]
    return out.reshape(BITS, BITS)


def grouped_bits(counts: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Groups of near-equal size, each grown from a free bit by the bits most correlated with it."""
    share = counts / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(share - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, out = set(range(BITS)), []
    for k in range(groups):
        size = BITS // groups + (k < BITS % groups)
        group = [max(sorted(free), key=lambda b: related[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(free), key=lambda b: related[b, group].sum()))
            free.discard(group[-1])
        out.append(sorted(group))
    return out


@dataclass(frozen=True)
class Probe:
    """One group: its bits as a mask, its threshold, and the flips of the mask within it."""

    mask: int
    threshold: int
    flips: tuple[int, ...]


def _flips(bits: list[int], threshold: int) -> tuple[int, ...]:
    return tuple(sum(1 << b for b in some) for k in range(threshold + 1) for some in combinations(bits, k))


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds -1, 0, 1 ... by group, summing to `total`, of least cost. costs[i][t + 1]: cost of t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                if done + t not in step or cost + more < step[done + t][0]:
                    step[done + t] = (cost + more, [*chosen, t])
        best = step
    return best.get(total, (math.inf, []))


def plan(prints: DataFrame, distance: int) -> list[Probe]:
    """The groups and thresholds of least estimated cost for these distinct fingerprints."""
    n = prints.count()
    counts = bit_counts(prints)
    p = np.diag(counts) / max(n, 1)
    differ = 2 * p * (1 - p)
    split = {m: grouped_bits(counts, n, m) for m in GROUPS if m <= distance + 1 or m == 2}
    keys = [(m, i, bits) for m, groups in split.items() for i, bits in enumerate(groups)]
    values = F.explode(
        F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits)))).alias("v")) for k, (_, _, bits) in enumerate(keys)])
    ).alias("x")
    shared = prints.select(values).groupBy("x.k", "x.v").count().groupBy("k").agg(F.sum(F.col("count").cast("double") ** 2).alias("s"))
    same = {row["k"]: row["s"] for row in shared.collect()}
    choices = []
    for m, groups in split.items():
        costs = []
        for i, bits in enumerate(groups):
            k = next(x for x, key in enumerate(keys) if key[:2] == (m, i))
            within, row = [1.0] + [0.0] * distance, [0.0]
            for b in bits:  # chance of 0, 1, 2 ... differing bits
                within = [within[t] * (1 - differ[b]) + (within[t - 1] * differ[b] if t else 0) for t in range(distance + 1)]
            for t in range(distance + 1):
                probes = sum(math.comb(len(bits), x) for x in range(t + 1))
                near = min(float(n) ** 2, same.get(k, 0.0) * sum(within[: t + 1]) / max(within[0], 1e-300))
                row.append(PROBE_COST * n * probes + near if probes <= MOST_PROBES else math.inf)
            costs.append(row)
        choices.append((*allocate(costs, distance - m + 1), groups))
    _, thresholds, groups = min(choices, key=lambda c: c[0])
    return [Probe(sum(1 << b for b in bits), t, _flips(bits, t)) for bits, t in zip(groups, thresholds, strict=True) if t >= 0]


def links(prints: DataFrame, distance: int, probes: list[Probe] | None = None, heavy: int = HEAVY) -> DataFrame:
    """Links (a, b) between distinct fingerprints within `distance` bits that keep every component whole.

    All pairs are linked, but for fingerprints that touch a value held by more than `heavy` others:
    those are linked through the points within half the distance of them, one row per point, which
    gives the same components without listing a dense group's pairs.
    """
    probes = plan(prints, distance) if probes is None else probes

    def keyed(kind: str):
        each = [
            F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(p.mask))).bitwiseXOR(F.lit(_signed(flip))).alias("v"))
            for i, p in enumerate(probes)
            for flip in (p.flips if kind == "probe" else (0,))
        ]
        return prints.select("fp", F.explode(F.array(*each)).alias("x")).select("x.k", "x.v", "fp")

    crowded = stored(keyed("index").groupBy("k", "v").count().where(F.col("count") > heavy).select("k", "v"), "simhash-heavy")
    index, probe = keyed("index"), keyed("probe")
    dense = crowded.limit(1).count() > 0
    if dense:
        touching = stored(index.union(probe).join(crowded, ["k", "v"], "left_semi").select("fp").distinct(), "simhash-dense")
        index, probe = (x.join(crowded, ["k", "v"], "left_anti") for x in (index, probe))
    a, b = probe.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    met = a.join(b, ["k", "v"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    found = met.select("a", "b").distinct()
    if dense:
        found = found.union(_through_points(touching, distance))
    return found


def _through_points(prints: DataFrame, distance: int) -> DataFrame:
    """Two fingerprints within 2r (or 2r + 1) bits share a point within r (r + 1) of one and r of the other."""
    near, far = distance // 2, distance - distance // 2

    def points(radius: int):
        flips = np.array([f for f in _flips(list(range(BITS)), radius)], np.uint64)

        def make():
            def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                values = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
                at = (values.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)
                return pa.table({"point": at.ravel(), "fp": np.repeat(values, len(flips))})

            return each

        return by_batch(prints.select("fp"), make, "point long, fp long")

    low = points(near).groupBy("point").agg(F.min("fp").alias("a"))
    reach = points(far) if far != near else points(near)
    # An odd distance meets through a point within `near` of one and `far` of the other.
    return reach.join(low, "point").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(id, text_hash, fingerprint, component_fp, component_id) of every row of `docs`.

    component_fp is the smallest fingerprint that can be reached by steps of at most `distance` bits,
    component_id the smallest id that holds one of those reached. Rows are linked by fingerprint
    alone: copies and repeated rows share one, NULL and blank texts all have fingerprint zero. NULL
    ids take part but are never a component's id, unless it has no other. Columns besides the two
    named are not read. An empty table gives no rows.
    """
    rows = stored(with_fingerprints(docs, words, id_col, text_col), "simhash-rows")
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    roots = components(links(prints.select("fp"), distance, heavy=heavy), label="simhash-links")
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component_fp", F.coalesce("root", "fp"))
    ids = placed.groupBy("component_fp").agg(F.min("least").alias("component_id"))
    placed = stored(placed.select("fp", "component_fp").join(ids, "component_fp"), "simhash-placed")
    found = rows.join(placed, "fp")
    return found.select(
        F.col("id").alias(id_col), "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_fp", "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest id.

    A document is its (doc_id, text); rows that repeat both count once. All columns are kept.
    """
    found = near_duplicates(docs, words, distance)
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("x")
    kept = found.groupBy("component_fp").agg(chosen).select(F.col("x.doc_id").alias("__kept_id"), F.col("x.text_hash").alias("__kept_hash"))
    keyed = docs.withColumns({"__kept_id": F.col("doc_id").cast("long"), "__kept_hash": F.xxhash64("text")})
    both = keyed.alias("d").join(
        kept.alias("k"), F.col("d.__kept_hash").eqNullSafe(F.col("k.__kept_hash")) & F.col("d.__kept_id").eqNullSafe(F.col("k.__kept_id")), "left_semi"
    )
    return both.dropDuplicates(["__kept_hash", "__kept_id"]).drop("__kept_id", "__kept_hash")
