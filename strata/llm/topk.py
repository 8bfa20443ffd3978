"""Exact top-k by inner product with pivot-table elimination.

For vectors q and x and a pivot p, |d(q,p) - d(x,p)| bounds the distance of q and x from below, and so
their inner product (|q|^2 + |x|^2 - d^2) / 2 from above. Distances of all vectors to many pivots are
computed once. For each query the candidates of a block are taken in the order of their best bound
over all pivots, and the block is left as soon as the next bound can't reach the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import by_batch, shipped, stored

#: Rows in a block of candidates and of queries: what a task holds at once.
BLOCK, QUERY_BLOCK = 4096, 512
PIVOTS = 32
#: Above this, sums of products may leave what 64-bit floats hold exactly.
EXACT = 2.0**52


def scaled(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v): floor(256 x) of every component; rows with a NULL id or vector, or a NULL or non-finite component, are left out."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(good)
    return rows.select(
        F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), F.transform(v, lambda x: F.floor(x * 256.0).cast("double")).alias("v")
    )


def _bytes(values: list[list[float]]) -> bytes:
    """The numbers in the smallest of three types that holds them all exactly, after the type's letter."""
    x = np.array(values, np.float64)
    most = np.abs(x).max(initial=0)
    return b"h" + x.astype("<i2").tobytes() if most < 2**15 else b"i" + x.astype("<i4").tobytes() if most < 2**31 else b"d" + x.tobytes()


def _matrix(values: bytes, n: int, dim: int) -> np.ndarray:
    kind = {"h": "<i2", "i": "<i4", "d": "<f8"}[chr(values[0])]
    return np.frombuffer(values, kind, offset=1).reshape(n, dim).astype(np.float64)


def _products(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Python integers where 64-bit floats would round, held to the range of a long."""
    most = max(np.abs(queries).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(x.shape[1], 1)
    if most < EXACT:
        return (queries @ x.T).astype(np.int64)
    a = [[int(c) for c in row] for row in queries.tolist()]
    b = [[int(c) for c in row] for row in x.tolist()]
    top = (1 << 63) - 1
    return np.array([[max(-top - 1, min(top, sum(p * q for p, q in zip(r, s, strict=True)))) for s in b] for r in a], np.int64).reshape(len(a), len(b))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def search_block(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, pivots: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query, id, score) of each query's k best in the block, ties to smaller ids; and how many were evaluated.

    Repeated ids are candidates each; a query's own id is none.
    """
    out, evaluated = [], 0
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    if not len(x):
        return out, 0
    to_x, to_q = _distances(x, pivots), _distances(queries, pivots)
    with np.errstate(over="ignore", invalid="ignore"):
        norm_x, norm_q = (x * x).sum(1), (queries * queries).sum(1)
    for i in range(len(queries)):
        with np.errstate(over="ignore", invalid="ignore"):
            low = np.abs(to_x - to_q[i]).max(1) if len(pivots) else np.zeros(len(x))
            bound = (norm_q[i] + norm_x - low * low) / 2
            # Room for the rounding of distances: relative to the squares they come from.
            bound = np.nan_to_num(bound + 1e-6 * (norm_q[i] + norm_x + low * low) + 1e-6, nan=np.inf, posinf=np.inf, neginf=np.inf)
        bound[ids == query_ids[i]] = -np.inf
        best, places = np.zeros(0, np.int64), np.zeros(0, np.int64)  # places follow ids
        left, step, at = np.argsort(-bound, kind="stable"), 64, 0
        while at < len(left):
            if np.isneginf(bound[left[at]]) or len(best) == k and bound[left[at]] < best[-1]:
                break
            some = left[at : at + step]
            some = some[~np.isneginf(bound[some])]
            scores = _products(queries[i : i + 1], x[some])[0]
            evaluated += len(some)
            best, places = np.append(best, scores), np.append(places, some)
            first = np.lexsort((places, -best.astype(object) if best.min(initial=0) == np.iinfo(np.int64).min else -best))[:k]
            best, places = best[first], places[first]
            at, step = at + step, min(step * 2, 1024)
        out += [(int(query_ids[i]), int(ids[p]), int(s)) for s, p in zip(best, places, strict=True)]
    return out, evaluated


def pick_pivots(vectors: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each next one has the largest distance to the nearest chosen."""
    if not len(vectors):
        return vectors
    chosen = [int(np.argmax((vectors * vectors).sum(1)))]
    near = _distances(vectors, vectors[chosen])[:, 0]
    while len(chosen) < min(n, len(vectors)) and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def packed_blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, block, n, ids, v): rows of one dimension and block as bytes, at most `size` in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, list[float]]]] = {}

        def flush(key: tuple[int, int]):
            some = held.pop(key)
            ids = np.array([r[0] for r in some], np.int64).tobytes()
            head = {"dim": pa.array([key[0]], pa.int32()), "block": pa.array([key[1]], pa.int64()), "n": pa.array([len(some)], pa.int32())}
            return pa.record_batch(head | {"ids": [ids], "v": [_bytes([r[1] for r in some])]})

        for batch in batches:
            for row_id, dim, block, v in zip(*(batch.column(c).to_pylist() for c in ("id", "dim", "block", "v")), strict=True):
                key = (dim, block)
                held.setdefault(key, []).append((row_id, v))
                if len(held[key]) >= size:
                    yield flush(key)
        for key in list(held):
            yield flush(key)

    return rows.select("id", "dim", "block", "v").mapInArrow(shipped(run), "dim int, block long, n int, ids binary, v binary")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = 2048) -> DataFrame:
    """(query_id, rank, id, score): the k highest integer inner products of every query, all if fewer.

    Queries are the rows whose id is divisible by `every`; candidates are all rows but those with the
    query's own id. Components count as floor(256 x); scores beyond a long are held to its ends. Only
    vectors of equal length meet. Rows that repeat a query's id are one query each, with the same
    answers, and are given once; a candidate that repeats is listed as often. Pivots are picked from
    about `sample` vectors by a hash, which steers only the speed. An empty table gives no rows.

    Candidates are dealt into blocks once, and blocks of queries go to each of them; k rows of a query
    leave a block.
    """
    rows = stored(scaled(vectors, id_col, vector_col), "topk-rows")
    total = rows.count()
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    some = rows.where(spread <= int((1 << 30) * min(1.0, sample / max(total, 1)))).orderBy(F.xxhash64("id"), "id").limit(2 * sample).collect()
    by_dim: dict[int, list] = {}
    for r in some:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    pivots = {dim: pick_pivots(np.array(v, np.float64).reshape(len(v), dim)) for dim, v in by_dim.items()}

    count = -(-max(total, 1) // BLOCK)
    place = F.pmod(F.xxhash64("id"), F.lit(count)).alias("block")
    blocks = packed_blocks(rows.select("id", "dim", place, "v").repartition("block"), BLOCK)
    wanted = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "dim", "v"]).withColumn("block", F.lit(0).cast("long"))
    queries = packed_blocks(wanted, QUERY_BLOCK).select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("block"),
        F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"),
    )
    pairs = stored(blocks, "topk-blocks").join(queries, ["dim", "block"])

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            found: list[tuple[int, int, int, int]] = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                dim = row["dim"]
                x, q = _matrix(row["v"], row["n"], dim), _matrix(row["q_v"], row["q_n"], dim)
                ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                best, _ = search_block(q, query_ids, x, ids, pivots.get(dim, np.zeros((0, dim))), k)
                found += [(a, dim, b, s) for a, b, s in best]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            columns = list(zip(*found, strict=True)) or [()] * 4
            return pa.table({n: pa.array(v, t) for n, v, t in zip(("query_id", "dim", "id", "score"), columns, kinds, strict=True)})

        return each

    near = by_batch(pairs.select("dim", "n", "ids", "v", "q_n", "q_ids", "q_v"), make, "query_id long, dim int, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
