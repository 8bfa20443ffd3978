"""Helpers of the training-data operators: Arrow batches, stored steps, ranks and components."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import scratch_dir, stored_once

#: Rows in one Arrow batch. Texts are long, so a batch is kept well under what a worker holds.
BATCH_ROWS = 256


def prepared(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows from a written copy in the shared folder: computed once, safe from lost executors."""
    return stored_once(df, scratch_dir(df.sparkSession, label))


def shipped(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function in a form that a Python worker can load where this package isn't on its path yet.

    Workers that see the folder the package lies in find it there; others need it installed.
    """
    packed, root = cloudpickle.dumps(run), str(Path(__file__).resolve().parents[2])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if root not in sys.path:
            sys.path.append(root)
        yield from pickle.loads(packed)(batches)

    return call


def by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.Table | None]], schema: str) -> DataFrame:
    """mapInArrow where `make` runs once per task and its result turns each batch into rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            table = each(batch)
            if table is not None:
                yield from table.to_batches()

    return df.mapInArrow(shipped(run), schema)


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, rows_per_part: int = 512, part: Column | None = None) -> DataFrame:
    """Adds `name`: 0, 1, 2 ... within each value of `keys`, without gathering a key in one task.

    A key is cut by a hash of `order` into parts of about `rows_per_part` rows; rows are counted
    within a part, and the parts' sizes, one row each, are summed up. Rows equal in `order` may
    change places. `keys` must not be NULL and have few values, bounded by the caller's design (they
    are broadcast). The frame is read more than once: pass a stored one.

    With `part`, an integer that rises with `order` and holds few rows a value, the parts are those and ranks
    follow `order` within the whole key; nothing is broadcast.
    """
    if part is not None:
        cut = df.withColumn("__part", part)
        return _ranked(cut, cut.groupBy(*keys, "__part").count(), keys, order, name)
    sizes = df.groupBy(*keys).count().select(*keys, F.ceil(F.col("count") / rows_per_part).alias("__parts"))
    sizes = F.broadcast(sizes)
    cut = df.join(sizes, keys).withColumn("__part", F.pmod(F.xxhash64(*order), F.col("__parts")))
    counts = df.join(sizes, keys).groupBy(*keys, F.pmod(F.xxhash64(*order), F.col("__parts")).alias("__part")).count()
    return _ranked(cut, counts, keys, order, name).drop("__parts")


def _ranked(cut: DataFrame, counts: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    inside = W.partitionBy(*keys, "__part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    cut = cut.withColumn("__at", F.row_number().over(inside) - 1)
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    return (
        cut.join(starts, [*keys, "__part"])
        .withColumn(name, F.col("__start") + F.col("__at"))
        .drop("__part", "__at", "__start")
    )


def components(edges: DataFrame, left: str = "a", right: str = "b", label: str = "components") -> DataFrame:
    """(node, root) of every node in `edges`: root is the smallest node that can be reached.

    Large-star and small-star rounds in turn; each round's links are written, so lost executors
    cost one round. Links between a node and its root at most, so rows never exceed the links given.
    """
    spark = edges.sparkSession
    a, b = F.col(left), F.col(right)
    links = stored(edges.where(a != b).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), label)
    seen = None
    while True:
        links = stored(_star(_star(links, large=True), large=False), label)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(links.select("u", "u").distinct())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round: every neighbour above (large) or below (small) a node is linked to its smallest."""
    if large:
        near = links.union(links.select("v", "u"))
        least = near.groupBy("u").agg(F.min("v").alias("__m")).select("u", F.least("u", "__m").alias("m"))
        out = near.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v")
    else:
        below = links.select(F.col("v").alias("n"), F.col("u").alias("w"))
        least = below.groupBy("n").agg(F.min("w").alias("m"))
        out = below.join(least, "n").select(F.col("m").alias("u"), F.col("w").alias("v"))
        out = out.union(least.select(F.col("m").alias("u"), F.col("n").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()
