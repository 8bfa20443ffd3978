"""Ordered work per key when one key may hold a large part of all rows.

A window over a key runs in one task. Here the long keys are cut into slices of their
sequence, so that a window over (key, slice) stays bounded, and a few rows per slice carry
what crosses a border. Short keys are worked on apart and pay nothing.

Which keys are long, and where they are cut, comes from a sample of rows of bounded size, over
the key and sequence columns only. It steers placement alone: results are the same for every
choice of cut points.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, stored_once
from .columns import named_all

SLICE = "__slice"

_CHUNK = 32
# Sampled rows for each slice: slices are then even within about an eighth.
_SAMPLE = 64


@dataclass(frozen=True)
class SkewPolicy:
    """A key is cut once it holds more than about max(min_rows, all rows / target_slices) rows.

    About target_slices keys can be that long, and their cut points together number about
    2 * target_slices at most. That bounds what is broadcast, whatever the data size. By default
    the target is the number of shuffle partitions, but at least 2,000, so that a slice is
    no larger than an even share of the data.
    """

    min_rows: int = 1_000_000
    target_slices: int | None = None
    enabled: bool = True

    def row_limit(self, spark: SparkSession, total: int) -> int:
        target = self.target_slices or max(2_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return max(self.min_rows, math.ceil(total / target))


@dataclass(frozen=True)
class Slicing:
    """Cut points of the long keys (one row per key) and their heavily repeated
    sequence values, if there are any. Both bounded by the policy."""

    cuts: DataFrame
    repeats: DataFrame | None


def find_long_keys(
    df: DataFrame, keys: Sequence[str], order: str, policy: SkewPolicy, total: int | None = None
) -> Slicing | None:
    """Cut points for keys too long for one task, or None where there are none.

    Counts the rows, if no `total` (how many there are at most) is given, and only if a key could be too long takes a sample of about 64 rows for each
    slice that all rows would make: two passes, and a shuffle of the sample.
    """
    if not policy.enabled:
        return None
    total = df.count() if total is None else total
    limit = policy.row_limit(df.sparkSession, total)
    if total <= limit:
        return None
    rate = min(1.0, _SAMPLE / limit)
    rows = df.select(*named_all(keys), order)
    sample = rows if rate == 1.0 else rows.where(F.rand(17) < rate)
    size = limit * rate
    points = (
        sample.groupBy(*named_all(keys))
        .agg(F.sort_array(F.collect_list(order)).alias("__all"))
        .where(F.size("__all") > size)
        .select(*named_all(keys), "__all", F.ceil(F.size("__all") / size).cast("int").alias("__parts"))
        .select(
            *named_all(keys),
            F.expr("transform(sequence(1, __parts - 1), i -> __all[cast(i * size(__all) / __parts as int)])").alias("__points"),
        )
    )
    cuts = points.select(
        *named_all(keys),
        F.array_distinct("__points").alias("__cuts"),
        F.expr(
            "array_distinct(filter(__points, (p, i) -> i > 0 and p = __points[i - 1]))"
        ).alias("__repeats"),
    ).select(
        *named_all(keys),
        F.expr(
            f"transform(sequence(0, (size(__cuts) - 1) div {_CHUNK}),"
            f" i -> slice(__cuts, i * {_CHUNK} + 1, {_CHUNK}))"
        ).alias("__chunks"),
        "__repeats",
    ).withColumn("__heads", F.transform("__chunks", lambda chunk: chunk[0]))
    # Written once, so that no later branch samples again.
    stored = stored_once(cuts, scratch_dir(df.sparkSession, "slices"))
    if stored.isEmpty():
        return None
    repeats = stored.select(*named_all(keys), F.explode("__repeats").alias(order))
    return Slicing(stored.drop("__repeats"), None if repeats.isEmpty() else repeats)


def split_long_keys(
    df: DataFrame, keys: Sequence[str], order: str, slicing: Slicing
) -> tuple[DataFrame, DataFrame]:
    """The rows of short keys, and those of long keys with SLICE: 1, 2, ... in sequence
    order. Rows of one key with the same sequence share a slice."""
    short = df.join(F.broadcast(slicing.cuts.select(*named_all(keys))), list(keys), "left_anti")
    seq = F.col(order)
    inside = F.size(F.filter(F.get("__chunks", F.col("__chunk") - 1), lambda point: point <= seq))
    number = F.when(F.col("__chunk") == 0, 1).otherwise(1 + (F.col("__chunk") - 1) * _CHUNK + inside)
    long = (
        df.join(F.broadcast(slicing.cuts), list(keys))
        .withColumn("__chunk", F.size(F.filter("__heads", lambda head: head <= seq)))
        .withColumn(SLICE, number)
        .select(*named_all(df.columns), SLICE)
    )
    return short, long


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    marks: Mapping[str, Column],
    sliced: bool,
) -> DataFrame:
    """For each entry of `marks`, adds a column with its last non-NULL value up to and
    including the row. A mark should be a struct if NULL itself must be carried.

    `sliced` rows have SLICE and take two steps: fill inside each slice, then hand on the
    last mark of the earlier slices. The last marks are one row per slice.
    """
    part = [*keys, SLICE] if sliced else list(keys)
    rows = Window.partitionBy(*named_all(part)).orderBy(*named_all(order))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({name: F.last(mark, ignorenulls=True).over(so_far) for name, mark in marks.items()})
    if not sliced:
        return local

    # Read twice below: the last filled values of a slice are what it hands on.
    local = stored_once(local, scratch_dir(df.sparkSession, "filled"))
    position = F.struct(*named_all(order))
    tails = local.groupBy(*named_all(part)).agg(
        *(F.max_by(name, F.when(F.col(name).isNotNull(), position)).alias(name) for name in marks)
    )
    before = (
        Window.partitionBy(*named_all(keys)).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    handed = tails.select(
        *named_all(part),
        *(F.last(name, ignorenulls=True).over(before).alias(f"__in_{name}") for name in marks),
    )
    return (
        local.join(handed, part, "left")
        .withColumns({name: F.coalesce(F.col(name), F.col(f"__in_{name}")) for name in marks})
        .drop(*(f"__in_{name}" for name in marks))
    )
