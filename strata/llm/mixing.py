"""Interleaving sources to target weights by proportionate-fair scheduling.

The documents of a source are cut into blocks. With integer weights W the fluid schedule serves
all sources at once, W_s / (sum of the weights of sources not yet used up) of a block each slot.
Block j of source s may start when the fluid schedule has served j blocks of s (its release) and
must end when it has served j + 1 (its deadline); earliest deadline first among the released then
keeps every source within one block of the fluid schedule. Sources that run out leave their share
to the others, so every document is placed.

All times are exact integer arithmetic. Whenever every source has been served a whole multiple of its
weight (or is used up), the fluid schedule has served whole blocks of all: there the slots are cut
into chunks of a few hundred blocks, which are scheduled apart from each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ranked, stored

#: Largest sum of weights: a chunk holds as many blocks.
MOST_WEIGHT = 4096
#: Small weights are served several times in a chunk, up to about this many blocks.
CHUNK = 256


def _class(source: Column, weights: dict[str, int]) -> Column:
    """Place of the source in `weights`; sources not named there, and NULL, share the place after the last."""
    named = [F.when(source == name, F.lit(i)) for i, name in enumerate(weights)]
    return F.coalesce(*named, F.lit(len(weights)))


def schedule(blocks: list[int], weights: list[int], spark) -> DataFrame:
    """(class, block, slot): every block 0 .. blocks[i] - 1 of class i in a slot of its own, from slot 0 without gaps."""
    used = [(n, w, i) for i, (n, w) in enumerate(zip(blocks, weights, strict=True)) if n > 0]
    if not used:
        return spark.createDataFrame([], "class int, block long, slot long")
    heaviest = sum(w for _, w, _ in used)
    if heaviest > MOST_WEIGHT:
        raise ValueError(f"the weights sum to {heaviest}; at most {MOST_WEIGHT}")
    turns = max(1, CHUNK // heaviest)
    total = sum(n for n, _, _ in used)

    starts, at = [], 0
    for n, w, i in used:
        starts.append((at, n, w, i))
        at += n
    row = F.col("id")
    pick = lambda values: F.coalesce(*[F.when(row < a + n, F.lit(v)) for (a, n, _, _), v in zip(starts, values, strict=True)])
    jobs = spark.range(total).select(
        pick([i for *_, i in starts]).cast("int").alias("class"),
        pick([w for _, _, w, _ in starts]).cast("long").alias("w"),
        (row - pick([a for a, *_ in starts])).alias("block"),
    )

    def served(j: Column, w: Column) -> Column:  # w times the slots in which j blocks of weight w are done
        return sum((F.least(F.lit(n).cast("long") * w, F.lit(x).cast("long") * j) for n, x, _ in used), F.lit(0).cast("long"))

    jobs = jobs.withColumns({"from": served(F.col("block"), F.col("w")), "to": served(F.col("block") + 1, F.col("w"))})
    jobs = jobs.select(
        "class",
        "block",
        F.expr("`from` div w").alias("release"),
        F.expr("(`to` + w - 1) div w").alias("deadline"),
        F.expr(f"block div (w * {turns})").alias("chunk"),
    ).withColumn("start", served(F.col("chunk") * turns, F.lit(1).cast("long")))

    # Earliest deadline first, slot by slot, over the sorted blocks of a chunk that are left.
    chunk = jobs.groupBy("chunk", "start").agg(F.sort_array(F.collect_list(F.struct("deadline", "class", "block", "release"))).alias("jobs"))
    order = F.expr(
        """aggregate(sequence(0, size(jobs) - 1),
              named_struct('left', jobs, 'done', slice(jobs, 1, 0)),
              (s, i) -> transform(
                array(filter(s.left, x -> x.release <= start + i)[0]),
                p -> named_struct('left', filter(s.left, x -> x.class <> p.class OR x.block <> p.block),
                                  'done', concat(s.done, array(p))))[0],
              s -> s.done)"""
    )
    slots = chunk.select("start", F.posexplode(order).alias("at", "job"))
    return slots.select(F.col("job.class").alias("class"), F.col("job.block").alias("block"), (F.col("start") + F.col("at")).alias("slot"))


def mixed(docs: DataFrame, weights: dict[str, int], rest: int = 1, block_rows: int = 32) -> DataFrame:
    """(doc_id, source, key, block, slot, position) of every distinct document, in Pfair order of its source's blocks.

    weights: a positive integer by source. Sources not named, and NULL, are one further source of
    weight `rest`. A block is `block_rows` documents of a source by doc_id within hashed parts; a
    source's last block may be shorter. position is slot * block_rows + place in the block: unique,
    rising with the slot, with gaps only after short blocks. key is a hash of text and source that,
    with doc_id, names the row; rows that repeat all three are one document here. NULL ids and texts
    are values like any other. An empty table gives no rows. Other columns are not read.
    """
    if any(w < 1 for w in (*weights.values(), rest)) or block_rows < 1:
        raise ValueError("weights and block_rows must be positive integers")
    keys = docs.select("doc_id", "source", row_key().alias("key"), _class(F.col("source"), weights).alias("class")).distinct()
    keys = stored(keys, "mixing-keys")
    counts = {r["class"]: r["count"] for r in keys.groupBy("class").count().collect()}
    shares = [*weights.values(), rest]
    blocks = [-(-counts.get(i, 0) // block_rows) for i in range(len(shares))]
    slots = schedule(blocks, shares, docs.sparkSession)
    rows = ranked(keys, ["class"], ["doc_id", "key"], "rank").withColumn("block", F.expr(f"rank div {block_rows}"))
    found = rows.join(slots, ["class", "block"])
    position = F.col("slot") * block_rows + F.col("rank") % block_rows
    return found.select("doc_id", "source", "key", "block", "slot", position.alias("position"))


def row_key() -> Column:
    return F.xxhash64(F.col("text"), F.col("source"))


def in_mixed_order(docs: DataFrame, weights: dict[str, int], rest: int = 1, block_rows: int = 32, place: str | None = None) -> DataFrame:
    """All rows and columns of `docs`, sorted into Pfair order: written files hold them interleaved.

    `place` names a column for the position, by which later steps can follow the order.
    """
    places = mixed(docs, weights, rest, block_rows).select(F.col("doc_id").alias("__place_id"), F.col("key").alias("__place_key"), F.col("position").alias("__position"))
    keyed = docs.withColumn("__key", row_key())
    same = F.col("doc_id").eqNullSafe(F.col("__place_id")) & (F.col("__key") == F.col("__place_key"))
    found = keyed.join(places, same).drop("__place_id", "__place_key", "__key").orderBy("__position")
    return found.withColumnRenamed("__position", place) if place else found.drop("__position")
