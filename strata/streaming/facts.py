"""Streamed facts with the keys of their dimensions, micro-batch by micro-batch.

A join of a stream with versions ordered in time cannot run as one streaming plan unless the
versions fit into every task. So each micro-batch of facts is a frame of its own, joined with the
dimensions as they stand then, whatever their size. A micro-batch writes one folder,

    <location>/batches/__batch=<id>

and writes it anew if it runs again after a failure, so that every fact counts once.

With `late`, facts that no version holds yet are kept apart, and `resolve_late` looks them up again once
the dimensions have grown:

    <location>/batches/open/__batch=id    their rows as the table shows them, with the unknown key
    <location>/pending/__batch=id         the facts as they came, and the keys they were given last

Only the open folders of micro-batches whose answers changed are written again. A reader at that moment is
in the same place as one beside a micro-batch that runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import named, named_all
from ..operators.expectations import Expectation, observe
from ..operators.gold import BROADCAST_ROWS, Lookup, fact
from ..operators.skew import SkewPolicy
from ..operators.tables import ensure_schema, grow_table, quoted, set_comment
from ..session import scratch_dir, stored_once


def narrowed(lookup: Lookup, facts: DataFrame, most: int = BROADCAST_ROWS) -> Lookup:
    """The lookup with only those dimension rows whose key the facts have, where these are `most` keys at most.

    So a small micro-batch reads a large dimension, but does not shuffle it.
    """
    keys = [f"__n{i}" for i in range(len(lookup.on))]
    wanted = facts.select(*(named(ours).alias(k) for k, ours in zip(keys, lookup.on))).dropna().distinct()
    if wanted.limit(most + 1).count() > most:
        return lookup
    same = [named(theirs) == F.col(k) for k, theirs in zip(keys, lookup.on.values())]
    return replace(lookup, dimension=lookup.dimension.join(F.broadcast(wanted), same, "left_semi"))


def land_facts(
    facts: DataFrame,
    lookups: Callable[[SparkSession], Sequence[Lookup]],
    checkpoint: str,
    location: str,
    table: str | None = None,
    comment: str | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    expectations: Sequence[Expectation] = (),
    skew: SkewPolicy = SkewPolicy(),
    broadcast_rows: int = BROADCAST_ROWS,
    late: bool = False,
) -> dict[str, int]:
    """Appends all streamed facts that are available now, with the keys that `lookups` gives.

    lookups: called for each micro-batch, so that dimensions are read as they stand then. finish: columns
    and filters of the table, after the lookups. Of a fact, the answer is that of the batch operators
    over the dimension as read; which plan finds it follows from measured sizes.

    late: keep the facts without a version of some dimension for resolve_late.

    Returns the sums over this run of the counts of the expectations. Rows are in <location>/batches.
    """
    sums: dict[str, int] = {}
    rows = f"{location.rstrip('/')}/batches"

    def write(df: DataFrame, folder: str) -> None:
        checked, counts = observe(finish(df), list(expectations))
        if table:
            _entered(checked, table, rows, comment)
        checked.write.mode("overwrite").parquet(folder)
        if isinstance(counts, Observation):
            for name, value in counts.get.items():
                sums[name] = sums.get(name, 0) + (value or 0)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            found = [narrowed(x, batch, broadcast_rows) if set(x.on) <= set(batch.columns) else x for x in lookups(batch.sparkSession)]
            if not late:
                write(fact(batch, found, skew, broadcast_rows), f"{rows}/__batch={batch_id}")
                return
            keyed = fact(batch.withColumn(_ROW, F.struct(*named_all(batch.columns))), found, skew, broadcast_rows).persist()
            try:
                missing = _waits(found, batch.columns)
                _as_pending(keyed.where(missing), found).write.mode("overwrite").parquet(_pending(location, batch_id))
                write(keyed.where(missing).drop(_ROW), _open(location, batch_id))
                write(keyed.where(~missing).drop(_ROW), f"{rows}/__batch={batch_id}")
            finally:
                keyed.unpersist()
        finally:
            batch.unpersist()

    if table:
        # A table without rows yet, also if no micro-batch comes.
        like = facts.sparkSession.createDataFrame([], facts.schema)
        _entered(finish(fact(like, lookups(facts.sparkSession), skew, broadcast_rows)), table, rows, comment)
    query = facts.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if table:
        facts.sparkSession.catalog.refreshTable(quoted(table))
    return sums


_ROW, _HAD = "__row", "__had"


def _open(location: str, batch_id: int) -> str:
    return f"{location.rstrip('/')}/batches/open/__batch={batch_id}"


def _pending(location: str, batch_id: int) -> str:
    return f"{location.rstrip('/')}/pending/__batch={batch_id}"


def _unknown(skey: Column, lookup: Lookup) -> Column:
    if lookup.unknown is None:
        return skey.isNull()
    return skey.isNull() | skey.eqNullSafe(F.lit(lookup.unknown).cast("bigint"))


def _waits(lookups: Sequence[Lookup], columns: Sequence[str]) -> Column:
    """Whether a row has the unknown key of some dimension, and the key and time that a later version could have.
    Never NULL."""
    waits = F.lit(False)
    for lookup in lookups:
        given = [F.col(_ROW).getField(c).isNotNull() for c in lookup.reads if c in columns]
        waits = waits | reduce(and_, given, _unknown(named(lookup.target), lookup))
    return waits


def _answers(lookups: Sequence[Lookup]) -> Column:
    return F.struct(*(named(x.target).cast("bigint").alias(f"s{i}") for i, x in enumerate(lookups)))


def _as_pending(keyed: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    return keyed.select(_ROW, _answers(lookups).alias(_HAD))


def resolve_late(
    spark: SparkSession,
    lookups: Callable[[SparkSession], Sequence[Lookup]],
    location: str,
    table: str | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    expectations: Sequence[Expectation] = (),
    skew: SkewPolicy = SkewPolicy(),
    broadcast_rows: int = BROADCAST_ROWS,
) -> int:
    """Looks up again the facts that land_facts(late=True) found no version for; how many micro-batches changed.

    Cost follows the pending facts: the dimensions are narrowed to their keys where those are few, and facts
    that were found when they landed are not read. A micro-batch stops being pending once all its facts are found; those
    without key or time never are pending. A fact that has a key keeps it, whatever arrives later. Expectations
    that drop or fail rows hold here too; the counts of a run are those of land_facts.

    Interrupted between its writes, it finds the same micro-batches changed when it runs again, for the rows that the
    table shows are written first. Not to be run beside land_facts of the same location.
    """
    try:
        pending = spark.read.parquet(f"{location.rstrip('/')}/pending")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise
    columns = pending.select(f"{_ROW}.*").columns
    waiting = pending.select(f"{_ROW}.*", _ROW, _HAD, "__batch")
    found = [narrowed(x, waiting, broadcast_rows) if set(x.on) <= set(columns) else x for x in lookups(spark)]
    keyed = fact(waiting, found, skew, broadcast_rows)
    had = {x.target: F.col(_HAD).getField(f"s{i}") for i, x in enumerate(found)}
    keyed = keyed.withColumns({x.target: F.when(_unknown(had[x.target], x), named(x.target)).otherwise(had[x.target]) for x in found})
    # Written once: the folders that it is read from are replaced below.
    keyed = stored_once(keyed, scratch_dir(spark, "late"))
    batches = keyed.groupBy("__batch").agg(
        F.bool_or(~_answers(found).eqNullSafe(F.col(_HAD))).alias("changed"), F.bool_or(_waits(found, columns)).alias("waits")
    )
    changed = batches.where("changed").orderBy("__batch").collect()
    for batch_id, _, waits in changed:
        again = keyed.where(F.col("__batch") == batch_id)
        checked, _ = observe(finish(again.drop(_ROW, _HAD, "__batch")), list(expectations))
        checked.write.mode("overwrite").parquet(_open(location, batch_id))
        _as_pending(again.where(F.lit(waits)), found).write.mode("overwrite").parquet(_pending(location, batch_id))
    if table and changed:
        spark.catalog.refreshTable(quoted(table))
    return len(changed)


def _entered(like: DataFrame, table: str, rows: str, comment: str | None) -> None:
    """The catalog's entry over all folders of micro-batches, made or grown to the frame's columns."""
    spark = like.sparkSession
    ensure_schema(spark, table)
    if not spark.catalog.tableExists(quoted(table)):
        spark.catalog.createTable(quoted(table), path=rows, source="parquet", schema=like.schema, recursiveFileLookup="true")
    else:
        grow_table(like, table)
    set_comment(spark, table, comment)


def landed_facts(spark: SparkSession, location: str) -> DataFrame | None:
    """What land_facts wrote without a table; None if that is nothing yet."""
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(f"{location.rstrip('/')}/batches")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
