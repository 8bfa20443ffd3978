"""Change feeds to SCD tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import ChangeSpec, apply_changes, refused_changes
from ..operators.skew import SkewPolicy
from ..session import scratch_dir
from ..streaming.history import HistoryStore
from .base import EVENT_FEED, EVENT_VERSIONS, Query, event_changes, table

_NULLED = "CASE WHEN event_type = 'click' THEN NULL ELSE value END"


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(*EVENT_FEED)


def _nulled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "ts", "event_type", F.expr(_NULLED).alias("value"))


def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    spec = ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=1)
    return apply_changes(table(spark, sf, "events"), spec)


def scd1_delete(spark: SparkSession, sf: str) -> DataFrame:
    spec = event_changes(scd_type=1, except_column_list=[])
    return apply_changes(table(spark, sf, "events"), spec)


def scd1_composite(spark: SparkSession, sf: str) -> DataFrame:
    spec = ChangeSpec(
        keys=["l_orderkey", "l_linenumber"], sequence_by="l_shipdate", scd_type=1, tie_breaker=["l_partkey", "l_suppkey"]
    )
    return apply_changes(table(spark, sf, "lineitem"), spec)


def scd1_ignore_nulls(spark: SparkSession, sf: str) -> DataFrame:
    spec = event_changes(scd_type=1, apply_as_deletes="event_type = 'signup'", ignore_null_updates=True)
    return apply_changes(_nulled(spark, sf), spec)


def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(_feed(spark, sf), event_changes(apply_as_deletes=None))


def scd2_delete(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(_feed(spark, sf), event_changes())


def scd2_tracked_cols(spark: SparkSession, sf: str) -> DataFrame:
    feed = table(spark, sf, "events").select(*EVENT_FEED, "value")
    return apply_changes(feed, event_changes(apply_as_deletes=None, track_history_column_list=["event_type"]))


def scd2_ignore_nulls(spark: SparkSession, sf: str) -> DataFrame:
    spec = event_changes(apply_as_deletes="event_type = 'signup'", ignore_null_updates=True)
    return apply_changes(_nulled(spark, sf), spec)


def scd2_composite(spark: SparkSession, sf: str) -> DataFrame:
    feed = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    spec = ChangeSpec(
        keys=["l_orderkey", "l_linenumber"],
        sequence_by="l_shipdate",
        track_history_column_list=["l_quantity"],
        tie_breaker=["l_partkey", "l_suppkey"],
    )
    return apply_changes(feed, spec)


def scd2_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scattered over partitions by a hash of their id, far from sequence order."""
    events = table(spark, sf, "events")
    shuffled = events.repartition(7, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("event_id", F.lit(1)))
    return apply_changes(shuffled.select(*EVENT_FEED), event_changes())


def scd2_long_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a limit so low that almost every key is cut into slices."""
    return apply_changes(_feed(spark, sf), event_changes(), SkewPolicy(min_rows=20, target_slices=1_000_000))


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("lsn"), "event_type")


def _by_number() -> ChangeSpec:
    return event_changes(sequence_by="lsn", except_column_list=["lsn"])


def scd2_integer_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Changes ordered by a 64-bit number, as logs have it; versions are bounded by such numbers."""
    return apply_changes(_numbered(spark, sf), _by_number())


def scd2_integer_sequence_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, "numbers", _numbered(spark, sf), _by_number())


def _streamed(spark: SparkSession, sf: str, label: str, feed: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The feed as three files in no order, one micro-batch each."""
    work = scratch_dir(spark, label)
    feed.repartition(3, F.xxhash64(spec.sequence_by)).write.parquet(f"{work}/in")
    store = HistoryStore(spark, f"{work}/cdc", spec, feed.schema, buckets=8)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    query = (
        stream.writeStream.foreachBatch(store.apply)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read()


def scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, "scd2", _feed(spark, sf), event_changes())


def scd1_incremental(spark: SparkSession, sf: str) -> DataFrame:
    feed = table(spark, sf, "events")
    return _streamed(spark, sf, "scd1", feed, event_changes(scd_type=1, except_column_list=[]))


def _late(spark: SparkSession, feed: DataFrame, spec: ChangeSpec, label: str) -> DataFrame:
    store = HistoryStore(spark, scratch_dir(spark, label), spec, feed.schema, buckets=8)
    for batch_id, changes in with_late_changes(feed):
        store.apply(changes, batch_id)
    return store.read()


def with_late_changes(feed: DataFrame) -> Iterator[tuple[int, DataFrame]]:
    """Four micro-batches in order of time, then one with every tenth change of all times."""
    late = F.pmod(F.xxhash64("user_id", "ts"), F.lit(10)) == 0
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    span = feed.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    part = F.floor((at - F.lit(span["a"])) * 4 / (F.lit(span["b"]) - F.lit(span["a"]) + 1))
    for i in range(4):
        yield i + 1, feed.where(~late & (part == i))
    yield 5, feed.where(late)


def scd2_incremental_late(spark: SparkSession, sf: str) -> DataFrame:
    return _late(spark, _feed(spark, sf), event_changes(), "scd2-late")


def scd2_ignore_nulls_late(spark: SparkSession, sf: str) -> DataFrame:
    """Late changes meet carried values: each reads on from its run, with what the run before it ended with."""
    spec = event_changes(apply_as_deletes="event_type = 'signup'", ignore_null_updates=True)
    return _late(spark, _nulled(spark, sf), spec, "scd2-nulls-late")


def cdc_refused_rows(spark: SparkSession, sf: str) -> DataFrame:
    """How many changes lack a key or a sequence."""
    feed = table(spark, sf, "events").select(
        "event_id",
        F.expr("CASE WHEN event_type <> 'signup' THEN user_id END").alias("user_id"),
        F.expr("CASE WHEN event_id % 7 <> 0 THEN ts END").alias("ts"),
    )
    refused = refused_changes(feed, ChangeSpec(keys=["user_id"], sequence_by="ts"))
    return refused.groupBy(F.isnull("user_id").alias("no_key"), F.isnull("ts").alias("no_sequence")).agg(
        F.count(F.lit(1)).alias("changes")
    )


def scd1_except_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Rescued text, and here the ids too, are not stored."""
    feed = table(spark, sf, "events").withColumn("_rescued_data", F.lit("x"))
    spec = ChangeSpec(
        keys=["user_id", "event_type"], sequence_by="ts", scd_type=1, except_column_list=["_rescued_data", "event_id", "props"]
    )
    return apply_changes(feed, spec)


_VERSIONS_SQL = f"""
WITH {EVENT_VERSIONS}
SELECT user_id, event_type, start_at AS __START_AT, end_at AS __END_AT FROM versions
"""

_NUMBERED_SQL = f"""
WITH {EVENT_VERSIONS}
SELECT user_id, event_type, epoch_us(start_at) AS __START_AT, epoch_us(end_at) AS __END_AT FROM versions
"""

_DELETE_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
) WHERE rn = 1 AND event_type <> 'error'
"""

_CARRIED = f"""
  epochs AS (
    SELECT user_id, ts, event_type, event_type = 'signup' AS gone, {_NULLED} AS value,
           sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS epoch
    FROM events
  ),
  carried AS (
    SELECT user_id, ts, event_type, gone,
           CASE WHEN NOT gone THEN
             last_value(CASE WHEN gone THEN NULL ELSE value END IGNORE NULLS)
               OVER (PARTITION BY user_id, epoch ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           END AS value
    FROM epochs
  )
"""

_IGNORE_NULLS_SQL = f"""
WITH {_CARRIED}, marked AS (
  SELECT *, row_number() OVER w = 1 OR gone <> lag(gone) OVER w
            OR (NOT gone AND (event_type IS DISTINCT FROM lag(event_type) OVER w
                              OR value IS DISTINCT FROM lag(value) OVER w)) AS opens
  FROM carried WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), bounded AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at FROM marked WHERE opens
)
SELECT user_id, event_type, value, ts AS __START_AT, end_at AS __END_AT FROM bounded WHERE NOT gone
"""

QUERIES = {
    "scd1_latest": Query(
        scd1_latest,
        """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
) WHERE rn = 1
""",
    ),
    "scd1_delete": Query(scd1_delete, _DELETE_SQL),
    "scd1_composite": Query(
        scd1_composite,
        """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem
) WHERE rn = 1
""",
    ),
    "scd1_ignore_nulls": Query(
        scd1_ignore_nulls,
        f"""
WITH {_CARRIED}
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM carried
) WHERE rn = 1 AND NOT gone
""",
    ),
    "scd2_history": Query(
        scd2_history,
        """
WITH marked AS (
  SELECT user_id, ts, event_type,
         row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
)
SELECT user_id, event_type, ts AS __START_AT, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT
FROM marked WHERE opens
""",
    ),
    "scd2_delete": Query(scd2_delete, _VERSIONS_SQL),
    "scd2_tracked_cols": Query(
        scd2_tracked_cols,
        """
WITH marked AS (
  SELECT user_id, ts, event_type, value,
         CASE WHEN row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM marked
), merged AS (
  SELECT user_id, run, min(event_type) AS event_type, arg_max(value, ts) AS value, min(ts) AS start_at
  FROM runs GROUP BY user_id, run
)
SELECT user_id, event_type, value, start_at AS __START_AT,
       lead(start_at) OVER (PARTITION BY user_id ORDER BY run) AS __END_AT
FROM merged
""",
    ),
    "scd2_ignore_nulls": Query(scd2_ignore_nulls, _IGNORE_NULLS_SQL),
    "scd2_ignore_nulls_late": Query(scd2_ignore_nulls_late, _IGNORE_NULLS_SQL),
    "scd2_composite": Query(
        scd2_composite,
        """
WITH single AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate ORDER BY l_partkey DESC, l_suppkey DESC) = 1
), marked AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 OR l_quantity IS DISTINCT FROM lag(l_quantity) OVER w THEN 1 ELSE 0 END AS opens
  FROM single WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate) AS run FROM marked
), merged AS (
  SELECT l_orderkey, l_linenumber, run, arg_max(l_partkey, l_shipdate) AS l_partkey, arg_max(l_suppkey, l_shipdate) AS l_suppkey,
         max(l_shipdate) AS l_shipdate, min(l_quantity) AS l_quantity, min(l_shipdate) AS start_at
  FROM runs GROUP BY l_orderkey, l_linenumber, run
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, start_at AS __START_AT,
       lead(start_at) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY run) AS __END_AT
FROM merged
""",
    ),
    "cdc_refused_rows": Query(
        cdc_refused_rows,
        """
SELECT event_type = 'signup' AS no_key, event_id % 7 = 0 AS no_sequence, count(*) AS changes
FROM events WHERE event_type = 'signup' OR event_id % 7 = 0 GROUP BY 1, 2
""",
    ),
    "scd1_except_columns": Query(
        scd1_except_columns,
        """
SELECT user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events
) WHERE rn = 1
""",
    ),
    "scd2_out_of_order": Query(scd2_out_of_order, _VERSIONS_SQL),
    "scd2_long_keys": Query(scd2_long_keys, _VERSIONS_SQL),
    "scd2_incremental": Query(scd2_incremental, _VERSIONS_SQL),
    "scd1_incremental": Query(scd1_incremental, _DELETE_SQL),
    "scd2_incremental_late": Query(scd2_incremental_late, _VERSIONS_SQL),
    "scd2_integer_sequence": Query(scd2_integer_sequence, _NUMBERED_SQL),
    "scd2_integer_sequence_incremental": Query(scd2_integer_sequence_incremental, _NUMBERED_SQL),
}
