"""Streaming reads and appends. Every run takes what is new and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.tables import ensure_table, grow_table, quoted


_REMEMBERED = "spark.sql.streaming.numRecentProgressUpdates"


def read_hop(spark: SparkSession, table: str, read_mode: str = "snapshot", append_only: bool = False) -> DataFrame:
    """An upstream hop as a whole table or as a stream. Tables that are rewritten (cdc and
    everything after it) cannot be streamed."""
    if read_mode == "snapshot":
        return spark.read.table(quoted(table))
    if read_mode != "stream":
        raise ValueError(f"{table}: read_mode must be 'snapshot' or 'stream', not {read_mode!r}")
    if not append_only:
        raise ValueError(f"{table}: read_mode 'stream' needs an append-only source; this one is rewritten")
    return spark.readStream.table(quoted(table))


def land_stream(
    df: DataFrame, checkpoint: str, location: str, table: str | None = None, comment: str | None = None, metrics: str | None = None
) -> dict[str, int]:
    """Appends all data that is available now; the checkpoint makes each file count once.

    Returns the sums over this run of the counts that the frame observes under the name `metrics`.
    """
    spark = df.sparkSession
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if table:
        ensure_table(spark, df, table, location, comment)
        grow_table(df, table)
    # Every micro-batch of the run must be remembered to be counted.
    usual = spark.conf.get(_REMEMBERED)
    spark.conf.set(_REMEMBERED, str(1_000_000))
    try:
        query = writer.toTable(quoted(table)) if table else writer.start(location)
    finally:
        spark.conf.set(_REMEMBERED, usual)
    query.awaitTermination()
    sums: dict[str, int] = {}
    for progress in query.recentProgress if metrics else ():
        row = (progress["observedMetrics"] or {}).get(metrics)
        for name, value in (row.asDict() if row is not None else {}).items():
            sums[name] = sums.get(name, 0) + (value or 0)
    return sums
