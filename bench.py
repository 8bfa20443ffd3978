"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]. Prints one JSON line.

Each query runs once to warm up, then BENCH_RUNS times; the median counts. Results are
computed in full and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark

from pyspark.sql import functions as F

from strata.operators.cdc import ChangeSpec, apply_changes
from strata.operators.skew import SkewPolicy
from strata.queries import ALL
from strata.queries.base import table
from strata.session import local_session, scratch_dir
from strata.streaming.history import HistoryStore

HEADLINE = [
    "ts_parse_multi",
    "scd1_latest",
    "scd1_delete",
    "scd1_composite",
    "scd1_ignore_nulls",
    "scd2_history",
    "scd2_delete",
    "scd2_tracked_cols",
    "scd2_ignore_nulls",
    "scd2_composite",
    "scd2_long_keys",
    "processed_scd2",
    "processed_cleanse",
    "processed_user_columns",
    "gold_cons_join",
    "gold_fact_skey_scd1",
    "gold_pit_skey",
    "gold_pit_skey_ordered",
    "gold_pit_skey_long_keys",
    "gold_fact_three_dims",
    "gold_custom_sql",
    "expect_warn_counts",
    "scd2_incremental",
    "scd2_incremental_late",
    "registry_fact_as_of",
]


def copies(spark, sf_dir: str, times: int):
    """The events `times` over, each copy with keys of its own, and a third of all rows on one key."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type")
    many = events.crossJoin(spark.range(times).withColumnRenamed("id", "copy"))
    hot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3)) == 0
    key = F.when(hot, F.lit(-1)).otherwise(F.col("user_id") * times + F.col("copy"))
    return many.select(key.cast("long").alias("k"), (F.col("at") * times + F.col("copy")).alias("seq"), "event_type")


def hot_key(spark, sf_dir: str) -> dict[str, float]:
    """History of 20 copies of the feed with a third of all rows on one key."""
    feed = copies(spark, sf_dir, 20)
    spec = ChangeSpec(keys=["k"], sequence_by="seq", except_column_list=["seq"])
    begin = time.perf_counter()
    apply_changes(feed, spec, SkewPolicy(min_rows=50_000)).write.format("noop").mode("overwrite").save()
    return {"scd2_hot_key_x20": round(time.perf_counter() - begin, 3)}


def growing_state(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of a micro-batch of a thousand changes as the state it meets grows."""
    spec = ChangeSpec(keys=["k"], sequence_by="seq", except_column_list=["seq"])
    feed = copies(spark, sf_dir, 20).where("k >= 0")
    store = HistoryStore(spark, scratch_dir(spark, "bench-state"), spec, feed.schema, buckets=16)
    taken, batch = {}, 0
    for share in (2, 8, 20):
        batch += 1
        store.apply(feed.where((F.col("k") % 20 < share) & (F.col("k") % 20 >= {2: 0, 8: 2, 20: 8}[share])), batch)
        few = feed.where(F.col("k") % 20 < share).limit(1000).select("k", (F.col("seq") * 2).alias("seq"), F.lit("bench").alias("event_type"))
        batch += 1
        begin = time.perf_counter()
        store.apply(few, batch)
        taken[f"micro_batch_state_{share}_of_20"] = round(time.perf_counter() - begin, 3)
    return taken


def many_batches(spark, sf_dir: str, batches: int = 64) -> dict[str, float]:
    """Median seconds of the last sixteen of many micro-batches of a hundred changes, and the rows of runs that all wrote."""
    spec = ChangeSpec(keys=["k"], sequence_by="seq", except_column_list=["seq"])
    feed = copies(spark, sf_dir, 2).where("k >= 0")
    store = HistoryStore(spark, scratch_dir(spark, "bench-batches"), spec, feed.schema, buckets=4)
    store.apply(feed, 1)
    last = feed.agg({"seq": "max"}).first()[0]
    few = feed.select("k").distinct().orderBy("k").limit(100)
    taken, written = [], 0
    for i in range(2, batches + 2):
        changes = few.select("k", F.lit(last + i).alias("seq"), F.lit(f"bench {i}").alias("event_type"))
        begin = time.perf_counter()
        store.apply(changes, i)
        taken.append(time.perf_counter() - begin)
        written += sum(p.rows for p in store.manifest() if p.version == i and p.kind in (0, 1, 2))
    print(f"{batches} micro-batches of 100 changes wrote {written} rows of runs and cuts", file=sys.stderr, flush=True)
    return {"micro_batch_after_48_batches": round(statistics.median(taken[-16:]), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "bench")

    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)

    if "BENCH_QUERIES" not in os.environ:
        for more in (hot_key, growing_state, many_batches):
            seconds |= more(spark, sf_dir)
            print(seconds, file=sys.stderr, flush=True)

    events = table(spark, sf_dir, "events")
    longest = events.groupBy("user_id").count().agg({"count": "max"}).first()[0]
    print(
        json.dumps(
            {
                "metric": "total median time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cores),
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "spark": pyspark.__version__,
                "most_rows_per_event_key": longest,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
