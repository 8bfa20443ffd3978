"""Whole registries from files to gold."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Medallion
from ..session import scratch_dir
from .base import EVENT_VERSIONS, Query, skey_sql, table
from .processed import PROCESSED_VERSIONS


def _hops() -> dict[str, dict[str, str]]:
    """Schemas of this run only."""
    run = uuid.uuid4().hex[:8]
    return {
        "l01": {"schema": f"01_bronze_{run}"},
        "l02": {"schema": f"02_silver_{run}"},
        "l03": {"schema": f"02_silver_{run}"},
        "gold": {"schema": f"03_gold_{run}"},
    }


def _defaults(**l01: Any) -> dict[str, Any]:
    return {
        "l01": {"enabled": True, "metadata_driven": True, **l01},
        "l02": {"enabled": True, "metadata_driven": True, "sequence_by": "__source_updated_at"},
        "l03": {"enabled": True, "metadata_driven": True, "write_mode": "materialized_view", "read_mode": "snapshot"},
    }


def _dimension_of_users(hops: dict[str, dict[str, str]], files: str, **refresh: str) -> dict[str, Any]:
    """Files, raw, type 2 history by micro-batch, keys, cons, dim."""
    return {
        "hops": hops,
        "source_systems": {
            "shop": {
                "source_type": "cloud_storage",
                "connection": {"cloud_storage_path": files, "cloud_storage_type": "parquet"},
                "defaults": _defaults(ingestion_mode="streaming", merge_strategy="append"),
                "dimensions": {
                    "events": {
                        "primary_key_columns": "user_id",
                        "l01": {"source_updated_at_col": "ts", "data_items": ["user_id", "ts", "event_type"]},
                        "l02": {"apply_as_deletes": "event_type = 'error'", "track_history_column_list": ["event_type"]},
                        "l03": {"skey_column": "user_skey", "leading_columns": ["user_id"], **refresh},
                    }
                },
            }
        },
        "gold": [
            {"object_name": "cons_user", "source_object": "processed_events", **refresh},
            {
                "object_name": "dim_user",
                "source_object": "cons_user",
                "create_scd2_view": True,
                "columns": [
                    {"source_col": c, "target_col": c}
                    for c in ("user_skey", "user_id", "event_type", "__etl_effective_from", "__etl_effective_to", "__etl_is_current")
                ],
                **refresh,
            },
        ],
    }


def registry_dim_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """A streamed dimension, its processed and gold tables written in full."""
    hops = _hops()
    registry = _dimension_of_users(hops, sf.rstrip("/") + "/{object}*.parquet")
    Medallion(spark, registry, scratch_dir(spark, "registry-dim"), buckets=8).run()
    return spark.table(f"spark_catalog.{hops['gold']['schema']}.dim_user")


def registry_dim_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two runs, each with half of the changes of all times; three tables are refreshed by what changed."""
    hops, work = _hops(), scratch_dir(spark, "registry-incremental")
    medallion = Medallion(spark, _dimension_of_users(hops, f"{work}/in/{{object}}", refresh="incremental"), work, buckets=8, keep_versions=1)
    for half in (0, 1):
        changes = table(spark, sf, "events").where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        changes.write.mode("append").parquet(f"{work}/in/events")
        medallion.run()
    return spark.table(f"spark_catalog.{hops['gold']['schema']}.dim_user")


def registry_fact_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """A fact with the key of its dimension, both from snapshots."""
    hops = _hops()
    silver = f"spark_catalog.{hops['l03']['schema']}"
    registry = {
        "hops": hops,
        "source_systems": {
            "shop": {
                "source_type": "cloud_storage",
                "connection": {"cloud_storage_path": sf.rstrip("/") + "/{object}.parquet", "cloud_storage_type": "parquet"},
                "defaults": _defaults(ingestion_mode="snapshot", merge_strategy="overwrite"),
                "dimensions": {
                    "customer": {
                        "primary_key_columns": ["c_custkey"],
                        "data_items": ["*", "timestamp'2020-01-01 00:00:00' AS changed"],
                        "source_updated_at_col": "changed",
                    }
                },
                "facts": {
                    "orders": {
                        "primary_key_columns": ["o_custkey"],
                        "source_updated_at_col": "o_orderdate",
                        "l02": {"tie_breaker": ["o_orderkey"]},
                        "l03": {
                            "columns": [
                                {
                                    "source_col": "o_totalprice",
                                    "target_col": "total",
                                    "data_type": "DECIMAL(18,2)",
                                    "constraint_name": "positive_total",
                                    "constraint_expression": "total > 0",
                                    "constraint_on_violation": "DROP",
                                }
                            ]
                        },
                    }
                },
            }
        },
        "gold": [
            {
                "object_name": "fact_orders",
                "custom_sql": f"""
                    SELECT f.orders_skey, d.customer_skey, f.o_custkey, f.o_orderkey, f.o_orderdate, f.total
                    FROM {silver}.processed_orders f
                    LEFT JOIN {silver}.processed_customer d ON f.o_custkey = d.c_custkey AND d.__etl_is_current
                """,
            }
        ],
    }
    Medallion(spark, registry, scratch_dir(spark, "registry-fact")).run()
    return spark.table(f"spark_catalog.{hops['gold']['schema']}.fact_orders")


def registry_fact_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """A fact that takes the key of the dimension's version at its event time, by configuration alone."""
    hops = _hops()
    events = {"source_updated_at_col": "ts"}
    registry = {
        "hops": hops,
        "source_systems": {
            "shop": {
                "source_type": "cloud_storage",
                "connection": {"cloud_storage_path": sf.rstrip("/") + "/{object}*.parquet", "cloud_storage_type": "parquet"},
                "defaults": _defaults(ingestion_mode="snapshot", merge_strategy="overwrite"),
                "dimensions": {
                    "events": {
                        "primary_key_columns": "user_id",
                        "l01": {**events, "data_items": ["user_id", "ts", "event_type"]},
                        "l02": {"apply_as_deletes": "event_type = 'error'", "track_history_column_list": ["event_type"], "buckets": 8},
                        "l03": {"skey_column": "user_skey"},
                    }
                },
                "facts": {
                    "event": {
                        "primary_key_columns": "event_id",
                        "l01": {**events, "data_items": ["event_id", "user_id", "ts", "value"]},
                        "l02": {"buckets": 8},
                    }
                },
            }
        },
        # Listed before what it reads; run after it.
        "gold": [
            {
                "object_name": "fact_event",
                "source_object": "processed_event",
                "lookups": [{"dimension": "dim_user", "on": "user_id", "skey": "user_skey", "event_time": "ts", "unknown": -1}],
                "columns": [{"source_col": c, "target_col": c} for c in ("user_skey", "event_id", "user_id", "ts", "value")],
            },
            {
                "object_name": "dim_user",
                "source_object": "processed_events",
                "write_mode": "permanent_table",
                "columns": [
                    {"source_col": c, "target_col": c}
                    for c in ("user_skey", "user_id", "__etl_effective_from", "__etl_effective_to", "__etl_is_current")
                ],
            },
        ],
    }
    Medallion(spark, registry, scratch_dir(spark, "registry-as-of")).run()
    return spark.table(f"spark_catalog.{hops['gold']['schema']}.fact_event")


def registry_fact_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed raw facts that take the key of the dimension's version at their time, as they come."""
    hops = _hops()
    columns = ("user_skey", "user_id", "__etl_effective_from", "__etl_effective_to", "__etl_is_current")
    registry = {
        "hops": hops,
        "source_systems": {
            "shop": {
                "source_type": "cloud_storage",
                "connection": {"cloud_storage_path": sf.rstrip("/") + "/{object}*.parquet", "cloud_storage_type": "parquet"},
                "defaults": _defaults(ingestion_mode="streaming", merge_strategy="append"),
                "dimensions": {
                    "events": {
                        "primary_key_columns": "user_id",
                        "l01": {"source_updated_at_col": "ts", "data_items": ["user_id", "ts", "event_type"]},
                        "l02": {"apply_as_deletes": "event_type = 'error'", "track_history_column_list": ["event_type"], "buckets": 8},
                        "l03": {"skey_column": "user_skey"},
                    }
                },
                "facts": {
                    "event": {
                        "primary_key_columns": "event_id",
                        "l01": {"source_updated_at_col": "ts", "data_items": ["event_id", "user_id", "ts", "value"]},
                        "l02": {"enabled": False},
                        "l03": {"enabled": False},
                    }
                },
            }
        },
        "gold": [
            {
                "object_name": "fact_event",
                "source_object": "raw_event",
                "source_schema": hops["l01"]["schema"],
                "read_mode": "stream",
                "append_only_source": True,
                "write_mode": "streaming_table",
                "lookups": [{"dimension": "dim_user", "on": "user_id", "skey": "user_skey", "event_time": "ts", "unknown": -1}],
                "columns": [{"source_col": c, "target_col": c} for c in ("user_skey", "event_id", "user_id", "ts", "value")],
            },
            {"object_name": "dim_user", "source_object": "processed_events", "columns": [{"source_col": c, "target_col": c} for c in columns]},
        ],
    }
    Medallion(spark, registry, scratch_dir(spark, "registry-stream")).run()
    return spark.table(f"spark_catalog.{hops['gold']['schema']}.fact_event")


_AS_OF_SQL = f"""
WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS})
SELECT coalesce(d.user_skey, -1) AS user_skey, e.event_id, e.user_id, e.ts, e.value
FROM events e LEFT JOIN dim d
  ON e.user_id = d.user_id AND e.ts >= d.__etl_effective_from AND e.ts < d.__etl_effective_to
"""

QUERIES = {
    "registry_fact_as_of": Query(registry_fact_as_of, _AS_OF_SQL),
    "registry_fact_stream": Query(registry_fact_stream, _AS_OF_SQL),
    "registry_dim_end_to_end": Query(
        registry_dim_end_to_end, f"WITH {EVENT_VERSIONS} {PROCESSED_VERSIONS}"
    ),
    "registry_dim_incremental": Query(
        registry_dim_incremental, f"WITH {EVENT_VERSIONS} {PROCESSED_VERSIONS}"
    ),
    "registry_fact_end_to_end": Query(
        registry_fact_end_to_end,
        f"""
SELECT {skey_sql('o_custkey')} AS orders_skey,
       CASE WHEN c_custkey IS NOT NULL THEN {skey_sql('c_custkey', "TIMESTAMP '2020-01-01 00:00:00'")} END AS customer_skey,
       o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS total
FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
) LEFT JOIN customer ON o_custkey = c_custkey
WHERE rn = 1 AND o_totalprice > 0
""",
    ),
}
