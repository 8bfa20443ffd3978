from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.cdc import ChangeSpec


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # Surrogate keys and text timestamps depend on the zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The change feed most queries share: events by user, ordered by time, where an error
# event deletes the user.
EVENT_FEED = ["user_id", "ts", "event_type"]


def event_changes(**more) -> ChangeSpec:
    base = {
        "keys": ["user_id"],
        "sequence_by": "ts",
        "apply_as_deletes": "event_type = 'error'",
        "except_column_list": ["ts"],
    }
    return ChangeSpec(**{**base, **more})


# The same in SQL: one row per version, deletes closing the version before them.
EVENT_VERSIONS = """
  marked AS (
    SELECT user_id, ts, event_type,
           row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w AS opens
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
  ),
  bounded AS (
    SELECT user_id, event_type, ts AS start_at,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
    FROM marked WHERE opens
  ),
  versions AS (SELECT * FROM bounded WHERE event_type <> 'error')
"""


def skey_sql(*parts: str) -> str:
    """SQL text of a surrogate key over these expressions."""
    texts = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('||', {texts})), 1, 15) AS BIGINT)"
