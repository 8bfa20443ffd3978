"""The processed hop and expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, PROCESSED_AT, START_AT
from ..functions.keys import surrogate_key
from ..operators.cdc import apply_changes
from ..operators.expectations import Expectation, enforce, expectations_of, violation_counts
from ..operators.gold import mapped
from ..operators.processed import ProcessedSpec, processed, read_rules
from ..operators.raw import RawSpec, raw
from ..session import scratch_dir
from ..streaming.history import AT, HistoryStore
from ..streaming.views import RowView
from .base import EVENT_FEED, EVENT_VERSIONS, Query, event_changes, skey_sql, table
from .history import with_late_changes


def event_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The type 2 dimension of users with its surrogate key, ready for lookups."""
    history = apply_changes(table(spark, sf, "events").select(*EVENT_FEED), event_changes())
    spec = ProcessedSpec(business_key_columns=["user_id"], skey_column="user_skey")
    return processed(history, spec).drop(PROCESSED_AT)


def event_views(spark: SparkSession, sf: str, gold: bool) -> RowView:
    """The processed versions of users, or a dimension of them, refreshed after each micro-batch by what changed."""
    feed, work = table(spark, sf, "events").select(*EVENT_FEED), scratch_dir(spark, "views")
    store = HistoryStore(spark, f"{work}/cdc", event_changes(), feed.schema, buckets=8, merge_after=3)
    spec = ProcessedSpec(business_key_columns=["user_id"], skey_column="user_skey")
    done = RowView(spark, f"{work}/processed", store, lambda df: processed(df, spec), repr(spec))
    shown = read_rules(
        [{"target_col": "status", "expression": "upper(event_type)"}]
        + [{"source_col": c, "target_col": c} for c in ("user_skey", "user_id", EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, AT)]
    )
    dim = RowView(spark, f"{work}/dim", done, lambda df: mapped(df, shown), repr(shown))
    for batch_id, changes in with_late_changes(feed):
        store.apply(changes, batch_id)
        done.refresh()
        if gold:
            dim.refresh()
    return dim if gold else done


def processed_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return event_views(spark, sf, gold=False).read().drop(PROCESSED_AT)


def customer_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The type 1 dimension of customers with its surrogate key."""
    spec = ProcessedSpec(business_key_columns=["c_custkey"], skey_column="customer_skey")
    return processed(table(spark, sf, "customer"), spec).drop(PROCESSED_AT)


def skey_scd1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        surrogate_key(["c_custkey"]).alias("customer_skey"),
        surrogate_key(["c_custkey", "c_name", "c_mktsegment"]).alias("composite_skey"),
    )


def skey_scd2(spark: SparkSession, sf: str) -> DataFrame:
    history = apply_changes(table(spark, sf, "events").select(*EVENT_FEED), event_changes(apply_as_deletes=None))
    return history.select("user_id", START_AT, surrogate_key(["user_id", START_AT]).alias("user_skey"))


def processed_scd1(spark: SparkSession, sf: str) -> DataFrame:
    landed = raw(table(spark, sf, "events"), RawSpec(source_updated_at_col="ts"))
    latest = apply_changes(landed, event_changes(scd_type=1, except_column_list=["ts", "props"]))
    spec = ProcessedSpec(business_key_columns=["user_id"], skey_column="user_skey")
    return processed(latest, spec).drop(PROCESSED_AT, "__etl_loaded_at")


def processed_user_columns(spark: SparkSession, sf: str) -> DataFrame:
    rules = read_rules(
        [
            {"source_col": "l_extendedprice", "target_col": "amount", "expression": "l_extendedprice * 1", "data_type": "DECIMAL(10,2)"},
            {"target_col": "is_high_value", "data_type": "BOOLEAN", "expression": "l_extendedprice > 50000"},
            {"source_col": "l_returnflag", "target_col": "flag"},
            {"source_col": "l_quantity", "target_col": "quantity", "data_type": "INT"},
            {"source_col": "l_linestatus", "target_col": "status_number", "data_type": "INT"},
            {"target_col": "ship_month", "expression": "substring(cast(l_shipdate as string), 1, 7)"},
            {"target_col": "nothing_to_build"},
        ]
    )
    return processed(table(spark, sf, "lineitem"), ProcessedSpec(columns=rules)).drop(PROCESSED_AT)


def processed_cleanse(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.concat(F.lit("  "), F.when(F.col("l_returnflag") != "N", F.lower("l_returnflag")).otherwise(""), F.lit(" ")).alias("flag"),
    )
    rules = read_rules(
        [
            {"source_col": "l_extendedprice", "target_col": "price", "expression": "CAST(l_extendedprice AS DECIMAL(10,2))"},
            {"source_col": "flag", "target_col": "flag", "data_type": "STRING", "expression": "NULLIF(TRIM(UPPER(flag)), '')"},
        ]
    )
    return processed(source, ProcessedSpec(columns=rules)).drop(PROCESSED_AT)


def processed_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "orders").withColumn("_rescued_data", F.lit("x"))
    rules = read_rules([{"source_col": "o_totalprice", "target_col": "total", "data_type": "DECIMAL(18,2)"}])
    return processed(source, ProcessedSpec(columns=rules)).drop(PROCESSED_AT)


def processed_leading(spark: SparkSession, sf: str) -> DataFrame:
    """Every row, each column named after its place too, so that the order counts."""
    spec = ProcessedSpec(
        business_key_columns=["o_orderkey"], skey_column="order_skey", leading_columns=["o_orderdate", "no_such", "order_skey"]
    )
    built = processed(table(spark, sf, "orders"), spec).drop(PROCESSED_AT)
    return built.toDF(*(f"c{i}_{c}" for i, c in enumerate(built.columns)))


_CHECKS = [
    Expectation("valid_price", "l_extendedprice > 1000 AND l_extendedprice < 90000"),
    Expectation("small_discount", "l_discount <= 0.08"),
    Expectation("known_flag", "nullif(l_returnflag, 'N') IN ('A', 'R')"),
]


def expect_warn_counts(spark: SparkSession, sf: str) -> DataFrame:
    return violation_counts(table(spark, sf, "lineitem"), _CHECKS)


def expect_drop(spark: SparkSession, sf: str) -> DataFrame:
    checks = [Expectation(rule.name, rule.expression, "DROP") for rule in _CHECKS]
    return enforce(table(spark, sf, "lineitem"), checks).select("l_orderkey", "l_linenumber", "l_extendedprice")


def expect_fail_clean(spark: SparkSession, sf: str) -> DataFrame:
    rules = read_rules(
        [
            {"source_col": "l_orderkey", "target_col": "l_orderkey", "is_nullable": False},
            {
                "source_col": "l_quantity",
                "target_col": "l_quantity",
                "constraint_name": "positive",
                "constraint_expression": "l_quantity > 0",
                "constraint_on_violation": "FAIL",
            },
        ]
    )
    return enforce(table(spark, sf, "lineitem"), expectations_of(rules)).select("l_orderkey", "l_linenumber", "l_quantity")


def processed_scd2(spark: SparkSession, sf: str) -> DataFrame:
    return event_versions(spark, sf)


PROCESSED_VERSIONS = f"""
SELECT {skey_sql('user_id', 'start_at')} AS user_skey, user_id, event_type,
       start_at AS __etl_effective_from,
       coalesce(end_at, TIMESTAMP '9999-12-31 23:59:59') AS __etl_effective_to,
       end_at IS NULL AS __etl_is_current
FROM versions
"""

QUERIES = {
    "skey_scd1": Query(
        skey_scd1,
        f"""
SELECT c_custkey, {skey_sql('c_custkey')} AS customer_skey,
       {skey_sql('c_custkey', 'c_name', 'c_mktsegment')} AS composite_skey
FROM customer
""",
    ),
    "skey_scd2": Query(
        skey_scd2,
        f"""
WITH marked AS (
  SELECT user_id, ts, row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
)
SELECT user_id, ts AS __START_AT, {skey_sql('user_id', 'ts')} AS user_skey FROM marked WHERE opens
""",
    ),
    "processed_scd1": Query(
        processed_scd1,
        f"""
SELECT {skey_sql('user_id')} AS user_skey, event_id, user_id, event_type, value, ts AS __source_updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
) WHERE rn = 1 AND event_type <> 'error'
""",
    ),
    "processed_scd2": Query(processed_scd2, f"WITH {EVENT_VERSIONS} {PROCESSED_VERSIONS}"),
    "processed_incremental": Query(processed_incremental, f"WITH {EVENT_VERSIONS} {PROCESSED_VERSIONS}"),
    "processed_user_columns": Query(
        processed_user_columns,
        """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount, l_tax, l_shipdate,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, l_extendedprice > 50000 AS is_high_value,
       l_returnflag AS flag, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       TRY_CAST(l_linestatus AS INTEGER) AS status_number, strftime(l_shipdate, '%Y-%m') AS ship_month
FROM lineitem
""",
    ),
    "processed_cleanse": Query(
        processed_cleanse,
        """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag
FROM lineitem
""",
    ),
    "processed_passthrough": Query(
        processed_passthrough,
        """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total
FROM orders
""",
    ),
    "processed_leading": Query(
        processed_leading,
        f"""
SELECT o_orderdate AS c0_o_orderdate, {skey_sql('o_orderkey')} AS c1_order_skey, o_orderkey AS c2_o_orderkey, o_custkey AS c3_o_custkey,
       o_orderstatus AS c4_o_orderstatus, o_totalprice AS c5_o_totalprice, o_orderpriority AS c6_o_orderpriority
FROM orders
""",
    ),
    "expect_warn_counts": Query(
        expect_warn_counts,
        """
WITH checked AS (
  SELECT coalesce(l_extendedprice > 1000 AND l_extendedprice < 90000, false) AS a,
         coalesce(l_discount <= 0.08, false) AS b,
         coalesce(nullif(l_returnflag, 'N') IN ('A', 'R'), false) AS c
  FROM lineitem
)
SELECT 'valid_price' AS constraint_name, count(*) FILTER (a) AS passed, count(*) FILTER (NOT a) AS failed FROM checked
UNION ALL SELECT 'small_discount', count(*) FILTER (b), count(*) FILTER (NOT b) FROM checked
UNION ALL SELECT 'known_flag', count(*) FILTER (c), count(*) FILTER (NOT c) FROM checked
""",
    ),
    "expect_drop": Query(
        expect_drop,
        """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice > 1000 AND l_extendedprice < 90000 AND l_discount <= 0.08 AND l_returnflag IN ('A', 'R')
""",
    ),
    "expect_fail_clean": Query(expect_fail_clean, "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"),
}
