"""Consolidation, key lookups, dimensions and facts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EFFECTIVE_FROM, EFFECTIVE_TO
from ..functions.keys import key_collisions, surrogate_key
from ..operators.gold import Lookup, cons, custom_sql, dimension, fact, mapped, with_skey, with_skey_as_of
from ..operators.processed import read_rules
from ..operators.skew import SkewPolicy
from ..operators.tables import append_table, create_current_view, replace_table
from ..session import scratch_dir, stored_once
from ..streaming.facts import land_facts, landed_facts, resolve_late
from ..streaming.ingest import land_stream
from .base import EVENT_VERSIONS, Query, skey_sql, table
from .processed import PROCESSED_VERSIONS, customer_keys, event_versions, event_views


def gold_cons_join(spark: SparkSession, sf: str) -> DataFrame:
    views = {f"src_{name}": table(spark, sf, name) for name in ("orders", "customer", "nation")}
    return custom_sql(
        spark,
        """
        SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name
        FROM src_orders o
        LEFT JOIN src_customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment <> 'BUILDING'
        LEFT JOIN src_nation n ON c.c_nationkey = n.n_nationkey
        """,
        views,
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "ts")


def gold_fact_skey_scd1(spark: SparkSession, sf: str) -> DataFrame:
    lookup = Lookup(customer_keys(spark, sf), {"o_custkey": "c_custkey"}, "customer_skey")
    return with_skey(_orders(spark, sf), lookup)


def gold_fact_current(spark: SparkSession, sf: str) -> DataFrame:
    lookup = Lookup(event_versions(spark, sf), {"user_id": "user_id"}, "user_skey", into="current_skey", unknown=-1)
    return with_skey(_facts(spark, sf), lookup)


def _users(spark: SparkSession, sf: str) -> DataFrame:
    """The type 2 dimension as a stored table, as lookups find it."""
    return stored_once(event_versions(spark, sf), scratch_dir(spark, "processed_user"))


def _as_of(spark: SparkSession, sf: str) -> Lookup:
    return Lookup(_users(spark, sf), {"user_id": "user_id"}, "user_skey", event_time="ts")


def gold_pit_skey(spark: SparkSession, sf: str) -> DataFrame:
    return with_skey_as_of(_facts(spark, sf), _as_of(spark, sf))


def gold_pit_skey_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The way for dimensions too large to broadcast."""
    return with_skey_as_of(_facts(spark, sf), _as_of(spark, sf), broadcast_rows=0)


def _streamed(spark: SparkSession, sf: str, **how) -> DataFrame:
    """The facts arrive in three files, each a micro-batch; the dimension is read anew for each."""
    facts, work, dim = _facts(spark, sf), scratch_dir(spark, "stream-facts"), scratch_dir(spark, "processed_user")
    event_versions(spark, sf).write.parquet(dim)
    for part in range(3):
        facts.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{work}/raw")
    stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/raw")
    land_facts(
        stream,
        lambda spark: [Lookup(spark.read.parquet(dim), {"user_id": "user_id"}, "user_skey", event_time="ts")],
        f"{work}/checkpoint",
        f"{work}/facts",
        **how,
    )
    return landed_facts(spark, f"{work}/facts")


def gold_pit_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf)


def gold_pit_stream_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The same where nothing may be broadcast."""
    return _streamed(spark, sf, broadcast_rows=0)


def gold_late_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the users arrive after their facts, which have the unknown key until then."""
    facts, work = _facts(spark, sf), scratch_dir(spark, "late-dimension")
    users = event_versions(spark, sf)
    users.where("user_id % 3 <> 0").write.parquet(f"{work}/dim")
    for part in range(3):
        facts.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{work}/raw")
    stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/raw")

    def lookups(spark: SparkSession) -> list[Lookup]:
        return [Lookup(spark.read.parquet(f"{work}/dim"), {"user_id": "user_id"}, "user_skey", event_time="ts", unknown=-1)]

    land_facts(stream, lookups, f"{work}/checkpoint", f"{work}/facts", late=True)
    users.where("user_id % 3 = 0").write.mode("append").parquet(f"{work}/dim")
    resolve_late(spark, lookups, f"{work}/facts")
    return landed_facts(spark, f"{work}/facts")


def _overlapping(spark: SparkSession, sf: str) -> Lookup:
    """A dimension whose versions overlap and start together: one per event, from its day on for some hours."""
    start = F.date_trunc("day", "ts")
    versions = table(spark, sf, "events").select(
        "user_id",
        F.col("event_id").alias("user_skey"),
        start.alias(EFFECTIVE_FROM),
        (start + F.make_interval(hours=1 + F.col("event_id") % 97)).alias(EFFECTIVE_TO),
    )
    return Lookup(stored_once(versions, scratch_dir(spark, "overlapping")), {"user_id": "user_id"}, "user_skey", event_time="ts")


def gold_pit_overlapping(spark: SparkSession, sf: str) -> DataFrame:
    return with_skey_as_of(_facts(spark, sf), _overlapping(spark, sf))


def gold_pit_overlapping_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return with_skey_as_of(_facts(spark, sf), _overlapping(spark, sf), broadcast_rows=0)


def gold_pit_skey_long_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a limit so low that almost every key is cut into slices."""
    skew = SkewPolicy(min_rows=20, target_slices=1_000_000)
    return with_skey_as_of(_facts(spark, sf), _as_of(spark, sf), skew, broadcast_rows=0)


def gold_current_view(spark: SparkSession, sf: str) -> DataFrame:
    name = f"spark_catalog.gold_{uuid.uuid4().hex[:8]}.dim_user"
    replace_table(dimension(event_versions(spark, sf)), name, scratch_dir(spark, "dim_user"))
    return spark.table(create_current_view(spark, name))


def gold_dim(spark: SparkSession, sf: str) -> DataFrame:
    rules = read_rules(
        [
            {"source_col": "user_skey", "target_col": "user_skey"},
            {"source_col": "user_id", "target_col": "user_id"},
            {"target_col": "status", "expression": "upper(event_type)"},
            {"source_col": "__etl_effective_from", "target_col": "__etl_effective_from"},
            {"source_col": "__etl_effective_to", "target_col": "__etl_effective_to"},
            {"source_col": "__etl_is_current", "target_col": "__etl_is_current"},
        ]
    )
    return mapped(dimension(cons(event_versions(spark, sf))), rules)


def gold_dim_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension over a processed table, both refreshed after each micro-batch by what changed."""
    return event_views(spark, sf, gold=True).read()


def gold_fact(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "events").select("event_id", "user_id", "ts", "value").withColumn("buyer", F.col("user_id") % 100 + 1)
    lookups = [
        Lookup(_users(spark, sf), {"user_id": "user_id"}, "user_skey", event_time="ts", unknown=-1),
        Lookup(customer_keys(spark, sf), {"buyer": "c_custkey"}, "customer_skey"),
    ]
    return fact(facts, lookups).drop("buyer")


def _periods(rows: DataFrame, key: str, at: str, unit: str, name: str) -> DataFrame:
    """A type 2 dimension: a version of each key for every period it is seen in, until the next one."""
    start = F.date_trunc(unit, at)
    # The periods of a key are few: gathered per task, then in one shuffle.
    seen = rows.groupBy(key).agg(F.sort_array(F.collect_set(start)).alias("__starts"))
    never = F.lit("9999-12-31").cast("timestamp_ntz").cast(seen.schema["__starts"].dataType.elementType)
    spans = F.transform(
        "__starts",
        lambda s, i: F.struct(s.alias(EFFECTIVE_FROM), F.coalesce(F.get("__starts", i + 1), never).alias(EFFECTIVE_TO)),
    )
    return seen.select(key, F.inline(spans)).select(
        key, EFFECTIVE_FROM, EFFECTIVE_TO, surrogate_key([key, EFFECTIVE_FROM]).alias(name)
    )


def _three_dims(spark: SparkSession, sf: str) -> tuple[DataFrame, list[Lookup]]:
    orders = _orders(spark, sf)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    parts = _periods(lines, "l_partkey", "l_shipdate", "month", "part_skey")
    suppliers = _periods(lines, "l_suppkey", "l_shipdate", "week", "supplier_skey")
    buyers = _periods(orders, "o_custkey", "o_orderdate", "year", "customer_skey")
    dims = {name: stored_once(dim, scratch_dir(spark, name), "zstd") for name, dim in (("parts", parts), ("suppliers", suppliers), ("buyers", buyers))}
    facts = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")
    # Orders are often older than the first version of what they buy: those facts have the unknown key.
    return facts, [
        Lookup(dims["parts"], {"l_partkey": "l_partkey"}, "part_skey", event_time="o_orderdate", unknown=-1),
        Lookup(dims["suppliers"], {"l_suppkey": "l_suppkey"}, "supplier_skey", event_time="l_shipdate"),
        Lookup(dims["buyers"], {"o_custkey": "o_custkey"}, "customer_skey", event_time="l_shipdate", unknown=-1),
    ]


def gold_fact_three_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Three dimensions by version, none of which may be broadcast: one shuffle of the facts."""
    facts, lookups = _three_dims(spark, sf)
    return fact(facts, lookups, broadcast_rows=0)


def gold_fact_three_dims_measured(spark: SparkSession, sf: str) -> DataFrame:
    """The same with each dimension's way chosen by its measured size."""
    return fact(*_three_dims(spark, sf))


def skey_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of customers and parts, and of nations made to collide: once as the first and once as the second part."""
    nothing = F.lit(None).cast("string")
    nations = table(spark, sf, "nation")
    keys = (
        table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"))
        .unionByName(table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("a"), F.col("p_name").alias("b")))
        .unionByName(nations.select(F.col("n_name").alias("a"), nothing.alias("b")))
        .unionByName(nations.where("n_nationkey % 2 = 0").select(nothing.alias("a"), F.col("n_name").alias("b")))
    )
    return key_collisions(keys.withColumn("k", surrogate_key(["a", "b"])), ["a", "b"], "k")


def gold_custom_sql(spark: SparkSession, sf: str) -> DataFrame:
    return custom_sql(
        spark,
        """
        SELECT c.c_mktsegment, year(o.o_orderdate) AS order_year, count(*) AS orders,
               cast(sum(cast(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
        FROM src_orders o JOIN src_customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_mktsegment, year(o.o_orderdate)
        """,
        {"src_orders": table(spark, sf, "orders"), "src_customer": table(spark, sf, "customer")},
    )


def gold_window_rule(spark: SparkSession, sf: str) -> DataFrame:
    return custom_sql(
        spark,
        """
        SELECT o_custkey, o_orderkey, rank, gap FROM (
          SELECT o_custkey, o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank,
                 datediff(o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS gap
          FROM src_orders
        ) WHERE rank <= 3
        """,
        {"src_orders": table(spark, sf, "orders")},
    )


def gold_cond_agg(spark: SparkSession, sf: str) -> DataFrame:
    return custom_sql(
        spark,
        """
        SELECT l_suppkey, count(*) AS lines, count_if(l_returnflag = 'R') AS returned,
               cast(sum(CASE WHEN l_discount > 0.05 THEN cast(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(38,2)) AS discounted,
               sum(cast(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus = 'O') AS open_quantity
        FROM src_lineitem GROUP BY l_suppkey
        """,
        {"src_lineitem": table(spark, sf, "lineitem")},
    )


def gold_union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return custom_sql(
        spark,
        """
        SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey FROM src_customer
        UNION ALL
        SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM src_supplier
        """,
        {"src_customer": table(spark, sf, "customer"), "src_supplier": table(spark, sf, "supplier")},
    )


def gold_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = read_rules(
        [
            {"source_col": "o_orderkey", "target_col": "order_key"},
            {"source_col": "o_totalprice", "target_col": "total", "data_type": "DECIMAL(18,2)"},
        ]
    )
    return mapped(table(spark, sf, "orders"), rules, "o_orderstatus = 'F' AND o_totalprice > 1000")


def stream_static_join(spark: SparkSession, sf: str) -> DataFrame:
    """A gold statement that reads one table as a stream and one as it is."""
    work = scratch_dir(spark, "stream-join")
    schema = f"spark_catalog.stream_{uuid.uuid4().hex[:8]}"
    append_table(table(spark, sf, "events").select("event_id", "user_id", "value"), f"{schema}.raw_events", f"{work}/raw")
    joined = custom_sql(
        spark,
        f"""
        SELECT e.event_id, e.value, c.c_name, c.c_mktsegment
        FROM STREAM({schema}.raw_events) e LEFT JOIN src_customer c ON e.user_id = c.c_custkey AND c.c_acctbal > 0
        """,
        {"src_customer": table(spark, sf, "customer")},
    )
    assert joined.isStreaming
    land_stream(joined, f"{work}/checkpoint", f"{work}/joined")
    return spark.read.parquet(f"{work}/joined")


_PIT_SQL = f"""
WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS})
SELECT e.event_id, e.user_id, e.ts, d.user_skey
FROM events e LEFT JOIN dim d
  ON e.user_id = d.user_id AND e.ts >= d.__etl_effective_from AND e.ts < d.__etl_effective_to
"""

_OVERLAPPING_SQL = """
WITH dim AS (
  SELECT user_id, event_id AS user_skey, date_trunc('day', ts) AS starts,
         date_trunc('day', ts) + to_hours(CAST(1 + event_id % 97 AS INTEGER)) AS ends
  FROM events
),
best AS (SELECT *, row_number() OVER (PARTITION BY user_id, starts ORDER BY ends DESC, user_skey DESC) AS place FROM dim),
cut AS (SELECT *, lead(starts) OVER (PARTITION BY user_id ORDER BY starts) AS until FROM best WHERE place = 1)
SELECT e.event_id, e.user_id, e.ts, c.user_skey
FROM events e LEFT JOIN cut c
  ON e.user_id = c.user_id AND e.ts >= c.starts AND e.ts < c.ends AND (c.until IS NULL OR e.ts < c.until)
"""

_THREE_DIMS_SQL = f"""
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, o_custkey, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
part_starts AS (SELECT DISTINCT l_partkey AS k, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS starts FROM lineitem),
parts AS (SELECT *, lead(starts) OVER (PARTITION BY k ORDER BY starts) AS ends FROM part_starts),
supplier_starts AS (SELECT DISTINCT l_suppkey AS k, CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS starts FROM lineitem),
suppliers AS (SELECT *, lead(starts) OVER (PARTITION BY k ORDER BY starts) AS ends FROM supplier_starts),
buyer_starts AS (SELECT DISTINCT o_custkey AS k, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS starts FROM orders),
buyers AS (SELECT *, lead(starts) OVER (PARTITION BY k ORDER BY starts) AS ends FROM buyer_starts)
SELECT CASE WHEN p.k IS NULL THEN -1 ELSE {skey_sql('p.k', 'p.starts')} END AS part_skey,
       CASE WHEN s.k IS NOT NULL THEN {skey_sql('s.k', 's.starts')} END AS supplier_skey,
       CASE WHEN b.k IS NULL THEN -1 ELSE {skey_sql('b.k', 'b.starts')} END AS customer_skey,
       lines.*
FROM lines
LEFT JOIN parts p ON l_partkey = p.k AND o_orderdate >= p.starts AND (p.ends IS NULL OR o_orderdate < p.ends)
LEFT JOIN suppliers s ON l_suppkey = s.k AND l_shipdate >= s.starts AND (s.ends IS NULL OR l_shipdate < s.ends)
LEFT JOIN buyers b ON o_custkey = b.k AND l_shipdate >= b.starts AND (b.ends IS NULL OR l_shipdate < b.ends)
"""

_DIM_SQL = f"""
WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS})
SELECT user_skey, user_id, upper(event_type) AS status, __etl_effective_from, __etl_effective_to, __etl_is_current FROM dim
"""

QUERIES = {
    "gold_cons_join": Query(
        gold_cons_join,
        """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment <> 'BUILDING'
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    ),
    "gold_fact_skey_scd1": Query(
        gold_fact_skey_scd1,
        f"""
SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN c_custkey IS NOT NULL THEN {skey_sql('c_custkey')} END AS customer_skey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""",
    ),
    "gold_fact_current": Query(
        gold_fact_current,
        f"""
WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS})
SELECT e.event_id, e.user_id, e.ts, coalesce(d.user_skey, -1) AS current_skey
FROM events e LEFT JOIN dim d ON e.user_id = d.user_id AND d.__etl_is_current
""",
    ),
    "gold_pit_skey": Query(gold_pit_skey, _PIT_SQL),
    "gold_pit_skey_ordered": Query(gold_pit_skey_ordered, _PIT_SQL),
    "gold_pit_skey_long_keys": Query(gold_pit_skey_long_keys, _PIT_SQL),
    "gold_pit_stream": Query(gold_pit_stream, _PIT_SQL),
    "gold_pit_stream_ordered": Query(gold_pit_stream_ordered, _PIT_SQL),
    "gold_late_dimension": Query(gold_late_dimension, _PIT_SQL.replace("d.user_skey\n", "coalesce(d.user_skey, -1) AS user_skey\n")),
    "gold_pit_overlapping": Query(gold_pit_overlapping, _OVERLAPPING_SQL),
    "gold_pit_overlapping_ordered": Query(gold_pit_overlapping_ordered, _OVERLAPPING_SQL),
    "gold_current_view": Query(
        gold_current_view, f"WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS}) SELECT * FROM dim WHERE __etl_is_current"
    ),
    "gold_dim": Query(gold_dim, _DIM_SQL),
    "gold_dim_incremental": Query(gold_dim_incremental, _DIM_SQL),
    "gold_fact": Query(
        gold_fact,
        f"""
WITH {EVENT_VERSIONS}, dim AS ({PROCESSED_VERSIONS})
SELECT coalesce(d.user_skey, -1) AS user_skey,
       CASE WHEN c.c_custkey IS NOT NULL THEN {skey_sql('c.c_custkey')} END AS customer_skey,
       e.event_id, e.user_id, e.ts, e.value
FROM events e
LEFT JOIN dim d ON e.user_id = d.user_id AND e.ts >= d.__etl_effective_from AND e.ts < d.__etl_effective_to
LEFT JOIN customer c ON e.user_id % 100 + 1 = c.c_custkey
""",
    ),
    "gold_fact_three_dims": Query(gold_fact_three_dims, _THREE_DIMS_SQL),
    "gold_fact_three_dims_measured": Query(gold_fact_three_dims_measured, _THREE_DIMS_SQL),
    "skey_collisions": Query(
        skey_collisions,
        f"""
WITH keys AS (
  SELECT CAST(c_custkey AS VARCHAR) AS a, c_name AS b FROM customer
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name FROM part
  UNION ALL SELECT n_name, NULL FROM nation
  UNION ALL SELECT NULL, n_name FROM nation WHERE n_nationkey % 2 = 0
),
whole AS (
  SELECT {skey_sql('a', 'b')} AS skey,
         coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(b) || ':' || b, '-') AS whole FROM keys
)
SELECT skey, min(whole) AS least_key, max(whole) AS greatest_key FROM whole GROUP BY skey HAVING count(DISTINCT whole) > 1
""",
    ),
    "gold_custom_sql": Query(
        gold_custom_sql,
        """
SELECT c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER) AS order_year, count(*) AS orders,
       sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2
""",
    ),
    "gold_window_rule": Query(
        gold_window_rule,
        """
SELECT o_custkey, o_orderkey, CAST(rank AS INTEGER) AS rank, CAST(gap AS INTEGER) AS gap FROM (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank,
         date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap
  FROM orders
) WHERE rank <= 3
""",
    ),
    "gold_cond_agg": Query(
        gold_cond_agg,
        """
SELECT l_suppkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned,
       sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS discounted,
       CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_linestatus = 'O') AS BIGINT) AS open_quantity
FROM lineitem GROUP BY l_suppkey
""",
    ),
    "gold_union_sources": Query(
        gold_union_sources,
        """
SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier
""",
    ),
    "gold_filter": Query(
        gold_filter,
        """
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS total
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000
""",
    ),
    "stream_static_join": Query(
        stream_static_join,
        """
SELECT e.event_id, e.value, c.c_name, c.c_mktsegment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_acctbal > 0
""",
    ),
}
