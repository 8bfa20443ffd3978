"""Sources, raw tables, timestamps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOADED_AT, SOURCE_UPDATED_AT
from ..functions.timestamps import parse_timestamp
from ..operators.raw import RawSpec, raw
from ..operators.tables import append_table, load_once, stage_load
from ..session import scratch_dir
from ..sources import read_source
from ..streaming.files import land_files
from ..streaming.ingest import land_stream
from .base import Query, table

# Case number -> how Spark prints the moment `t` (see _MOMENT) for that case.
_PRINTED = [
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss.SSS'+02'\")",
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")",
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "date_format(t, 'yyyy-MM-dd HH:mm:ss.SSS')",
    "date_format(t, 'yyyy-MM-dd HH:mm:ss')",
    "date_format(t, 'yyyy-MM-dd')",
    "date_format(t, 'MM/dd/yyyy HH:mm:ss')",
    "date_format(t, 'MM/dd/yyyy')",
    "date_format(t, 'dd/MM/yyyy HH:mm:ss')",
    "date_format(t, 'dd/MM/yyyy')",
    "date_format(t, 'dd-MM-yyyy HH:mm:ss')",
    "date_format(t, 'dd-MM-yyyy')",
    "date_format(t, 'yyyyMMdd HHmmss')",
    "date_format(t, 'yyyyMMdd')",
    "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'\")",
    "date_format(t, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "date_format(t, 'yyyy')",
    "date_format(t, 'HH:mm:ss')",
    "concat('no date ', o_orderkey)",
    "concat(year(t), '-02-30')",
    "cast(unix_seconds(cast(t as timestamp)) as string)",
    "''",
]
_MOMENT = "o_orderdate + make_dt_interval(0, 0, o_orderkey % 1440, o_orderkey % 60 + (o_orderkey % 1000) * 0.001001)"

_TS_PARSE_SQL = f"""
WITH moments AS (
  SELECT o_orderkey, o_orderkey % {len(_PRINTED)} AS c,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) + to_seconds(CAST(o_orderkey % 60 AS INTEGER))
           + to_microseconds((o_orderkey % 1000) * 1001) AS t
  FROM orders
), cut AS (
  SELECT *, date_trunc('day', t) AS d, date_trunc('second', t) AS s, date_trunc('millisecond', t) AS ms,
         CASE WHEN day(t) <= 12
              THEN make_timestamp(CAST(year(t) AS BIGINT), CAST(day(t) AS BIGINT), CAST(month(t) AS BIGINT), 0, 0, 0.0)
              ELSE date_trunc('day', t) END AS us
  FROM moments
)
SELECT o_orderkey,
       CASE WHEN c IN (0, 17) THEN t
            WHEN c IN (1, 16) THEN ms - INTERVAL 2 HOUR
            WHEN c IN (2, 4, 6, 8, 12, 14) THEN s
            WHEN c IN (3, 5) THEN ms
            WHEN c IN (7, 9, 13, 15) THEN d
            WHEN c = 10 THEN us + (s - d)
            WHEN c = 11 THEN us
            WHEN c = 18 THEN date_trunc('year', t) END AS parsed
FROM cut
"""


def ts_parse_multi(spark: SparkSession, sf: str) -> DataFrame:
    branches = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(_PRINTED))
    moments = table(spark, sf, "orders").select("o_orderkey", F.expr(_MOMENT).alias("t"))
    texts = moments.withColumn("text", F.expr(f"CASE o_orderkey % {len(_PRINTED)} {branches} END"))
    return texts.select("o_orderkey", parse_timestamp(F.col("text")).cast("timestamp_ntz").alias("parsed"))


def raw_source_ts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    kinds = {
        "timestamp": F.col("o_orderdate"),
        "date": F.col("o_orderdate").cast("date"),
        "text": F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss"),
        "epoch": F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
    }
    parts = []
    for kind, column in kinds.items():
        landed = raw(orders.withColumn("changed", column), RawSpec(source_updated_at_col="changed"))
        parts.append(
            landed.select(
                F.lit(kind).alias("kind"), "o_orderkey", F.col(SOURCE_UPDATED_AT).cast("timestamp_ntz").alias("updated_at")
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def raw_append_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in three loads: one run once, one run twice, one that stops before it is entered and runs again."""
    work = scratch_dir(spark, "loads")
    name = f"loads_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", (F.col("o_orderkey") % 3).cast("int").alias("load"))
    for load in (0, 1, 1):
        load_once(orders.where(F.col("load") == load), name, f"{work}/orders", f"load-{load}")
    stage_load(orders.where("load = 2"), name, f"{work}/orders", "load-2")
    before = spark.table(name).where("load = 2").count()
    load_once(orders.where("load = 2"), name, f"{work}/orders", "load-2")
    return spark.table(name).withColumn("too_early", F.lit(before))


def raw_projection(spark: SparkSession, sf: str) -> DataFrame:
    spec = RawSpec(
        data_items=["l_orderkey", "l_linenumber", "upper(l_returnflag) AS flag", "l_quantity * 2 AS doubled", "l_shipdate"],
        source_updated_at_col="l_shipdate",
    )
    return raw(table(spark, sf, "lineitem"), spec).drop(LOADED_AT)


def raw_filter(spark: SparkSession, sf: str) -> DataFrame:
    spec = RawSpec(filter="l_quantity > 25 AND l_returnflag = 'R'", source_updated_at_col="l_shipdate")
    return raw(table(spark, sf, "lineitem"), spec).select("l_orderkey", "l_linenumber", "l_quantity", SOURCE_UPDATED_AT)


_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _part_files(spark: SparkSession, sf: str) -> dict:
    """The part table as delimited text, with a marker for small parts' missing brand."""
    path = scratch_dir(spark, "part-csv")
    part = table(spark, sf, "part").select(*_PART).withColumn("p_brand", F.expr("nullif(p_brand, 'Brand#13')"))
    part.write.option("header", True).option("delimiter", "|").option("nullValue", "^^").csv(path)
    return {
        "cloud_storage_type": "csv",
        "cloud_storage_path": path,
        "header": True,
        "delimiter": "|",
        "null_value": "^^",
    }


def _typed_part(df: DataFrame) -> DataFrame:
    kinds = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}
    return df.select(*(F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in _PART))


def raw_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _typed_part(raw(read_source(spark, "cloud_storage", _part_files(spark, sf))))


def raw_stream(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "part-stream")
    connection = {**_part_files(spark, sf), "cloud_schema_location": f"{work}/schema"}
    land_stream(raw(read_source(spark, "cloud_storage", connection, True)), f"{work}/checkpoint", f"{work}/raw")
    return _typed_part(spark.read.parquet(f"{work}/raw"))


def raw_json_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Json lines by stream in two runs. The second brings a field in its newest file and one in an older
    file; both land."""
    work = scratch_dir(spark, "part-json")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.lit("x").alias("odd"))
    connection = {"cloud_storage_type": "json", "cloud_storage_path": f"{work}/in", "cloud_schema_location": f"{work}/schema"}

    def land() -> None:
        land_stream(raw(read_source(spark, "cloud_storage", connection, True)), f"{work}/checkpoint", f"{work}/raw")

    def write(n: int, *columns: str) -> None:
        part.where(F.col("p_partkey") % 3 == n).select(*columns).coalesce(1).write.mode("append").json(f"{work}/in")

    write(0, "p_partkey", "p_name")
    land()
    write(1, "p_partkey", "p_name", "odd")
    write(2, "p_partkey", "p_name", "p_size")
    land()
    landed = spark.read.option("mergeSchema", "true").parquet(f"{work}/raw")
    return landed.select("p_partkey", "p_name", "p_size", "odd")


def raw_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot source that gains a column and loses another: the table has both."""
    name = f"spark_catalog.raw_{uuid.uuid4().hex[:8]}.part"
    location = scratch_dir(spark, "part-grown")
    part = table(spark, sf, "part")
    append_table(part.where("p_partkey % 2 = 0").select("p_partkey", "p_brand"), name, location)
    append_table(part.where("p_partkey % 2 = 1").select("p_size", "p_partkey"), name, location)
    return spark.table(name)


def raw_rescued(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "part-bad")
    line = F.expr(
        "CASE p_partkey % 10 WHEN 0 THEN concat('x', p_partkey, ',', p_name, ',', p_size)"
        " WHEN 1 THEN concat(p_partkey, ',', p_name)"
        " WHEN 2 THEN concat(p_partkey, ',', p_name, ',', p_size, ',more')"
        " ELSE concat(p_partkey, ',', p_name, ',', p_size) END"
    )
    table(spark, sf, "part").select(line).write.text(path)
    connection = {
        "cloud_storage_type": "csv",
        "cloud_storage_path": path,
        "schema": "p_partkey bigint, p_name string, p_size int, _rescued_data string",
    }
    landed = raw(read_source(spark, "cloud_storage", connection))
    return landed.select("p_partkey", "p_name", "p_size", F.col("_rescued_data").alias("rescued"))


def raw_parquet_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Parts in three kinds of parquet files that all land in one stream: the second has a column more, the third has
    sizes as text, some of which are no numbers. Two of the kinds come when the stream has run before."""
    work, name = scratch_dir(spark, "part-files"), f"parts_{uuid.uuid4().hex}"
    part = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("int").alias("p_size"), "p_brand")
    kinds = [
        part.drop("p_brand"),
        part,
        part.drop("p_brand").withColumn("p_size", F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat('about ', p_size) ELSE cast(p_size AS string) END")),
    ]
    connection = {"cloud_storage_type": "parquet", "cloud_storage_path": f"{work}/in"}
    for i, files in enumerate(kinds):
        files.where(F.col("p_partkey") % 3 == i).write.mode("append").parquet(f"{work}/in")
        if i != 1:
            land_files(spark, connection, lambda df: raw(df, RawSpec()), f"{work}/checkpoint", f"{work}/raw", name)
    return spark.table(name).select("p_partkey", "p_name", "p_size", "p_brand", F.col("_rescued_data").alias("rescued"))


_PART_SQL = """
SELECT p_partkey, p_name, nullif(p_brand, 'Brand#13') AS p_brand, p_type, p_size, p_retailprice FROM part
"""

QUERIES = {
    "ts_parse_multi": Query(ts_parse_multi, _TS_PARSE_SQL),
    "raw_source_ts": Query(
        raw_source_ts,
        """
SELECT kind, o_orderkey, CASE WHEN kind = 'date' THEN date_trunc('day', o_orderdate)
                              WHEN kind IN ('text', 'epoch') THEN date_trunc('second', o_orderdate)
                              ELSE o_orderdate END AS updated_at
FROM orders, (VALUES ('timestamp'), ('date'), ('text'), ('epoch')) kinds(kind)
""",
    ),
    "raw_append_loads": Query(
        raw_append_loads,
        "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderkey % 3 AS INTEGER) AS load, CAST(0 AS INTEGER) AS too_early FROM orders",
    ),
    "raw_projection": Query(
        raw_projection,
        """
SELECT l_orderkey, l_linenumber, upper(l_returnflag) AS flag, l_quantity * 2 AS doubled, l_shipdate,
       l_shipdate AS __source_updated_at
FROM lineitem
""",
    ),
    "raw_filter": Query(
        raw_filter,
        """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate AS __source_updated_at
FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'
""",
    ),
    "raw_snapshot": Query(raw_snapshot, _PART_SQL),
    "raw_stream": Query(raw_stream, _PART_SQL),
    "raw_json_stream": Query(
        raw_json_stream,
        """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 2 THEN CAST(p_size AS BIGINT) END AS p_size,
       CASE WHEN p_partkey % 3 = 1 THEN 'x' END AS odd
FROM part
""",
    ),
    "raw_new_column": Query(
        raw_new_column,
        """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 2 = 1 THEN p_size END AS p_size
FROM part
""",
    ),
    "raw_parquet_rescued": Query(
        raw_parquet_rescued,
        """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 <> 2 OR p_partkey % 2 = 1 THEN CAST(p_size AS INTEGER) END AS p_size,
       CASE WHEN p_partkey % 3 = 1 THEN p_brand END AS p_brand,
       CASE WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN '{"p_size":"about ' || p_size || '"}' END AS rescued
FROM part
""",
    ),
    "raw_rescued": Query(
        raw_rescued,
        """
SELECT CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey END AS p_partkey, p_name,
       CASE WHEN p_partkey % 10 = 1 THEN NULL ELSE p_size END AS p_size,
       CASE p_partkey % 10 WHEN 0 THEN 'x' || p_partkey || ',' || p_name || ',' || p_size
                           WHEN 1 THEN p_partkey || ',' || p_name
                           WHEN 2 THEN p_partkey || ',' || p_name || ',' || p_size || ',more' END AS rescued
FROM part
""",
    ),
}
