"""Source types by name. A reader is `(spark, connection, streaming) -> DataFrame`."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import RESCUED
from ..functions.schemas import merged

Reader = Callable[[SparkSession, Mapping[str, Any], bool], DataFrame]

_READERS: dict[str, Reader] = {}


def register_source(name: str, reader: Reader) -> None:
    """Adds or replaces a source type."""
    _READERS[name] = reader


def source_types() -> list[str]:
    return sorted(_READERS)


def read_source(
    spark: SparkSession, source_type: str, connection: Mapping[str, Any], streaming: bool = False
) -> DataFrame:
    if source_type not in _READERS:
        raise ValueError(f"unknown source_type {source_type!r}; known: {', '.join(source_types())}")
    return _READERS[source_type](spark, connection, streaming)


def _needs(connection: Mapping[str, Any], source_type: str, *fields: str) -> None:
    missing = [f for f in fields if connection.get(f) in (None, "")]
    if missing:
        raise ValueError(f"{source_type} connection lacks {', '.join(missing)}")


def _load(reader: Any, kind: str, path: str | list[str] | None = None) -> DataFrame:
    try:
        return reader.load(path) if path else reader.load()
    except AnalysisException as error:
        if error.getCondition() == "DATA_SOURCE_NOT_FOUND" or "Failed to find data source" in str(error):
            raise ValueError(f"Spark has no {kind} connector on its classpath; add its package") from error
        raise


# Connection field -> reader option, for text formats.
_TEXT_OPTIONS = {"header": "header", "delimiter": "delimiter", "null_value": "nullValue"}


def _text_options(connection: Mapping[str, Any]) -> dict[str, str]:
    options = {}
    for field, option in _TEXT_OPTIONS.items():
        value = connection.get(field)
        if field == "header" and value is not None:
            options[option] = "true" if str(value).lower() == "true" else "false"
        elif value:
            options[option] = str(value)
    return options


def remembered_schema(spark: SparkSession, location: str) -> T.StructType | None:
    try:
        rows = spark.read.text(location, wholetext=True).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    return T.StructType.fromJson(json.loads(rows[0][0])) if rows else None


#: Below the remembered schema: the files that it was inferred from. Readers skip the name.
_SEEN = "_files"
_CORRUPT = "_corrupt_record"


def _new_files(spark: SparkSession, path: str, location: str | None) -> tuple[DataFrame, list[str]]:
    """All files there are now, and the paths of those that no schema was inferred from, the newest first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime")
    files = spark.createDataFrame(files.collect(), files.schema)  # one listing: what comes later is new next time
    new = files
    try:
        if location:
            new = files.join(spark.read.schema("path string").parquet(f"{location}/{_SEEN}"), "path", "left_anti")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
    return files, [r["path"] for r in new.orderBy(F.desc("modificationTime"), F.desc("path")).collect()]


def _found_schema(batch: Any, kind: str, paths: list[str]) -> T.StructType:
    """The fields of all the files; of csv, whose fields go by place, those of the first one."""
    if kind == "json":
        found = _load(batch, kind, paths).schema
    elif kind in ("parquet", "orc"):
        try:
            found = _load(batch.option("mergeSchema", "true"), kind, paths).schema
        except Exception as error:
            if "CANNOT_MERGE" not in str(error) and "Failed to merge" not in str(error):
                raise
            found = _one_by_one(batch.option("mergeSchema", "false"), kind, paths)
    elif kind == "avro":
        found = _one_by_one(batch, kind, paths)
    else:
        found = _load(batch, kind, paths[0]).schema
    return T.StructType([f for f in found.fields if kind != "json" or f.name not in (RESCUED, _CORRUPT)])


def _one_by_one(batch: Any, kind: str, paths: list[str]) -> T.StructType:
    found = T.StructType([])
    for path in paths:
        found = merged(found, _load(batch, kind, path).schema)
    return found


def _stream_schema(spark: SparkSession, connection: Mapping[str, Any], batch: Any, path: str) -> T.StructType:
    """The schema of a file stream: inferred once and remembered, and grown at a restart by the fields, at
    any depth, of all files that came since; of csv by those of the newest one. A csv header with other
    fields stops the load; a json line or csv row with other fields is rescued."""
    location, kind = connection.get("cloud_schema_location"), connection["cloud_storage_type"]
    known = remembered_schema(spark, location) if location else None
    files, new = _new_files(spark, path, location if known is not None else None)
    if known is not None and not new:
        return known
    if known is None:
        # The folder, not its files: its subfolders' names may hold columns.
        schema = _load(batch, kind, path).schema
        if new and kind in ("parquet", "orc", "avro"):
            schema = merged(schema, _found_schema(batch, kind, new))
    else:
        body = T.StructType([f for f in known.fields if f.name != RESCUED])
        schema = merged(body, _found_schema(batch, kind, new))
        if schema == body:
            schema = known
    if kind in ("csv", "json") and RESCUED not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    if location:
        if schema != known:
            spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)
        files.select("path").coalesce(1).write.mode("overwrite").parquet(f"{location}/{_SEEN}")
    return schema


def _has_struct(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_struct(kind.elementType)
    return _has_struct(kind.valueType) if isinstance(kind, T.MapType) else isinstance(kind, T.StructType)


def _unknown(text: Column, kind: T.DataType) -> Column:
    """Whether a json text has a field, at any depth, that the type lacks."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(F.from_json(text, "array<string>"), lambda x: _unknown(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.exists(F.map_values(F.from_json(text, "map<string,string>")), lambda x: _unknown(x, kind.valueType)), F.lit(False))
    others = F.array_except(F.json_object_keys(text), F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>"))
    found = F.coalesce(F.size(others) > 0, F.lit(False))
    for f in kind.fields:
        if _has_struct(f.dataType):
            inner = F.from_json(text, T.StructType([T.StructField(f.name, T.StringType())]))
            found = found | _unknown(inner.getField(f.name), f.dataType)
    return found


def _json_lines(reader: Any, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a schema; a line with a field, at any depth, that the schema lacks is kept whole in RESCUED."""
    lines = _load(reader, "text", path)
    line = F.col("value")
    parsed = F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED})
    unknown = _unknown(line, T.StructType([f for f in schema.fields if f.name != RESCUED]))
    rescued = F.coalesce(F.col(f"__row.`{RESCUED}`"), F.when(unknown, line)).alias(RESCUED)
    rows = lines.where(F.length(F.trim(line)) > 0).withColumn("__row", parsed)
    folders = [c for c in lines.columns if c != "value"]  # columns that the folders' names hold

    def column(name: str) -> Column:
        if name in folders:
            return F.col(f"`{name}`")
        return rescued if name == RESCUED else F.col(f"__row.`{name}`").alias(name)

    return rows.select(*[column(f.name) for f in schema.fields])


def _cloud_storage(spark: SparkSession, connection: Mapping[str, Any], streaming: bool) -> DataFrame:
    """Files of any Spark format. Text is read as strings unless a `schema` is given; a
    schema with a _rescued_data column keeps malformed lines there."""
    _needs(connection, "cloud_storage", "cloud_storage_type", "cloud_storage_path")
    kind, path = connection["cloud_storage_type"], connection["cloud_storage_path"]
    options = _text_options(connection)
    batch = spark.read.format(kind).options(**options)
    schema = T.DataType.fromDDL(connection["schema"]) if connection.get("schema") else None
    if streaming:
        if schema is None:
            schema = _stream_schema(spark, connection, batch, path)
        if connection.get("cloud_ingestion_mode") not in (None, "", "directory_listing"):
            warnings.warn("cloud_ingestion_mode has no effect: new files are always found by listing")
        if connection.get("cloud_archive_path"):
            options |= {"cleanSource": "archive", "sourceArchiveDir": connection["cloud_archive_path"]}
        if connection.get("max_files_per_trigger"):
            options["maxFilesPerTrigger"] = str(connection["max_files_per_trigger"])
    if schema is not None and RESCUED in schema.names:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}
    if kind == "csv" and options.get("header") == "true":
        options["enforceSchema"] = "false"  # columns in another order stop the load
    if kind == "json" and schema is not None and RESCUED in schema.names and streaming:
        kept = {k: v for k, v in options.items() if k in ("cleanSource", "sourceArchiveDir", "maxFilesPerTrigger")}
        return _json_lines(spark.readStream.format("text").options(**kept), path, schema)
    reader = (spark.readStream if streaming else spark.read).format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return _load(reader, kind, path)


def _jdbc(spark: SparkSession, connection: Mapping[str, Any], streaming: bool) -> DataFrame:
    """A table or subquery. With a partition column the read runs in parallel ranges."""
    if streaming:
        raise ValueError("a jdbc source can only be read as a snapshot")
    _needs(connection, "jdbc", "url", "dbtable")
    ranged = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    if connection.get("partitionColumn"):
        _needs(connection, "jdbc", *ranged)
    elif not connection.get("single_task"):
        warnings.warn("a jdbc source without partitionColumn is read by a single task; set single_task if it is small")
    fields = ("url", "driver", "dbtable", "fetchsize", *ranged)
    options = {f: str(connection[f]) for f in fields if connection.get(f) not in (None, "")}
    return _load(spark.read.format("jdbc").options(**options), "jdbc")


def _kafka(spark: SparkSession, connection: Mapping[str, Any], streaming: bool) -> DataFrame:
    """Records of one topic as Spark delivers them (binary key and value)."""
    _needs(connection, "kafka", "bootstrap_servers", "topic")
    if connection.get("schema_registry_url"):
        raise ValueError("schema_registry_url is not supported; decode the value column in data_items")
    options = {
        "kafka.bootstrap.servers": connection["bootstrap_servers"],
        "subscribe": connection["topic"],
    }
    if connection.get("starting_offsets"):
        options["startingOffsets"] = connection["starting_offsets"]
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    return _load(reader, "kafka")


def _federated(spark: SparkSession, connection: Mapping[str, Any], streaming: bool) -> DataFrame:
    """A table of another catalog configured in this session (spark.sql.catalog.*). The
    connection name stands for the catalog if no remote catalog is named."""
    _needs(connection, "lakehouse_federation", "remote_table")
    catalog = connection.get("remote_catalog") or connection.get("connection_name")
    parts = [p for p in (catalog, connection.get("remote_schema"), connection["remote_table"]) if p]
    name = ".".join(f"`{p}`" for p in parts)
    return spark.readStream.table(name) if streaming else spark.read.table(name)


register_source("cloud_storage", _cloud_storage)
register_source("jdbc", _jdbc)
register_source("kafka", _kafka)
register_source("lakehouse_federation", _federated)
