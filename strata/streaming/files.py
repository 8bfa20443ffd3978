"""Streamed landing of files that carry their own schema: each micro-batch with the fields of exactly its files."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import RESCUED
from ..functions.schemas import merged
from ..operators.tables import Folders, load_once
from ..sources.readers import remembered_schema
from .history import BATCH, _folders, _read

KINDS = ("parquet", "orc")
#: The paths of a micro-batch go through the driver. A connection may set another number as max_files_per_trigger.
FILES_PER_BATCH = 10_000
_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_SCHEMA = T.StructType([T.StructField("schema", T.StringType())])


def lands_by_batch(spark: SparkSession, connection: Mapping[str, Any], location: str) -> bool:
    """Not where a schema is given, nor where Spark's file sink began a table: its log would hide what is put beside it."""
    if connection.get("cloud_storage_type") not in KINDS or connection.get("schema"):
        return False
    return not Folders(spark).holds(f"{location}/_spark_metadata")


def land_files(
    spark: SparkSession,
    connection: Mapping[str, Any],
    build: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    location: str,
    table: str,
    comment: str | None = None,
) -> None:
    """Lands all files that are new, each once, as loads of the table named by micro-batch.

    A field that no file had before becomes a column. A value of another type than its column has is cast if nothing is
    lost by it; otherwise the column is NULL and the value is kept, as JSON by field, in _rescued_data. What is known of the
    fields after a micro-batch is written beside the checkpoint.
    """
    known_at = f"{checkpoint.rstrip('/')}-fields"

    def land(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        paths = sorted(r["path"] for r in files.collect())
        if not paths:
            return
        known = _known(spark, known_at, batch_id, connection)
        groups = _groups(spark, connection, paths)
        fields = known
        for group in groups:
            fields = merged(fields, T.StructType([f for f in group.schema.fields if f.name != RESCUED]))
        landed = [build(fitted(group, fields)) for group in groups]
        rows = landed[0]
        for more in landed[1:]:
            rows = rows.unionByName(more)
        text = spark.range(0, 1, 1, 1).select(F.lit(fields.json()).alias("schema"))
        text.write.mode("overwrite").parquet(f"{known_at}/{BATCH}={batch_id}")
        load_once(rows, table, location, f"batch-{batch_id}", comment)

    query = (
        _paths(spark, connection)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _paths(spark: SparkSession, connection: Mapping[str, Any]) -> DataFrame:
    """A stream of paths; nothing is read of the files."""
    # Files of subfolders too; what the folders' names hold is read with the files.
    options = {"recursiveFileLookup": "true", "maxFilesPerTrigger": str(connection.get("max_files_per_trigger") or FILES_PER_BATCH)}
    if connection.get("cloud_archive_path"):
        options |= {"cleanSource": "archive", "sourceArchiveDir": connection["cloud_archive_path"]}
    reader = spark.readStream.format("binaryFile").schema(_FILE).options(**options)
    return reader.load(connection["cloud_storage_path"]).select("path")


def _known(spark: SparkSession, known_at: str, batch_id: int, connection: Mapping[str, Any]) -> T.StructType:
    everything = _read(spark, known_at, T.StructType([*_SCHEMA.fields, T.StructField(BATCH, T.LongType())]))
    before = [batch for (batch,) in _folders(everything, BATCH) if batch < batch_id]
    if before:
        return T.StructType.fromJson(json.loads(_read(spark, f"{known_at}/{BATCH}={max(before)}", _SCHEMA).first()["schema"]))
    location = connection.get("cloud_schema_location")
    found = remembered_schema(spark, location) if location else None
    return T.StructType([f for f in (found or T.StructType([])).fields if f.name != RESCUED])


def _groups(spark: SparkSession, connection: Mapping[str, Any], paths: list[str]) -> list[DataFrame]:
    """The files as frames, as few as types that do not go together allow."""
    source = connection["cloud_storage_path"]
    plain = re.split(r"[*?\[{]", source)[0]
    if plain != source or not Folders(spark).is_folder(source):
        plain = plain.rsplit("/", 1)[0]
    reader = spark.read.format(connection["cloud_storage_type"]).option("mergeSchema", "true").option("basePath", plain)

    def read(some: list[str]) -> list[DataFrame]:
        try:
            return [reader.load([re.sub(r"([*?\[\]{}\\])", r"\\\1", path) for path in some])]
        except Exception as error:
            if len(some) == 1 or not ("CANNOT_MERGE" in str(error) or "Failed to merge" in str(error)):
                raise
        return read(some[: len(some) // 2]) + read(some[len(some) // 2 :])

    return read(paths)


def _fits(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether a file's type is the wanted one but for fields that it lacks."""
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        types = {f.name.lower(): f.dataType for f in wanted.fields}
        return all(f.name.lower() in types and _fits(f.dataType, types[f.name.lower()]) for f in found.fields)
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _fits(found.elementType, wanted.elementType)
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType):
        return found.keyType == wanted.keyType and _fits(found.valueType, wanted.valueType)
    return found == wanted


_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _castable(found: T.DataType, wanted: T.DataType) -> bool:
    both = isinstance(found, _PLAIN) and isinstance(wanted, _PLAIN)
    return both and (isinstance(found, T.NumericType) and isinstance(wanted, T.NumericType) or T.StringType() in (found, wanted))


def fitted(df: DataFrame, fields: T.StructType) -> DataFrame:
    """The frame of some files with these fields and _rescued_data. It stays a projection of the files, whose hidden metadata
    can be read."""
    there = {f.name.lower(): f for f in df.schema.fields if f.name != RESCUED}
    columns, rescued = [], []
    for f in fields.fields:
        own = there.get(f.name.lower())
        if own is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        column = F.col(f"`{own.name}`")
        if own.dataType == f.dataType:
            columns.append(column.alias(f.name))
        elif _fits(own.dataType, f.dataType):
            columns.append(_grown(column, own.dataType, f.dataType).alias(f.name))
        else:
            value = F.lit(None).cast(f.dataType)
            if _castable(own.dataType, f.dataType):
                cast = column.try_cast(f.dataType)
                value = F.when(cast.try_cast(own.dataType).eqNullSafe(column), cast)
            columns.append(value.alias(f.name))
            rescued.append(F.when(value.isNull(), column).alias(f.name))
    kept = [F.col(f"`{RESCUED}`").cast("string")] if RESCUED in df.columns else []
    if rescued:
        some = rescued[0].isNotNull()
        for c in rescued[1:]:
            some = some | c.isNotNull()
        kept.append(F.when(some, F.to_json(F.struct(*rescued))))
    text = F.coalesce(*kept) if kept else F.lit(None).cast("string")
    return df.select(*columns, text.alias(RESCUED))


def _grown(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """The value with the fields, NULL, that its type lacks at any depth."""
    if found == wanted:
        return value
    if isinstance(wanted, T.StructType):
        own = {f.name.lower(): f for f in found.fields}
        parts = []
        for f in wanted.fields:
            has = own.get(f.name.lower())
            part = _grown(value.getField(has.name), has.dataType, f.dataType) if has else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _grown(x, found.elementType, wanted.elementType))
    return F.transform_values(value, lambda _, x: _grown(x, found.valueType, wanted.valueType))
