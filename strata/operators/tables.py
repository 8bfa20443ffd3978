"""Catalog tables at explicit locations, without a transactional table format."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import IS_CURRENT
from ..functions.schemas import merged
from .columns import named

WRITE_MODES = ("materialized_view", "streaming_table", "permanent_table")


class Folders:
    """Folders of a shared file system, found by pattern and removed one by one."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _files(self, pattern: str) -> tuple[Any, list[Any]]:
        path = self.jvm.org.apache.hadoop.fs.Path(pattern)
        files = path.getFileSystem(self.conf)
        return files, list(files.globStatus(path) or ())

    def remove(self, pattern: str, dead: Callable[[str], bool]) -> int:
        files, found = self._files(pattern)
        gone = [f.getPath() for f in found if dead(f.getPath().toString())]
        for path in gone:
            files.delete(path, True)
        return len(gone)

    def holds(self, path: str) -> bool:
        return bool(self._files(path)[1])

    def is_folder(self, path: str) -> bool:
        found = self._files(path)[1]
        return bool(found) and found[0].isDirectory()

    def mark(self, path: str) -> None:
        """An empty file; no error if it is there."""
        files, _ = self._files(path)
        files.create(self.jvm.org.apache.hadoop.fs.Path(path), True).close()

    def move(self, pattern: str, folder: str) -> int:
        files, found = self._files(pattern)
        for f in found:
            target = self.jvm.org.apache.hadoop.fs.Path(folder, f.getPath().getName())
            if not files.rename(f.getPath(), target):
                raise OSError(f"cannot move {f.getPath()} to {target}")
        return len(found)

    def remove_older(self, pattern: str, keep: int) -> int:
        """All but the `keep` that were changed last."""
        files, found = self._files(pattern)
        found.sort(key=lambda f: (f.getModificationTime(), f.getPath().toString()))
        gone = found[: max(0, len(found) - keep)]
        for f in gone:
            files.delete(f.getPath(), True)
        return len(gone)


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, table: str) -> None:
    parent = table.rsplit(".", 1)[0] if "." in table else None
    if parent:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(parent)}")


def set_comment(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {quoted(table)} IS {literal(comment)}")


def replaces_kind(spark: SparkSession, table: str, kind: str) -> None:
    """Drops a table where a view is to stand, and the other way round. Files stay."""
    name = quoted(table)
    if not spark.catalog.tableExists(name):
        return
    held = spark.catalog.getTable(name).tableType
    if held == "MANAGED" and kind == "VIEW":
        raise ValueError(f"{table}: a managed table stands there; its files would go with it")
    if (held == "VIEW") != (kind == "VIEW"):
        spark.sql(f"DROP {'VIEW' if held == 'VIEW' else 'TABLE'} {name}")


def ensure_table(spark: SparkSession, like: DataFrame, table: str, location: str, comment: str | None = None) -> None:
    """Creates the table if it is not there. Safe to repeat."""
    ensure_schema(spark, table)
    if not spark.catalog.tableExists(quoted(table)):
        spark.catalog.createTable(quoted(table), path=location, source="parquet", schema=like.schema)
    set_comment(spark, table, comment)


def grow_table(df: DataFrame, table: str) -> list[str]:
    """Adds the columns that the frame has besides, as the last ones, and what its structs have besides; the
    table's columns after that.

    A column that changed its type is an error.
    """
    spark, name = df.sparkSession, quoted(table)
    given = {f.name.lower(): f.dataType for f in df.schema.fields}
    schema = spark.table(name).schema
    grown = T.StructType([T.StructField(f.name, merged(f.dataType, given.get(f.name.lower(), f.dataType)), f.nullable, f.metadata) for f in schema.fields])
    if grown != schema and all(f.dataType == given.get(f.name.lower(), f.dataType) for f in grown.fields):
        _remake(spark, table, grown)
    held = {f.name.lower(): f for f in spark.table(name).schema.fields}
    more = [f for f in df.schema.fields if f.name.lower() not in held]
    if more:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in more)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    changed = [f.name for f in df.schema.fields if f.name.lower() in held and f.dataType != held[f.name.lower()].dataType]
    if changed:
        raise ValueError(f"{table}: cannot append, types differ: {', '.join(changed)}")
    return spark.table(name).columns


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}


def _remake(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """The table's entry anew with another schema, over the same files. Structs can't be altered in place."""
    facts = _facts(spark, table)
    if facts.get("Type") != "EXTERNAL" or facts.get("Provider", "").lower() != "parquet" or "# Partition Information" in facts:
        raise ValueError(f"{table}: types differ, and only external parquet tables without partitions can have structs that grow")
    spark.sql(f"DROP TABLE {quoted(table)}")
    spark.catalog.createTable(quoted(table), path=facts["Location"], source="parquet", schema=schema)
    set_comment(spark, table, facts.get("Comment"))


def append_table(df: DataFrame, table: str, location: str, comment: str | None = None) -> None:
    """Appends by name. New columns are added to the table, NULL in its older rows; columns that the
    frame lacks are NULL in the new ones."""
    # Appending goes by position.
    _as_table(df, table, location, comment).write.mode("append").insertInto(quoted(table))


def _as_table(df: DataFrame, table: str, location: str, comment: str | None) -> DataFrame:
    """The frame with the columns of the table, which is made and grown as needed."""
    spark = df.sparkSession
    ensure_table(spark, df, table, location, comment)
    columns = grow_table(df, table)
    there = {c.lower() for c in df.columns}
    types = {f.name: f.dataType for f in spark.table(quoted(table)).schema.fields}
    return df.select(*(named(c) if c.lower() in there else F.lit(None).cast(types[c]).alias(c) for c in columns))


def load_once(df: DataFrame, table: str, location: str, load_id: str, comment: str | None = None) -> bool:
    """Appends the rows as the load of that id, once however often it is run. False if the load was in the table.

    A load is written beside the table, sealed, and then entered by moving its files:

        <location>/_loads/<id>/rows      not read by anyone; written anew if a run ends before the seal
        <location>/_loads/<id>/_sealed   from here on a run with this id only moves what is not moved yet
        <location>/_loads/<id>/_entered  nothing more to do

    So the rows are those of the run that sealed the load. Files are moved one by one, as a commit of Spark's does it: a
    reader in that moment may see a part of the load. Two runs of one id must not overlap.
    """
    if not stage_load(df, table, location, load_id, comment):
        return False
    enter_load(df.sparkSession, table, load_id)
    return True


def _load_folder(spark: SparkSession, table: str, load_id: str) -> tuple[str, str]:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"{table}: a load id has letters, digits, dots, dashes and underscores, not {load_id!r}")
    location = _facts(spark, table)["Location"].rstrip("/")
    return location, f"{location}/_loads/{load_id}"


def stage_load(df: DataFrame, table: str, location: str, load_id: str, comment: str | None = None) -> bool:
    """First half of load_once: written and sealed, not in the table. False if the load was entered before."""
    spark, files = df.sparkSession, Folders(df.sparkSession)
    ensure_table(spark, df, table, location, comment)
    _, load = _load_folder(spark, table, load_id)
    if files.holds(f"{load}/_entered"):
        return False
    if not files.holds(f"{load}/_sealed"):
        _as_table(df, table, location, comment).write.mode("overwrite").parquet(f"{load}/rows")
        files.mark(f"{load}/_sealed")
    return True


def enter_load(spark: SparkSession, table: str, load_id: str) -> None:
    """Second half of load_once."""
    location, load = _load_folder(spark, table, load_id)
    files = Folders(spark)
    if not files.holds(f"{load}/_sealed"):
        raise ValueError(f"{table}: load {load_id} is not written")
    files.move(f"{load}/rows/part-*", location)
    files.mark(f"{load}/_entered")
    spark.catalog.refreshTable(quoted(table))


def replace_table(df: DataFrame, table: str, location: str, comment: str | None = None, keep: int | None = None) -> None:
    """Full recompute: writes a fresh folder, then points the table at it. A reader sees the
    old rows or the new ones. Older folders stay for readers still running: all of them, or the
    newest `keep` with the one in use."""
    spark = df.sparkSession
    version = f"{location.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(version)
    ensure_schema(spark, table)
    name = quoted(table)
    replaces_kind(spark, table, "TABLE")
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(version)}")
        spark.catalog.refreshTable(name)
    else:
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=version, source="parquet", schema=df.schema)
    set_comment(spark, table, comment)
    if keep is not None:
        Folders(spark).remove_older(f"{location.rstrip('/')}/version=*", max(1, keep))


def create_current_view(spark: SparkSession, table: str, view_name: str | None = None) -> str:
    """A view of the current versions, beside the table unless its name says otherwise."""
    parent, _, short = table.rpartition(".")
    view = view_name or f"vw_{short}_current"
    if parent and "." not in view:
        view = f"{parent}.{view}"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT * FROM {quoted(table)} WHERE {IS_CURRENT} = TRUE")
    return view
