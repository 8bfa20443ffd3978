"""The raw hop: append-only landing with two audit columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LOADED_AT, SOURCE_UPDATED_AT
from ..functions.timestamps import column_as_timestamp

INGESTION_MODES = ("snapshot", "streaming")
MERGE_STRATEGIES = ("append", "overwrite", "upsert")


def check_raw_modes(ingestion_mode: str, merge_strategy: str, label: str = "raw") -> None:
    """Raw keeps every load: no upsert at all, and a stream cannot overwrite."""
    if ingestion_mode not in INGESTION_MODES:
        raise ValueError(f"{label}: ingestion_mode must be one of {INGESTION_MODES}, not {ingestion_mode!r}")
    if merge_strategy not in MERGE_STRATEGIES:
        raise ValueError(f"{label}: merge_strategy must be one of {MERGE_STRATEGIES}, not {merge_strategy!r}")
    if merge_strategy == "upsert":
        raise ValueError(f"{label}: a raw table only appends; upserts belong to the cdc hop")
    if merge_strategy == "overwrite" and ingestion_mode == "streaming":
        raise ValueError(f"{label}: a streaming raw table cannot be overwritten")


@dataclass(frozen=True)
class RawSpec:
    data_items: Sequence[str] | None = None
    filter: str | None = None
    source_updated_at_col: str | None = None


def raw(source: DataFrame, spec: RawSpec = RawSpec()) -> DataFrame:
    """Filter, projection and audit columns over a batch or streaming source.

    Without a source column, the time is that of the file, so the source must be
    file-based and its files still visible as hidden metadata.
    """
    df = source.where(F.expr(spec.filter)) if spec.filter else source
    if spec.data_items:
        df = df.selectExpr(*spec.data_items)
    if spec.source_updated_at_col:
        updated = column_as_timestamp(df, spec.source_updated_at_col)
    else:
        updated = F.col("_metadata.file_modification_time")
    return df.withColumns({SOURCE_UPDATED_AT: updated, LOADED_AT: F.current_timestamp()})
