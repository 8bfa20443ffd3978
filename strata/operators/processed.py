"""The processed hop: casts, cleansing, surrogate key and audit columns in one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    END_AT,
    END_OF_TIME,
    FIELD_SEPARATOR,
    IS_CURRENT,
    LOADED_AT,
    PROCESSED_AT,
    RESCUED,
    SOURCE_UPDATED_AT,
    START_AT,
)
from ..functions.casts import lenient_cast
from ..functions.keys import surrogate_key
from .columns import named


@dataclass(frozen=True)
class ColumnRule:
    """One entry of a `columns` list. Constraint fields are read by `expectations`."""

    target_col: str
    source_col: str | None = None
    expression: str | None = None
    data_type: str | None = None
    strict: bool = False
    is_nullable: bool = True
    is_audit_col: bool = False
    constraint_name: str | None = None
    constraint_expression: str | None = None
    constraint_on_violation: str | None = None

    @staticmethod
    def read(entry: Mapping[str, Any]) -> ColumnRule | None:
        """None for an entry that names nothing to build; an error for one that would
        make its source column vanish."""
        known = {k: v for k, v in entry.items() if k in ColumnRule.__dataclass_fields__ and v is not None}
        unknown = set(entry) - set(ColumnRule.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown fields in a column entry: {sorted(unknown)}")
        if not known.get("target_col"):
            if known.get("source_col"):
                raise ValueError(f"column entry for {known['source_col']!r} has no target_col")
            return None
        if not known.get("source_col") and not known.get("expression"):
            return None
        return ColumnRule(**known)

    def value(self) -> Column:
        return F.expr(self.expression) if self.expression else named(self.source_col)


def build_columns(df: DataFrame, rules: Sequence[ColumnRule]) -> dict[str, Column]:
    """Target name -> expression. A value that does not fit the type is NULL, or an error
    under `strict`."""
    if not rules:
        return {}
    kinds = df.select(*(rule.value().alias(rule.target_col) for rule in rules)).schema
    built = {}
    for rule, field_ in zip(rules, kinds.fields):
        value = rule.value()
        if rule.data_type and rule.strict:
            value = value.cast(rule.data_type)
        elif rule.data_type:
            value = lenient_cast(value, field_.dataType, rule.data_type)
        built[rule.target_col] = value
    return built


def read_rules(entries: Iterable[Mapping[str, Any]] | None) -> tuple[ColumnRule, ...]:
    rules = (ColumnRule.read(entry) for entry in entries or ())
    return tuple(rule for rule in rules if rule is not None)


@dataclass(frozen=True)
class ProcessedSpec:
    columns: Sequence[ColumnRule] = ()
    business_key_columns: Sequence[str] = ()
    skey_column: str | None = None
    leading_columns: Sequence[str] = ()
    end_of_time: str = END_OF_TIME
    separator: str = FIELD_SEPARATOR
    dropped: Sequence[str] = field(default=(RESCUED,))


def has_versions(df: DataFrame) -> bool:
    """Type 2 tables are known by their columns, not by configuration."""
    return START_AT in df.columns


def skey_of(df: DataFrame, spec: ProcessedSpec) -> Column:
    """Key of the row: of the version for type 2, of the business key for type 1."""
    parts = [*spec.business_key_columns, *([START_AT] if has_versions(df) else [])]
    return surrogate_key(parts, spec.separator)


def _forever(kind: T.DataType, end_of_time: str) -> Column:
    """The end of a current version: the configured time, or the largest number of the type."""
    if isinstance(kind, T.LongType):
        return F.lit(2**63 - 1)
    if isinstance(kind, T.DecimalType):
        return F.lit("9" * (kind.precision - kind.scale) + "." + "9" * kind.scale).cast(kind)
    if isinstance(kind, T.FractionalType):
        return F.lit(float("inf")).cast(kind)
    return F.lit(end_of_time).cast(kind)


def audit_columns(df: DataFrame, end_of_time: str = END_OF_TIME) -> dict[str, Column]:
    """The audit columns of the processed hop, in table order."""
    audit = {c: named(c) for c in (SOURCE_UPDATED_AT, LOADED_AT) if c in df.columns}
    audit[PROCESSED_AT] = F.current_timestamp()
    if has_versions(df):
        forever = _forever(df.schema[START_AT].dataType, end_of_time)
        audit[EFFECTIVE_FROM] = named(START_AT)
        audit[EFFECTIVE_TO] = F.coalesce(named(END_AT), forever)
        audit[IS_CURRENT] = named(END_AT).isNull()
    return audit


def processed(df: DataFrame, spec: ProcessedSpec) -> DataFrame:
    """Select list: surrogate key, untouched columns, user columns, audit columns. Then
    the leading columns move to the front. A user column replaces an untouched one of
    the same name."""
    user = build_columns(df, spec.columns)
    audit = audit_columns(df, spec.end_of_time)
    handled = {rule.source_col for rule in spec.columns}
    handled |= {START_AT, END_AT, SOURCE_UPDATED_AT, LOADED_AT, *spec.dropped, *user}

    select: dict[str, Column] = {}
    if spec.skey_column and spec.business_key_columns:
        select[spec.skey_column] = skey_of(df, spec)
    select |= {c: named(c) for c in df.columns if c not in handled and c not in select}
    select |= user
    select |= audit
    order = [c for c in spec.leading_columns if c in select]
    order += [c for c in select if c not in order]
    return df.select(*(select[c].alias(c) for c in order))
