"""Text in many layouts to timestamps, without ANSI errors."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted layouts. The order decides ambiguous text (03/05/2024 is
# 5 March, 05-03-2024 is 5 March).
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd'T'HH:mm:ssX",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy",
    "yyyyMMdd HHmmss",
    "yyyyMMdd",
)

# What text a layout letter can match at all. Trying a layout on text that it cannot read
# costs twenty times as much as this check. Years stop where every moment of them still fits a
# timestamp, 290307 BC and AD 294246: one that overflows makes even try_to_timestamp fail, and
# with it the job.
_SHAPES = {
    "yyyy": (
        r"(?:\+?0*(?:\d{4,5}|1\d{5}|2[0-8]\d{4}|29[0-3]\d{3}|294[01]\d{2}|2942[0-3]\d|29424[0-6])"
        r"|-0*(?:\d{4,5}|1\d{5}|2[0-8]\d{4}|290[0-2]\d{2}|29030[0-7]))"
    ),
    "SSSSSS": r"\d{1,6}",
    "SSS": r"\d{1,3}",
    "X": r"(?:Z|[+-]\d\d(?:\d\d)?)",
    "'T'": "T",
    **dict.fromkeys(("MM", "dd", "HH", "mm", "ss"), r"\d\d"),
}


def _shape(layout: str) -> str:
    """A pattern that holds for every text the layout can read (and for some others)."""
    letters = "|".join(sorted(_SHAPES, key=len, reverse=True))
    parts = re.findall(f"{letters}|.", layout)
    return "(?i)^" + "".join(_SHAPES.get(part) or re.escape(part) for part in parts) + "$"


# The cast of last resort would read a bare time as "today"; only text that begins
# with a year may reach it.
_STARTS_WITH_YEAR = r"^\s*[0-9]{4}(-|\s*$)"


def parse_timestamp(text: Column) -> Column:
    """First layout of TIMESTAMP_FORMATS that fits, then a plain cast, else NULL."""
    by_layout = (
        F.when(text.rlike(_shape(layout)), F.try_to_timestamp(text, F.lit(layout))) for layout in TIMESTAMP_FORMATS
    )
    by_cast = F.when(text.rlike(_STARTS_WITH_YEAR), text.try_cast("timestamp"))
    return F.coalesce(*by_layout, by_cast)


# Epoch seconds whose microseconds fit 64 bits.
_MOST_SECONDS = (2**63 - 1) // 1_000_000


def column_as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp, whatever its type: timestamps pass through, dates and
    numbers (epoch seconds) are cast, text is parsed. Numbers that no timestamp holds are an
    error: a cast would give them all the same moment."""
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(kind, T.StringType):
        return parse_timestamp(column)
    stamp = column.cast("timestamp")
    if isinstance(kind, (T.LongType, T.DecimalType)):
        message = F.concat(F.lit(f"{name}: not epoch seconds that a timestamp can hold: "), column.cast("string"))
        fits = column.between(F.lit(-_MOST_SECONDS), F.lit(_MOST_SECONDS))
        return F.when(column.isNull() | fits, stamp).otherwise(F.raise_error(message).cast("timestamp"))
    return stamp


def column_as_sequence(df: DataFrame, name: str) -> Column:
    """The column as something that orders changes: numbers as they are, all else as a timestamp."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(f"`{name}`").cast("bigint")
    if isinstance(kind, T.NumericType):
        return F.col(f"`{name}`")
    return column_as_timestamp(df, name)
