"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FIELD_SEPARATOR

# Fixed value: 15 hex digits are 60 bits, so the key is never negative.
_HEX_DIGITS = 15


def surrogate_key(columns: Sequence[str], separator: str = FIELD_SEPARATOR) -> Column:
    """Integer key from the md5 of the joined column texts.

    NULL parts are skipped by the join and a part may contain the separator, so
    ('a', NULL) equals (NULL, 'a') and ('a||b', 'c') equals ('a', 'b||c'). The text of a
    zoned timestamp follows the session time zone: keep that at UTC.
    """
    joined = F.concat_ws(separator, *(F.col(f"`{c}`").cast("string") for c in columns))
    return F.conv(F.left(F.md5(joined), F.lit(_HEX_DIGITS)), 16, 10).cast("bigint")


def whole_key(columns: Sequence[str]) -> Column:
    """The key as one text that no other key has: each part with its length in bytes, NULL as a dash."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def key_collisions(df: DataFrame, columns: Sequence[str], skey: str) -> DataFrame:
    """The surrogate keys that rows of different business keys share: skey, least_key, greatest_key, as
    whole_key writes them.

    One aggregate with map-side combine, two texts per key in a shuffle. NULL surrogate keys are not compared.
    """
    whole = df.select(F.col(f"`{skey}`").alias("skey"), whole_key(columns).alias("whole")).where("skey IS NOT NULL")
    ends = whole.groupBy("skey").agg(F.min("whole").alias("least_key"), F.max("whole").alias("greatest_key"))
    return ends.where("least_key <> greatest_key")
