from .casts import lenient_cast
from .keys import surrogate_key
from .timestamps import TIMESTAMP_FORMATS, column_as_sequence, column_as_timestamp, parse_timestamp

__all__ = ["TIMESTAMP_FORMATS", "column_as_sequence", "column_as_timestamp", "lenient_cast", "parse_timestamp", "surrogate_key"]
