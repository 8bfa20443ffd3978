"""Example queries over the sample tables, each with the SQL it must agree with."""

from .base import Query
from .gold import QUERIES as GOLD
from .history import QUERIES as HISTORY
from .landing import QUERIES as LANDING
from .processed import QUERIES as PROCESSED
from .registry import QUERIES as REGISTRY

ALL: dict[str, Query] = {**LANDING, **HISTORY, **PROCESSED, **GOLD, **REGISTRY}
