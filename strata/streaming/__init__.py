from .history import HistoryStore
from .ingest import land_stream, read_hop

__all__ = ["HistoryStore", "land_stream", "read_hop"]
