from .readers import read_source, register_source, source_types

__all__ = ["read_source", "register_source", "source_types"]
