"""Reading and writing ORC files as declared tables."""

from .table import OrcTable, Server, TableError

__all__ = ["OrcTable", "Server", "TableError"]
