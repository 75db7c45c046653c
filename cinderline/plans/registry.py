"""The queries of the library's own operators, by name, and the SQL that states what each returns."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
