"""The registered queries and their DuckDB oracle texts (see
``covspark.queries``)."""

from covspark.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
