"""
over whole driver tables (through ``covspark.sources.fixtures``), with the
DuckDB text that recomputes it independently.  Flat rows; doubles rounded to
6 places in both engines so value hashes compare."""

from covspark.queries import analysis, catalogue, jobs, temporal, vector, zonal  # noqa: F401  (registration)
from covspark.queries.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
