"""Registration of queries and their DuckDB oracle texts, and the fixed
parameters shared by both engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered zonal queries (fixed so both engines agree).
RADIUS_M = 250000.0
N_DAYS = 30
CELL_HALF_DEG = 0.5


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(F.col(c).cast("double"), 6).alias(c)
