"""User-side analysis of enriched events: grouped summaries and line fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_summary(df: DataFrame, by, site: str = "site", value: str = "response") -> DataFrame:
    """Per group: number of distinct sites, number of rows and mean value."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(
        F.count_distinct(site).alias("n_sites"),
        F.count(F.lit(1)).alias("n_events"),
        F.avg(value).alias("mean_value"))


def fit_line(df: DataFrame, y: str, x: str, by=None) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group (all rows when ``by`` is
    None): slope, intercept, R^2 and number of complete pairs."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"),
            F.regr_count(F.col(y), F.col(x)).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
