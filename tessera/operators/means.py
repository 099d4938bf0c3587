"""Means and counts over a nullable column.

The reference uses two different means and both are kept, under separate
names:

* ``mean_skip_missing``: divide by the number of present values;
* ``mean_missing_as_zero``: missing counts as 0 and every row counts in the
  denominator.

Sums are exact and rounded once (``exact_sums``), so neither order nor
partitions change a value. Each is an aggregate with map-side partials: the
shuffle carries at most 71 rows per task, whatever the data size. Empty input
gives a null mean. The ``*_expr`` columns are Spark's own floating-point
aggregates for use inside other aggregates; their last digits follow the order
of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact_sums import exact_sums


def mean_skip_missing_expr(value: str) -> Column:
    return F.avg(F.col(value))


def mean_missing_as_zero_expr(value: str) -> Column:
    total = F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    return F.try_divide(total, F.count(F.lit(1)).cast("double"))


def mean_skip_missing(df: DataFrame, value: str, name: str = "mean") -> DataFrame:
    return exact_sums(df, value).select(F.col("mean_present").alias(name))


def mean_missing_as_zero(df: DataFrame, value: str, name: str = "mean") -> DataFrame:
    return exact_sums(df, value).select(F.col("mean_all_rows").alias(name))


def sum_skip_missing(df: DataFrame, value: str, name: str = "sum") -> DataFrame:
    """Sum of present values; 0 when there are none."""
    return exact_sums(df, value).select(F.col("sum").alias(name))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Rows, missing values included."""
    return df.agg(F.count(F.lit(1)).alias(name))


def both_means(df: DataFrame, value: str) -> DataFrame:
    """Both definitions side by side, with their numerators and denominators,
    in one pass."""
    return exact_sums(df, value)
