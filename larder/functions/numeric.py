"""Small column expressions shared by features, metrics and replenishment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.schemas import EPS


def nan_to_null(c: Column) -> Column:
    """NaN compares as the largest double in Spark; missing values must be NULL."""
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def log1p(c: Column) -> Column:
    """NULL at and below -1, where the logarithm does not exist."""
    c = c.cast("double")
    return F.when(c > -1, F.log1p(c))


def variation(std: Column, mean: Column) -> Column:
    """Coefficient of variation; the small term keeps an empty series finite.

    A mean of exactly -1e-6 would divide by zero: NULL instead of an error.
    """
    return F.try_divide(std, mean + F.lit(EPS))


def all_present(names: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def present(df: DataFrame, names) -> list[str]:
    """Those of the names that the frame has."""
    return [n for n in names if n in df.columns]


def in_range(c: Column, low: float, high: float) -> Column:
    """Open interval."""
    return (c > F.lit(low)) & (c < F.lit(high))
