"""Lag and rolling features of daily series."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.functions import numeric
from larder.operators import rollup
from larder.operators.star import PRODUCT_GROUP, STORE_GROUP, Star
from larder.schemas import LAGS, LEVELS


def series_features(daily: DataFrame, keys, target: str = "sales_qty") -> DataFrame:
    """Append lags 1 to 7, rolling mean, deviation and variation, and the log target.

    Lags count rows, not days: a day without a sale is skipped over. All of them
    share one window, so there is one exchange and one sort, and a series has at
    most one row a day however many sales are behind it. Rows whose seventh lag
    is missing are dropped, so for the rows that remain the seven lags are the
    rolling frame itself, and its statistics are plain arithmetic on them.
    """
    w = Window.partitionBy(*keys).orderBy("full_date")
    lagged = daily.withColumns({
        name: F.lag(target, i).over(w) for i, name in enumerate(LAGS, start=1)
    })
    return rolling_statistics(lagged.where(F.col(LAGS[-1]).isNotNull())).withColumn(
        "log_sales_qty", numeric.log1p(F.col(target))
    )


def rolling_statistics(lagged: DataFrame) -> DataFrame:
    """Mean, sample deviation (0 for a single value) and variation of the present lags."""
    values = [F.col(name) for name in LAGS]
    n = reduce(add, [v.isNotNull().cast("int") for v in values])
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values])
    averaged = lagged.withColumn("rolling_mean_7", F.try_divide(total, n))
    mean = F.col("rolling_mean_7")
    squares = reduce(add, [F.coalesce((v - mean) * (v - mean), F.lit(0.0)) for v in values])
    spread = F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0))
    return averaged.withColumn("rolling_std_7", spread).withColumn(
        "cv_7", numeric.variation(F.col("rolling_std_7"), mean)
    )


def level_features(star: Star, level: str) -> DataFrame:
    """The feature table of one level. A series with a missing key has no features.

    The windows run over integer stand-ins of the groups; names come after.
    """
    keys = LEVELS[level]
    cells = series_features(rollup.level_cells(star, keys), (PRODUCT_GROUP, STORE_GROUP))
    return rollup.with_level_keys(star, cells, keys).where(numeric.all_present(keys))


def all_level_features(star: Star, step: Callable[[DataFrame, tuple[str, ...]], DataFrame] | None = None) -> DataFrame:
    """The feature tables of the six levels in one long table, with one window pass.

    A step is applied to the features and the stand-ins that part their series before
    names are attached, when the rows of a series by store are still in one task.
    """
    parts = [
        series_features(cells, keys) if step is None else step(series_features(cells, keys), keys)
        for cells, keys in rollup.level_parts(star)]
    complete = F.lit(False)
    for level, keys in LEVELS.items():
        complete = complete | ((F.col("level") == level) & numeric.all_present(keys))
    return rollup.with_all_keys(star, reduce(DataFrame.unionByName, parts)).where(complete)
